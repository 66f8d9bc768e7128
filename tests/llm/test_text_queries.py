"""The registered queries, and the pipeline stage by stage."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest_rows import compared
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from riskrules.llm.common import table
from riskrules.llm.queries import ORACLES, QUERIES
from riskrules.session import cut


def test_registered():
    found = entry_points.queries()
    assert QUERIES.keys() <= found.keys() and "pipeline" in found
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys() & entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, folder, name):
    tables = {"op5_url_verdicts": "pages", "op6_licenses": "documents", "op11_centroids": "embeddings", "op12_chat_trees": "conversations", "op13_conversation_trie": "conversations"}
    compared(QUERIES[name](spark, folder), ORACLES[name], **{tables[name]: table(spark, folder, tables[name])})


def test_pipeline(spark, folder):
    docs = table(spark, folder, "documents")
    columns, sizes = docs.columns, []
    kept = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, folder))
        rows = docs.collect()
        assert docs.columns == columns
        assert all(kept[r.doc_id] == r for r in rows)  # rows are kept as they are
        if name != "mixing":
            assert len({r.doc_id for r in rows}) == len(rows)
        kept = {r.doc_id: r for r in rows}
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] > 0.75 * sizes[0]
    times = Counter(r.doc_id for r in rows)
    assert max(times.values()) <= 3
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).orderBy("start").collect()
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode_batch([kept[r.doc_id].text for r in last], add_special_tokens=False)
    assert Counter(r.doc_id for r in last) == times
    assert [r.doc_id for r in last] == sorted(r.doc_id for r in last)
    assert [(r.n_tokens, r.ids_crc32) for r in last] == [(len(e.ids) + 1, zlib.crc32(np.array([*e.ids, 1], "<u4").tobytes())) for e in ids]
    key = lambda rs: sorted(map(tuple, rs))
    assert key(corpus_pipeline.run(spark, folder).collect()) == key(last)
