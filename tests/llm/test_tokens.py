"""Token files as an exact round trip, token counts against the tokenizer library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from riskrules.llm import token_counts, token_files
from riskrules.llm.common import prepared, table
from riskrules.llm.subwords import Encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n\t ", "Plain words, twice: plain words!", "don't DON'T it's'll ''s 'S", "É é e\u0301 ÀÇ ß ẞ İ ﬁ ª ǅ Å", "ΣΑΣ σας", "日本語 テスト", "a\x1cb \x85 \u2003 \u00a0x",
    "<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", "1a2b ３ Ⅷ ½", "👍🏽 e👍", "\ufeff\u200bzero", "A" * 5000, "x  y   z    ", "<0x0A> <unk> </s> ▁▁ a▁b", "\u0301start",
]


def ids_of(texts):
    return [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


def test_word_by_word_is_the_whole_text(spark, folder):
    texts = ODD + [" ".join(ODD)] + [r.text for r in table(spark, folder, "documents").limit(300).collect()]
    one = Encoder(WORDS)
    assert one.short
    for _ in range(2):  # new and remembered
        for text, wanted in zip(texts, ids_of(texts)):
            assert np.frombuffer(one.encode(text.encode()), one.kind).tolist() == wanted, text[:80]
    long_way = Encoder(WORDS)
    long_way.short = False
    assert [long_way.encode(t.encode()) for t in texts] == [one.encode(t.encode()) for t in texts]


def test_round_trip(spark, docs_of, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 200)
    rows = [(7 * i % 53, t) for i, t in enumerate(ODD)] + [(900, "word " * 30_000), (None, "no id"), (3000, None), (14, "again"), (14, "again")]
    docs = docs_of(rows, extra=("start", "n_tokens", "part", "h"))
    where = token_files.folder_for(spark)
    token_files.write(docs, where, WORDS)
    found = token_files.read(spark, where).orderBy("start").collect()
    assert [r.start for r in found] == np.concatenate(([0], np.cumsum([r.n_tokens for r in found])[:-1])).tolist()
    ids = [r.doc_id if r.doc_id is not None else -1 for r in found]
    assert ids == sorted(ids) and ids[0] == -1
    wanted = [(d if d is not None else -1, len(i) + 1, zlib.crc32(np.array([*i, 1], "<u4").tobytes())) for (d, _), i in zip(rows, ids_of([t or "" for _, t in rows]))]
    assert sorted(zip(ids, [r.n_tokens for r in found], [r.ids_crc32 for r in found])) == sorted(wanted)
    assert token_files.one(spark, where, 900) == [ids_of(["word " * 30_000])[0] + [1]]
    assert token_files.one(spark, where, 14).count(ids_of(["again"])[0] + [1]) == 2 and token_files.one(spark, where, -5) == []
    data = spark.read.parquet(f"{where}/blocks").first().block
    with pytest.raises(ValueError):
        token_files.Block(bytes(data), b"another")


def test_empty_table(spark, docs_of):
    where = token_files.folder_for(spark)
    token_files.write(docs_of([]), where, WORDS)
    assert token_files.read(spark, where).count() == 0
    assert token_counts.counted(docs_of([]), PIECES).count() == 0


def unigram(vocabulary, bytes_known):
    names = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256 if bytes_known else 0)), *vocabulary.items()]
    return Tokenizer(models.Unigram(names, 0, bytes_known))


def test_counts_of_given_texts(spark, folder, docs_of):
    texts = [t for t in ODD if "<0x" not in t] + [r.text for r in table(spark, folder, "documents").limit(200).collect()]
    known = token_counts.Vocabulary.of(PIECES)
    whole = unigram(known.pieces, True)
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000, None), (None, "x")]
    found = {r.doc_id: r for r in token_counts.counted(docs_of(rows, extra=("n_tokens", "score")), PIECES).collect()}
    for i, t in enumerate(texts):
        assert found[i].n_tokens == (len(whole.encode("▁" + t.replace(" ", "▁")).ids) if t else 0), t[:80]
    assert found[9000].n_tokens == 0 and found[None].n_tokens > 0


@pytest.mark.parametrize("bytes_known", [True, False])
def test_ties_and_unknowns(bytes_known):
    """Scores that tie everywhere, on every short word of three letters and an unknown one."""
    from itertools import product

    pieces = {"a": -1.0, "b": -1.0, "ab": -2.0, "ba": -2.0, "aba": -3.0, "abab": -3.0, "▁": -1.0, "▁a": -2.0, "bb": -1.0}
    counter = token_counts.Counter(token_counts.Vocabulary(pieces, bytes_known, -3.0))
    whole = unigram(pieces, False)
    for n in range(1, 7):
        for letters in product("abé ", repeat=n):
            text = "".join(letters)
            found = whole.encode("▁" + text.replace(" ", "▁"))
            # A run of unknown letters is one token of the library; with byte pieces it counts its bytes.
            wanted = sum(len(text_of(found, i).encode()) if bytes_known and t == 0 else 1 for i, t in enumerate(found.ids))
            assert counter.count(text)[1] == wanted, text


def text_of(found, i):
    begin, end = found.offsets[i]
    return found.tokens[i] if found.ids[i] else "é" * (end - begin)


def test_broken_texts_are_defined(spark):
    """Bytes that are not UTF-8 count as the replacement mark."""
    prepared(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = Encoder(path)
    whole = encoder.tokenizer.encode("a\ufffdb word", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(b"a\xffb word"), encoder.kind).tolist() == whole
    docs = spark.sql("SELECT 1L AS doc_id, CAST(x'41FF42' AS string) AS text")
    assert token_counts.counted(docs, public_tokenizers.path("piece_bpe_32k.model")).first().n_tokens > 0


def test_ids_of_mixed_marks():
    """Marks, capitals that lower to two letters and special strings in any order."""
    encoder, rng = Encoder(public_tokenizers.path("word_bpe_49k.json")), random.Random(1)
    parts = ["a", "B", "the", " ", ".", ",", "!", "'", "'s", "é", "e\u0301", "\u0301", "1", "_", "\n", "(", ")", "...", ";", "\u00a0", "🎉", "İ", "<|endoftext|>", "don't", "-"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text.encode()), encoder.kind).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
