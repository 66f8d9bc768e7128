"""Prefix tries of conversations: against SQL and plain recursion, on odd rows, with hot keys dealt."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest_rows import compared

from riskrules.llm import chat_tree, conversation_trie, turns
from riskrules.llm.common import prepared

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, f1 int, branch int, weight string, _part int"


def conversations(seed, n=60):
    """Few different turns, so that beginnings, whole conversations and single turns repeat."""
    rng, rows = random.Random(seed), []
    said = ["a", "b", "hello ### there", "\\", "</turn>", "", None, "é🎉 ####", "\\### x: </turn>\n"]
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            rows.append((c * rng.choice([1, 1, 3]), t, rng.choice(["user", "assistant", None, "a: b", "sys\ntem"]), rng.choice(said[: 2 + seed % 8])))
    rows += [(1000 + c, t, "user", "same") for c in range(40) for t in range(5)]  # copies
    rows += [(2000, t, "assistant", f"turn {t % 3}") for t in range(400)]  # one long conversation
    rows += [(2001, t, "assistant", f"turn {t % 3}") for t in range(390)] + [(2003, 0, "user", "alone")]
    rows += [(None, 1, "user", "no id"), (3000, None, "user", "no turn"), (3000, None, "assistant", None), (3000, 2, "user", "x"), (3000, 2, "user", "x"), (3000, 2, None, "y")]
    rows += [(-3, 0, "user", "negative"), (-3, 1, "assistant", "x"), (-5, 0, "user", "its base"), (-10, 0, "user", "other base")]
    rows += [(4000, 0, "assistant", "long " * 60_000), (4001, 0, "assistant", "long " * 60_000 + "end")]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def table_of(spark):
    prepared(spark)
    return lambda rows: spark.createDataFrame([(*r, 0, 0, 0, "", 0) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(params=[False, True])
def dealt(request, monkeypatch):
    """Once as it is, once with every key of a few rows dealt over several tasks."""
    if request.param:
        monkeypatch.setattr(turns, "KEY_ROWS", 3)
        monkeypatch.setattr(turns, "KEY_SHARE", 1 / 10_000)
    return request.param


def test_trie(table_of, dealt):
    rows = table_of(conversations(5 + dealt))
    found = conversation_trie.trie(rows)
    compared(found.drop("turn_of", "turn_no"), conversation_trie.oracle(), conversations=rows.select("conv_id", "turn", "role", "text"))
    assert found.filter("depth > 0 AND (turn_of IS NULL OR turn_no IS NULL)").count() == 0


def test_formatted(table_of, dealt):
    rows = table_of(conversations(7 - dealt))
    trees = chat_tree.formatted(rows, PATH)
    compared(chat_tree.read_back(trees), chat_tree.oracle(), conversations=rows.select("conv_id", "turn", "role", "text"))


def test_trees(table_of):
    """Segments in depth-first order without gaps; each different prefix once; intervals are the ancestors."""
    rows = [r for r in conversations(3) if r[0] is not None]
    trees = chat_tree.formatted(table_of(rows), PATH)
    of = defaultdict(list)
    for s in sorted(trees.segments.collect(), key=lambda s: (s.tree, s.start)):
        of[s.tree].append(s)
    words, prefixes = chat_tree.subwords(PATH), {}
    order = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    said = defaultdict(list)
    for c, _, role, text in sorted(rows, key=order):
        said[c].append((role or "", text or ""))
    for tree, segments in of.items():
        at, stack = 0, []
        for s in segments:
            assert s.start == at and s.n_tokens == len(s.tokens) // 2
            at += s.n_tokens
            stack = stack[: s.depth - 1] + [s]
            assert len(stack) == s.depth and s.position == sum(x.n_tokens for x in stack[:-1])
            seen = np.zeros(at, bool)
            for span in s.ancestors:
                assert not seen[span.start : span.end].any()
                seen[span.start : span.end] = True
            wanted = np.zeros(at, bool)
            for x in stack[:-1]:
                wanted[x.start : x.start + x.n_tokens] = True
            assert (seen == wanted).all()
            ids = np.frombuffer(s.tokens, "<u2")
            path = tuple(chat_tree.turns_of("".join(words.text(np.frombuffer(x.tokens, "<u2")) for x in stack)))
            assert path not in prefixes and len(path) == s.depth
            prefixes[path] = s.start + s.n_tokens, tree
            role, text = path[-1]
            assert chat_tree.plain(words.text(ids[s.loss_start : s.loss_end])) == (text if role == "assistant" else "")
    assert set(prefixes) == {tuple(p[: i + 1]) for p in said.values() for i in range(len(p))}
    assert {r.conv_id: (r.end, r.tree) for r in trees.leaves.collect()} == {c: prefixes[tuple(p)] for c, p in said.items()}


@pytest.mark.parametrize("text", ["", "#", "###", "####", "######", "\\", "\\\\", "\\###", "</turn>", "\\</turn>\n", "a\n", "### assistant: x</turn>\n", "🎉\u0000é", "</tur</turn>n>"])
def test_escapes(text):
    whole = f"{chat_tree.head(text)}{chat_tree.escaped(text)}{chat_tree.CLOSE}" * 2
    assert chat_tree.turns_of(whole) == [(text, text)] * 2
    words = chat_tree.subwords(PATH)
    assert words.text(words.ids([whole])[0]) == whole


def test_broken_text_is_defined(spark):
    prepared(spark)
    rows = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'assistant' AS role, CAST(x'41FF42' AS string) AS text")
    (found,) = chat_tree.read_back(chat_tree.formatted(rows, PATH)).collect()
    assert found.loss_chars == 3  # A, the replacement mark, B
    assert conversation_trie.trie(rows).count() == 1  # 1 takes its head from conversation 0, which is absent


def test_no_conversations(table_of):
    empty = table_of([(None, 0, "user", "x")]).filter("conv_id = 1")
    assert conversation_trie.trie(empty).count() == 0
    trees = chat_tree.formatted(empty, PATH)
    assert trees.segments.count() == 0 and trees.leaves.count() == 0 and chat_tree.read_back(trees).count() == 0
    assert conversation_trie.trie(table_of([(None, 0, "user", "x")])).count() == 0


def test_collisions_are_seen(spark):
    columns = "d1 long, d1_most long, d2 long, d2_most long"
    assert conversation_trie.verified(spark.createDataFrame([(1, 1, 2, 2)], columns)).columns == ["d1", "d2"]
    for wrong in ((1, 2, 0, 0), (1, 1, 0, 3)):
        with pytest.raises(RuntimeError):
            conversation_trie.verified(spark.createDataFrame([wrong], columns))


def test_running_sums_in_parts(spark):
    prepared(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, o, (k + 1) * o % 7) for k, n in ((0, 500), (1, 3), (2, 90)) for o in range(n)]
        df = spark.createDataFrame(rows, "k long, o long, v long").repartition(4)
        found = {(r.k, r.o): r.b for r in turns.running_before(df, ["k"], "o", df["v"], "b").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k, o, _ in rows:
        assert found[k, o] == sum(v for kk, oo, v in rows if kk == k and oo < o)
