"""Conversations in a chat template, with beginnings that several share emitted once.

Template: a turn is ``### role: text</turn>`` and a line break. A backslash stands before every backslash
and every control string (``###``, ``</turn>``, in roles also the colon) of a role or text, so that
reading stops at real marks only and taking the backslashes off gives the original.

All conversations that share their first turn form one tree; a node is a turn after given turns before.
The tree's tokens are one sequence in depth-first order, siblings by their smallest conversation. Each
turn is a segment of it: where it starts, the position id of its first token (the others follow), which
part of it counts for the loss, and the intervals of the sequence that it may attend to beside itself,
namely its ancestors.

No tree is gathered anywhere. A node belongs to its smallest conversation, its owner; the nodes of one
owner are one branch, contiguous in the sequence. Sums of own tokens over a node's members give the size
of its subtree, running sums over siblings give what lies before a node beside its ancestors, and a
node's start is its position plus these shifts along its path.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.conversation_trie import NODE, verified
from riskrules.llm.subwords import _byte_letters
from riskrules.llm.turns import looked_up, numbered, running_before, shortened
from riskrules.session import cut

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
LEARNED = "assistant"  # the role whose texts count for the loss
REACH = 1 << 16  # tokens of a branch that are looked up together
_CONTROL, _ROLE = re.compile(r"\\|#(?=##)|</turn>"), re.compile(r"\\|#(?=##)|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PATH = "array<struct<depth:long,branch:long,position:long,shift:long>>"
_INTERVALS = "array<struct<branch:long,start:long,end:long>>"


def escaped(text: str, marks: re.Pattern = _CONTROL) -> str:
    return marks.sub(lambda m: "\\" + m[0], text)


def plain(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def head(role: str) -> str:
    return f"{OPEN}{escaped(role, _ROLE)}{COLON}"


def _until(text: str, mark: str, at: int) -> int:
    """The first place from ``at`` on of a mark that no backslash escapes."""
    found = text.index(mark, at)
    while True:
        back = found
        while back > at and text[back - 1] == "\\":
            back -= 1
        if (found - back) % 2 == 0:
            return found
        found = text.index(mark, found + 1)


def turns_of(text: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of formatted turns."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError("a turn does not begin with its mark")
        role = _until(text, COLON, at + len(OPEN))
        end = _until(text, CLOSE, role + len(COLON))
        out.append((plain(text[at + len(OPEN) : role]), plain(text[role + len(COLON) : end])))
        at = end + len(CLOSE)
    return out


class Subwords:
    """A byte-level tokenizers file: ids of pieces of text, and back without loss."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark shares out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        of = {chr(letter): byte for byte, letter in _byte_letters().items()}
        self.bytes = {i: bytes(of[c] for c in t) for t, i in vocabulary.items() if all(c in of for c in t)}
        self.heads: dict[str, np.ndarray] = {}
        self.close = self.ids([CLOSE])[0]

    def ids(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def head(self, role: str) -> np.ndarray:
        if role not in self.heads:
            if len(self.heads) > 10_000:
                self.heads.clear()
            self.heads[role] = self.ids([head(role)])[0]
        return self.heads[role]

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes[i] for i in ids.tolist()]).decode()

    def weigh(self, roles: list[bytes], texts: list[bytes]) -> tuple[list[int], list[bytes]]:
        """Per turn its number of tokens and its packed tokens: where the loss begins and ends, then the ids."""
        sizes, packed = [], []
        bodies = self.ids([escaped(t.decode(errors="replace")) for t in texts])
        for role, body in zip(roles, bodies):
            name = role.decode(errors="replace")
            before = self.head(name)
            ids = np.concatenate((before, body, self.close))
            loss = (len(before), len(before) + len(body)) if name == LEARNED else (0, 0)
            sizes.append(len(ids))
            packed.append(np.array(loss, ">u4").tobytes() + ids.astype(self.kind).tobytes())
        return sizes, packed


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


@dataclass(frozen=True)
class Trees:
    """Written tables.

    ``segments``: (tree, start, branch, depth, position, n_tokens, loss_start, loss_end, tokens, ancestors),
    written in order of (tree, start). ``start`` and the ``ancestors`` [start, end) are places in the
    tree's sequence, the loss interval counts from the segment's start, ``tokens`` are little-endian
    unsigned numbers of the tokenizer's width. A tree, and a branch, is named by its smallest conversation.

    ``leaves``: (conv_id, tree, branch, end), where every conversation ends.
    """

    segments: DataFrame
    leaves: DataFrame
    path: str


def formatted(conversations: DataFrame, path: str, **names: str) -> Trees:
    """The trees of all conversations, rows in order of turn, role and text (null turns first).

    Null roles and texts count as empty, bytes that are not UTF-8 as the replacement mark. Repeated rows are
    turns of their own; rows without ``conv_id`` belong to no conversation and are left out; an empty
    table gives empty tables.
    """
    turns = numbered(conversations, lambda: subwords(path).weigh, **names)
    members = turns.withColumns({"depth": F.col("turn_no") + 1, "position": F.col("upto") - F.col("weight")})
    nodes = verified(
        cut(
            members.groupBy(*NODE).agg(
                F.min("conv_id").alias("branch"),
                *[f(c).alias(n) for c in ("d1", "d2") for f, n in ((F.min, c), (F.max, f"{c}_most"))],
                *[F.min(c).alias(c) for c in ("v1", "v2", "weight", "position")],
            )
        )
    )
    # Branches, and what every conversation adds to the subtrees it is in.
    top = [F.min_by(c, "depth").alias(c) for c in ("f1", "f2", "position")]
    tops = nodes.groupBy("branch").agg(F.sum("weight").alias("own"), F.min("depth").alias("depth"), *top)
    sizes = turns.groupBy("conv_id").agg(F.max("upto").alias("total"), (F.max("turn_no") + 1).alias("size"))
    tops = cut(tops)
    convs = sizes.join(tops.select(F.col("branch").alias("conv_id"), "own", F.col("depth").alias("top")), "conv_id", "left").na.fill(0, ["own", "top"])
    members = cut(looked_up(cut(members.select("conv_id", *NODE)), convs, ["conv_id"]))
    below = members.groupBy(*NODE).agg((F.sum("own") - F.min_by("own", "conv_id") + F.min_by("total", "conv_id")).alias("below"))

    # What lies before a node beside its ancestors: the subtrees of its earlier siblings.
    parent = {"p1": shortened(0)("f1", "v1"), "p2": shortened(1)("f2", "v2")}
    siblings = nodes.filter("depth > 1").select(*NODE, "branch", "v1", "v2", "position").withColumns(parent).join(below, NODE)
    siblings = siblings.select(*NODE, "p1", "p2", "branch", (F.col("below") - F.col("position")).alias("subtree"))
    shifts = running_before(siblings, ["depth", "p1", "p2"], "branch", F.col("subtree"), "shift").select(*NODE, "shift")
    tops = tops.join(shifts, NODE, "left").select(*NODE, "branch", "position", F.coalesce("shift", F.lit(0)).alias("shift"))
    steps = looked_up(members.filter("depth <= top").select("conv_id", *NODE), tops, NODE)
    paths = steps.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "branch", "position", "shift"))).alias("path"))  # a row per branching on one path
    branches = cut(paths.mapInArrow(_placed, f"branch long, tree long, shift long, top long, outer_ancestors {_INTERVALS}"))

    placed = cut(looked_up(nodes.select(*NODE, "branch", "weight", "position"), branches, ["branch"]).withColumn("start", F.col("shift") + F.col("position")))
    own = F.struct("branch", (F.col("shift") + F.col("top")).alias("start"), F.col("start").alias("end"))
    ancestors = F.concat("outer_ancestors", F.when(F.col("position") > F.col("top"), F.array(own)).otherwise(F.expr(f"CAST(array() AS {_INTERVALS})")))
    packed = turns.select(F.col("conv_id").alias("branch"), (F.col("turn_no") + 1).alias("depth"), "payload")

    def number(at: int):
        return F.conv(F.hex(F.substring("payload", at, 4)), 16, 10).cast("long")

    segments = placed.withColumn("ancestors", ancestors).join(packed, ["branch", "depth"]).select(
        "tree",
        "start",
        "branch",
        "depth",
        "position",
        F.col("weight").alias("n_tokens"),
        number(1).alias("loss_start"),
        number(5).alias("loss_end"),
        F.expr("substring(payload, 9)").alias("tokens"),
        "ancestors",
    )
    segments = cut(segments.repartitionByRange("tree", "start").sortWithinPartitions("tree", "start"))
    last = members.filter(F.col("depth") == F.col("size")).select("conv_id", *NODE)
    leaves = looked_up(last, placed.select(*NODE, "tree", "branch", (F.col("start") + F.col("weight")).alias("end")), NODE)
    return Trees(segments, cut(leaves.select("conv_id", "tree", "branch", "end")), path)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per branch its tree, shift, the position of its top and the intervals of the branches above it."""
    kind = pa.list_(pa.struct([("branch", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for conv, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            shift, above = 0, []
            for step, after in zip(path, [*path[1:], None]):
                shift += step["shift"]
                if after:
                    above.append({"branch": step["branch"], "start": shift + step["position"], "end": shift + after["position"]})
            for column, value in zip(out, (conv, path[0]["branch"], shift, path[-1]["position"], above)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:4]), pa.array(out[4], kind)], names=["branch", "tree", "shift", "top", "outer_ancestors"])


def paths_of(trees: Trees) -> DataFrame:
    """(branch, end, start, tokens, loss_start, loss_end): for every different conversation, named by where it
    ends, the segments it consists of, found by the intervals of its last one."""
    segments = trees.segments
    wanted = trees.leaves.select("branch", "end").distinct()
    last = segments.withColumn("end", F.col("start") + F.col("n_tokens")).join(wanted, ["branch", "end"])
    self = F.array(F.struct("branch", "start", "end"))
    spans = last.select("branch", "end", F.explode(F.concat("ancestors", self)).alias("s"))
    reach = F.explode(F.sequence(F.floor(F.col("s.start") / REACH), F.floor((F.col("s.end") - 1) / REACH)))
    spans = cut(spans.select(F.col("branch").alias("of"), F.col("end").alias("of_end"), F.col("s.branch").alias("branch"), F.col("s.start").alias("a"), F.col("s.end").alias("b"), reach.alias("chunk")))
    held = segments.select("branch", F.floor(F.col("start") / REACH).alias("chunk"), "start", "tokens", "loss_start", "loss_end")
    met = looked_up(spans, held, ["branch", "chunk"]).filter("start >= a AND start < b")
    return met.select(F.col("of").alias("branch"), F.col("of_end").alias("end"), "start", "tokens", "loss_start", "loss_end")


DIGEST = "branch long, end long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(trees: Trees) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation, from the
    written segments. Hashes run over a conversation's segments in order, one at a time."""
    path = trees.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, names = subwords(path), [f.split()[0] for f in DIGEST.split(", ")]
        at, done = None, []

        def close():
            done.append((*at, n, turns.hexdigest(), learned, loss.hexdigest(), chars))

        def rows():
            columns = list(zip(*done)) if done else [()] * 7
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i in (3, 5) else pa.int64()) for i, c in enumerate(columns)], names=names)

        for b in batches:
            for *one, tokens, lo, hi in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5))):
                if one != at:
                    if at:
                        close()
                    at, n, learned, chars, turns, loss = one, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                ids = np.frombuffer(tokens, words.kind)
                text, masked = words.text(ids), plain(words.text(ids[lo:hi]))
                for role, said in turns_of(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                chars, learned = chars + len(text), learned + len(masked)
                loss.update(masked.encode())
            yield rows()
        if at:
            close()
            yield rows()

    ordered = paths_of(trees).repartition("branch", "end").sortWithinPartitions("branch", "end", "start")
    found = ordered.select("branch", "end", "start", "tokens", "loss_start", "loss_end").mapInArrow(run, DIGEST)
    return looked_up(trees.leaves, found, ["branch", "end"]).drop("tree", "branch", "end")


def oracle(extra: str = "") -> str:
    """The query's columns in SQL over ``conversations`` and the ``extra`` rows."""
    added = lambda t: f"(len({t}) - len(replace({t}, '\\', '')) + (len({t}) - len(replace({t}, '</turn>', ''))) // 7 + coalesce(list_sum(list_transform(regexp_extract_all({t}, '#{{3,}}'), lambda x: len(x) - 2)), 0))"
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL{extra})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
  CAST(coalesce(sum(len(t)) FILTER (WHERE r = '{LEARNED}'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (WHERE r = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum(14 + len(r) + {added('r')} + len(r) - len(replace(r, ':', '')) + len(t) + {added('t')}) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
