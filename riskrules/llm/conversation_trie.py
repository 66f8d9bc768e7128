"""A prefix trie over conversations that are rebuilt from two parts, without rebuilding any text.

A rebuilt conversation is a head of one conversation and the rest of another. Its prefixes' fingerprints
follow from the products of the stored ones (``turns``): up to the head's end they are the base's own,
beyond it the own prefix with the base's head in place of the own head. A node of the trie is the group of
all prefixes of one length and product. A group is verified by its turn references: the
referenced last turns of all members must agree in 128 further bits of their SHA-256. The product without
that turn names the parent, whose group is verified in the same way, so by induction all members are
equal sequences; if any group fails, the run stops with an error.

Sums over subtrees need no walk. Every node belongs to its smallest member, so a conversation owns the
nodes of its path from some depth on. A subtree's own nodes are those of its members, less what its top's
owner has above the top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.turns import PRIME, looked_up, numbered, shifted, shortened, text_bytes
from riskrules.session import cut

HEADS = 9  # a head has 0 to HEADS - 1 turns
FAMILY = 5  # conversations that share a base
NODE = ["depth", "f1", "f2"]
CHUNK_BYTES = 1 << 20  # of joined ids in one row


def rebuilt(conversations: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """(plans, turns): how every conversation is rebuilt, and the stored turns, both written.

    A plan has ``conv_id``, ``head`` (own turns left out), ``base_head`` (the base's turns in their place,
    at most HEADS - 1: products and references, no texts), ``taken`` (their number), ``size`` (rebuilt
    turns), ``total`` (their weight), and what makes own prefixes rebuilt ones: ``swap1, swap2`` (product of
    the base's head less that of the own head) and ``more`` (the same of weights).
    """
    turns = numbered(conversations, lambda: text_bytes, **names)
    first = F.struct("turn_no", "f1", "f2", "d1", "d2", "v1", "v2", "weight", "upto")
    convs = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("turn_no") < HEADS - 1, first))).alias("own"),  # at most HEADS - 1
        (F.max("turn_no") + 1).alias("n"),
        F.max("upto").alias("own_total"),
    )
    spread = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    convs = cut(convs.withColumns({"head": spread, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"), F.col("n").alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0))).cast("int")
    both = convs.join(bases, "base", "left").withColumns({"taken": taken, "goes_on": F.col("n") > F.col("head")})

    def upto(turns_of: str, n: str, field: str):
        return F.when(F.col(n) > 0, F.get(turns_of, F.col(n) - 1)[field]).otherwise(0)

    def swap(field: str):
        return F.when(F.col("goes_on"), upto("base_own", "taken", field) - upto("own", "head", field)).otherwise(0)

    plans = both.select(
        "conv_id",
        "base",
        "head",
        "taken",
        "goes_on",
        F.when(F.col("taken") > 0, F.slice("base_own", F.lit(1), F.col("taken"))).alias("base_head"),
        (F.col("taken") + F.when(F.col("goes_on"), F.col("n") - F.col("head")).otherwise(0)).cast("long").alias("size"),
        F.when(F.col("goes_on"), F.col("own_total") + swap("upto")).otherwise(upto("base_own", "taken", "upto")).alias("total"),
        F.pmod(swap("f1"), F.lit(PRIME)).alias("swap1"),
        F.pmod(swap("f2"), F.lit(PRIME)).alias("swap2"),
        swap("upto").alias("more"),
    )
    return cut(plans), turns


def prefixes(plans: DataFrame, turns: DataFrame) -> DataFrame:
    """A written row per rebuilt conversation and prefix, the empty one included: its length and product, the
    parent's product, the last turn's reference, bits and weight, and the weight before that turn."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("f1", "f2", "add1", "add2", "steps", "d1", "d2", "v1", "v2", "weight", "upto")]
    at_root = plans.select("conv_id", "size", F.lit(0).cast("long").alias("depth"), *zero, F.lit(None).cast("long").alias("turn_of"), F.lit(None).cast("long").alias("turn_no"))
    head = plans.filter("taken > 0").select("conv_id", "size", "base", F.explode("base_head").alias("t")).select(
        "conv_id",
        "size",
        (F.col("t.turn_no") + 1).alias("depth"),
        "t.f1",
        "t.f2",
        *zero[2:5],
        *[f"t.{c}" for c in ("d1", "d2", "v1", "v2", "weight", "upto")],
        F.col("base").alias("turn_of"),
        "t.turn_no",
    )
    ways = plans.filter("goes_on").select("conv_id", "size", "head", "taken", "swap1", "swap2", "more")
    steps = F.col("turn_no") + 1 - F.col("head")
    own = looked_up(turns.drop("payload", "part"), ways, ["conv_id"]).filter(F.col("turn_no") >= F.col("head"))
    own = own.select(
        "conv_id",
        "size",
        (F.col("taken") + steps).alias("depth"),
        "f1",
        "f2",
        F.col("swap1").alias("add1"),
        F.col("swap2").alias("add2"),
        steps.alias("steps"),
        *["d1", "d2", "v1", "v2", "weight"],
        (F.col("upto") + F.col("more")).alias("upto"),
        F.col("conv_id").alias("turn_of"),
        "turn_no",
    )
    whole = head.unionByName(own)
    whole = whole.withColumns({"f1": shifted(0)("f1", "add1", "steps"), "f2": shifted(1)("f2", "add2", "steps")})
    whole = whole.withColumns({"p1": shortened(0)("f1", "v1"), "p2": shortened(1)("f2", "v2")})
    columns = ["conv_id", *NODE, "p1", "p2", "d1", "d2", "weight", (F.col("upto") - F.col("weight")).alias("before"), "turn_of", "turn_no", (F.col("depth") == F.col("size")).alias("ends")]
    at_root = at_root.withColumns({"p1": F.lit(None).cast("long"), "p2": F.lit(None).cast("long")})
    return cut(whole.select(columns).union(at_root.select(columns)))


def verified(nodes: DataFrame) -> DataFrame:
    """``nodes``, whose members' last turns agree; an error if a group holds different ones."""
    if nodes.filter("d1 <> d1_most OR d2 <> d2_most").limit(1).count():
        raise RuntimeError("two sequences of turns share a fingerprint: choose other BASES in riskrules.llm.turns")
    return nodes.drop("d1_most", "d2_most")


def trie(conversations: DataFrame, **names: str) -> DataFrame:
    """A row per node, the textless root included: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, turn_of, turn_no).

    ``conv_id`` is the smallest member, ``turn_of`` and ``turn_no`` refer to a stored turn that is the
    node's last. Null roles and texts count as empty, turns of one number are ordered by role and text,
    repeated rows are turns of their own, rows without ``conv_id`` are left out; an empty table has no
    nodes. The base of a negative id follows SQL's remainder, which has the id's sign.
    """
    plans, turns = rebuilt(conversations, **names)
    members = prefixes(plans, turns)
    nodes = verified(
        cut(
            members.groupBy(*NODE).agg(
                F.min("conv_id").alias("conv_id"),
                F.min("p1").alias("p1"),
                F.min("p2").alias("p2"),
                *[f(c).alias(n) for c in ("d1", "d2") for f, n in ((F.min, c), (F.max, f"{c}_most"))],
                F.max("weight").alias("weight"),
                F.max("before").alias("before"),
                F.min("turn_of").alias("turn_of"),
                F.min_by("turn_no", "turn_of").alias("turn_no"),
            )
        )
    )
    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(F.count("*").alias("n_children"))
    nodes = cut(nodes.join(below, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    owned = nodes.groupBy("conv_id").agg(F.sum("weight").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    owners = plans.select("conv_id", "total").join(owned, "conv_id", "left").na.fill(0, ["own", "leaf"])
    sums = looked_up(members.select("conv_id", *NODE), owners, ["conv_id"]).groupBy(*NODE).agg(
        F.count("*").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        (F.sum("total") - F.min_by("total", "conv_id")).alias("others_total"),
        (F.sum("own") - F.min_by("own", "conv_id")).alias("others_own"),
    )
    saved = F.col("others_total") - (F.col("n_convs") - 1) * F.col("before") - F.col("others_own")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = looked_up(nodes, parents, ["depth", "p1", "p2"], "left").join(sums, NODE).join(ends(members), NODE, "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        "turn_of",
        "turn_no",
    )


def ends(members: DataFrame) -> DataFrame:
    """Per node with conversations that end there: SHA-256 of their ids, ascending, joined by commas.

    Ids are cut by ranges of (node, id) and joined to chunks by as many tasks as they need; what remains
    in order for one node is to hash its chunks, one after another.
    """
    last = members.filter("ends").select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, texts, size = None, None, [], 0
        done: list[tuple] = []

        def rows():
            columns = [list(x) for x in zip(*done)]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns[:4]] + [pa.array(columns[4], pa.string())], names=[*NODE, "first", "ids"])

        held = 0
        for b in batches:
            for *at, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                if at != node or size > CHUNK_BYTES:
                    if texts:
                        done.append((*node, first, ",".join(texts)))
                        held += size
                    node, first, texts, size = at, c, [], 0
                texts.append(str(c))
                size += len(texts[-1]) + 1
            if len(done) >= 10_000 or held > 8 * CHUNK_BYTES:
                yield rows()
                held = 0
        if texts:
            done.append((*node, first, ",".join(texts)))
        if done:
            yield rows()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done: list[tuple] = []
            for *at, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    chunks = last.mapInArrow(chunked, "depth long, f1 long, f2 long, first long, ids string")
    placed = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return placed.select(*NODE, "ids").mapInArrow(hashed, "depth long, f1 long, f2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns[:3]] + [pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])


def oracle() -> str:
    """The query's columns in SQL over ``conversations``."""
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)), lambda a, b: {})"
    bits = "xor(a, b)"
    for _ in range(8):
        bits = f"list_transform([{bits}], lambda x: xor(x >> 1, (x & 1) * 3988292384))[1]"
    h = f"xor({crc.format(bits)}, 4294967295) % {HEADS}"
    return f"""
WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, l, {h} AS h FROM own),
r AS (SELECT h.conv_id, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % {FAMILY}),
m AS (SELECT conv_id, l, d, l[1:d] AS p FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM r)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(l) = d)), sha256('')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(any_value(l[d].t))) END AS bytes FROM m GROUP BY p, d),
c AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON n.p = c.p AND n.d = c.d),
u AS (SELECT p[1:e] AS p, e AS d, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM k) GROUP BY 1, 2)
SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, f.conv_id AS parent_conv_id, k.n_convs, k.n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN u ON k.p = u.p AND k.d = u.d LEFT JOIN k f ON k.d > 0 AND f.d = k.d - 1 AND f.p = k.p[1:k.d - 1]"""
