"""Decision trees as a source of rules.

Spark ML joins sibling leaves that predict the same class. With rare disputes every leaf predicts
"no dispute", so its classification trees fold into their root. The trees here are grown level by
level from counts instead: one pass per level counts rows and positives per (group, node, feature,
bucket), windows over these cells rate every split, and only the best split of each node comes to
the driver. The trees of all segments and days of life grow in the same passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from riskrules.functions.measures import fill_gaps
from riskrules.operators import large_nodes
from riskrules.operators.binning import edge_counts, quantile_edges
from riskrules.operators.large_nodes import Nodes, between
from riskrules.session import cut, small

CONDITIONS = "array<struct<feature:string,op:string,threshold:double>>"


def _entropy(n: Column, p: Column) -> Column:
    """Rows times entropy of a node."""
    def part(k: Column) -> Column:
        return F.when(k > 0, -k * F.ln(k / n)).otherwise(0.0)

    return part(p) + part(n - p)


def _gini(n: Column, p: Column) -> Column:
    return F.when(n > 0, 2 * p * (n - p) / n).otherwise(0.0)


# The split criteria by their usual names; log loss and entropy are one criterion.
CRITERIA = {"gini": _gini, "entropy": _entropy, "log_loss": _entropy}


@dataclass(frozen=True)
class Node:
    """A node of a group's tree. ``node_id`` is 1 for the root and 2i, 2i + 1 for the children of i."""

    group: tuple
    node_id: int
    conditions: tuple[tuple[str, str, float], ...]
    is_leaf: bool
    n: int
    positives: int


def grow(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    by: Sequence[str] = (),
    criterion: str = "log_loss",
    depth: int = 7,
    leaf_size: int = 100,
    bins: int = 128,
    max_groups: int | None = None,
) -> list[Node]:
    """Trees of every group (all values of ``by``), parents before children. An action.

    The driver holds the trees of all groups; a caller who wants to be stopped beyond some number of
    groups gives ``max_groups``.

    Split points are quantile edges of the whole table. Unknown values count as 0. Ties between
    splits go to the earlier feature and the lower threshold.
    """
    features, by = list(features), list(by)
    known = df.select(*by, *features, F.col(label).cast("int").alias("_y"))
    for k in by:
        known = known.filter(F.col(k).isNotNull())
    filled = fill_gaps(known, features)
    edges = {f: e[:-1] for f, e in quantile_edges(filled, features, bins).items()}
    buckets = F.array(*[F.col(f"{f}_above").cast("short") for f in features])
    # Every level reads this narrow table again, so it is written once.
    table = cut(edge_counts(filled, edges).select(*by, "_y", buckets.alias("_b")))

    tree: dict[tuple, dict] = {}
    groups = table.groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("p")).collect()
    if max_groups is not None and len(groups) > max_groups:
        raise ValueError(f"{len(groups)} groups, more than {max_groups}")
    for r in groups:
        if r["n"]:
            tree[(tuple(r[k] for k in by), 1)] = {"path": (), "n": r["n"], "p": r["p"], "split": None}
    rows = table.withColumn("node", F.lit(1))
    for level in range(depth):
        splits = _best_splits(rows, by, CRITERIA[criterion], leaf_size)
        for s in splits:
            g, node = tuple(s[k] for k in by), s["node"]
            feature, limit = features[s["f"]], float(edges[features[s["f"]]][s["bucket"] - 1])
            parent = tree[g, node]
            parent["split"] = True
            low = {"path": (*parent["path"], (feature, "<=", limit)), "n": s["ln"], "p": s["lp"], "split": None}
            high = {"path": (*parent["path"], (feature, ">", limit)), "n": parent["n"] - s["ln"], "p": parent["p"] - s["lp"], "split": None}
            tree[g, 2 * node], tree[g, 2 * node + 1] = low, high
        if not splits or level == depth - 1:
            break
        rows = _one_level_down(rows, by, splits)
    return [Node(g, i, t["path"], t["split"] is None, int(t["n"]), int(t["p"])) for (g, i), t in sorted(tree.items())]


def _best_splits(rows: DataFrame, by: list[str], impurity, leaf_size: int) -> list:
    """The best split of each node that has one: at most one row per node comes back."""
    at = [*by, "node"]
    cells = rows.select(*at, "_y", F.posexplode("_b").alias("f", "bucket")).groupBy(*at, "f", "bucket").agg(F.count("*").alias("n"), F.sum("_y").alias("p"))
    line = Window.partitionBy(*at, "f")
    before = line.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    options = cells.select(
        *at, "f", "bucket", F.sum("n").over(before).alias("ln"), F.sum("p").over(before).alias("lp"), F.sum("n").over(line).alias("an"), F.sum("p").over(line).alias("ap")
    )
    ln, lp, an, ap = (F.col(c) for c in ("ln", "lp", "an", "ap"))
    fair = options.filter((ln >= leaf_size) & (an - ln >= leaf_size))
    gain = F.round(impurity(an, ap) - impurity(ln, lp) - impurity(an - ln, ap - lp), 9)
    rated = fair.withColumn("gain", gain).filter(F.col("gain") > 0)
    best = F.max_by(F.struct("f", "bucket", "ln", "lp"), F.struct(F.col("gain"), -F.col("f"), -F.col("bucket")))
    return rated.groupBy(*at).agg(best.alias("s")).select(*at, "s.*").collect()


def _one_level_down(rows: DataFrame, by: list[str], splits: list) -> DataFrame:
    """Rows of split nodes, moved to the child they fall in. The splits are at most one row per node."""
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in by]
    schema = ", ".join([*types, "node int", "_f int", "_at int"])
    table = rows.sparkSession.createDataFrame([(*[s[k] for k in by], s["node"], s["f"], s["bucket"]) for s in splits], schema)
    moved = rows.join(small(table, len(splits), len(by) + 3), [*by, "node"])
    child = F.col("node") * 2 + (F.get("_b", F.col("_f")) >= F.col("_at")).cast("int")
    return moved.select(*by, "_y", "_b", child.alias("node"))


# Rows of a node that one task orders by itself (about 0.5 GB with four features).
LOCAL_ROWS = 3_000_000
# Rows from which a segment's rows travel in blocks; the driver holds a number for each such segment.
PACKED_ROWS = 50_000
_TOLD = "node_id int, conditions {0}, is_leaf boolean, n long, positives long"


def _rated(criterion: str, n, p):
    with np.errstate(divide="ignore", invalid="ignore"):
        if criterion == "gini":
            return np.where(n > 0, 2 * p * (n - p) / n, 0.0)
        return sum(np.where(k > 0, -k * np.log(k / n), 0.0) for k in (p, n - p))


def _own_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct edges of equal-share bins of sorted values, the highest left out."""
    place = (len(values) - 1) * (np.arange(bins + 1) / bins)
    low, high = values[np.floor(place).astype(int)], values[np.ceil(place).astype(int)]
    return np.unique(between(low, high, place))[:-1]


def _divisible(n: int, p: int, leaf_size: int) -> bool:
    return n >= 2 * leaf_size and 0 < p < n


def _best_edge(edges: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int, p: int, criterion: str, leaf_size: int) -> tuple[int, float, int, int] | None:
    """(feature, edge, rows and positives up to it) of the best split, from all edges of every feature."""
    best = None
    for f, (limits, ln, lp) in enumerate(edges):
        gain = np.round(_rated(criterion, float(n), float(p)) - _rated(criterion, ln, lp) - _rated(criterion, n - ln, p - lp), 9)
        gain = np.where((ln >= leaf_size) & (n - ln >= leaf_size), gain, 0.0)
        if len(gain) and gain.max() > (best[0] if best else 0.0):
            k = gain.argmax()
            best = gain[k], f, float(limits[k]), int(ln[k]), int(lp[k])
    return best and best[1:]


def _grown_here(x: np.ndarray, y: np.ndarray, features: list[str], root: int, criterion: str, depth: int, leaf_size: int, bins: int) -> list[tuple]:
    """(node, conditions below the root, is_leaf, n, positives) of a subtree whose rows, (feature, row), are all here."""
    out = []

    def edges(rows: np.ndarray) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        hits = y[rows]
        for of_feature in x:
            values = of_feature[rows]
            positive = np.repeat(values, hits)
            values.sort()
            positive.sort()
            limits = _own_edges(values, bins)
            yield limits, values.searchsorted(limits, "right"), positive.searchsorted(limits, "right")

    def down(rows: np.ndarray, node: int, path: list) -> None:
        n, p = len(rows), int(y[rows].sum())
        best = _best_edge(edges(rows), n, p, criterion, leaf_size) if node.bit_length() - 1 < depth and _divisible(n, p, leaf_size) else None
        out.append((node, path, best is None, n, p))
        if best:
            f, limit, *_ = best
            low = x[f][rows] <= limit
            for child, part, op in ((2 * node, rows[low], "<="), (2 * node + 1, rows[~low], ">")):
                down(part, child, [*path, {"feature": features[f], "op": op, "threshold": limit}])

    down(np.arange(len(y)), root, [])
    return out


def by_segment(
    df: DataFrame, features: Sequence[str], label: str, by: Sequence[str], criterion: str = "log_loss", depth: int = 7, leaf_size: int = 100, bins: int = 128, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """The trees of all segments as a table: (*by, node_id, conditions, is_leaf, n, positives, rate). An action.

    Every node tries the quantile edges of its own rows, so a segment finds its own thresholds, and finer
    ones the smaller a node is. A node of at most ``local_rows`` rows is grown to the end by one task, larger
    ones are split level by level from counts, by the same rules (``large_nodes``). Unknown values count as 0,
    null labels are no positives, segments with a null key are left out, ties go to the earlier feature and
    the lower threshold. ``df`` is read up to three times; a caller with a costly one cuts it first. The
    driver holds the nodes that come of segments of more than ``PACKED_ROWS`` rows.
    """
    features, by = list(features), list(by)
    known = df.select(*by, *[F.col(f).cast("double").alias(f) for f in features], F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("_y"))
    for k in by:
        known = known.filter(F.col(k).isNotNull())
    sizes = cut(known.groupBy(*by).agg(F.count("*").alias("n"), F.sum("_y").alias("p")))
    if depth == 0:
        none = F.expr(f"CAST(array() AS {CONDITIONS})")
        return _with_rate(sizes.select(*by, F.lit(1).alias("node_id"), none.alias("conditions"), F.lit(True).alias("is_leaf"), "n", F.col("p").alias("positives")))
    rows, how = fill_gaps(known, features), (criterion, depth, leaf_size, bins)
    number = (F.row_number().over(Window.orderBy(*by)) - 1).alias("_s")
    held = cut(sizes.filter(F.col("n") > min(local_rows, PACKED_ROWS)).select(*by, number, "n", "p"))
    roots = held.select("_s", "n", "p").orderBy("_s").collect()
    keys, found = small(held.select(*by, "_s"), len(roots), len(by) + 1), []
    with large_nodes.small_batches(df.sparkSession):
        if roots:
            found.append(_grown_from_blocks(rows.join(keys, by), features, roots, local_rows, *how).join(keys, "_s").select(*by, *_NODE))
        if not roots or len(roots) < sizes.count():
            few = rows.join(keys, by, "left_anti") if roots else rows
            schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by), _TOLD.format(CONDITIONS)])
            arrow = to_arrow_schema(_parse_datatype_string(schema))

            def grow_here(group: pa.Table) -> pa.Table:
                x = np.stack([group.column(f).to_numpy() for f in features])
                told = _grown_here(x, group.column("_y").to_numpy().astype(np.int64), features, 1, *how)
                same = {k: [group.column(k)[0].as_py()] * len(told) for k in by}
                return pa.table({**same, **dict(zip(_NODE, map(list, zip(*told))))}, schema=arrow)

            found.append(few.groupBy(*by).applyInArrow(grow_here, schema))
        return _with_rate(reduce(DataFrame.unionByName, found))


_NODE = ["node_id", "conditions", "is_leaf", "n", "positives"]


def _with_rate(nodes: DataFrame) -> DataFrame:
    return cut(nodes.withColumn("rate", F.col("positives") / F.col("n")))


def _grown_from_blocks(rows: DataFrame, features: list[str], roots: list, local_rows: int, criterion: str, depth: int, leaf_size: int, bins: int) -> DataFrame:
    """(_s, node_id, conditions, is_leaf, n, positives) of the trees of the numbered segments ``_s``."""
    nodes = Nodes()
    for r in roots:
        nodes.add(r["_s"], 1, (), r["n"], r["p"])

    def to_split(some: Iterable[int]) -> list[int]:
        return [i for i in some if nodes.node_id[i].bit_length() - 1 < depth and _divisible(nodes.n[i], nodes.p[i], leaf_size)]

    large = [i for i in to_split(range(len(roots))) if nodes.n[i] > local_rows]
    blocks = large_nodes.packed(rows, features, {i: min(1.0, large_nodes.SAMPLE_ROWS / len(large) / nodes.n[i]) for i in large})
    if large:
        blocks = cut(blocks, large_nodes.FILE_BLOCKS)
        samples = large_nodes.sample(blocks, len(features))
    while large:
        children = []
        for i, edges in large_nodes.edge_counts(blocks, nodes, large, samples, len(features), bins):
            some = samples.pop(i, None)
            if best := _best_edge(edges, nodes.n[i], nodes.p[i], criterion, leaf_size):
                f, limit, ln, lp = best
                low, high = nodes.split(i, f, features[f], limit, ln, lp)
                children += [low, high]
                if some is not None:
                    below = some[f] <= limit
                    samples[low], samples[high] = some[:, below], some[:, ~below]
        large = [i for i in to_split(children) if nodes.n[i] > local_rows]
    here = {i: (nodes.segment[i], nodes.node_id[i], _conditions(nodes.path[i])) for i in to_split(range(len(nodes.n))) if nodes.child[i] < 0 and nodes.n[i] <= local_rows}

    told = [(nodes.segment[i], nodes.node_id[i], list(nodes.path[i]), nodes.child[i] < 0, int(nodes.n[i]), int(nodes.p[i])) for i in range(len(nodes.n)) if i not in here]
    schema = f"_s int, {_TOLD.format(CONDITIONS)}"
    whole = rows.sparkSession.createDataFrame(told, schema)
    if not here:
        return whole
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def grow_node(group: pa.Table) -> pa.Table:
        segment, node, path = here[group.column("node")[0].as_py()]
        found = _grown_here(*large_nodes.rows_of(group, len(features)), features, node, criterion, depth, leaf_size, bins)
        columns = dict(zip(_NODE, map(list, zip(*found))))
        columns["conditions"] = [path + c for c in columns["conditions"]]
        return pa.table({"_s": [segment] * len(found), **columns}, schema=arrow)

    return whole.unionByName(large_nodes.rows_by_node(blocks, nodes.ways(here)).groupBy("node").applyInArrow(grow_node, schema))


def _conditions(path: Iterable[tuple[str, str, float]]) -> list[dict]:
    return [{"feature": f, "op": op, "threshold": limit} for f, op, limit in path]


def node_table(df: DataFrame, nodes: Sequence[Node], by: Sequence[str] = ()) -> DataFrame:
    """Nodes as a rule table: group columns, node id, conditions, is_leaf, n, positives, rate."""
    types = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by]
    schema = ", ".join([*types, "node_id int", f"conditions {CONDITIONS}", "is_leaf boolean", "n long", "positives long"])
    rows = [(*x.group, x.node_id, list(x.conditions), x.is_leaf, x.n, x.positives) for x in nodes]
    return df.sparkSession.createDataFrame(rows, schema).withColumn("rate", F.col("positives") / F.col("n"))


def leaf_rules(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = (), **options) -> DataFrame:
    """A rule per leaf of the tree of every segment and day of life named in ``by``. An action."""
    nodes = [x for x in grow(df, features, label, by, **options) if x.is_leaf]
    return node_table(df, nodes, by).drop("is_leaf")


def node_metrics(nodes: Sequence[Node], df: DataFrame, label: str) -> DataFrame:
    """Rows, positives and rate of every node of one tree on any table, from one pass.

    A row finds its leaf by walking down one nested expression; leaves are then added up to their
    ancestors.
    """
    features = sorted({f for x in nodes for f, _, _ in x.conditions})
    filled = fill_gaps(df.select(*features, label), features)
    leaf = walk(nodes, {f: F.col(f) for f in features}, lambda x: F.lit(x.node_id))
    counts = filled.groupBy(leaf.alias("leaf")).agg(F.count("*").alias("n"), F.sum(label).alias("positives"))
    spark = df.sparkSession
    up = [(x.node_id >> k, x.node_id) for x in nodes if x.is_leaf for k in range(x.node_id.bit_length())]
    above = spark.createDataFrame(up, "node_id int, leaf int")
    table = spark.createDataFrame([(x.node_id, list(x.conditions), x.is_leaf) for x in nodes], f"node_id int, conditions {CONDITIONS}, is_leaf boolean")
    summed = above.join(counts, "leaf").groupBy("node_id").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    whole = table.join(summed, "node_id", "left").na.fill(0, ["n", "positives"])
    return whole.withColumn("rate", F.try_divide(F.col("positives").cast("double"), "n"))


def walk(nodes: Sequence[Node], column: Mapping[str, Column], at_leaf: Callable[[Node], Column]) -> Column:
    """What ``at_leaf`` gives for the leaf a row falls in, as one nested expression."""
    at = {x.node_id: x for x in nodes}

    def down(i: int) -> Column:
        if at[i].is_leaf:
            return at_leaf(at[i])
        feature, _, limit = at[2 * i].conditions[-1]
        return F.when(column[feature] <= limit, down(2 * i)).otherwise(down(2 * i + 1))

    return down(1)


def pruned(node_table: DataFrame, rows: int = 150, positives: int = 10, path: str = "conditions") -> DataFrame:
    """Nodes of a rule tree with the flags for pruning after training.

    A node is good with enough rows or positives. ``children_meet`` tells that a node below it is
    good too; ``final`` nodes are the good ones without. Ancestors are found by joining every
    path's own prefixes.
    """
    good = (F.col("n") >= rows) | (F.col("positives") >= positives)
    table = node_table.filter(F.col("n") > 0).withColumn("meets", good)
    prefixes = F.transform(F.sequence(F.lit(0), F.size(path) - 1), lambda i: F.slice(F.col(path), 1, i))
    below = table.filter("meets").filter(F.size(path) > 0).select(F.explode(prefixes).alias(path)).distinct().withColumn("children_meet", F.lit(True))
    flagged = table.join(below, path, "left").withColumn("children_meet", F.coalesce("children_meet", F.lit(False)))
    kind: Column = F.when(~F.col("meets") & F.col("children_meet"), "Parent").otherwise("Leaf")
    return flagged.withColumns({"node_type": kind, "final": F.col("meets") & ~F.col("children_meet")})


def rule_columns(rules: DataFrame, conditions: int = 7, digits: int = 3) -> DataFrame:
    """Conditions as text columns ``condition_1..k``, null beyond the rule's own."""
    def text(i: int) -> Column:
        c = F.get("conditions", i)
        return F.when(c.isNotNull(), F.concat_ws(" ", c["feature"], c["op"], F.format_string(f"%.{digits}f", c["threshold"])))

    return rules.withColumns({f"condition_{i + 1}": text(i) for i in range(conditions)}).drop("conditions")
