"""Merkle manifest of a data set: a tree of digests per part, and a tree over the parts.

A leaf is the digest of a row's columns. Per tree, nodes are numbered from 0 in order, and
runs of `FAN` consecutive ones make a family. Every level joins its nodes with themselves:
a node computes the numbers of its siblings (the other slots of its family) and meets them
in an equi-join; the rows in slot zero then emit the parents. All trees climb together, a
level at a time, until each has one node; the roots of the parts are the leaves of the top
tree. On the way down every family hands its path to its children, so a row gets the
siblings of all levels without any level meeting all rows.

At scale: a level shuffles its nodes once, by family (at most `FAN` rows, so no hot key,
however large one part is), and has an eighth of the rows of the one below. Numbers come
from a range partition: position within its partition plus the rows before, of which
there is one count per tree and partition. Levels are written tables, so a lost executor
costs a part of one level. Nothing is gathered in one task or the driver but the height.

Edge cases: a null value is `-` in a leaf. Nulls sort first, in the part and in the order
column; rows that agree there are ordered by their leaves, so equal rows are leaves of
their own and interchangeable. Very long texts are only hashed. Columns named like a
result are replaced, others carried along. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import own, refuse_clash
from docquarry.session import stage

FAN = 8
RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
_STEP = "array<struct<before:string,after:string>>"


def sha256(*parts: Column) -> Column:
    """Lowercase hex digest of the strings put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as byte count, colon, value; `-` for null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return sha256(*map(part, columns))


def numbered(rows: DataFrame, tree: str, order: Sequence[str], number: str, size: str) -> DataFrame:
    """The rows with their number from 0 within their tree, in ascending order, nulls first,
    and the tree's number of rows.

    Rows that agree in `order` are told apart by their place in the input, so they spread
    over partitions too.
    """
    part, place, row, base = own("part"), own("place"), own("row"), own("base")
    keys = [tree, *order, row]
    spread = rows.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(
        spread.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id()).drop(row),
        "merkle-order")
    # One row per tree and partition; as a written table, Spark knows whether it is small.
    counts = placed.groupBy(tree, part).agg(F.count("*").alias(size), F.min(place).alias(base))
    before = Window.partitionBy(tree).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = stage(counts.select(
        tree, part, F.sum(size).over(Window.partitionBy(tree)).alias(size),
        (F.coalesce(F.sum(size).over(before), F.lit(0)) - F.col(base)).alias(base)), "merkle-shift")
    return placed.join(shift, [tree, part]).withColumn(number, F.col(place) + F.col(base)).drop(part, place, base)


def siblings(nodes: DataFrame) -> DataFrame:
    """The nodes (tree, number, size, hash and others) with family, slot, before and after.

    A node's siblings stand 1 to `FAN` - 1 slots on, modulo `FAN`, in the same family;
    `before` and `after` are their digests put together, in order.
    """
    rows = nodes.withColumns({"family": F.expr(f"number div {FAN}"), "slot": F.expr(f"number % {FAN}")})
    rows = rows.repartition("tree", "family")
    wanted = F.transform(F.sequence(F.lit(1), F.lit(FAN - 1)), lambda k: F.col("family") * FAN + (F.col("slot") + k) % FAN)
    node = F.struct(*(c for c in rows.columns if c not in ("tree", "family")))
    asks = rows.select("tree", "family", node.alias("node"), wanted.alias("wanted")).alias("a")
    other = rows.select("tree", "family", F.col("number").alias("sibling"), F.col("hash").alias("digest")).alias("s")
    # The family, which a sibling's number begins with, is what both sides are dealt by: one
    # shuffle serves the join, the grouping, and a join with the parents.
    met = asks.join(
        other.hint("merge"),
        F.expr("a.tree = s.tree AND a.family = s.family AND array_contains(a.wanted, s.sibling)"), "left")
    found = met.groupBy("a.tree", "a.family", "a.node.slot").agg(
        F.first("node").alias("node"),
        F.array_sort(F.collect_list(F.when(F.col("sibling").isNotNull(), F.struct("sibling", "digest")))).alias("s"))
    joined = lambda keep: F.array_join(F.transform(F.filter("s", keep), lambda x: x["digest"]), "")
    return found.select(
        "tree", "family", *(f"node.{c}" for c in rows.columns if c not in ("tree", "family")),
        joined(lambda x: x["sibling"] < F.col("node.number")).alias("before"),
        joined(lambda x: x["sibling"] > F.col("node.number")).alias("after"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(levels, roots): the node tables from the leaves up, and (tree, hash, height) of the
    last nodes. A level holds the nodes of all trees that have more than one node there."""
    levels, roots = [], None
    while True:
        done = nodes.filter("size = 1").select("tree", "hash", F.lit(len(levels)).alias("height"))
        roots = done if roots is None else roots.unionByName(done)
        nodes = nodes.filter("size > 1")
        if nodes.isEmpty():
            return levels, stage(roots, "merkle-roots")
        levels.append(nodes)
        parents = siblings(nodes).filter("slot = 0").select(
            "tree", F.col("family").alias("number"), F.ceil(F.col("size") / FAN).cast("long").alias("size"),
            sha256(F.col("before"), F.col("hash"), F.col("after")).alias("hash"))
        nodes = stage(parents, "merkle-level")


def _paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with `top` and `path`, the siblings of every level from the lowest up.

    `tops` (tree, height, top, path) gives what stands above the roots; it is handed down.
    """
    def children(nodes: DataFrame, above: DataFrame) -> DataFrame:
        step = F.array(F.struct("before", "after")).cast(_STEP)
        return siblings(nodes).join(above.hint("merge"), ["tree", "family"]).select(
            *nodes.columns, "top", F.concat(step, "path").alias("path"))

    def roots(height: int) -> DataFrame:
        return tops.filter(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("family"), "top", "path")

    above = roots(len(levels))
    for height in range(len(levels) - 1, 0, -1):
        down = children(levels[height], above).select("tree", F.col("number").alias("family"), "top", "path")
        above = stage(down.unionByName(roots(height)), "merkle-paths")
    alone = leaves.filter("size = 1").join(roots(0), "tree").select(*leaves.columns, "top", "path")
    return children(leaves.filter("size > 1"), above).unionByName(alone) if levels else alone


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, lowest level first, lead to."""
    return F.aggregate(path, start, lambda x, s: sha256(s["before"], x, s["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(
    rows: DataFrame, columns: Sequence[str], part: str, order: str,
    tampered: Column | None = None, instead: dict[str, Column] | None = None,
) -> DataFrame:
    """The rows (without the hashed columns, but with `part` and `order`) with leaf, subroot,
    root, proof_sha256, folded_root and verified.

    Where `tampered` holds, `instead` gives other values for some columns: `folded_root` is
    what the leaf of these values leads to, by the siblings of the untampered tree.
    """
    base = refuse_clash(rows, *RESULTS)
    kept = [c for c in base.columns if c not in columns or c in (part, order)]
    original = leaf([F.col(c) for c in columns])
    changed = original if tampered is None else F.when(
        tampered, leaf([(instead or {}).get(c, F.col(c)) for c in columns])).otherwise(original)
    leaves = stage(base.select(
        # A null part sorts before the empty one.
        F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit("")).alias("tree"),
        F.col(order).alias("position"), original.alias("hash"), changed.alias("held"), F.struct(*kept).alias("row"),
    ), "merkle-leaves")
    listed = stage(numbered(leaves, "tree", ["position", "hash"], "number", "size").drop("position"), "merkle-leaves")
    levels, roots = climb(listed.select("tree", "number", "size", "hash"))

    parts = roots.select(F.lit("").alias("all"), F.col("tree").alias("part"), "height", "hash")
    top = stage(numbered(parts, "all", ["part"], "number", "size").withColumnRenamed("all", "tree"), "merkle-top")
    top_levels, root = climb(top.select("tree", "number", "size", "hash"))
    start = root.select("tree", "height", F.col("hash").alias("top"), F.array().cast(_STEP).alias("path"))
    tops = stage(_paths(top, top_levels, start).select(
        F.col("part").alias("tree"), "height", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"), "path",
    ), "merkle-tops")

    return _paths(listed, levels, tops).select(
        "row.*", F.col("hash").alias("leaf"), "top.subroot", "top.root", proof(F.col("path")).alias("proof_sha256"),
        fold(F.col("held"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
