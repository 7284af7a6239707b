"""What the operators share: text helpers, scratch names, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.session import stage

#: ASCII white space; words are the runs between.
SPACE = " \t\n\x0b\x0c\r"
#: Lengths that are added up one by one in running totals.
_BLOCK = 256
_SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also when a lambda refers to it."""
    return F.transform(F.array(value), use)[0]


def text_of(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def running_totals(lengths: Column) -> Column:
    """Running totals, by blocks, so that many matches do not cost their square."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    size = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(size / _BLOCK).cast("int")),
        lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    before = let(blocks, lambda t: F.transform(t, lambda x, b: total(F.slice(t, F.lit(1), b))))
    return let(before, lambda t: F.transform(lengths, lambda x, i: F.get(t, F.floor(i / _BLOCK).cast("int")) + total(
        F.slice(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1))))


def own(name: str) -> str:
    """A column name that no input should bring along."""
    return f"_llm_{name}"


def refuse_clash(df: DataFrame, *names: str) -> DataFrame:
    """The input without columns that bear a name the operator gives out, in any case: they are replaced."""
    taken = {n.lower() for n in names}
    return df.select(*(df[c] for c in df.columns if c.lower() not in taken))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): connected components of (a, b); the root is the smallest node.

    Alternating stars: every node hooks its larger neighbours, then itself and its smaller
    ones, to the smallest node it sees, until nothing changes. Each round is groupings by
    ``min`` (combined before the shuffle) and equi-joins whose one side has one row per
    node, so a hub is split like any skewed join; rounds end in a written table. The rounds
    grow with the logarithm of the longest chain. Self-links and repeated links are fine.
    """
    links = stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        name,
    )
    mark = _fingerprint(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        links = stage(small, name)
        now = _fingerprint(links)
        if now == mark:
            break
        mark = now
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
