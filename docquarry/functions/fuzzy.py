"""Token-set similarity of two texts.

The score (0-100) compares the words two texts share and the words only one of
them has. It needs the insert/delete distance of the two leftover strings. That
distance lies between the difference and the sum of their lengths, which decides
most pairs natively; only the rest reach Python, as Arrow batches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from docquarry.functions.text import word_set


def common_subsequence(left: str, right: str) -> int:
    """Length of the longest common subsequence; one machine-integer row per character."""
    places: dict[str, int] = {}
    for i, ch in enumerate(left):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for ch in right:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


@F.pandas_udf(LongType())
def _indel(left: pd.Series, right: pd.Series) -> pd.Series:
    def one(a, b):
        return None if a is None or b is None else len(a) + len(b) - 2 * common_subsequence(a, b)

    return pd.Series([one(a, b) for a, b in zip(left, right)], dtype="Int64")


def _with_parts(df: DataFrame, left: Column, right: Column) -> DataFrame:
    df = df.withColumn("_l", word_set(left)).withColumn("_r", word_set(right))
    joined = lambda words: F.array_join(F.array_sort(words), " ")
    return (
        df.withColumn("_common", joined(F.array_intersect("_l", "_r")))
        .withColumn("_a", joined(F.array_except("_l", "_r")))
        .withColumn("_b", joined(F.array_except("_r", "_l")))
        .withColumn("_empty", (F.size("_l") == 0) | (F.size("_r") == 0))
    )


def _score(indel: Column) -> Column:
    """The score for a given insert/delete distance of the leftovers `_a` and `_b`."""
    x, a, b = F.length("_common"), F.length("_a"), F.length("_b")
    gap = F.when(x > 0, 1).otherwise(0)
    p, q = x + gap + a, x + gap + b
    leftovers = 100.0 * (1.0 - indel / (p + q))
    shared_left = 100.0 * (1.0 - (gap + a) / (x + p))
    shared_right = 100.0 * (1.0 - (gap + b) / (x + q))
    return (
        F.when(F.col("_empty"), 0.0)
        .when((x > 0) & ((a == 0) | (b == 0)), 100.0)
        .when(x == 0, leftovers)
        .otherwise(F.greatest(leftovers, shared_left, shared_right))
    )


_PARTS = ["_l", "_r", "_common", "_a", "_b", "_empty"]


def with_token_set_bounds(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """Add `score_low` and `score_high`, which enclose the exact score."""
    a, b = F.length("_a"), F.length("_b")
    return (
        _with_parts(df, left, right)
        .withColumn("score_low", _score(a + b))
        .withColumn("score_high", _score(F.abs(a - b)))
        .drop(*_PARTS)
    )


def with_token_set_ratio(df: DataFrame, left: Column, right: Column, out: str) -> DataFrame:
    """Add the exact score of every pair."""
    df = _with_parts(df, left, right)
    return df.withColumn(out, _score(_indel("_a", "_b"))).drop(*_PARTS)


def with_token_set_match(
    df: DataFrame, left: Column, right: Column, out: str, threshold: float
) -> DataFrame:
    """Add `out`: is the exact score above the threshold?

    Pairs settled by the bounds send nulls to Python, which skips them.
    """
    df = _with_parts(df, left, right)
    a, b = F.length("_a"), F.length("_b")
    surely = _score(a + b) > threshold
    never = _score(F.abs(a - b)) <= threshold
    df = df.withColumn("_open", ~surely & ~never)
    indel = _indel(F.when(F.col("_open"), F.col("_a")), F.when(F.col("_open"), F.col("_b")))
    match = F.when(F.col("_open"), _score(indel) > threshold).otherwise(surely)
    return df.withColumn(out, match).drop("_open", *_PARTS)
