"""Array helpers that keep costly expressions from being computed twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unnest(df: DataFrame, keep: list, array: Column, place: str, value: str) -> DataFrame:
    """One row per array item with its place; rows with a null or empty array go.

    A plain explode makes the optimiser filter on the array's size first, which
    computes the array a second time. The outer form with a filter on the place
    afterwards gives the same rows and computes it once.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(place, value)).filter(
        F.col(place).isNotNull()
    )
