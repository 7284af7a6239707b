"""Rows that may have one of some keys, told by a table of fixed size, without moving a row.

A key's hash falls into one of 2^23 places. The places of many keys are at most 131,072 rows
of 64 bits, so they can be sent to all tasks, whatever the number of keys. A row at another
place has none of the keys; only the others need the exact join, and its shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACES, _WORD = 1 << 23, 64
_PLACE, _NUMBER, _BITS = "_place", "_place_number", "_place_bits"


def _place(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(_PLACES))


def places(keys: DataFrame, hashed: Column) -> pa.Table:
    """The places of all keys; without a key no row. One job."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(_PLACE) % _WORD).cast("int"))
    found = keys.select(_place(hashed).alias(_PLACE))
    return found.groupBy(F.expr(f"{_PLACE} div {_WORD}").alias(_NUMBER)).agg(F.bit_or(bit).alias(_BITS)).toArrow()


def by_places(rows: DataFrame, held: pa.Table, hashed: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that have none of the keys, rows that may have one)."""
    columns = rows.columns
    if not held.num_rows:
        return rows, rows.limit(0)
    words = F.broadcast(rows.sparkSession.createDataFrame(held))
    placed = rows.withColumn(_PLACE, _place(hashed))
    met = placed.join(words, F.expr(f"{_PLACE} div {_WORD}") == F.col(_NUMBER), "left")
    bit = F.call_function("shiftright", F.col(_BITS), (F.col(_PLACE) % _WORD).cast("int")).bitwiseAND(F.lit(1))
    may = F.coalesce(bit, F.lit(0)) == 1
    return met.filter(~may).select(*columns), met.filter(may).select(*columns)
