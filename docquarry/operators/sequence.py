"""Running totals along ordered groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def with_start(
    df: DataFrame, group: str, order: str, length: str, out: str = "start",
    total: str | None = None, before: int | None = None, block: int = 4096,
) -> DataFrame:
    """Add the summed `length` of all earlier rows of the group, and as `total` of all.

    One window per group would sort a very large group in one task. Here the rows
    of a group are cut into blocks of `order`; windows run inside the blocks, and
    only one total per block goes through the window over the whole group. With
    `before`, rows that start there or later are left out.
    """
    df = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = df.groupBy(group, "_block").agg(F.sum(length).alias("_total"))
    over_blocks = Window.partitionBy(group).orderBy("_block").rowsBetween(*_SO_FAR)
    offsets = totals.select(
        group, "_block", (F.sum("_total").over(over_blocks) - F.col("_total")).alias("_offset"),
        *([F.sum("_total").over(Window.partitionBy(group)).alias(total)] if total else []),
    )
    if before is not None:
        offsets = offsets.filter(F.col("_offset") < before)
    in_block = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(*_SO_FAR)
    placed = (
        df.join(offsets, [group, "_block"])
        .withColumn(
            out, (F.col("_offset") + F.sum(length).over(in_block) - F.col(length)).cast("long")
        )
        .drop("_block", "_offset")
    )
    return placed if before is None else placed.filter(F.col(out) < before)
