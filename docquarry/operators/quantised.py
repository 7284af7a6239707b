"""Exact search over 8-bit codes: a first pass with a proven error bound, then exact scores.

A vector is kept as one byte per dimension, a scale, and the length of what rounding took
away. The inner product with a question is off by at most that length times the question's
(Cauchy and Schwarz), so every point has a lowest and a highest possible score. The first
pass reads codes only, a quarter of the bytes of 4-byte floats, and keeps the points whose
highest score reaches the k-th best lowest one; only these are fetched and scored exactly.
So the result is that of `top_k`, whatever the data; how many points are fetched depends
on how close scores lie together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docquarry.functions.vectors import cosine, squared_l2
from docquarry.operators.encoding import unit_rows
from docquarry.operators.retrieval import BLOCK, SCORE_PLACES, SLICE, _packed, _unpacked
from docquarry.session import stage

#: Added to every bound, for scores that are equal once rounded.
_SLACK = 2 * 10.0**-SCORE_PLACES


def _vectors(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def with_codes(points: DataFrame, metric: str = "cosine") -> DataFrame:
    """(id, code, scale, lost, square): what the first pass reads, to be kept as a table.

    Vectors that are not finite have no code. All must have the same number of dimensions.
    """
    schema = T.StructType([
        points.schema["id"], T.StructField("code", T.BinaryType()), T.StructField("scale", T.DoubleType()),
        T.StructField("lost", T.DoubleType()), T.StructField("square", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            exact = _vectors(batch.column("embedding"))
            finite = np.isfinite(exact).all(axis=1)
            ids, exact = batch.column("id").filter(pa.array(finite)), exact[finite]
            exact = unit_rows(exact) if metric == "cosine" else exact
            scale = np.abs(exact).max(axis=1, initial=0) / 127
            code = np.round(np.divide(exact, scale[:, None], out=np.zeros_like(exact), where=scale[:, None] > 0)).astype(np.int8)
            lost = np.linalg.norm(exact - code * scale[:, None], axis=1)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), pa.array(lost),
                pa.array((exact**2).sum(axis=1))], names=schema.names)

    return points.select("id", "embedding").mapInArrow(run, schema)


def candidates(questions: DataFrame, codes: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """(query_id, id): all points that can be among the k best of a question."""
    schema = T.StructType([
        questions.schema["query_id"], codes.schema["id"], T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])
    arrow = to_arrow_schema(schema)
    asked = stage(questions.select("query_id", "embedding"), "questions")
    blocks = stage(_packed(asked.coalesce(1 + asked.count() // BLOCK), BLOCK, "block"), "blocks")

    def bounds(points: pa.Table, asked: pa.Table) -> pa.Table:
        wanted = _vectors(asked.column("embedding").combine_chunks())
        wanted = unit_rows(wanted) if metric == "cosine" else wanted
        scale, lost, square = (points.column(c).to_numpy() for c in ("scale", "lost", "square"))
        code = np.frombuffer(b"".join(points.column("code").to_pylist()), dtype=np.int8).reshape(points.num_rows, -1)
        near = (code.astype(np.float64) @ wanted.T) * scale[:, None]
        off = lost[:, None] * np.linalg.norm(wanted, axis=1)
        if metric == "l2":
            near, off = 2 * near - square[:, None] - (wanted**2).sum(axis=1), 2 * off
        low, high = near - off - _SLACK, near + off + _SLACK
        floor = np.full(low.shape[1], -np.inf)
        if len(low) > k:
            floor = np.partition(low, len(low) - k, axis=0)[len(low) - k]
        at, of = np.nonzero(high >= floor)
        return pa.table([
            asked.column("query_id").take(pa.array(of)), points.column("id").take(pa.array(at)),
            pa.array(low[at, of]), pa.array(high[at, of])], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, asked in zip(batch.column("points"), batch.column("block")):
                yield from bounds(_unpacked(points), _unpacked(asked)).to_batches()

    found = stage(_packed(codes, SLICE, "points").crossJoin(blocks).mapInArrow(run, schema), "bounds")
    best = Window.partitionBy("query_id").orderBy(F.desc("low"))
    kth = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).groupBy("query_id").agg(
        F.min("low").alias("floor"), F.count("*").alias("n"))
    # With fewer than k points in all, every one of them counts.
    floor = kth.select("query_id", F.when(F.col("n") == k, F.col("floor")).otherwise(float("-inf")).alias("floor"))
    return found.join(floor, "query_id").filter(F.col("high") >= F.col("floor")).select("query_id", "id")


def quantised_top_k(questions: DataFrame, codes: DataFrame, points: DataFrame, k: int = 5, metric: str = "cosine") -> DataFrame:
    """(query_id, rank, id, score) as `top_k` gives them; `codes` are those of the points."""
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric}")
    near = stage(candidates(questions, codes, k, metric), "candidates")
    pairs = near.join(points.select("id", "embedding"), "id").join(
        questions.select("query_id", F.col("embedding").alias("asked")), "query_id")
    measure = cosine if metric == "cosine" else squared_l2
    scored = pairs.select("query_id", "id", F.round(measure(F.col("embedding"), F.col("asked")), SCORE_PLACES).alias("score"))
    order = F.desc("score") if metric == "cosine" else F.asc("score")
    best = Window.partitionBy("query_id").orderBy(order, F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
