"""Approximate search by an inverted file: points are filed into cells, questions read a few.

Cells are the neighbourhoods of centroids, by cosine. The centroids are trained on a
sample of bounded, stated size (spherical k-means from the sample's first points), so
training costs the same at any size; every point is filed. The file is a table
partitioned by cell: a search lists the cells that its questions probe, their nearest
ones first, and the scan reads these folders only. Within them the search is the exact
one, an equi-join on the cell that splits large cells and popular ones.

`recall` compares with the exact result; it depends on how much the data clusters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.encoding import unit_rows
from docquarry.operators.retrieval import SCORE_PLACES, top_k
from docquarry.session import stage

#: Points that centroids are trained on, at most, and rounds of training.
SAMPLE, ROUNDS = 16_384, 5


def _nearest(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n nearest cells of each vector, nearest first; of equal ones the first."""
    near = np.round(unit_rows(vectors) @ centroids.T, SCORE_PLACES)
    return np.argsort(-near, axis=1, kind="stable")[:, :n]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


@dataclass(frozen=True)
class Cells:
    """Trained centroids, one row each: as many numbers as cells times dimensions."""

    centroids: np.ndarray

    @classmethod
    def train(cls, points: DataFrame, cells: int, sample: int = SAMPLE, rounds: int = ROUNDS) -> Cells:
        """From the points whose ids have the lowest MD5, at most `sample` of them."""
        rows = points.filter(F.exists("embedding", lambda x: x != 0)).select("id", "embedding").orderBy(
            F.md5(F.col("id").cast("string")), "id").limit(sample).toArrow()
        if not rows.num_rows:
            raise ValueError("no points to train cells on")
        vectors = unit_rows(_matrix(rows.column("embedding").combine_chunks()))
        centroids = vectors[:cells].copy()
        for _ in range(rounds):
            own = _nearest(vectors, centroids, 1)[:, 0]
            sums = np.zeros_like(centroids)
            np.add.at(sums, own, vectors)
            # A cell that lost all its points stays where it is.
            held = np.bincount(own, minlength=len(centroids)) > 0
            centroids[held] = unit_rows(sums[held])
        return cls(centroids)

    def _add(self, df: DataFrame, n: int | None) -> DataFrame:
        kind = T.IntegerType() if n is None else T.ArrayType(T.IntegerType())
        base = df.drop("cell")
        schema = T.StructType([*base.schema.fields, T.StructField("cell", kind)])
        shared = df.sparkSession.sparkContext.broadcast(self.centroids)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    near = _nearest(_matrix(batch.column("embedding")), shared.value, n or 1)
                    cells = pa.array(near[:, 0] if n is None else list(near), pa.int32() if n is None else pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cell"])

        return base.mapInArrow(run, schema)

    def assign(self, points: DataFrame) -> DataFrame:
        """The points with their `cell`."""
        return self._add(points, None)

    def probe(self, questions: DataFrame, probes: int) -> DataFrame:
        """The questions with the array `cell`: the nearest cells, nearest first."""
        return self._add(questions, min(probes, len(self.centroids)))

    def write(self, points: DataFrame, path: str) -> None:
        """File all points: one folder per cell, large cells in several files."""
        self.assign(points).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def approximate_top_k(
    questions: DataFrame, filed: DataFrame, cells: Cells, k: int = 5, probes: int = 4, metric: str = "cosine",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Top-k within the probed cells of a filed table (or of points with a `cell` column)."""
    looking = cells.probe(questions.select("query_id", "embedding"), probes)
    # At most as many numbers as there are cells; they reach the scan as partition filters.
    looking = stage(looking, "probes")
    wanted = [r[0] for r in looking.select(F.explode("cell").alias("cell")).distinct().collect()]
    return top_k(looking, filed.filter(F.col("cell").isin(sorted(wanted))), k, metric, filters=["cell"], carry=carry, many_values=True)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found, over all questions."""
    found = approximate.select("query_id", "id", F.lit(1).alias("found"))
    return exact.join(found, ["query_id", "id"], "left").agg(
        F.count("*").alias("exact_hits"),
        F.count("found").alias("found_hits"),
        F.avg(F.coalesce("found", F.lit(0))).alias("recall_at_k"),
    )


def recall_by_probes(questions: DataFrame, filed: DataFrame, cells: Cells, exact: DataFrame) -> DataFrame:
    """(probes, exact_hits, found_hits, recall_at_k, rows_read): for each number of probes, the
    share of the exact hits it finds and of all points it reads, on average.

    An exact hit is found if its cell is among the probed ones, so one look at the cell of
    each exact hit gives the whole curve.
    """
    # One row per cell, so a few numbers per question.
    sizes = stage(filed.groupBy("cell").agg(F.count("*").alias("n")), "cell-sizes")
    order = cells.probe(questions.select("query_id", "embedding"), len(cells.centroids))
    order = stage(order.select("query_id", F.posexplode("cell").alias("nth", "cell")), "probes")
    total = sizes.agg(F.sum("n").alias("total"))
    so_far = Window.partitionBy("query_id").orderBy("nth")
    read = order.join(sizes, "cell", "left").withColumn("n", F.sum(F.coalesce("n", F.lit(0))).over(so_far))
    read = read.groupBy("nth").agg(F.avg("n").alias("n")).join(total).select("nth", (F.col("n") / F.col("total")).alias("rows_read"))
    hits = exact.select("query_id", "id").join(filed.select("id", "cell"), "id").join(order, ["query_id", "cell"])
    found = hits.groupBy("nth").agg(F.count("*").alias("found"))
    # As many rows as there are cells.
    curve = Window.orderBy("nth")
    return read.join(found, "nth", "left").select(
        (F.col("nth") + 1).alias("probes"),
        F.sum(F.coalesce("found", F.lit(0))).over(Window.partitionBy()).alias("exact_hits"),
        F.sum(F.coalesce("found", F.lit(0))).over(curve).alias("found_hits"), "rows_read",
    ).withColumn("recall_at_k", F.col("found_hits") / F.col("exact_hits"))


def enough_probes(curve: DataFrame, target: float = 0.9) -> int:
    """The least number of probes whose recall reaches the target."""
    return curve.filter(F.col("recall_at_k") >= target).agg(F.min("probes")).first()[0]
