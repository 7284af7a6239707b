"""Exact top-k retrieval for whole tables of questions.

Questions without a filter are scored by a nested loop over blocks: every slice of points
meets every block of questions, and points never move. Up to `SENT` questions, a few blocks,
are sent to all tasks, which read their points slice by slice. More questions are packed
rows, as are the slices then, and Spark sends the blocks or splits the pairs among tasks. A
few questions with filter values go to the points in the same way; more of them meet their points in an equi-join on these values: a value with many points,
or with many questions, is split by salts on both sides, so a source, label or cell with a
third of all rows is many tasks' work.

Either way a pair of a slice and a block sends on the best k ids per question, Spark keeps
k per task before the shuffle and k after it, and only then are texts and other columns
fetched, by id. Nothing goes through the driver but numbers of rows and, if there are few,
the questions' vectors and the filter values that let the scan skip.

Scores are rounded to nine places before they are compared, and equal scores are
ordered by id, so ranks do not depend on how the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docquarry.functions.vectors import cosine, literal_vector, squared_l2
from docquarry.operators.encoding import unit_rows
from docquarry.session import stage

#: Questions in a block and points in a slice, at most (by salts: about).
BLOCK, SLICE = 1024, 4096
#: Up to so many questions are sent to the points; beyond, those with a filter are joined.
SENT = 4 * BLOCK
SCORE_PLACES = 9
# Largest score tile that is computed at once (points x questions).
_TILE = 4_000_000
# Up to so many filter values are listed in a predicate, so that the scan can skip.
_LISTED = 1000


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    lengths = column.value_lengths()
    if column.null_count or not pc.all(pc.equal(lengths, dim)).as_py():
        raise ValueError(f"every vector must have {dim} dimensions")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(-1, dim)


class _Block:
    """A bounded set of questions, grouped by the values they filter on."""

    def __init__(self, rows: pa.Table, filters: Sequence[str], metric: str):
        self.ids = rows.column("query_id").combine_chunks()
        lists = rows.column("embedding").combine_chunks()
        self.dim = len(lists[0])
        matrix = _matrix(lists, self.dim)
        self.vectors = unit_rows(matrix) if metric == "cosine" else matrix
        self.metric, self.filters = metric, filters
        # Wanted values -> places in the block.
        self.groups: dict[tuple, list[int]] = {}
        for i, wanted in enumerate(zip(*(rows.column(f).to_pylist() for f in filters)) if filters else [()] * len(rows)):
            self.groups.setdefault(wanted, []).append(i)

    def matches(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of the batch, questions) that belong together."""
        if not self.filters:
            yield np.arange(batch.num_rows), np.array(self.groups[()])
            return
        columns = [batch.column(f).dictionary_encode() for f in self.filters]
        code = np.zeros(batch.num_rows, dtype=np.int64)
        for column in columns:
            # Nulls share one code, which stands for no value.
            part = column.indices.fill_null(len(column.dictionary)).to_numpy(zero_copy_only=False)
            code = code * (len(column.dictionary) + 1) + part
        order = np.argsort(code, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0]) if len(order) else []
        for begin, end in zip(begins, [*begins[1:], len(order)]):
            rows = order[begin:end]
            key = tuple(c[int(rows[0])].as_py() for c in columns)
            if key in self.groups:
                yield rows, np.array(self.groups[key])

    def scores(self, points: np.ndarray, questions: np.ndarray) -> np.ndarray:
        """Higher is better, for both metrics."""
        wanted = self.vectors[questions]
        if self.metric == "cosine":
            return np.round(points @ wanted.T, SCORE_PLACES)
        squares = (
            (points**2).sum(axis=1)[:, None] + (wanted**2).sum(axis=1) - 2 * (points @ wanted.T)
        )
        return -np.round(np.maximum(squares, 0.0), SCORE_PLACES)

    def best(self, batch: pa.RecordBatch, k: int) -> pa.Table:
        """(query_id, score, id): the best k of the batch's points for each question."""
        vectors = _matrix(batch.column("embedding"), self.dim)
        # A vector that is not finite has no distance to anything.
        finite = np.isfinite(vectors).all(axis=1)
        if not finite.all():
            batch, vectors = batch.filter(pa.array(finite)), vectors[finite]
        place_of_id = np.empty(batch.num_rows, dtype=np.int64)
        place_of_id[pc.sort_indices(batch.column("id")).to_numpy()] = np.arange(batch.num_rows)
        if self.metric == "cosine":
            vectors = unit_rows(vectors)
        found = []
        for rows, questions in self.matches(batch):
            width = max(1, _TILE // max(1, len(rows)))
            for begin in range(0, len(questions), width):
                some = questions[begin:begin + width]
                scores = self.scores(vectors[rows], some)
                lowest = np.full(len(some), -np.inf)
                if len(rows) > k:
                    lowest = np.partition(scores, len(rows) - k, axis=0)[len(rows) - k]
                at, of = np.nonzero(scores >= lowest)
                # Of many equal scores the first ids stay.
                order = np.lexsort((place_of_id[rows[at]], -scores[at, of], of))
                begins = np.searchsorted(of[order], of[order])
                order = order[np.arange(len(order)) - begins < k]
                at, of = at[order], of[order]
                found.append(pa.table([
                    self.ids.take(pa.array(some[of])), pa.array(scores[at, of]),
                    batch.column("id").take(pa.array(rows[at]))], names=["query_id", "score", "id"]))
        return pa.concat_tables(found) if found else _NOTHING


_NOTHING = pa.table({"query_id": [], "score": [], "id": []})


def _packed(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Runs of up to so many rows, each as one binary value, where they lie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch.slice(begin, rows))
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=[name])

    return df.mapInArrow(run, f"{name} binary")


def _unpacked(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all()


def _nested(questions: DataFrame, points: DataFrame, used: list[str], k: int, metric: str, hits: T.StructType) -> DataFrame:
    """Slices of points and blocks of questions meet, each with each."""
    arrow, count = to_arrow_schema(hits), questions.count()
    points = _listed(points.select("id", "embedding", *used), questions, used)
    blocks = _packed(questions.coalesce(1 + count // BLOCK), BLOCK, "block")
    if count <= SENT:
        sent = points.sparkSession.sparkContext.broadcast([bytes(r["block"]) for r in blocks.collect()])

        def run_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = [_Block(_unpacked(pa.scalar(b, pa.binary())), used, metric) for b in sent.value]
            for batch in batches:
                for begin in range(0, batch.num_rows, SLICE):
                    for block in asked:
                        yield from block.best(batch.slice(begin, SLICE), k).cast(arrow).to_batches()

        return points.mapInArrow(run_sent, hits)

    # Written, so that Spark knows whether the blocks are small enough to send around.
    blocks = stage(blocks, "blocks")
    slices = _packed(points, SLICE, "points")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            for some, asked in zip(batch.column("points"), batch.column("block")):
                if block is None or not last.equals(asked):
                    last, block = asked, _Block(_unpacked(asked), used, metric)
                for part in _unpacked(some).to_batches():
                    yield from block.best(part, k).cast(arrow).to_batches()

    return slices.crossJoin(blocks).mapInArrow(run, hits)


def _joined(questions: DataFrame, points: DataFrame, used: list[str], k: int, metric: str, hits: T.StructType) -> DataFrame:
    """Questions and points that agree in the `used` columns."""
    arrow, keys = to_arrow_schema(hits), ["_points", "_questions"]
    values = questions.groupBy(*used).agg(F.count("*").alias("q"))
    points = _listed(points.select("id", "embedding", *used), values, used)
    sizes = points.groupBy(*used).agg(F.count("*").alias("p"))
    # One row per value that is asked for: into how many parts its points and questions go.
    split = stage(values.join(sizes, used).select(
        *used, "p", F.ceil(F.col("p") / SLICE).alias("ps"), F.ceil(F.col("q") / BLOCK).alias("qs")), "filter-values")
    buckets = 1 + (split.agg(F.sum(F.col("p") * F.col("qs"))).first()[0] or 0) // SLICE
    split = split.drop("p")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    bucket = F.pmod(F.xxhash64(*used, *keys), F.lit(buckets)).alias("_bucket")
    left = questions.join(split, used).select("query_id", "embedding", *used, every("ps").alias(keys[0]), part("query_id", "qs").alias(keys[1]))
    right = points.join(split, used).select("id", "embedding", *used, part("id", "ps").alias(keys[0]), every("qs").alias(keys[1]))
    columns = [*used, *keys]

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not asked.num_rows or not rows.num_rows:
            return arrow.empty_table()
        block = _Block(asked, columns, metric)
        return pa.concat_tables([block.best(b, k) for b in rows.combine_chunks().to_batches()], promote_options="permissive").cast(arrow)

    return left.select("*", bucket).groupBy("_bucket").cogroup(right.select("*", bucket).groupBy("_bucket")).applyInArrow(run, hits)


def _listed(points: DataFrame, values: DataFrame, used: list[str]) -> DataFrame:
    """The points of the values asked for: by a predicate for the scan where they are few, else by
    a semi-join, which Spark moves before the encoder as well."""
    for name in used:
        wanted = values.select(name).distinct()
        few = [r[0] for r in wanted.limit(_LISTED + 1).collect()]
        if len(few) <= _LISTED:
            points = points.filter(F.col(name).isin(sorted(few)))
        else:
            points = points.join(wanted, name, "left_semi")
    return points


def top_k(
    questions: DataFrame,
    points: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    filters: Sequence[str] = (),
    carry: Sequence[str] = (),
    many_values: bool = False,
) -> DataFrame:
    """(query_id, rank, id, score, carried columns), at most k rows per question.

    `filters` names columns of both sides that must be equal; a question with null
    there is not filtered. With `many_values` the question side holds arrays of
    accepted values; an empty one accepts none. For `l2` the score is the squared
    distance, smallest first. The id tells which point a carried column is fetched from.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric}")
    filters, carry = list(filters), list(carry)
    hits = T.StructType([
        T.StructField("query_id", questions.schema["query_id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("id", points.schema["id"].dataType)])
    asked = questions.select("query_id", "embedding", *filters)
    if many_values:
        for name in filters:
            some = F.array_compact(F.array_distinct(name))
            asked = asked.filter(F.col(name).isNull() | (F.size(some) > 0)).withColumn(name, F.explode_outer(some))
    asked = stage(asked, "questions")
    # Which columns a question filters on: at most two to the power of their number.
    masks = asked.select(*(F.col(f).isNotNull().alias(f) for f in filters)).distinct().collect() if filters else [()]
    found = None
    for mask in masks:
        used = [f for f, is_set in zip(filters, mask) if is_set]
        some = asked
        for f in filters:
            some = some.filter(F.col(f).isNotNull() if f in used else F.col(f).isNull())
        some = some.select("query_id", "embedding", *used)
        search = _joined if used and some.count() > SENT else _nested
        part = search(some, points, used, k, metric, hits)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = points.sparkSession.createDataFrame([], hits)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    score = -F.col("score") if metric == "l2" else F.col("score")
    ranked = ranked.select("query_id", "rank", "id", score.alias("score"))
    if not carry:
        return ranked
    ranked = stage(ranked, "ranked")
    fetched = points.select("id", *(c for c in carry if c != "id")).join(
        ranked.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    return ranked.join(fetched, "id").select("query_id", "rank", "id", "score", *carry)


def top_k_single(
    points: DataFrame, vector: Sequence[float], k: int = 5, metric: str = "cosine",
    where: Column | None = None,
) -> DataFrame:
    """One question: native scoring, then a top-k sort. The filter applies before ranking."""
    if where is not None:
        points = points.filter(where)
    question = literal_vector(vector)
    if metric == "cosine":
        score = F.round(cosine(F.col("embedding"), question), SCORE_PLACES)
        order = F.desc("score")
    else:
        score = F.round(squared_l2(F.col("embedding"), question), SCORE_PLACES)
        order = F.asc("score")
    return points.withColumn("score", score).orderBy(order, F.asc("id")).limit(k).drop("embedding")


def drop_empty_hits(hits: DataFrame) -> DataFrame:
    """Hits without text go after the ranking, so fewer than k may stay."""
    return hits.filter(F.coalesce(F.col("text"), F.lit("")) != "")


def hits_as_array(hits: DataFrame) -> DataFrame:
    """One row per question: its hit texts in rank order (at most k each)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy("query_id").agg(F.transform(ordered, lambda h: h["text"]).alias("texts"))
