"""Hard negatives by a secondary-sort shuffle.

Every anchor is scored against every row. Pair scores travel under the key (anchor,
descending score, positives first, id): dealt out by anchor, sorted within partitions, and
read by an iterator that opens a window below each of the anchor's first positives and
emits the first negatives of every window as they come. It holds the open windows of one
anchor, never its pairs, so an anchor whose label holds a third of all rows streams by.

Scores are made in tiles: anchors in blocks, rows in slices, each pair of a block and a
slice one task's work, of bounded size on both sides. A tile sends on only what can still
count: the first positives of each anchor (`positives` per tile are enough), and, once the
positives are known, the first negatives of each of their windows. So the sort sees a few
rows per anchor and tile, and the result is that of all pairs.

Components are scaled and rounded down to integers. Scores are exact: by floating-point
products where no partial sum can leave 2^53, by Python's integers beyond; scores beyond
the range of a long are set to its ends.

Edge cases: rows with a null label or vector, or with any null or non-finite component,
take no part; a label or id may be of any type that sorts. Only vectors of equal length
are scored with each other; two empty ones score 0. A null id sorts last among equal
scores and cannot be told apart by its id, but each row, also a repeated one, is a row of
its own: a copy of an anchor is one of its "other" rows, and an anchor that comes twice has
its results twice. Anchors without positives, and positives without negatives, give no
rows. Other columns, whatever their names, are not looked at. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docquarry.session import stage

#: Anchors in a block and rows in a slice, about: a tile has a million scores.
BLOCK, SLICE = 1024, 1024
_LONG = (1 << 63) - 1
_LEAST = np.int64(-_LONG - 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers, as longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    return np.clip(whole(a) @ whole(b).T, -_LONG, _LONG).astype(np.int64)


def first(scores: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest masked scores of each row; of equal ones the first columns."""
    n, width = scores.shape
    if np.abs(scores).max(initial=0) >= _LONG // (2 * width + 2) or (scores == _LEAST).any():
        _, ranks = np.unique(scores, return_inverse=True)
        scores = ranks.reshape(n, width)
    # Score and column in one number: distinct, so exactly k are the highest.
    packed = np.where(mask, scores * width + (width - 1 - np.arange(width)), _LEAST)
    if width > k:
        packed = np.partition(packed, width - k, axis=1)[:, width - k:]
    rows, places = np.nonzero(packed != _LEAST)
    return rows, width - 1 - packed[rows, places] % width


def _codes(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    rows = len(column)
    flat = pc.list_flatten(column).to_numpy().astype(np.float64)
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.floor(np.clip(flat * scale, -most, most)).reshape(rows, -1 if flat.size else 0)


class _Tile:
    """All scores of a block of anchors and a slice of rows; rows in the order of their ids."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, scale: float):
        self.rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("row", "ascending")]))
        self.anchors = anchors
        self.scores = products(_codes(anchors.column("vector"), scale), _codes(self.rows.column("vector"), scale))
        labels = pa.chunked_array([*anchors.column("label").chunks, *self.rows.column("label").chunks])
        codes = labels.combine_chunks().dictionary_encode().indices.to_numpy()
        self.same = codes[:anchors.num_rows, None] == codes[None, anchors.num_rows:]
        self.itself = anchors.column("row").to_numpy()[:, None] == self.rows.column("row").to_numpy()[None]

    def records(self, at: np.ndarray, of: np.ndarray, negative: bool, schema: pa.Schema) -> pa.Table:
        anchors, rows = self.anchors.take(pa.array(at)), self.rows.take(pa.array(of))
        return pa.table([
            anchors.column("row"), anchors.column("id"), pa.array(self.scores[at, of]),
            pa.array(np.full(len(at), negative)), rows.column("id"), rows.column("row"),
        ], schema=schema)


def _tiles(anchors: DataFrame, rows: DataFrame, blocks: int, slices: int, work, schema: T.StructType) -> DataFrame:
    """`work(anchors, rows)` for each block of anchors and slice of rows of equal length."""
    key = ["length", "block", "slice"]
    length = F.size("vector")
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.select("*", length.alias("length"), dealt(blocks).alias("block"), every(slices).alias("slice"))
    # Names of its own, as both sides may stem from one table.
    rows = rows.toDF(*rows.columns)
    right = rows.select("*", length.alias("length"), every(blocks).alias("block"), dealt(slices).alias("slice"))
    empty = to_arrow_schema(schema).empty_table()

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return work(a, b) if a.num_rows and b.num_rows else empty

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)


def _by_anchor(pairs: DataFrame) -> DataFrame:
    """The secondary sort: each anchor's pairs together and in order."""
    return pairs.repartition("anchor").sortWithinPartitions(
        "anchor", F.desc("score"), "negative", F.asc_nulls_last("id"), "row")


def _positives(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The first k pairs of each anchor."""
    anchor, seen = None, 0
    for batch in batches:
        keep = []
        for i, a in enumerate(batch.column("anchor").to_pylist()):
            anchor, seen = (a, 0) if a != anchor else (anchor, seen)
            if seen < k:
                keep.append(i)
                seen += 1
        yield batch.take(pa.array(keep, pa.int64()))


def window(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """The least and greatest negative score that goes with a positive's."""
    return -(-score * low[0] // low[1]), score * high[0] // high[1]


def _negatives(batches, positives: int, negatives: int, low, high, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The first negatives of each positive's window, in one pass over the sorted pairs."""
    anchor, opened, windows = None, 0, []
    for batch in batches:
        out = []
        names = ("anchor", "anchor_id", "score", "negative", "id")
        for a, anchor_id, score, negative, other in zip(*(batch.column(c).to_pylist() for c in names)):
            if a != anchor:
                anchor, opened, windows = a, 0, []
            if not negative:
                if opened < positives:
                    opened += 1
                    least, most = window(score, low, high)
                    windows.append([least, most, 0, other, score])
                continue
            closed = False
            for w in windows:
                if w[0] <= score <= w[1]:
                    w[2] += 1
                    out.append((anchor_id, w[3], w[2], other, w[4], score))
                closed |= score < w[0] or w[2] == negatives
            if closed:
                windows = [w for w in windows if score >= w[0] and w[2] < negatives]
        columns = zip(*out) if out else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3,
    low: tuple[int, int] = (1, 2), high: tuple[int, int] = (19, 20), scale: float = 256.0,
    id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` says which rows are anchors. `low` and `high` are fractions: a negative counts
    for a positive if its score is between these parts of the positive's.
    """
    if not (0 < positives and 0 < negatives and 0 <= low[0] * high[1] <= high[0] * low[1] <= low[1] * high[1]):
        raise ValueError("at least one positive and negative, and 0 <= low <= high <= 1")
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    kind = vectors.schema[vector_column].dataType.elementType
    numbers = F.col(vector_column) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vector_column).cast("array<double>")
    rows = stage(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(label_column).alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), numbers.alias("vector"),
    ).filter(F.col("label").isNotNull() & F.forall("vector", finite)), "negatives-rows")
    size = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks, slices = 1 + size[1] // BLOCK, 1 + size[0] // SLICE
    asked, rows = rows.filter("anchor").drop("anchor"), rows.drop("anchor")

    id_type = rows.schema["id"].dataType
    pair = T.StructType([
        T.StructField("anchor", T.LongType()), T.StructField("anchor_id", id_type), T.StructField("score", T.LongType()),
        T.StructField("negative", T.BooleanType()), T.StructField("id", id_type), T.StructField("row", T.LongType())])
    arrow_pair = to_arrow_schema(pair)

    def best_positives(a: pa.Table, b: pa.Table) -> pa.Table:
        tile = _Tile(a, b, scale)
        return tile.records(*first(tile.scores, tile.same & ~tile.itself, positives), False, arrow_pair)

    def best_negatives(a: pa.Table, b: pa.Table) -> pa.Table:
        tile = _Tile(a, b, scale)
        found = np.zeros(tile.scores.shape, dtype=bool)
        scores = a.column("scores").to_pylist()
        for k in range(max(map(len, scores))):
            bounds = [window(s[k], low, high) if k < len(s) else (1, 0) for s in scores]
            least, most = (np.clip(np.array(x, dtype=object), -_LONG, _LONG).astype(np.int64)[:, None] for x in zip(*bounds))
            found[first(tile.scores, ~tile.same & (tile.scores >= least) & (tile.scores <= most), negatives)] = True
        return tile.records(*np.nonzero(found), True, arrow_pair)

    near = _tiles(asked, rows, blocks, slices, best_positives, pair)
    near = stage(_by_anchor(near).mapInArrow(lambda batches: _positives(batches, positives), pair), "negatives-positives")
    # At most `positives` scores for an anchor.
    scores = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("scores"))
    far = _tiles(asked.join(scores, "row"), rows, blocks, slices, best_negatives, pair)

    out = T.StructType([
        T.StructField("anchor_id", id_type), T.StructField("positive_id", id_type), T.StructField("rank", T.IntegerType()),
        T.StructField("negative_id", id_type), T.StructField("positive_score", T.LongType()),
        T.StructField("negative_score", T.LongType())])
    arrow_out = to_arrow_schema(out)
    return _by_anchor(near.unionByName(far)).mapInArrow(
        lambda batches: _negatives(batches, positives, negatives, low, high, arrow_out), out)
