"""Text encoders: text column in, unit-length `array<float>` column out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.ids import chunk_key, uuid5
from docquarry.functions.text import EDGE_SIGNS, terms
from docquarry.functions.words import word_values

# A term falls into one of 16^4 slots, by the first four digits of its MD5. The
# document frequencies are kept per slot, so the table has this many rows at most,
# whatever the size of the corpus and of its vocabulary.
SLOTS = 65536
_EVERY_CHUNK = -1
_NO_TERM = -1


def slot(term: Column) -> Column:
    return F.conv(F.substring(F.md5(term), 1, 4), 16, 10).cast("int")


def _slot_of(word: str) -> int:
    """The slot of a lower-cased word's term, `_NO_TERM` for one of edge signs only."""
    term = word.strip(EDGE_SIGNS)
    return int.from_bytes(md5(term.encode()).digest()[:2], "big") if term else _NO_TERM


def _slot_lists(texts: pa.Array) -> pa.ListArray:
    """The slots of each lower-cased text; of a null text none."""
    ends, found = word_values(texts, _slot_of, np.int32)
    kept = found != _NO_TERM
    ends = np.r_[0, np.cumsum(kept)][ends]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[kept]))


def slots(text: Column) -> Column:
    """The slots of a text's terms, in order, with repeats: `slot` of each of its `terms`.

    Words repeat, so each word of a batch is hashed once.
    """
    @F.arrow_udf("array<int>")
    def lookup(texts: pa.Array) -> pa.Array:
        return _slot_lists(texts)

    return lookup(F.lower(text))


def with_slots(df: DataFrame, text: str = "text", out: str = "slots") -> DataFrame:
    """Add the slots, for a stage that is both fitted and encoded."""
    return df.withColumn(out, slots(F.col(text)))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def list_column(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def _flat(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of all slots."""
    lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(ids)), lengths), ids.flatten().to_numpy(zero_copy_only=False)


def _hash_rows(ids: pa.ListArray, place: pa.Array, weights: np.ndarray, dim: int) -> pa.ListArray:
    """Sum the weights of each row's slots into `dim` buckets and scale to unit length.

    `place` tells which of the stacked weight tables is a row's.
    """
    rows = len(ids)
    row_of, flat = _flat(ids)
    flat = flat + place.to_numpy(zero_copy_only=False)[row_of] * SLOTS
    sums = np.bincount(
        row_of * dim + flat % dim, weights=weights[flat], minlength=rows * dim
    ).astype(np.float64).reshape(rows, dim)  # without any slot the sums are whole numbers
    return list_column(unit_rows(sums))


def slot_counts(chunks: DataFrame, by: str | None = None, text: str = "text") -> DataFrame:
    """(group, slot, count): in how many chunks each slot occurs; slot -1 counts the chunks.

    Counts of disjoint sets of chunks add up, so they can follow a changing collection.
    """
    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    ids = F.col("slots") if "slots" in chunks.columns else slots(F.col(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("group").dictionary_encode(null_encoding="encode")
            code = groups.indices.to_numpy(zero_copy_only=False)
            row, slot = _flat(batch.column("slots"))
            for i in range(len(groups.dictionary)):
                found = np.bincount(slot[code[row] == i], minlength=SLOTS)
                some = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([
                    groups.dictionary.take(pa.array(np.full(len(some) + 1, i))),
                    pa.array(np.r_[_EVERY_CHUNK, some], pa.int32()),
                    pa.array(np.r_[np.count_nonzero(code == i), found[some]], pa.int64())], names=["group", "slot", "count"])

    # Counted batch by batch, so that not every slot of every chunk is a row.
    counted = chunks.select(group.alias("group"), F.array_distinct(ids).alias("slots")).mapInArrow(count, "group string, slot int, count long")
    return counted.groupBy("group", "slot").agg(F.sum("count").alias("count"))


@dataclass
class HashedIdf:
    """Feature hashing weighted by inverse document frequency.

    `fit` counts, in one aggregation, how many chunks hold each slot; `encode` adds
    the vectors row by row without a shuffle. Both use a column `slots` where there is
    one. With `by`, each value of that column (a configuration name) gets its own
    frequencies; for a value that was not fitted every term counts alike.
    """

    dim: int = 256
    by: str | None = None
    weights: dict[str | None, np.ndarray] = field(default_factory=dict)

    def fit(self, chunks: DataFrame, text: str = "text") -> "HashedIdf":
        return self.fit_counts(slot_counts(chunks, self.by, text))

    def fit_counts(self, counts: DataFrame) -> "HashedIdf":
        """From (group, slot, count), as `slot_counts` gives them: a table of fixed size."""
        rows = counts.toPandas()
        self.weights = {}
        for name, own in rows.groupby("group", dropna=False):
            frequency = np.zeros(SLOTS)
            seen = own[own["slot"] >= 0]
            frequency[seen["slot"].to_numpy()] = seen["count"].to_numpy()
            total = own.loc[own["slot"] == _EVERY_CHUNK, "count"].sum()
            self.weights[name if self.by else None] = np.log((total + 1) / (frequency + 1))
        if not self.by and not self.weights:
            self.weights = {None: np.zeros(SLOTS)}  # fitted on nothing: log(1 / 1)
        return self

    def encode(self, df: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        if not self.weights:
            raise ValueError("the encoder has not been fitted")
        dim, ids = self.dim, F.col("slots") if "slots" in df.columns else slots(F.col(text))
        names = sorted(self.weights) if self.by else [None]
        # The last rows are for groups without frequencies.
        table = np.vstack([self.weights[n] for n in names] + [np.ones(SLOTS)] * bool(self.by)).ravel()
        shared = df.sparkSession.sparkContext.broadcast(table)
        place = F.lit(0)
        if self.by:
            place = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col(self.by)), F.lit(0))
            place = F.when(place == 0, len(names)).otherwise(place - 1).cast("int")

        @F.arrow_udf("array<float>")
        def vectors(rows: pa.Array, place: pa.Array) -> pa.Array:
            # The table's width is a multiple of `dim`, so buckets are unchanged.
            return _hash_rows(rows, place, shared.value, dim)

        return df.withColumn(out, vectors(ids, place))


@dataclass
class UserEncoder:
    """A sentence encoder given as Python code, loaded once per task.

    `load` returns a function from a list of texts to a matrix. Texts go to it in
    batches; `dim` saves a look at the first vector. Each row passes through exactly once, as `mapInArrow` is never repeated
    or moved by the optimiser.
    """

    load: Callable[[], Callable[[list[str]], np.ndarray]]
    batch_size: int = 32
    dim: int | None = None

    def encode(self, df: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        load, size = self.load, self.batch_size
        schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                for begin in range(0, batch.num_rows, size):
                    part = batch.slice(begin, size)
                    texts = part.column(part.schema.get_field_index(text)).to_pylist()
                    matrix = unit_rows(np.asarray(model(texts), dtype=np.float64))
                    columns = [*part.columns, list_column(matrix)]
                    yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, out])

        return df.mapInArrow(run, schema)


def to_points(embedded: DataFrame, ids: str = "uuid") -> DataFrame:
    """(id, embedding, payload fields) from embedded chunks; ids as UUIDs or plain keys."""
    key = chunk_key(F.col("source_file"), F.col("chunk_id"))
    point_id = uuid5(key) if ids == "uuid" else key
    extra = [c for c in ("config",) if c in embedded.columns]
    return embedded.select(
        point_id.alias("id"), "embedding", "text", "chunk_id", "source_file", *extra
    )
