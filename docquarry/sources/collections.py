"""Keyed vector collections: Parquet deltas plus a small append-only log.

An upsert writes its own points as one delta (again, once each, if an id comes twice among
them), then appends one log row; that append is what makes the new version visible. A job that dies before it leaves the old
version in place. A read takes the newest row of each id: rows of the base whose id comes
again in a delta are left out (an anti-join with the deltas' ids), and among deltas the
latest version counts, so a read pays for the deltas, not for the base again. Rows of ids and
sources that are in one delta only, told by tables of fixed size, are not shuffled for that:
a read first looks through the ids and sources, in jobs of its own. `compact`
turns what is read into the new base; call it when the deltas have grown to a good part
of the base. One writer per collection at a time. Where a table format with row-level
updates is installed, `MERGE INTO` can replace `upsert`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.places import by_places, places
from docquarry.session import remove

METRICS = ("cosine", "l2")
_VERSION, _GONE = "collection_version", "collection_gone"
_LOG = "version int, kind string, path string, dim int, metric string"


def check_dimension(embedding: Column, dim: int) -> Column:
    """The vector itself; a wrong length fails the job in the pass that writes it."""
    return F.when(F.size(embedding) == dim, embedding).otherwise(
        F.raise_error(
            F.concat(F.lit(f"expected {dim} dimensions, found "), F.size(embedding).cast("string"))
        )
    )


def dimension_report(points: DataFrame) -> DataFrame:
    size = F.size("embedding")
    return points.agg(
        F.count("*").alias("points"), F.min(size).alias("min_dim"), F.max(size).alias("max_dim")
    )


def last_write(points: DataFrame, order: Column, key: str = "id") -> DataFrame:
    """The newest row of each id. `max_by` combines before the shuffle, so an id
    repeated very often does not gather in one task."""
    row = F.struct(*points.columns)
    return points.groupBy(key).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def merge_points(
    existing: DataFrame, incoming: DataFrame, key: str = "id", replace_sources: bool = False
) -> DataFrame:
    """Incoming points replace existing ones with the same id; nothing else goes.

    With `replace_sources`, all existing points of a source that is delivered again
    go as well, so a shorter new version leaves no stale chunks.
    """
    kept = existing.join(incoming.select(key), key, "left_anti")
    if replace_sources:
        sources = incoming.select("source_file").distinct()
        kept = kept.join(sources, "source_file", "left_anti")
    return kept.unionByName(incoming)


@dataclass(frozen=True)
class _State:
    """What the log says: properties, the newest version, the base, and the deltas since."""

    version: int
    dim: int
    metric: str
    base: tuple[int, str] | None
    deltas: list[tuple[int, str, bool]]


class Collection:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.folder = f"{root.rstrip('/')}/{name}"

    def _state(self) -> _State | None:
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        # One row per write since the last compaction, plus one for the creation.
        rows = sorted(log.collect())
        if not rows:
            return None
        bases = [(r.version, r.path) for r in rows if r.kind == "base"]
        base = bases[-1] if bases else None
        deltas = [
            (r.version, r.path, r.kind == "replace") for r in rows
            if r.kind in ("delta", "replace") and (base is None or r.version > base[0])
        ]
        return _State(rows[-1].version, rows[0].dim, rows[0].metric, base, deltas)

    def _known(self) -> _State:
        state = self._state()
        if state is None:
            raise ValueError(f"no collection {self.name}")
        return state

    def _append(self, *row) -> None:
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def exists(self) -> bool:
        return self._state() is not None

    def has_points(self) -> bool:
        state = self._state()
        return state is not None and (state.base is not None or bool(state.deltas))

    def create(self, dim: int, metric: str = "cosine") -> "Collection":
        """Create if missing. An existing collection must have the same dimension and metric."""
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric}")
        state = self._state()
        if state is None:
            self._append(0, "made", "", dim, metric)
        elif (state.dim, state.metric) != (dim, metric):
            raise ValueError(
                f"collection {self.name} holds {state.dim} dimensions for {state.metric}, not {dim} for {metric}"
            )
        return self

    def properties(self) -> dict:
        state = self._known()
        return {"dim": state.dim, "metric": state.metric, "version": state.version, "deltas": len(state.deltas)}

    def _load(self, version: int, path: str) -> DataFrame:
        return self.spark.read.parquet(path).withColumn(_VERSION, F.lit(version))

    def read(self, only: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
        """The newest row of each id, without the rows of sources that were replaced since.

        `only` holds some values of columns that an id never changes, such as its source:
        other rows are left out before the newest are looked for, and with `columns`
        only these (the id, at least) go through that shuffle.
        """
        state = self._known()
        base = self._load(*state.base) if state.base else None
        deltas = [self._load(version, path) for version, path, _ in state.deltas]
        if base is None and not deltas:
            raise ValueError(f"collection {self.name} holds no points")
        replacing = [all_of_it for _, _, all_of_it in state.deltas]
        gone = _gone(base, deltas, replacing) if any(replacing) else None
        if columns:
            # A replaced row is told by its source.
            needed = [*dict.fromkeys([*columns, *(["source_file"] if gone else [])]), _VERSION]
            loaded = [*dict.fromkeys([*needed, *(only.columns if only is not None else [])])]
            base, deltas = base and base.select(loaded), [d.select(loaded) for d in deltas]
        changed = reduce(DataFrame.unionByName, deltas) if deltas else None
        if only is not None:
            keys = only.distinct()
            base, changed = (rows and _having(rows, keys) for rows in (base, changed))
        if columns:
            base, changed = (rows and rows.select(needed) for rows in (base, changed))
        if changed is None:
            return base.drop(_VERSION)
        newest = changed
        if gone:
            at = places(gone, F.xxhash64("source_file"))
            newest, base = (rows and _without(rows, gone, at) for rows in (newest, base))
        if len(deltas) > 1:
            newest = _last_version(newest)
        if base is not None:
            newest = base.join(changed.select("id").distinct(), "id", "left_anti").unionByName(newest)
        return newest.drop(_VERSION)

    def upsert(
        self, points: DataFrame, order: Column | None = None, replace_sources: bool = False
    ) -> "Collection":
        """Insert or replace by id: the batch is written, once, as a delta. `order` says
        which row of an id is the newest; without it, one of them is kept. With
        `replace_sources`, earlier points of a source that comes again no longer count."""
        state = self._known()
        checked = lambda rows: rows.withColumn("embedding", check_dimension(F.col("embedding"), state.dim))
        if order is None:
            path = self._write_once(points, state.dim, checked)
        else:
            path = self._write(checked(last_write(points, order)))
        if not self.spark.read.schema(points.schema).parquet(path).isEmpty():
            self._append(state.version + 1, "replace" if replace_sources else "delta", path, state.dim, state.metric)
        return self

    def _write(self, points: DataFrame) -> str:
        path = f"{self.folder}/points-{uuid.uuid4().hex}"
        # A vector's numbers hardly repeat, so a dictionary would only be written beside them.
        points.write.option("compression", "zstd").option("parquet.enable.dictionary#embedding.list.element", "false").parquet(path)
        return path

    def _write_once(self, points: DataFrame, dim: int, checked: Callable[[DataFrame], DataFrame]) -> str:
        """The path of the points, one row per id. They are written as they come; only if an id
        comes twice, which hashes of the ids tell, they are written again without its other rows."""
        seen = Observation("dimensions")
        wrong = F.count_if(~F.size("embedding").eqNullSafe(F.lit(dim)))
        path = self._write(points.observe(seen, wrong.alias("wrong")))
        written = self.spark.read.schema(points.schema).parquet(path)
        identity = F.xxhash64("id")
        twice = places(written.groupBy(identity.alias("hash")).count().filter("count > 1"), F.col("hash"))
        if twice.num_rows or seen.get.get("wrong") != 0:
            # Without an order, equal inputs still give equal results.
            single, repeated = by_places(written, twice, identity)
            path, first = self._write(checked(single.unionByName(last_write(repeated, F.xxhash64(*points.columns))))), path
            remove(self.spark, first)
        return path

    def compact(self) -> "Collection":
        """Write what is read now as the new base, so that reads stop paying for deltas."""
        state = self._known()
        if state.deltas:
            path = self._write(self.read())
            self._append(state.version + 1, "base", path, state.dim, state.metric)
        return self

    def written(self) -> DataFrame:
        """(version, rows): how many rows each write since the last compaction holds."""
        state = self._known()
        counts = [self._load(version, path).groupBy(F.col(_VERSION).alias("version")).agg(F.count("*").alias("rows"))
                  for version, path, _ in state.deltas]
        empty = self.spark.createDataFrame([], "version int, rows long")
        return reduce(DataFrame.unionByName, counts, empty)


def _having(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows with one of the keys. The keys that there are say where such rows may be, so the
    join moves few others."""
    hashed = F.xxhash64(*keys.columns)
    found = rows.select(*keys.columns).distinct().join(keys, keys.columns, "left_semi")
    _, some = by_places(rows, places(found, hashed), hashed)
    return some.join(keys, keys.columns, "left_semi")


def _gone(base: DataFrame | None, deltas: list[DataFrame], replacing: list[bool]) -> DataFrame:
    """(source_file, version): the sources with rows from before they were last replaced, and when that was."""
    versions = [d.select("source_file", _VERSION, (F.col(_VERSION) if all_of_it else F.lit(None).cast("int")).alias(_GONE))
                for d, all_of_it in [*zip(deltas, replacing), *([(base, False)] if base else [])]]
    last = reduce(DataFrame.unionByName, versions).groupBy("source_file").agg(F.min(_VERSION).alias("first"), F.max(_GONE).alias(_GONE))
    return last.filter(F.col("first") < F.col(_GONE)).select("source_file", _GONE)


def _without(rows: DataFrame, gone: DataFrame, at: pa.Table) -> DataFrame:
    """The rows whose source was not replaced after their version; those of other sources stay where they lie."""
    if not at.num_rows:
        return rows
    kept, some = by_places(rows, at, F.xxhash64("source_file"))
    later = (some["source_file"] == gone["source_file"]) & (some[_VERSION] < gone[_GONE])
    return kept.unionByName(some.join(gone, later, "left_anti"))


def _last_version(rows: DataFrame) -> DataFrame:
    """The newest row of each id; an id is in a version once. Only ids of several versions are looked through."""
    identity = F.xxhash64("id")
    versions = rows.groupBy(identity.alias("hash")).agg(F.min(_VERSION).alias("first"), F.max(_VERSION).alias("last"))
    several = places(versions.filter("first < last"), F.col("hash"))
    if not several.num_rows:
        return rows
    once, some = by_places(rows, several, identity)
    return once.unionByName(last_write(some, F.col(_VERSION)))
