"""Keeping a collection up to date as documents arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docquarry.operators.chunking import ChunkConfig, chunk_documents
from docquarry.operators.encoding import HashedIdf, UserEncoder, slot_counts, to_points, with_slots
from docquarry.session import stage, while_staged
from docquarry.sources.collections import Collection, last_write
from docquarry.sources.stages import append_progress


_BATCH, _COUNTS = "batch", "batch long, slot int, count long"


def refresh(
    arriving: DataFrame,
    collection: Collection,
    encoder: HashedIdf | UserEncoder,
    config: ChunkConfig,
    checkpoint: str,
    newest: str | None = None,
    replace_sources: bool = True,
    frequencies: str | None = None,
) -> StreamingQuery:
    """Chunk, encode and upsert arriving (source_file, text) rows until the input ends.

    The upsert is keyed, so a batch that is delivered again after a failure changes
    nothing. How many batches there are is the stream's affair: each one reads the sources
    of all points once, so bound a batch by bytes rather than by files. `newest` names a column that says which version of a document in one
    batch is the latest. What a batch stages is deleted when its points are written. There is no event time, so no watermark is needed.

    With `frequencies`, a table of slot counts follows the collection: each batch appends
    the counts of its chunks, less those of the chunks it replaces. A batch's counts are
    written before its points; when it is delivered again they are there, and stay.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if newest:
            batch = last_write(batch, F.col(newest), key="source_file")
        cut = chunk_documents(batch, F.col("source_file"), F.col("text"), [config])
        # Terms are hashed once, for the counts and for the vectors.
        with while_staged(with_slots(cut) if isinstance(encoder, HashedIdf) or frequencies else cut, "arrived") as cut:
            if frequencies:
                _follow(cut, collection, frequencies, number, replace_sources)
            points = to_points(encoder.encode(cut)).drop("config")
            collection.upsert(points, replace_sources=replace_sources)

    return (
        arriving.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _follow(cut: DataFrame, collection: Collection, path: str, number: int, replace_sources: bool) -> None:
    """Append the change that a batch of chunks makes to the slot counts."""
    spark = cut.sparkSession
    append_progress(spark.createDataFrame([], _COUNTS), path)
    if not spark.read.schema(_COUNTS).parquet(path).filter(F.col(_BATCH) == number).isEmpty():
        return
    change = slot_counts(cut).select("slot", "count")
    if collection.has_points():
        # Chunks are replaced by source, or, chunk by chunk, by their place in the source.
        key = ["source_file"] if replace_sources else ["source_file", "chunk_id"]
        old = collection.read(only=cut.select(*key), columns=["id", "text"])
        change = change.unionByName(slot_counts(old).select("slot", (-F.col("count")).alias("count")))
    # The slots are a fixed number, so a batch appends a table of bounded size; the marker of a
    # batch without chunks changes nothing.
    summed = change.groupBy("slot").agg(F.sum("count").alias("count")).filter("count <> 0")
    marker = spark.createDataFrame([(-1, 0)], "slot int, count long")
    append_progress(summed.unionByName(marker).select(F.lit(number).cast("long").alias(_BATCH), "slot", "count"), path)


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """(group, slot, count) of the collection as it is now, to fit an encoder with."""
    counts = spark.read.schema(_COUNTS).parquet(path).groupBy("slot").agg(F.sum("count").alias("count"))
    return counts.filter("count <> 0").select(F.lit(None).cast("string").alias("group"), "slot", "count")


def reencode(collection: Collection, encoder: HashedIdf | UserEncoder) -> Collection:
    """Encode all texts again, say with an encoder fitted on the current counts."""
    points = stage(collection.read().drop("embedding"), "texts")
    return collection.upsert(encoder.encode(points)).compact()
