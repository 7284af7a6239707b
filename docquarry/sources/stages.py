"""Stage tables: partitioned Parquet in place of one JSON file per document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.session import stage

_WAVE = "_wave"


def write_stage(df: DataFrame, path: str, partition_by: str = "config") -> None:
    """Write a stage; a rerun replaces only the partitions it produces."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def load_chunks(spark: SparkSession, path: str, config: str | None = None) -> DataFrame:
    """All chunks of a stage, or of one configuration (only its partition is read)."""
    chunks = spark.read.parquet(path)
    return chunks if config is None else chunks.filter(F.col("config") == config)


def append_progress(df: DataFrame, path: str) -> None:
    """Keep what is done so far; one append per run."""
    df.write.mode("append").parquet(path)


def remaining(work: DataFrame, done: DataFrame, key: str = "source_file") -> DataFrame:
    """Work whose key is not done yet."""
    return work.join(done.select(key), key, "left_anti")


def in_waves(
    work: DataFrame, do: Callable[[DataFrame], DataFrame], path: str, schema: str, wave: int,
    key: str = "source_file",
) -> DataFrame:
    """What `do` made of all the work, wave by wave; each wave is appended to the table at
    `path` before the next begins, so what is done outlives a run that dies.

    Keys that the table holds already are not done again. A wave holds about `wave` keys, by
    a hash of the key. `do` gives rows with the key and the columns of `schema`; a key
    without a row is not done.
    """
    spark = work.sparkSession
    # An empty append makes the table readable on the first run.
    append_progress(spark.createDataFrame([], schema), path)
    done = spark.read.schema(schema).parquet(path)
    left = remaining(work, done.select(key).distinct(), key)
    number = F.pmod(F.xxhash64(key), F.lit(1 + max(0, left.count() - 1) // wave))
    # The list of what was left when the run began; later waves must not look at `path` again.
    left = stage(left.withColumn(_WAVE, number), "waves")
    for (this,) in sorted(left.select(_WAVE).distinct().collect()):
        append_progress(do(left.filter(F.col(_WAVE) == this).drop(_WAVE)).select(*done.columns), path)
    return spark.read.schema(schema).parquet(path).join(work.select(key), key, "left_semi")
