"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "docquarry", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A private temporary folder is only acceptable where driver and executors are
    one process, so an unset folder on a cluster is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="docquarry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/docquarry/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so reruns cannot collide."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession) -> bool:
    """Delete all this application has staged, once its results are written elsewhere.

    Results that were not written yet read these tables; so a job calls this last.
    """
    return remove(spark, _own_folder(spark))


def remove(spark: SparkSession, folder: str) -> bool:
    """Delete a folder that this application wrote, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage that several jobs read, and continue from the written table.

    Unlike a cache, the table survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def while_staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A stage for the jobs of one block; its table is deleted after them."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on an input with few splits.

    Inputs of ordinary size already have more splits than cores and stay as they are.
    Only for scans: asking a plan with shuffles for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
