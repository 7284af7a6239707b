"""Queries over streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions.ids import chunk_key
from docquarry.operators.encoding import HashedIdf
from docquarry.plans.inputs import SMALL, chunks, chunks_sql, terms_sql, with_ctes
from docquarry.plans.registry import query, table
from docquarry.session import scratch_path
from docquarry.sources.collections import Collection
from docquarry.streaming.refresh import current_counts, refresh


#: A micro-batch takes files of about so many bytes, however many files a write is in.
_BATCH_BYTES = 1 << 30


def _refreshed(spark, sf_dir):
    """(collection, frequencies): documents arrive in four writes, and the stream goes on after
    each; the last write brings again, cut to half their length, the documents that eight divides."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc_"), "doc_id").alias("source_file"), "text")
    half = docs.filter("doc_id % 8 = 0").withColumn("text", F.expr("substring(text, 1, length(text) div 2)"))
    folder, stream = scratch_path(spark, "arriving"), scratch_path(spark, "stream")
    encoder = HashedIdf().fit(chunks(spark, sf_dir))
    collection = Collection(spark, scratch_path(spark, "collections"), "documents").create(encoder.dim)
    frequencies = scratch_path(spark, "frequencies")
    for write in [*(docs.filter(F.col("doc_id") % 3 == part) for part in range(3)), half]:
        write.drop("doc_id").write.mode("append").option("compression", "zstd").parquet(folder)
        # Files go once their batch is done; the documents themselves stay where they came from.
        options = {"maxBytesPerTrigger": _BATCH_BYTES, "cleanSource": "delete"}
        arriving = spark.readStream.schema("source_file string, text string").options(**options).parquet(folder)
        refresh(arriving, collection, encoder, SMALL, stream, frequencies=frequencies).awaitTermination()
    return collection, frequencies


_REFRESHED = """docs AS (
  SELECT 'doc_' || doc_id AS source_file, CASE WHEN doc_id % 8 = 0 THEN substr(text, 1, length(text) // 2) ELSE text END AS text
  FROM documents)"""


@query("i1_incremental_refresh", with_ctes(_REFRESHED, chunks_sql(SMALL)) + """
SELECT source_file || '_' || chunk_id AS key, text FROM chunks""")
def i1(spark, sf_dir):
    """After all micro-batches the collection holds the newest chunks of all documents."""
    collection, _ = _refreshed(spark, sf_dir)
    key = chunk_key(F.col("source_file"), F.col("chunk_id"))
    return collection.read().select(key.alias("key"), "text")


@query("i1_followed_frequencies", with_ctes(_REFRESHED, chunks_sql(SMALL), f"""term AS (
  SELECT DISTINCT source_file, chunk_id, ('0x' || substr(md5(t), 1, 4))::INT AS slot
  FROM (SELECT source_file, chunk_id, unnest({terms_sql('text')}) AS t FROM chunks))""") + """
SELECT slot, count(*) AS count FROM term GROUP BY slot
UNION ALL SELECT -1, count(*) FROM chunks""")
def i1_frequencies(spark, sf_dir):
    """The slot counts that followed the batches: those of a fresh fit on what is there now."""
    return current_counts(spark, _refreshed(spark, sf_dir)[1]).select("slot", "count")
