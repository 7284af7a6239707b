"""Queries over chunking and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions.ids import chunk_key, uuid5
from docquarry.functions.text import words
from docquarry.functions.vectors import l2_normalize, norm
from docquarry.operators.chunking import COMPARED, WORDS_AND_SIGNS, chunk_elements
from docquarry.operators.encoding import HashedIdf, to_points, with_slots
from docquarry.plans.inputs import (
    DOCS, SMALL, chunks, chunks_sql, documents, line_elements, vectors_sql, with_ctes, words_sql,
)
from docquarry.plans.registry import query, rounded, table
from docquarry.session import stage
from docquarry.sources.collections import check_dimension, dimension_report

_COMPARED_SQL = [
    chunks_sql(COMPARED[0], "c0"),
    chunks_sql(COMPARED[1], "c1", signs=True),
    chunks_sql(COMPARED[2], "c2", signs=True),
    "chunks AS (SELECT * FROM c0 UNION ALL SELECT * FROM c1 UNION ALL SELECT * FROM c2)",
]


@query("k1_tokenize", with_ctes(DOCS) + f"""
SELECT source_file, len({words_sql('text')})::BIGINT AS words,
  len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]'))::BIGINT AS tokens,
  array_to_string(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]'), ' ')
    AS token_text
FROM docs""")
def k1(spark, sf_dir):
    tokens = WORDS_AND_SIGNS.encode(F.col("text"))
    return documents(spark, sf_dir).select(
        "source_file",
        F.size(words(F.col("text"))).cast("long").alias("words"),
        F.size(tokens).cast("long").alias("tokens"),
        WORDS_AND_SIGNS.decode(tokens).alias("token_text"),
    )


@query("k2_chunk_documents", with_ctes(DOCS, chunks_sql(COMPARED[0], "chunks")) + """
SELECT config, source_file, chunk_id, text FROM chunks""")
def k2(spark, sf_dir):
    return chunks(spark, sf_dir, [COMPARED[0]])


@query("k2_chunk_elements", with_ctes(DOCS, chunks_sql(COMPARED[0], "chunks")) + """
SELECT config, source_file, chunk_id, text FROM chunks""")
def k2_elements(spark, sf_dir):
    """The same chunks, put together from line elements; files may be of any size."""
    return chunk_elements(line_elements(spark, sf_dir), COMPARED[0])


@query("k3_k4_chunk_text_and_ids", with_ctes(DOCS, chunks_sql(SMALL)) + """
SELECT source_file, count(*) AS chunks, min(chunk_id)::BIGINT AS first_id,
  max(chunk_id)::BIGINT AS last_id, sum(length(text))::BIGINT AS characters
FROM chunks GROUP BY source_file""")
def k3(spark, sf_dir):
    return chunks(spark, sf_dir).groupBy("source_file").agg(
        F.count("*").alias("chunks"),
        F.min("chunk_id").cast("long").alias("first_id"),
        F.max("chunk_id").cast("long").alias("last_id"),
        F.sum(F.length("text")).alias("characters"),
    )


@query("k6_chunk_configs", with_ctes(DOCS, *_COMPARED_SQL) + """
SELECT config, source_file, chunk_id, text FROM chunks""")
def k6(spark, sf_dir):
    return chunks(spark, sf_dir, COMPARED)


@query("e1_encode", with_ctes(DOCS, chunks_sql(SMALL), vectors_sql("chunks")) + """
SELECT source_file, chunk_id, count(*) FILTER (v <> 0) AS filled, round(sum(v), 4) AS total,
  round(sum(v * (b + 1)), 3) AS moment, round(max(v), 5) AS peak
FROM vec GROUP BY source_file, chunk_id""")
def e1(spark, sf_dir):
    cut = stage(with_slots(chunks(spark, sf_dir)), "chunks")
    embedded = HashedIdf().fit(cut).encode(cut).filter(F.exists("embedding", lambda x: x != 0))
    v = F.transform("embedding", lambda x: x.cast("double"))
    add = lambda t, x: t + x
    return embedded.select("source_file", "chunk_id", v.alias("v")).select(
        "source_file", "chunk_id",
        F.size(F.filter("v", lambda x: x != 0)).cast("long").alias("filled"),
        rounded(F.aggregate("v", F.lit(0.0), add), 4).alias("total"),
        rounded(F.aggregate(F.transform("v", lambda x, i: x * (i + 1)), F.lit(0.0), add), 3)
        .alias("moment"),
        rounded(F.array_max("v"), 5).alias("peak"),
    )


_TRIPLED = "list_transform(embedding, lambda x: x::DOUBLE * 3)"


@query("e2_l2_normalize", f"""
WITH t AS (SELECT vec_id, {_TRIPLED} AS e FROM embeddings),
u AS (SELECT vec_id, sqrt(list_dot_product(e, e)) AS l, e FROM t)
SELECT vec_id, round(l, 5) AS norm_before, 1.0::DOUBLE AS norm_after,
  round((e[1] / l)::FLOAT::DOUBLE, 5) AS first_part, round((e[-1] / l)::FLOAT::DOUBLE, 5) AS last_part FROM u""")
def e2(spark, sf_dir):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", tripled.alias("e"))
    return vectors.withColumn("u", l2_normalize(F.col("e"))).select(
        "vec_id",
        rounded(norm(F.col("e")), 5).alias("norm_before"),
        rounded(norm(F.col("u")), 5).alias("norm_after"),
        rounded(F.get("u", F.lit(0)).cast("double"), 5).alias("first_part"),
        rounded(F.element_at("u", -1).cast("double"), 5).alias("last_part"),
    )


@query("e3_dimension_report", """
SELECT count(*) AS points, min(len(embedding))::INT AS min_dim, max(len(embedding))::INT AS max_dim
FROM embeddings""")
def e3(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    dim = dimension_report(vectors).first()["max_dim"]
    return dimension_report(vectors.select(check_dimension(F.col("embedding"), dim).alias("embedding")))


@query("e4_uuid5", with_ctes(DOCS, chunks_sql(SMALL), """named AS (
  SELECT source_file, chunk_id, sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8')
    || encode(source_file || '_' || chunk_id)) AS h FROM chunks)""") + """
SELECT source_file, chunk_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3)
  || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3)
  || '-' || substr(h, 21, 12) AS id FROM named""")
def e4(spark, sf_dir):
    name = chunk_key(F.col("source_file"), F.col("chunk_id"))
    return chunks(spark, sf_dir).select("source_file", "chunk_id", uuid5(name).alias("id"))


@query("e5_plain_ids", with_ctes(DOCS, chunks_sql(SMALL)) + """
SELECT source_file || '_' || chunk_id AS id, source_file, chunk_id FROM chunks""")
def e5(spark, sf_dir):
    key = chunk_key(F.col("source_file"), F.col("chunk_id"))
    return chunks(spark, sf_dir).select(key.alias("id"), "source_file", "chunk_id")


@query("e6_points", with_ctes(DOCS, chunks_sql(SMALL)) + """
SELECT source_file || '_' || chunk_id AS id, text, chunk_id, source_file, 256::INT AS dim FROM chunks""")
def e6(spark, sf_dir):
    cut = stage(with_slots(chunks(spark, sf_dir)), "chunks")
    points = to_points(HashedIdf().fit(cut).encode(cut), ids="plain")
    return points.select("id", "text", "chunk_id", "source_file", F.size("embedding").alias("dim"))
