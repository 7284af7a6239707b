"""Queries over retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions.text import collapse_whitespace
from docquarry.operators.cells import Cells, approximate_top_k, read_cells, recall_by_probes
from docquarry.operators.encoding import HashedIdf, to_points, with_slots
from docquarry.operators.quantised import quantised_top_k, with_codes
from docquarry.operators.retrieval import drop_empty_hits, hits_as_array, top_k, top_k_single
from docquarry.plans.inputs import (
    DOCS, GOLD, SMALL, chunks, chunks_sql, gold, question_vectors_sql, questions, vectors_sql,
    with_ctes,
)
from docquarry.plans.registry import query, rounded, table
from docquarry.session import scratch_path, stage


def centroids(spark, sf_dir):
    """One question per label: the mean of its vectors."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # At most one row per dimension and label.
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))


def vector_points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


_CENTROIDS = """means AS (
  SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x,
    generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i),
ask AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM means GROUP BY label),
pts AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"""
_COSINE = "round(list_dot_product(q, e) / sqrt(list_dot_product(q, q) * list_dot_product(e, e)), 9)"
_L2 = """round(list_sum(list_transform(list_zip(q, e),
  lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9)"""


def _ranked_sql(score: str, direction: str, where: str = "") -> str:
    return f"""scored AS (SELECT query_id, id, {score} AS s FROM ask, pts {where})
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s {direction}, id)::INT AS rank,
  id, round(s, 6) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s {direction}, id) <= 5"""


def _hits(df):
    return df.select("query_id", "rank", "id", rounded("score").alias("score"))


@query("r2_top_k_cosine", with_ctes(_CENTROIDS, _ranked_sql(_COSINE, "DESC")))
def r2(spark, sf_dir):
    ask = centroids(spark, sf_dir).withColumnRenamed("label", "query_id")
    return _hits(top_k(ask, vector_points(spark, sf_dir)))


@query("r2_top_k_single", with_ctes(_CENTROIDS, """one AS (
  SELECT list(x ORDER BY i) AS q FROM (
    SELECT i, avg(x) AS x FROM (SELECT unnest(embedding)::DOUBLE AS x,
      generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)),
scored AS (SELECT id, label, """ + _COSINE + """ AS s FROM one, pts)
SELECT id, label, round(s, 6) AS score FROM scored ORDER BY s DESC, id LIMIT 5"""))
def r2_single(spark, sf_dir):
    """One question, the mean of all vectors: native scoring and a top-k sort."""
    parts = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("i", "x"))
    mean = parts.groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("x")).orderBy("i")
    vector = [r.x for r in mean.collect()]  # one number per dimension
    found = top_k_single(vector_points(spark, sf_dir), vector)
    return found.select("id", "label", rounded("score").alias("score"))


@query("r3_top_k_l2", with_ctes(_CENTROIDS, _ranked_sql(_L2, "ASC")))
def r3(spark, sf_dir):
    ask = centroids(spark, sf_dir).withColumnRenamed("label", "query_id")
    return _hits(top_k(ask, vector_points(spark, sf_dir), metric="l2"))


def _quantised(spark, sf_dir, metric):
    """Codes are written as a table; the first pass reads that one only."""
    ask = stage(centroids(spark, sf_dir).withColumnRenamed("label", "query_id"), "centroids")
    points = vector_points(spark, sf_dir)
    return _hits(quantised_top_k(ask, stage(with_codes(points, metric), "codes"), points, metric=metric))


@query("r2_quantised_top_k", with_ctes(_CENTROIDS, _ranked_sql(_COSINE, "DESC")))
def r2_quantised(spark, sf_dir):
    return _quantised(spark, sf_dir, "cosine")


@query("r3_quantised_top_k", with_ctes(_CENTROIDS, _ranked_sql(_L2, "ASC")))
def r3_quantised(spark, sf_dir):
    return _quantised(spark, sf_dir, "l2")


@query("r4_filtered_top_k", with_ctes(
    _CENTROIDS, _ranked_sql(_COSINE, "DESC", "WHERE query_id = label")))
def r4(spark, sf_dir):
    """Each label's question looks only at vectors of that label."""
    ask = centroids(spark, sf_dir).withColumn("query_id", F.col("label"))
    return _hits(top_k(ask, vector_points(spark, sf_dir), filters=["label"]))


def indexed(spark, sf_dir, configs=None):
    """(encoder, points) of all documents: cut and hashed once, then fitted and encoded."""
    cut = stage(with_slots(chunks(spark, sf_dir, configs)), "chunks")
    encoder = HashedIdf(by="config" if configs else None).fit(cut)
    return encoder, to_points(encoder.encode(cut), ids="plain")


def open_hits(spark, sf_dir, k=5):
    """Every benchmark passage against all chunks."""
    encoder, points = indexed(spark, sf_dir)
    ask = encoder.encode(questions(spark, sf_dir), "question")
    return top_k(ask, points, k, carry=["source_file", "text"])


def samples(spark, sf_dir):
    """Evaluation samples: each passage with each document that holds it."""
    return gold(spark, sf_dir).join(questions(spark, sf_dir), "query_id").select(
        F.concat_ws("@", F.col("query_id").cast("string"), "source_file").alias("query_id"),
        "source_file", "question", "reference_text",
    )


def filtered_hits(spark, sf_dir, k=5, asked=None):
    """Every sample against the chunks of its own document."""
    encoder, points = indexed(spark, sf_dir)
    ask = encoder.encode(asked or samples(spark, sf_dir), "question")
    return top_k(ask, points, k, filters=["source_file"], carry=["source_file", "text"])


SCORED_OPEN = """pairs AS (
  SELECT q.query_id, v.source_file, v.chunk_id, sum(q.v * v.v) AS d
  FROM qvec q JOIN vec v USING (b) GROUP BY ALL),
vlen AS (SELECT source_file, chunk_id, sqrt(sum(v * v)) AS l FROM vec GROUP BY ALL),
qlen AS (SELECT query_id, sqrt(sum(v * v)) AS ql FROM qvec GROUP BY ALL),
scored AS (
  SELECT query_id, source_file, chunk_id, source_file || '_' || chunk_id AS id,
    round(d / (l * ql), 9) AS s
  FROM pairs JOIN vlen USING (source_file, chunk_id) JOIN qlen USING (query_id))"""
OPEN_HITS = [
    DOCS, chunks_sql(SMALL), vectors_sql("chunks"), question_vectors_sql(), SCORED_OPEN,
    """hits AS (
  SELECT query_id, source_file, chunk_id, id, s, text,
    row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id)::INT AS rank
  FROM scored JOIN chunks USING (source_file, chunk_id)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 5)""",
]
FILTERED_HITS = [
    DOCS, chunks_sql(SMALL), vectors_sql("chunks"), question_vectors_sql(), SCORED_OPEN, GOLD,
    """hits AS (
  SELECT g.query_id || '@' || source_file AS query_id, source_file, chunk_id, id, s, text,
    row_number() OVER (PARTITION BY g.query_id, source_file ORDER BY s DESC, id)::INT AS rank
  FROM gold g JOIN scored s USING (query_id, source_file) JOIN chunks USING (source_file, chunk_id)
  QUALIFY row_number() OVER (PARTITION BY g.query_id, source_file ORDER BY s DESC, id) <= 5)""",
]
_SELECT_HITS = "SELECT query_id, rank, id, round(s, 6) AS score FROM hits"


@query("r1_embed_questions", with_ctes(
    DOCS, chunks_sql(SMALL), vectors_sql("chunks"), question_vectors_sql()) + """
SELECT query_id, count(*) FILTER (v <> 0) AS filled, round(sum(v), 4) AS total FROM qvec
GROUP BY query_id""")
def r1(spark, sf_dir):
    encoder = HashedIdf().fit(chunks(spark, sf_dir))
    asked = encoder.encode(questions(spark, sf_dir), "question")
    return asked.select(
        "query_id",
        F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("filled"),
        rounded(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double")), 4).alias("total"),
    )


@query("r5_batch_retrieval", with_ctes(*OPEN_HITS) + _SELECT_HITS)
def r5(spark, sf_dir):
    return _hits(open_hits(spark, sf_dir))


@query("r5_batch_retrieval_own_file", with_ctes(*FILTERED_HITS) + _SELECT_HITS)
def r5_own_file(spark, sf_dir):
    return _hits(filtered_hits(spark, sf_dir))


@query("r6_hits_as_array", with_ctes(*OPEN_HITS) + """
SELECT query_id, count(*)::INT AS n, string_agg(text, ' | ' ORDER BY rank) AS texts
FROM hits GROUP BY query_id""")
def r6(spark, sf_dir):
    return hits_as_array(open_hits(spark, sf_dir)).select(
        "query_id", F.size("texts").alias("n"), F.array_join("texts", " | ").alias("texts")
    )


@query("p10_drop_empty_hits", with_ctes(*OPEN_HITS) + """
SELECT query_id, rank, id FROM hits WHERE source_file NOT IN (
  SELECT 'doc_' || doc_id FROM labels WHERE toxic = 1)""")
def p10(spark, sf_dir):
    """The texts of documents marked toxic are blanked; their hits go after the ranking."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.concat(F.lit("doc_"), "doc_id").alias("source_file"), F.lit(True).alias("toxic")
    )
    hits = open_hits(spark, sf_dir).join(toxic, "source_file", "left")
    hits = hits.withColumn("text", F.when(F.col("toxic"), "").otherwise(collapse_whitespace(F.col("text"))))
    return drop_empty_hits(hits).select("query_id", "rank", "id")


_CELL_COUNT, _PROBES, _ROUNDS = 16, 4, 5


def _cells_sql() -> str:
    """Training, filing and probing; all points are in the sample at the sizes SQL runs on."""
    near = "round(list_dot_product({0}, c), 9) DESC, cell"
    ctes = [
        "unit AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM pts)",
        f"""cen0 AS (
  SELECT row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS cell, u AS c FROM unit
  QUALIFY row_number() OVER (ORDER BY md5(id::VARCHAR), id) <= {_CELL_COUNT})""",
    ]
    for k in range(_ROUNDS):
        ctes.append(f"""own{k} AS (
  SELECT u, cell FROM unit, cen{k} QUALIFY row_number() OVER (PARTITION BY id ORDER BY {near.format("u")}) = 1),
sum{k} AS (
  SELECT cell, i, sum(x) AS x FROM (
    SELECT cell, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM own{k}) GROUP BY cell, i),
mean{k} AS (
  SELECT cell, list(x / l ORDER BY i) AS m FROM (
    SELECT *, sqrt(sum(x * x) OVER (PARTITION BY cell)) AS l FROM sum{k}) GROUP BY cell),
cen{k + 1} AS (SELECT cell, coalesce(m, c) AS c FROM cen{k} LEFT JOIN mean{k} USING (cell))""")
    ctes.append(f"""pcell AS (
  SELECT id, cell FROM unit, cen{_ROUNDS} QUALIFY row_number() OVER (PARTITION BY id ORDER BY {near.format("u")}) = 1),
qcell AS (
  SELECT query_id, cell, row_number() OVER (PARTITION BY query_id ORDER BY {near.format("q").replace("c)", "c) / sqrt(list_dot_product(q, q))")}) AS nth
  FROM ask, cen{_ROUNDS}),
scored AS (
  SELECT query_id, id, {_COSINE} AS s, nth FROM pts JOIN pcell USING (id) JOIN qcell USING (cell) JOIN ask USING (query_id))""")
    return ",\n".join(ctes)


def _filed(spark, sf_dir):
    """(cells, all vectors filed under them, as a table partitioned by cell)."""
    points, path = vector_points(spark, sf_dir), scratch_path(spark, "cells")
    cells = Cells.train(points, _CELL_COUNT, rounds=_ROUNDS)
    cells.write(points, path)
    return cells, read_cells(spark, path)


@query("r7_approximate_top_k", with_ctes(_CENTROIDS, _cells_sql()) + f"""
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id)::INT AS rank, id, round(s, 6) AS score
FROM scored WHERE nth <= {_PROBES} QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 5""")
def r7(spark, sf_dir):
    """Each question reads the folders of its nearest cells only."""
    cells, filed = _filed(spark, sf_dir)
    ask = centroids(spark, sf_dir).withColumnRenamed("label", "query_id")
    return _hits(approximate_top_k(ask, filed, cells, probes=_PROBES))


@query("r7_recall", with_ctes(_CENTROIDS, _cells_sql()) + f""",
exact AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 5),
share AS (
  SELECT query_id, nth, sum(n) OVER (PARTITION BY query_id ORDER BY nth) / sum(n) OVER (PARTITION BY query_id) AS share
  FROM qcell JOIN (SELECT cell, count(p.id) AS n FROM cen{_ROUNDS} LEFT JOIN pcell p USING (cell) GROUP BY cell) USING (cell))
SELECT p::INT AS probes, (SELECT count(*) FROM exact) AS exact_hits, (SELECT count(*) FROM exact WHERE nth <= p) AS found_hits,
  round((SELECT count(*) FROM exact WHERE nth <= p) / (SELECT count(*) FROM exact), 6) AS recall_at_k,
  (SELECT round(avg(share), 6) FROM share WHERE nth = p) AS rows_read
FROM range(1, {_CELL_COUNT + 1}) AS a(p)""")
def r7_recall(spark, sf_dir):
    """What each number of probes finds of the exact hits, and what it reads."""
    cells, filed = _filed(spark, sf_dir)
    ask = stage(centroids(spark, sf_dir).withColumnRenamed("label", "query_id"), "centroids")
    exact = top_k(ask, vector_points(spark, sf_dir))
    curve = recall_by_probes(ask, filed, cells, exact)
    return curve.withColumns({c: rounded(c) for c in ("recall_at_k", "rows_read")})
