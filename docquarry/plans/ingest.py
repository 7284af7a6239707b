"""Queries over sources, cleaning and normalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions.text import (
    collapse_whitespace, course_of, has_text, stage_file_name,
)
from docquarry.operators.elements import (
    clean_elements, convert_tables, normalize_elements, prepare_elements, split_failures,
    stage_counters,
)
from docquarry.plans.inputs import (
    DOCS, LINES, ITEM_TABLES, SMALL, chunks, chunks_sql, documents, line_elements, item_tables,
    with_ctes,
)
from docquarry.plans.jobs import write_prepared
from docquarry.plans.registry import query, table
from docquarry.schemas import SAMPLE
from docquarry.session import scratch_path, spread
from docquarry.sources.collections import Collection, last_write, merge_points
from docquarry.sources.elements import (
    elements_from_html, elements_from_json, is_supported, samples_from_json,
)
from docquarry.sources.stages import append_progress, in_waves, load_chunks, remaining, write_stage

_CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_CODE = """CASE WHEN contains(filename, '_') THEN trim(replace(replace(replace(
  substr(filename, instr(filename, '_') + 1), '.pdf', ''), '.docx', ''), '.doc', '')) END"""
_NAME = """CASE WHEN contains(filename, '_')
  THEN trim(substr(filename, 1, instr(filename, '_') - 1)) ELSE filename END"""


@query("s1_supported_files", with_ctes(DOCS) + """
SELECT doc_id, filename FROM docs WHERE regexp_matches(lower(filename), '\\.(pdf|doc|docx)$')
UNION ALL
SELECT page_id AS doc_id, url AS filename FROM pages
WHERE regexp_matches(lower(url), '\\.(pdf|doc|docx)$')""")
def s1(spark, sf_dir):
    names = documents(spark, sf_dir).select("doc_id", "filename")
    urls = table(spark, sf_dir, "pages").select("page_id", "url").toDF("doc_id", "filename")
    return names.unionByName(urls).filter(is_supported(F.col("filename")))


@query("s2a_elements_from_text", with_ctes(DOCS, LINES) + """
SELECT source_file, seq::BIGINT AS seq, source_file || '#' || seq AS element_id, text FROM lines""")
def s2a(spark, sf_dir):
    return line_elements(spark, sf_dir).select("source_file", "seq", "element_id", "text")


@query("s2b_elements_from_html", r"""
WITH bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '[\r\n\x01\x02]+', ' ', 'g'),
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g') AS h FROM pages),
marked AS (
  SELECT page_id, regexp_replace(regexp_replace(h, '(?i)<(h[1-6]|title)\b[^>]*>',
    chr(10) || chr(1), 'g'), '(?i)<li\b[^>]*>', chr(10) || chr(2), 'g') AS h FROM bare),
cut AS (
  SELECT page_id, string_split(regexp_replace(regexp_replace(h,
    '(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>',
    chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) AS parts FROM marked),
blocks AS (
  SELECT page_id, unnest(parts) AS b, generate_subscripts(parts, 1) - 1 AS seq FROM cut),
texts AS (
  SELECT page_id, seq, CASE WHEN starts_with(b, chr(1)) THEN 'Title'
    WHEN starts_with(b, chr(2)) THEN 'ListItem' ELSE 'NarrativeText' END AS type,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(b, '[\x01\x02]', '', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
      '&apos;', ''''), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'),
      '\s+', ' ', 'g')) AS text FROM blocks)
SELECT 'page_' || page_id AS source_file, seq::BIGINT AS seq, type, text FROM texts
WHERE text <> ''""")
def s2b(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    found = elements_from_html(pages, F.concat(F.lit("page_"), "page_id"), F.col("html"))
    return found.select("source_file", "seq", "type", "text")


def _json_files(spark, sf_dir):
    """One JSON array per document: its lines as elements, a number and a string in
    between; documents in French are cut off, so they cannot be read."""
    lines = F.transform(F.split("text", "\n"), lambda t: F.to_json(F.struct(
        F.lit("NarrativeText").alias("type"), t.alias("text"),
        F.struct(F.col("filename")).alias("metadata"),
    )))
    body = F.concat(F.lit("["), F.array_join(F.array_append(lines, F.lit('7, {"text": 5}')), ", "))
    content = F.concat(body, F.when(F.col("lang") == "fr", "").otherwise("]"))
    return documents(spark, sf_dir).select("source_file", content.alias("content"))


@query("s3_elements_from_json", with_ctes(DOCS, LINES) + """
SELECT source_file, seq::BIGINT AS seq, 'NarrativeText' AS type, text, filename FROM lines
WHERE source_file NOT IN (SELECT source_file FROM docs WHERE lang = 'fr')
UNION ALL
SELECT source_file, (len(string_split(text, chr(10))) + k)::BIGINT, NULL, NULL, NULL
FROM docs, (VALUES (0), (1)) AS extra(k) WHERE lang <> 'fr'""")
def s3(spark, sf_dir):
    elements, _ = elements_from_json(_json_files(spark, sf_dir))
    return elements.select("source_file", "seq", "type", "text", F.col("metadata.filename").alias("filename"))


@query("s3_unreadable_files", with_ctes(DOCS) + """
SELECT source_file FROM docs WHERE lang = 'fr'""")
def s3_quarantine(spark, sf_dir):
    _, bad = elements_from_json(_json_files(spark, sf_dir))
    return bad.select("source_file")


_CHUNK_COLUMNS = "SELECT config, source_file, chunk_id, text FROM chunks"


@query("s4_load_chunks", with_ctes(DOCS, chunks_sql(SMALL)) + _CHUNK_COLUMNS)
def s4(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    write_stage(chunks(spark, sf_dir), path)
    return load_chunks(spark, path, SMALL.name).select("config", "source_file", "chunk_id", "text")


def _sample_files(spark, sf_dir):
    """Each conversation is written as one JSON data set, a sample for every turn; those
    whose number seven divides lack the end of the array."""
    sample = F.struct(
        F.col("text").alias("question"), F.col("role").alias("ground_truth_answer"),
        F.col("text").alias("reference_text"), F.concat(F.lit("conv_"), "conv_id").alias("source_file"),
    )
    # At most as many as a conversation has turns.
    turns = F.array_sort(F.collect_list(F.struct("turn", F.to_json(sample).alias("json"))))
    whole = F.array_join(F.transform("turns", lambda t: t["json"]), ",\n")
    folder = scratch_path(spark, "data-sets")
    files = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns")).select(
        F.concat(F.lit("set_"), "conv_id", F.lit(".json")).alias("data_set"),
        F.concat(F.lit("["), whole, F.when(F.col("conv_id") % 7 == 0, "").otherwise("]\n")).alias("content"))
    files.write.parquet(folder)
    return spark.read.parquet(folder)


_TURN_PLACES = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations)"""


@query("s5_load_eval_samples", with_ctes(_TURN_PLACES) + """
SELECT 'set_' || conv_id || '.json#' || place AS sample_id, place::INT AS item, text AS question,
  role AS ground_truth_answer, text AS reference_text, 'conv_' || conv_id AS source_file
FROM placed WHERE conv_id % 7 <> 0""")
def s5(spark, sf_dir):
    samples, _ = samples_from_json(_sample_files(spark, sf_dir))
    return samples.select("item", *SAMPLE.names)


@query("s5_unreadable_sets", """
SELECT DISTINCT 'set_' || conv_id || '.json' AS data_set FROM conversations WHERE conv_id % 7 = 0""")
def s5_quarantine(spark, sf_dir):
    _, bad = samples_from_json(_sample_files(spark, sf_dir))
    return bad.select("data_set")


@query("s6_write_stage", with_ctes(DOCS, chunks_sql(SMALL)) + """
SELECT config, count(*) AS chunks, sum(length(text))::BIGINT AS characters,
  max(chunk_id)::BIGINT AS last_chunk FROM chunks GROUP BY config""")
def s6(spark, sf_dir):
    path = scratch_path(spark, "stage")
    write_stage(chunks(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy(F.col("config").cast("string").alias("config")).agg(
        F.count("*").alias("chunks"), F.sum(F.length("text")).alias("characters"),
        F.max("chunk_id").cast("long").alias("last_chunk"),
    )


@query("s7_create_collection", """
SELECT 'vectors' AS collection, 64::BIGINT AS dim, 'cosine' AS metric, count(*) AS points
FROM embeddings WHERE len(embedding) = 64""")
def s7(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    dim = vectors.agg(F.max(F.size("embedding"))).first()[0]
    collection = Collection(spark, scratch_path(spark, "collections"), "vectors").create(dim)
    collection.create(dim)  # again: nothing happens
    collection.upsert(vectors.select(F.col("vec_id").alias("id"), "embedding", "label"))
    known = collection.properties()
    return collection.read().agg(F.count("*").alias("points")).select(
        F.lit("vectors").alias("collection"), F.lit(known["dim"]).cast("long").alias("dim"),
        F.lit(known["metric"]).alias("metric"), "points",
    )


def _texts_and_updates(spark, sf_dir):
    """Existing texts by id; incoming ones: labelled documents with clean text, twice
    (the second, newer delivery tells the quality), and benchmark passages as new ids."""
    existing = documents(spark, sf_dir).select(F.col("source_file").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), "doc_id").alias("id"), "quality"
    )
    labelled = existing.join(labels, "id")
    first = labelled.select("id", collapse_whitespace(F.col("text")).alias("text"), F.lit(1).alias("at"))
    second = labelled.select(
        "id", F.concat(F.lit("quality "), "quality").alias("text"), F.lit(2).alias("at")
    )
    fresh = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item_"), "item_id").alias("id"), "text", F.lit(1).alias("at")
    )
    return existing, first.unionByName(second).unionByName(fresh)


@query("s8_upsert", with_ctes(DOCS) + """
SELECT source_file AS id, CASE WHEN quality IS NULL THEN text ELSE 'quality ' || quality END AS text
FROM docs LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'item_' || item_id, text FROM benchmark""")
def s8(spark, sf_dir):
    existing, incoming = _texts_and_updates(spark, sf_dir)
    return merge_points(existing, last_write(incoming, F.col("at")).drop("at"))


@query("s8_collection_upsert", """
SELECT vec_id AS id, CASE label WHEN 0 THEN 100 WHEN 2 THEN 102 ELSE label END::INT AS label,
  round(embedding[1]::DOUBLE, 6) AS first_part FROM embeddings
UNION ALL
SELECT vec_id + 1000000, label, round(embedding[1]::DOUBLE, 6) FROM embeddings WHERE label = 1""")
def s8_collection(spark, sf_dir):
    """A stored collection: vectors of one label come again, twice in the same batch, those
    of a second one under new ids, and, after the base was compacted, those of a third."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    collection = Collection(spark, scratch_path(spark, "collections"), "vectors")
    collection.create(vectors.agg(F.max(F.size("embedding"))).first()[0]).upsert(vectors)
    again = vectors.filter("label = 0").withColumn("label", F.explode(F.array(F.lit(99), F.lit(100))))
    fresh = vectors.filter("label = 1").withColumn("id", F.col("id") + 1000000)
    collection.upsert(again.unionByName(fresh), order=F.col("label")).compact()
    collection.upsert(vectors.filter("label = 2").withColumn("label", F.lit(101)))
    collection.upsert(vectors.filter("label = 2").withColumn("label", F.lit(102)))
    first = F.round(F.get("embedding", F.lit(0)).cast("double"), 6)
    return collection.read().select("id", "label", first.alias("first_part"))


@query("s8_rows_written", """
SELECT version::INT AS version, rows FROM (
  SELECT 1 AS version, count(*) AS rows FROM embeddings UNION ALL
  SELECT 2, count(*) FROM embeddings WHERE label = 0) WHERE rows > 0""")
def s8_written(spark, sf_dir):
    """What each write stored: an upsert writes its own points, not the collection again."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    collection = Collection(spark, scratch_path(spark, "collections"), "vectors")
    collection.create(vectors.agg(F.max(F.size("embedding"))).first()[0]).upsert(vectors)
    return collection.upsert(vectors.filter("label = 0")).written()


@query("s9_resume", with_ctes(DOCS) + """
SELECT source_file, lang FROM docs ANTI JOIN labels USING (doc_id)""")
def s9(spark, sf_dir):
    """What a run that stopped after the labelled documents still has to do."""
    work = documents(spark, sf_dir).select("source_file", "lang")
    path = scratch_path(spark, "progress")
    labels = table(spark, sf_dir, "labels")
    append_progress(labels.select(F.concat(F.lit("doc_"), "doc_id").alias("source_file")), path)
    return remaining(work, spark.read.parquet(path))


@query("s9_waves", with_ctes(DOCS) + """
SELECT source_file, length(text) AS characters FROM docs""")
def s9_waves(spark, sf_dir):
    """A run that dies after its first waves, and one that takes up what is left: every
    file is measured once."""
    work = documents(spark, sf_dir).select("source_file", "text")
    path, schema, waves = scratch_path(spark, "progress"), "source_file string, characters long", []

    def measure(wave):
        if len(waves) == 2:
            raise ConnectionError("the service is down")
        waves.append(wave)
        return wave.select("source_file", F.length("text").cast("long").alias("characters"))

    size = 1 + work.count() // 4
    try:
        in_waves(work, measure, path, schema, size)
    except ConnectionError:
        waves.clear()
    return in_waves(work, lambda wave: wave.select("source_file", F.length("text").cast("long").alias("characters")), path, schema, size)


@query("p1_drop_blank", with_ctes(DOCS, LINES) + """
SELECT source_file, seq::BIGINT AS seq FROM lines WHERE regexp_matches(text, '\\S')""")
def p1(spark, sf_dir):
    kept = line_elements(spark, sf_dir).filter(has_text(F.col("text")))
    return kept.select("source_file", "seq")


@query("p2_clean_text", with_ctes(DOCS, LINES) + f"""
SELECT source_file, seq::BIGINT AS seq, {_CLEAN} AS text FROM lines
WHERE regexp_matches(text, '\\S')""")
def p2(spark, sf_dir):
    return clean_elements(line_elements(spark, sf_dir)).select("source_file", "seq", "text")


@query("p3_tables_to_markdown", with_ctes(ITEM_TABLES) + """
SELECT source_file, seq, CASE WHEN type = 'Table' THEN 'markdown_text' ELSE type END AS type,
  CASE WHEN type = 'Table' THEN markdown END AS markdown_text FROM item_tables""")
def p3(spark, sf_dir):
    return convert_tables(item_tables(spark, sf_dir)).select("source_file", "seq", "type", "markdown_text")


@query("p4_course_of_filename", with_ctes(DOCS) + f"""
SELECT filename, {_NAME} AS coursename, {_CODE} AS coursecode FROM docs""")
def p4(spark, sf_dir):
    name, code = course_of(F.col("filename"))
    return documents(spark, sf_dir).select("filename", name.alias("coursename"), code.alias("coursecode"))


@query("p5_prefer_markdown", with_ctes(ITEM_TABLES) + """
SELECT source_file, seq, CASE WHEN type = 'Table' THEN markdown ELSE text END AS text FROM item_tables""")
def p5(spark, sf_dir):
    return prepare_elements(item_tables(spark, sf_dir)).select("source_file", "seq", "text")


@query("p6_normalize", with_ctes(DOCS, LINES) + f"""
SELECT source_file, seq::BIGINT AS seq, 'NarrativeText' AS type, {_CLEAN} AS text,
  {_NAME} AS coursename, {_CODE} AS coursecode
FROM lines WHERE regexp_matches(text, '\\S')""")
def p6(spark, sf_dir):
    done = normalize_elements(convert_tables(clean_elements(line_elements(spark, sf_dir))))
    return done.select("source_file", "seq", "type", "text", "coursename", "coursecode")


@query("p7_stage_file_name", with_ctes(DOCS) + """
SELECT source_file, source_file || '.json' AS name FROM docs""")
def p7(spark, sf_dir):
    kind = F.when(F.col("lang") == "en", "docx").when(F.col("lang") == "fr", "pdf").otherwise("doc")
    parsed = F.concat(F.col("source_file"), F.lit("_"), kind, F.lit(".json"))
    return documents(spark, sf_dir).select("source_file", stage_file_name(parsed).alias("name"))


@query("p8_stage_counters", with_ctes(DOCS, LINES, ITEM_TABLES, """raw AS (
  SELECT source_file, text, 'NarrativeText' AS type FROM lines
  UNION ALL SELECT source_file, text, type FROM item_tables)""") + """
SELECT source_file, count(*) AS processed,
  count(*) FILTER (NOT regexp_matches(text, '\\S')) AS removed,
  count(*) FILTER (regexp_matches(text, '\\S')) AS remaining,
  count(*) FILTER (type = 'Table') AS converted,
  count(*) FILTER (regexp_matches(text, '\\S')) AS normalized,
  0::BIGINT AS skipped
FROM raw GROUP BY source_file""")
def p8(spark, sf_dir):
    return stage_counters(line_elements(spark, sf_dir).unionByName(item_tables(spark, sf_dir)))


@query("p8_observed_totals", with_ctes(DOCS, LINES, ITEM_TABLES, """raw AS (
  SELECT text, 'NarrativeText' AS type FROM lines UNION ALL SELECT text, type FROM item_tables)""") + """
SELECT count(*) AS processed, count(*) FILTER (NOT regexp_matches(text, '\\S')) AS removed,
  count(*) FILTER (regexp_matches(text, '\\S')) AS remaining, count(*) FILTER (type = 'Table') AS converted,
  count(*) FILTER (regexp_matches(text, '\\S')) AS normalized, 0::BIGINT AS skipped,
  count(*) FILTER (regexp_matches(text, '\\S')) AS written
FROM raw""")
def p8_observed(spark, sf_dir):
    """The totals of a run, counted while its elements were written, and the rows it wrote."""
    raw = line_elements(spark, sf_dir).unionByName(item_tables(spark, sf_dir))
    path = scratch_path(spark, "normalized")
    totals = write_prepared(raw, path)
    return spark.read.parquet(path).agg(F.count("*").alias("written")).select(
        *(F.lit(n).cast("long").alias(c) for c, n in totals.items()), "written")


@query("p9_source_filter", with_ctes(DOCS, chunks_sql(SMALL)) + """
SELECT source_file, chunk_id, text FROM chunks JOIN (SELECT 'doc_' || doc_id AS source_file
  FROM labels WHERE quality = 1) USING (source_file)""")
def p9(spark, sf_dir):
    """Equality on `source_file`, for many questions at once: an equi-join."""
    wanted = table(spark, sf_dir, "labels").filter("quality = 1").select(
        F.concat(F.lit("doc_"), "doc_id").alias("source_file")
    )
    return chunks(spark, sf_dir).join(wanted, "source_file").select("source_file", "chunk_id", "text")


@query("p11_failure_isolation", """
WITH d AS (SELECT doc_id, regexp_extract(text, '([0-9]+)', 1) AS found FROM documents),
n AS (SELECT doc_id, found, try_cast(found AS INT) AS value FROM d)
SELECT doc_id, CASE WHEN value IS NULL THEN 'quarantine' ELSE 'good' END AS side, value,
  CASE WHEN value IS NULL THEN 'not a whole number: ' || substr(found, 1, 20) END AS error FROM n""")
def p11(spark, sf_dir):
    """The first number of a text: none, or one too large, fails for its row alone."""
    found = F.regexp_extract("text", "([0-9]+)", 1)
    read = table(spark, sf_dir, "documents").select("doc_id", found.alias("found")).withColumn("value", F.col("found").try_cast("int"))
    failed = F.when(F.col("value").isNull(), F.concat(F.lit("not a whole number: "), F.substring("found", 1, 20)))
    good, bad = split_failures(read.withColumn("error", failed).drop("found"), "value", "error")
    return good.select("doc_id", F.lit("good").alias("side"), "value", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("doc_id", F.lit("quarantine").alias("side"), F.lit(None).cast("int").alias("value"), "error"))
