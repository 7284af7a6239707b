"""The stages' inputs, derived from the given tables, in Spark and in SQL.

The SQL fragments are common table expressions that the query modules put
together; each one mirrors the function above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.chunking import ChunkConfig, chunk_documents
from docquarry.operators.evalset import containing_files
from docquarry.plans.registry import table
from docquarry.session import spread
from docquarry.sources.elements import elements_from_text

# Documents have no file name; this rule (valid in Spark and in SQL) gives names of
# every kind: supported and not, with and without an underscore, in both cases.
FILENAME = """CASE lang
  WHEN 'en' THEN source || '_' || lang || '_' || doc_id || '.docx'
  WHEN 'fr' THEN source || '-' || doc_id || '.pdf'
  WHEN 'de' THEN source || '_' || doc_id || '.PDF'
  ELSE source || '_' || doc_id || '.txt' END"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), "doc_id").alias("source_file"),
        "text",
        F.expr(FILENAME).alias("filename"),
        "lang", "source", "doc_id",
    )


DOCS = f"""docs AS (
  SELECT 'doc_' || doc_id AS source_file, text, {FILENAME} AS filename, lang, source, doc_id
  FROM documents)"""


def line_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements_from_text(
        spread(documents(spark, sf_dir)), F.col("source_file"), F.col("text"), F.col("filename")
    )


LINES = """lines AS (
  SELECT source_file, filename, unnest(string_split(text, chr(10))) AS text,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS seq
  FROM docs)"""


def item_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table element per line item, its fields as HTML rows. Items that were
    returned have no header row; accepted ones come as plain text elements."""
    cells = lambda name, value: F.concat(
        F.lit(f"<tr><td><b>{name}</b></td>\n<td> "), value, F.lit("</td></tr>")
    )
    returned = F.col("l_returnflag") == "R"
    header = F.when(returned, "").otherwise("<tr><th>field</th><th>value</th></tr>")
    html = F.concat(
        F.lit("<table>"), header,
        cells("line", F.col("l_linenumber").cast("string")),
        cells("part", F.col("l_partkey").cast("string")),
        cells("quantity", F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" &amp; more"))),
        cells("status", F.concat_ws("_", "l_returnflag", "l_linestatus")),
        F.lit("</table>"),
    )
    name = F.concat(F.lit("order_"), "l_orderkey")
    return spread(table(spark, sf_dir, "lineitem")).select(
        name.alias("source_file"),
        F.col("l_linenumber").cast("long").alias("seq"),
        F.concat_ws("#", name, F.col("l_linenumber").cast("string")).alias("element_id"),
        F.when(F.col("l_returnflag") == "A", "NarrativeText").otherwise("Table").alias("type"),
        F.concat(F.lit("part "), "l_partkey").alias("text"),
        F.struct(
            F.concat(name, F.lit(".docx")).alias("filename"), html.alias("text_as_html")
        ).alias("metadata"),
    )


ITEM_TABLES = r"""item_tables AS (
  SELECT 'order_' || l_orderkey AS source_file, l_linenumber::BIGINT AS seq,
    CASE WHEN l_returnflag = 'A' THEN 'NarrativeText' ELSE 'Table' END AS type,
    'part ' || l_partkey AS text,
    CASE WHEN l_returnflag = 'R' THEN '|  |  |' ELSE '| field | value |' END || chr(10)
    || '| --- | --- |' || chr(10) || '| line | ' || l_linenumber || ' |' || chr(10)
    || '| part | ' || l_partkey || ' |' || chr(10)
    || '| quantity | ' || l_quantity::INT || ' & more |' || chr(10)
    || '| status | ' || l_returnflag || '\_' || l_linestatus || ' |' AS markdown
  FROM lineitem)"""


SMALL = ChunkConfig("words_64_8", 64, 8)


def chunks(spark: SparkSession, sf_dir: str, configs: list[ChunkConfig] | None = None) -> DataFrame:
    return chunk_documents(
        spread(documents(spark, sf_dir).select("source_file", "text")),
        F.col("source_file"), F.col("text"), configs or [SMALL],
    )


_WORDS_SQL = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
_SIGNS_SQL = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')"


def words_sql(text: str) -> str:
    return _WORDS_SQL.format(text)


def chunks_sql(config: ChunkConfig, name: str = "chunks", signs: bool = False) -> str:
    """CTE with the chunks of one configuration."""
    tokens = (_SIGNS_SQL if signs else _WORDS_SQL).format("text")
    c, s = config.chunk_size, config.step
    return f"""{name}_t AS (SELECT source_file, {tokens} AS tokens FROM docs),
{name}_n AS (
  SELECT source_file, tokens, unnest(generate_series(0,
    CASE WHEN len(tokens) < {c} THEN 0 ELSE (len(tokens) - {c}) // {s} + 1 END)) AS chunk_id
  FROM {name}_t WHERE len(tokens) > 0),
{name} AS (
  SELECT '{config.name}' AS config, source_file, chunk_id::INT AS chunk_id,
    array_to_string(list_slice(tokens, chunk_id * {s} + 1, chunk_id * {s} + {c}), ' ') AS text
  FROM {name}_n)"""


def terms_sql(text: str) -> str:
    return (
        "list_filter(list_transform(" + words_sql(f"lower({text})")
        + ", lambda w: trim(w, '.,;:!?()[]\"')), lambda w: w <> '')"
    )


def vectors_sql(
    chunks: str, dim: int = 256, prefix: str = "", key: str = "source_file, chunk_id"
) -> str:
    """CTEs `term`, `freq`, `total` and `vec` (key, b, v): the non-zero parts of unit vectors."""
    p = prefix
    return f"""{p}term AS (
  SELECT {key}, ('0x' || substr(md5(t), 1, 4))::INT AS slot
  FROM (SELECT {key}, unnest({terms_sql('text')}) AS t FROM {chunks})),
{p}freq AS (
  SELECT slot, count(*) AS df FROM (SELECT DISTINCT {key}, slot FROM {p}term) GROUP BY slot),
{p}total AS (SELECT count(*) AS n FROM {chunks}),
{p}raw AS (
  SELECT {key}, slot % {dim} AS b, sum(ln((n + 1) / (df + 1))) AS v
  FROM {p}term JOIN {p}freq USING (slot), {p}total GROUP BY ALL),
{p}vec AS (
  SELECT {key}, b, (v / sqrt(sum(v * v) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS v
  FROM {p}raw)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage, whole, as question and as reference text."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question"),
        F.col("text").alias("reference_text"),
    )


def question_vectors_sql(dim: int = 256, prefix: str = "", name: str = "qvec") -> str:
    """CTE (query_id, b, v): question vectors under the frequencies of `freq`."""
    p = prefix
    return f"""{name}_term AS (
  SELECT item_id AS query_id, ('0x' || substr(md5(t), 1, 4))::INT AS slot
  FROM (SELECT item_id, unnest({terms_sql('text')}) AS t FROM benchmark)),
{name}_raw AS (
  SELECT query_id, slot % {dim} AS b, sum(ln((n + 1) / (coalesce(df, 0) + 1))) AS v
  FROM {name}_term LEFT JOIN {p}freq USING (slot), {p}total GROUP BY ALL),
{name} AS (
  SELECT query_id, b, (v / sqrt(sum(v * v) OVER (PARTITION BY query_id)))::FLOAT::DOUBLE AS v
  FROM {name}_raw)"""


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, source_file): the documents that hold a benchmark passage word for word."""
    passages = questions(spark, sf_dir).select("query_id", F.col("question").alias("text"))
    return containing_files(passages, spread(documents(spark, sf_dir).select("source_file", "text")))


GOLD = """gold AS (
  SELECT item_id AS query_id, 'doc_' || doc_id AS source_file
  FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
