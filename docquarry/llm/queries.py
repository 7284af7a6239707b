"""The operators' registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import language_id
from docquarry.llm.decontamination import contaminated, question_and_answer
from docquarry.llm.hard_negatives import hard_negatives
from docquarry.llm.kneser_ney import classify
from docquarry.llm.license_scan import license_scan
from docquarry.llm.merkle import manifest
from docquarry.llm.packing import pack, token_pieces
from docquarry.llm.pii import KINDS, digest, find_pii
from docquarry.llm.quality_rules import quality_rules
from docquarry.llm.simhash import simhash_groups
from docquarry.llm.substring_dedup import repeated_strings
from docquarry.llm.token_counts import line_sections, section_counts
from docquarry.llm.weighted_sampling import neighbour_fingerprints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_JS = "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
_COUNTED = ", ".join(f"length(regexp_replace(text, '{c}', '', 'g'))" for c in (
    "[^#*$%&|<>]", "[^A-Z]", "[^0-9]", r"[^!\"''(-),-/:;=?@\[-`{}~+]", r"[\x00-\x7F]"))
_QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, lang, regexp_extract_all(text, '[^ 	-
]+') AS ws FROM d)),
n AS (SELECT r, any_value(lang) AS lang, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
windows AS (
  SELECT r, i, word AS a, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM windows WHERE c IS NOT NULL) WHERE k > 1),
covered AS (SELECT r, count(DISTINCT i + s) AS words FROM repeated, (VALUES (0), (1), (2)) AS x(s) GROUP BY r),
lines AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
classes AS (
  SELECT r, lang, length(text) AS size, list_transform([{_COUNTED}], lambda x: x / greatest(length(text), 1)) AS s FROM d),
shares AS (
  SELECT r, lang, size, unnest(list_append(s, greatest(0, 1 - list_sum(s)))) AS p, generate_subscripts(list_append(s, 0), 1) AS k
  FROM classes),
totals AS (SELECT lang, sum(n_words) AS total FROM n GROUP BY lang HAVING sum(n_words) >= 20000),
char_ref AS (SELECT lang, k, avg(p) AS q FROM shares WHERE size > 0 GROUP BY lang, k),
common AS (
  SELECT lang, word, count(*) / any_value(total) AS q FROM w JOIN totals USING (lang)
  GROUP BY lang, word HAVING count(*) >= 0.005 * any_value(total)),
char_js AS (
  SELECT r, sqrt(least(1, greatest(0, sum({_JS}) / 2))) AS x FROM shares JOIN char_ref USING (lang, k) GROUP BY r),
held AS (SELECT r, word, count(*) AS c FROM w GROUP BY r, word),
known AS (
  SELECT n.r, n.lang, common.q, coalesce(c, 0) / n_words AS p
  FROM n JOIN common USING (lang) LEFT JOIN held ON held.r = n.r AND held.word = common.word),
all_words AS (
  SELECT r, q, p FROM known UNION ALL SELECT r, 1 - sum(q), 1 - sum(p) FROM known GROUP BY r),
word_js AS (SELECT r, sqrt(least(1, greatest(0, sum({_JS}) / 2))) AS x FROM all_words GROUP BY r),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(words, 0) AS n_repeat_words,
    CASE WHEN n_words >= 50 AND word_js.x IS NOT NULL THEN char_js.x END AS cd,
    CASE WHEN n_words >= 50 THEN word_js.x END AS wd
  FROM d JOIN lines USING (r) LEFT JOIN n USING (r) LEFT JOIN covered USING (r)
    LEFT JOIN char_js USING (r) LEFT JOIN word_js USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
  NOT failed AND coalesce(cd, 0) <= 0.35 AND coalesce(wd, 0) <= 0.45 AS kept,
  round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM measured)"""


@query("op1_quality_rules", _QUALITY_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *(F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")),
    )


@query("op3_simhash_groups")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs, shingle=3, max_bits=2).select("doc_id", "fingerprint", "component_id")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    learned = docs.filter(~held_out & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    model = language_id.train(learned.select("text", "lang"))
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = question_and_answer(table(spark, sf_dir, "benchmark"))
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), items)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(digest(F.col("base_spans")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"),
    )


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The documents bear no paths; source, language and id make up a tree.
    path = F.concat_ws("/", "source", "lang", (F.col("doc_id") / 500).cast("long").cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan(docs)


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return section_counts(docs, line_sections(F.col("text")), tokenizer_path())


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"), n=400)
    spans = F.concat_ws(",", F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256", spans.alias("spans"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return classify(docs, trusted).withColumns({c: F.round(c, 4) for c in ("perplexity", "threshold")})


def _manifest_sql(height: int = 10) -> str:
    """Trees of up to 8 ** `height` leaves, and as many parts, level by level."""
    value = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    ctes = [
        # The remainder of the polynomial division, bit by bit over each byte of the decimal id.
        """crc AS (
  SELECT DISTINCT doc_id, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x // 2, 3988292384 * (x % 2)))), 4294967295) % 3 = 0 AS touched
  FROM documents)""",
        f"""raw AS (
  SELECT *, {leaf("text")} AS leaf, {leaf("low")} AS lower_leaf
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents))""",
        """leaves AS (
  SELECT raw.doc_id, lang, leaf, CASE WHEN touched THEN lower_leaf ELSE leaf END AS held,
    coalesce('=' || lang, '') AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY raw.doc_id NULLS FIRST, leaf) - 1 AS i
  FROM raw JOIN crc ON raw.doc_id IS NOT DISTINCT FROM crc.doc_id)""",
    ]

    def levels(name: str, start: str) -> None:
        """`name`k: the nodes of level k with their siblings; a tree's last node stays as it is."""
        ctes.append(f"{name}0 AS ({start})")
        for k in range(height):
            ctes.append(f"""{name}{k + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (n + 7) // 8 AS n
  FROM {name}{k} GROUP BY tree, i // 8, n)""")
            around = f"PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
            ctes.append(f"""{name}{k}s AS (
  SELECT tree, i, n > 1 AS hashed, coalesce(string_agg(h, '') OVER ({around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER ({around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k})""")

    def walk(name: str, rows: str, tree: str, i: str, x: str, trail: str, out: str) -> None:
        """From `x` up through the levels, collecting the siblings."""
        ctes.append(f"{out}0 AS (SELECT *, {tree} AS tree_, {i} AS i_, {x} AS x_, {trail} AS trail_ FROM {rows})")
        for k in range(height):
            ctes.append(f"""{out}{k + 1} AS (
  SELECT o.* REPLACE (i_ // 8 AS i_, CASE WHEN hashed THEN sha256(before || x_ || after) ELSE x_ END AS x_,
    trail_ || before || after AS trail_)
  FROM {out}{k} o JOIN {name}{k}s s ON s.tree = tree_ AND s.i = i_)""")

    levels("n", "SELECT tree, i, leaf AS h, n FROM leaves")
    ctes.append(f"""parts AS (
  SELECT tree, h, count(*) OVER () AS n, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM n{height})""")
    levels("t", "SELECT '' AS tree, i, h, n FROM parts")
    walk("n", "leaves", "tree", "i", "held", "''", "a")
    ctes.append(f"""folded AS (
  SELECT a.doc_id, a.lang, a.leaf, p.h AS subroot, p.i AS part, a.x_ AS folded, a.trail_ AS trail
  FROM a{height} a JOIN parts p USING (tree))""")
    walk("t", "folded", "''", "part", "folded", "trail", "b")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, lang, leaf, subroot, t.h AS root, sha256(trail_) AS proof_sha256, x_ AS folded_root, x_ = t.h AS verified
FROM b{height}, t{height} t"""


@query("op12_merkle_manifest", _manifest_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(docs, docs.columns, "lang", "doc_id", tampered, {"text": lower})


@query("op11_hard_negatives", """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS s
  FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, s AS p FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, id AS negative_id, p AS positive_score, s AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * p <= 100 * s AND 100 * s <= 95 * p
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id)
QUALIFY row_number() OVER w <= 3""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("op13_document_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
