"""Queries over retrieval metrics and answer metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions.fuzzy import with_token_set_bounds, with_token_set_ratio
from docquarry.functions.scores import judge_failed, judge_score, token_f1
from docquarry.operators.answer_metrics import judged, leaderboard, long_form, score_answers
from docquarry.operators.chunking import COMPARED, ChunkConfig
from docquarry.operators.generation import answer, with_models
from docquarry.operators.prompting import (
    FAITHFULNESS_PROMPT, RELEVANCY_PROMPT, faithfulness_prompt, relevancy_prompt,
)
from docquarry.operators.retrieval import top_k
from docquarry.operators.retrieval_metrics import (
    compare, coverage, evaluate_retrieval, fuzzy_matches, per_question, report,
)
from docquarry.plans.answering import ANSWERED, MODELS, asked, fill_sql
from docquarry.plans.inputs import (
    DOCS, GOLD, SMALL, chunks_sql, gold, question_vectors_sql, questions, terms_sql, vectors_sql,
    with_ctes, words_sql,
)
from docquarry.plans.registry import query, rounded, table
from docquarry.plans.search import (
    FILTERED_HITS, OPEN_HITS, filtered_hits, indexed, open_hits, samples,
)
from docquarry.session import stage


def round_measures(df):
    return df.select(*[
        rounded(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


# ---------------------------------------------------------------- token-set ratio in SQL

PARTS = """parts AS (
  SELECT pid, len(l) = 0 OR len(r) = 0 AS none,
    array_to_string(list_sort(list_intersect(l, r)), ' ') AS common,
    array_to_string(list_sort(list_filter(l, lambda w: NOT list_contains(r, w))), ' ') AS a,
    array_to_string(list_sort(list_filter(r, lambda w: NOT list_contains(l, w))), ' ') AS b
  FROM (SELECT pid, list_distinct({l}) AS l, list_distinct({r}) AS r FROM pair)),
sized AS (
  SELECT pid, none, a, b, length(common) AS x, length(a) AS la, length(b) AS lb,
    CASE WHEN length(common) > 0 THEN 1 ELSE 0 END AS g FROM parts)""".format(
    l=words_sql("lower(l)"), r=words_sql("lower(r)")
)


def score_sql(indel: str) -> str:
    return f"""CASE WHEN none THEN 0.0::DOUBLE WHEN x > 0 AND (la = 0 OR lb = 0) THEN 100.0
    WHEN x = 0 THEN 100.0::DOUBLE * (1 - ({indel}) / (2 * (x + g) + la + lb))
    ELSE greatest(100.0::DOUBLE * (1 - ({indel}) / (2 * (x + g) + la + lb)),
      100.0::DOUBLE * (1 - (g + la) / (2 * x + g + la)),
      100.0::DOUBLE * (1 - (g + lb) / (2 * x + g + lb))) END"""


# The longest common subsequence of the leftovers, one anti-diagonal per step: entry i
# of `cur` is the length for the first i signs of a and the first k - i of b.
def exact_sql(where: str = "true") -> str:
    """Scores of all pairs. Pairs outside `where` get their lower bound instead."""
    return f"""todo AS (
  SELECT pid, la, lb, list_transform(range(1, la + 1), lambda i: unicode(substr(a, i, 1))) AS ca,
    list_transform(range(1, lb + 1), lambda i: unicode(substr(b, i, 1))) AS cb
  FROM sized WHERE NOT none AND la > 0 AND lb > 0 AND {where}),
lcs AS (
  SELECT pid, 0 AS k, list_transform(range(0, la + 1), lambda i: 0::SMALLINT) AS cur,
    list_transform(range(0, la + 1), lambda i: 0::SMALLINT) AS prev FROM todo
  UNION ALL
  SELECT pid, k + 1, list_transform(range(0, la + 1), lambda i:
    CASE WHEN i = 0 OR k + 1 - i <= 0 OR k + 1 - i > lb THEN 0
      WHEN ca[i] = cb[k + 1 - i] THEN prev[i] + 1
      ELSE greatest(cur[i], cur[i + 1]) END::SMALLINT), cur
  FROM lcs JOIN todo USING (pid) WHERE k < la + lb),
exact AS (
  SELECT pid, {score_sql('la + lb - 2 * coalesce(cur[la + 1], 0)')} AS score
  FROM sized LEFT JOIN (SELECT pid, cur FROM lcs JOIN todo USING (pid) WHERE k = la + lb) USING (pid))"""


EXACT = exact_sql()
# Enough to tell whether a score exceeds 70: only pairs whose bounds enclose 70.
EXACT_NEAR_70 = exact_sql(f"{score_sql('la + lb')} <= 70 AND {score_sql('abs(la - lb)')} > 70")


def recursive(*ctes: str) -> str:
    return with_ctes(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


_OPEN_PAIRS = """pair AS (
  SELECT query_id || ':' || rank AS pid, query_id, rank, b.text AS l, h.text AS r
  FROM hits h JOIN benchmark b ON item_id = query_id)"""
_ALL_TEXT_PAIRS = """pair AS (
  SELECT query_id::VARCHAR AS pid, query_id, any_value(b.text) AS l,
    string_agg(h.text, ' ' ORDER BY rank) AS r
  FROM hits h JOIN benchmark b ON item_id = query_id GROUP BY query_id)"""
# Single hits and all hits of a question together (rank 0) in one set of pairs.
_BOTH_PAIRS = """pair AS (
  SELECT query_id || ':' || rank AS pid, query_id, rank, b.text AS l, h.text AS r
  FROM hits h JOIN benchmark b ON item_id = query_id
  UNION ALL
  SELECT query_id || ':0', query_id, 0, any_value(b.text), string_agg(h.text, ' ' ORDER BY rank)
  FROM hits h JOIN benchmark b ON item_id = query_id GROUP BY query_id)"""
_SCORED_QUESTIONS = """judged AS (
  SELECT query_id, max((rank = 1 AND score > 70)::INT) AS top1,
    max((rank > 0 AND score > 70)::INT) AS hit,
    coalesce(1.0::DOUBLE / min(CASE WHEN rank > 0 AND score > 70 THEN rank END), 0) AS rr,
    max((rank = 0 AND score > 70)::INT) AS covered
  FROM pair JOIN exact USING (pid) GROUP BY query_id)"""


def _pairs(spark, sf_dir):
    return open_hits(spark, sf_dir).join(
        questions(spark, sf_dir).select("query_id", "reference_text"), "query_id"
    )


@query("m1_case_fold", with_ctes(*OPEN_HITS) + """
SELECT query_id, rank, lower(text) AS text FROM hits""")
def m1(spark, sf_dir):
    return open_hits(spark, sf_dir).select("query_id", "rank", F.lower("text").alias("text"))


@query("m2_token_set_bounds", with_ctes(*OPEN_HITS, _OPEN_PAIRS, PARTS) + f"""
SELECT query_id, rank, round({score_sql('la + lb')}, 6) AS low,
  round({score_sql('abs(la - lb)')}, 6) AS high
FROM sized JOIN pair USING (pid)""")
def m2_bounds(spark, sf_dir):
    bounded = with_token_set_bounds(_pairs(spark, sf_dir), F.col("reference_text"), F.col("text"))
    return bounded.select(
        "query_id", "rank", rounded("score_low").alias("low"), rounded("score_high").alias("high")
    )


@query("m2_token_set_ratio", recursive(*OPEN_HITS, _OPEN_PAIRS, PARTS, EXACT) + """
SELECT query_id, rank, round(score, 6) AS score FROM exact JOIN pair USING (pid)""")
def m2(spark, sf_dir):
    scored = with_token_set_ratio(
        _pairs(spark, sf_dir), F.col("reference_text"), F.col("text"), "ratio"
    )
    return scored.select("query_id", "rank", rounded("ratio").alias("score"))


@query("m3_m5_per_question", recursive(*OPEN_HITS, _BOTH_PAIRS, PARTS, EXACT_NEAR_70, _SCORED_QUESTIONS) + """
SELECT query_id, top1, hit, round(rr, 6) AS reciprocal_rank FROM judged""")
def m3(spark, sf_dir):
    """Top-1, hit and reciprocal rank of each question."""
    ask = questions(spark, sf_dir)
    matches = fuzzy_matches(ask, open_hits(spark, sf_dir))
    scored = per_question(ask.select("query_id"), matches, ["query_id"])
    return scored.withColumn("reciprocal_rank", rounded("reciprocal_rank"))


@query("m3_m5_own_file", with_ctes(*FILTERED_HITS, """flags AS (
  SELECT query_id, rank, contains(h.text, b.text) AS ok
  FROM hits h JOIN benchmark b ON item_id = split_part(query_id, '@', 1)::BIGINT),
per AS (
  SELECT s.query_id, coalesce(max((rank = 1 AND ok)::INT), 0) AS top1, coalesce(max(ok::INT), 0) AS hit,
    coalesce(1.0::DOUBLE / min(CASE WHEN ok THEN rank END), 0) AS rr
  FROM (SELECT query_id || '@' || source_file AS query_id FROM gold) s LEFT JOIN flags USING (query_id) GROUP BY s.query_id)""") + """
SELECT count(*) AS total_samples, round(avg(top1), 6) AS top1_accuracy,
  round(avg(hit), 6) AS hit_rate_at_k, round(avg(rr), 6) AS mrr FROM per""")
def m3_own_file(spark, sf_dir):
    """Match = the hit's chunk, out of the sample's own file, holds the whole passage."""
    ask = stage(samples(spark, sf_dir), "samples")
    hits = filtered_hits(spark, sf_dir, asked=ask).join(ask.select("query_id", "question"), "query_id")
    matches = hits.withColumn("match", F.contains("text", "question"))
    return round_measures(report(per_question(ask.select("query_id"), matches, ["query_id"]), []))


@query("m4_containment_report", with_ctes(*OPEN_HITS, GOLD, """flags AS (
  SELECT query_id, rank, EXISTS (SELECT 1 FROM gold g WHERE g.query_id = hits.query_id
    AND g.source_file = hits.source_file) AS ok FROM hits),
per AS (
  SELECT item_id, coalesce(max((rank = 1 AND ok)::INT), 0) AS top1, coalesce(max(ok::INT), 0) AS hit,
    coalesce(1.0::DOUBLE / min(CASE WHEN ok THEN rank END), 0) AS rr
  FROM benchmark LEFT JOIN flags ON item_id = query_id GROUP BY item_id)""") + """
SELECT count(*) AS total_samples, round(avg(top1), 6) AS top1_accuracy,
  round(avg(hit), 6) AS hit_rate_at_k, round(avg(rr), 6) AS mrr FROM per""")
def m4(spark, sf_dir):
    """Match = the hit's document holds the passage word for word."""
    right = gold(spark, sf_dir).withColumn("match", F.lit(True))
    hits = open_hits(spark, sf_dir).join(right, ["query_id", "source_file"], "left")
    matches = hits.withColumn("match", F.coalesce("match", F.lit(False)))
    ask = questions(spark, sf_dir).select("query_id")
    return round_measures(report(per_question(ask, matches, ["query_id"]), []))


@query("m6_answer_coverage", recursive(*OPEN_HITS, _ALL_TEXT_PAIRS, PARTS, EXACT_NEAR_70) + """
SELECT query_id, score > 70 AS covered FROM exact JOIN pair USING (pid)""")
def m6(spark, sf_dir):
    return coverage(questions(spark, sf_dir), open_hits(spark, sf_dir), ["query_id"])


@query("m7_retrieval_report", recursive(*OPEN_HITS, _BOTH_PAIRS, PARTS, EXACT_NEAR_70, _SCORED_QUESTIONS) + """
SELECT count(*) AS total_samples, round(avg(coalesce(top1, 0)), 6) AS top1_accuracy,
  round(avg(coalesce(hit, 0)), 6) AS hit_rate_at_k, round(avg(coalesce(rr, 0)), 6) AS mrr,
  round(avg(coalesce(covered, 0)), 6) AS answer_coverage_at_k
FROM benchmark LEFT JOIN judged ON item_id = query_id""")
def m7(spark, sf_dir):
    """The flagship: index everything, ask every question, report the hits' quality."""
    hits = stage(open_hits(spark, sf_dir), "hits")
    return round_measures(evaluate_retrieval(questions(spark, sf_dir), hits))


_OWN_FILE_PAIRS = """asked_hits AS (
  SELECT h.*, b.text AS l FROM hits h JOIN benchmark b ON item_id = split_part(query_id, '@', 1)::BIGINT),
pair AS (
  SELECT query_id || ':' || rank AS pid, query_id, rank, l, text AS r FROM asked_hits
  UNION ALL
  SELECT query_id || ':0', query_id, 0, any_value(l), string_agg(text, ' ' ORDER BY rank)
  FROM asked_hits GROUP BY query_id)"""


@query("m7_report_own_file", recursive(
    *FILTERED_HITS, _OWN_FILE_PAIRS, PARTS, EXACT_NEAR_70, _SCORED_QUESTIONS) + """
SELECT count(*) AS total_samples, round(avg(coalesce(top1, 0)), 6) AS top1_accuracy,
  round(avg(coalesce(hit, 0)), 6) AS hit_rate_at_k, round(avg(coalesce(rr, 0)), 6) AS mrr,
  round(avg(coalesce(covered, 0)), 6) AS answer_coverage_at_k
FROM (SELECT query_id || '@' || source_file AS query_id FROM gold) LEFT JOIN judged USING (query_id)""")
def m7_own_file(spark, sf_dir):
    """The report over samples that each look only into their own document."""
    ask = stage(samples(spark, sf_dir), "samples")
    hits = stage(filtered_hits(spark, sf_dir, asked=ask), "hits")
    return round_measures(evaluate_retrieval(ask, hits))


CONFIGS = [SMALL, COMPARED[0], ChunkConfig("words_512_52", 512, 52)]


def _compared(spark, sf_dir):
    """The reports of all configurations, in one job: each chunk and each question
    carries its configuration, which is also the filter of the search."""
    encoder, points = indexed(spark, sf_dir, CONFIGS)
    ask = questions(spark, sf_dir).withColumn(
        "config", F.explode(F.array(*[F.lit(c.name) for c in CONFIGS]))
    )
    vectors = encoder.encode(ask, "question").select(
        F.struct("config", "query_id").alias("query_id"), "config", "embedding"
    )
    # An id is the same in all configurations; here it must tell which chunk is meant.
    points = points.withColumn("id", F.concat_ws("|", "config", "id"))
    hits = top_k(vectors, points, filters=["config"], carry=["text"])
    hits = stage(hits.select("query_id.*", "rank", "text"), "hits")
    return evaluate_retrieval(ask.select("config", "query_id", "reference_text"), hits, ["config"])


def _config_ctes(i: int, config: ChunkConfig) -> list[str]:
    return [
        chunks_sql(config, f"ch{i}"),
        vectors_sql(f"ch{i}", prefix=f"p{i}_"),
        question_vectors_sql(prefix=f"p{i}_", name=f"q{i}"),
        f"""d{i} AS (
  SELECT q.query_id, v.source_file, v.chunk_id, sum(q.v * v.v) AS d
  FROM q{i} q JOIN p{i}_vec v USING (b) GROUP BY ALL),
h{i} AS (
  SELECT '{config.name}' AS config, query_id, text, row_number() OVER (PARTITION BY query_id
    ORDER BY round(d / (l * ql), 9) DESC, source_file || '_' || chunk_id)::INT AS rank
  FROM d{i}
  JOIN (SELECT source_file, chunk_id, sqrt(sum(v * v)) AS l FROM p{i}_vec GROUP BY ALL)
    USING (source_file, chunk_id)
  JOIN (SELECT query_id, sqrt(sum(v * v)) AS ql FROM q{i} GROUP BY ALL) USING (query_id)
  JOIN ch{i} USING (source_file, chunk_id)
  QUALIFY rank <= 5)""",
    ]


_CONFIG_REPORTS = [
    DOCS,
    *[cte for i, c in enumerate(CONFIGS) for cte in _config_ctes(i, c)],
    "hits AS (" + " UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(len(CONFIGS))) + ")",
    """pair AS (
  SELECT config || ':' || query_id || ':' || rank AS pid, config, query_id, rank, b.text AS l, h.text AS r
  FROM hits h JOIN benchmark b ON item_id = query_id
  UNION ALL
  SELECT config || ':' || query_id || ':0', config, query_id, 0, any_value(b.text),
    string_agg(h.text, ' ' ORDER BY rank)
  FROM hits h JOIN benchmark b ON item_id = query_id GROUP BY config, query_id)""",
    PARTS,
    EXACT_NEAR_70,
    """flags AS (
  SELECT config, query_id, max((rank = 1 AND score > 70)::INT) AS top1,
    max((rank > 0 AND score > 70)::INT) AS hit,
    coalesce(1.0::DOUBLE / min(CASE WHEN rank > 0 AND score > 70 THEN rank END), 0) AS rr,
    max((rank = 0 AND score > 70)::INT) AS covered
  FROM pair JOIN exact USING (pid) GROUP BY config, query_id),
reports AS (
  SELECT config, count(*) AS total_samples, avg(top1) AS top1_accuracy, avg(hit) AS hit_rate_at_k,
    avg(rr) AS mrr, avg(covered) AS answer_coverage_at_k FROM flags GROUP BY config)""",
]


@query("m9_compare_configs", recursive(*_CONFIG_REPORTS) + """
SELECT config, total_samples, round(top1_accuracy, 6) AS top1_accuracy,
  round(hit_rate_at_k, 6) AS hit_rate_at_k, round(mrr, 6) AS mrr,
  round(answer_coverage_at_k, 6) AS answer_coverage_at_k FROM reports""")
def m9(spark, sf_dir):
    return round_measures(_compared(spark, sf_dir))


@query("m9_config_deltas", recursive(*_CONFIG_REPORTS) + f"""
SELECT r.config, round(r.top1_accuracy - b.top1_accuracy, 6) AS top1_accuracy_delta,
  round(r.hit_rate_at_k - b.hit_rate_at_k, 6) AS hit_rate_at_k_delta,
  round(r.mrr - b.mrr, 6) AS mrr_delta,
  round(r.answer_coverage_at_k - b.answer_coverage_at_k, 6) AS answer_coverage_at_k_delta
FROM reports r, reports b WHERE b.config = '{CONFIGS[0].name}'""")
def m9_deltas(spark, sf_dir):
    return round_measures(compare(_compared(spark, sf_dir), CONFIGS[0].name))


# ------------------------------------------------------------------------ answers

_TURNS = """turns AS (
  SELECT a.conv_id, a.turn, a.text AS prediction, u.text AS truth
  FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE a.role = 'assistant' AND u.role = 'user'),
sets AS (
  SELECT conv_id, turn, list_distinct({p}) AS p, list_distinct({t}) AS t FROM turns)""".format(
    p=words_sql("lower(prediction)"), t=words_sql("lower(truth)")
)


@query("a1_token_f1", with_ctes(_TURNS) + """
SELECT conv_id, turn, round(CASE WHEN len(list_intersect(p, t)) > 0
  THEN 2.0::DOUBLE * len(list_intersect(p, t)) / (len(p) + len(t)) ELSE 0 END, 6) AS f1 FROM sets""")
def a1(spark, sf_dir):
    """Each assistant turn against the user turn before it, joined on (conversation, turn)."""
    turns = table(spark, sf_dir, "conversations")
    truth = turns.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("truth")
    )
    return turns.filter("role = 'assistant'").join(truth, ["conv_id", "turn"]).select(
        "conv_id", "turn", rounded(token_f1(F.col("text"), F.col("truth"))).alias("f1")
    )


def answered(spark, sf_dir):
    """Each question answered by each model, with its context and its true answer."""
    rows = stage(asked(spark, sf_dir), "asked").withColumn("ground_truth_answer", F.col("question"))
    return answer(with_models(rows, MODELS))


def _share(needles: str, haystack: str) -> str:
    wanted = f"list_distinct({terms_sql(needles)})"
    return (
        f"CASE WHEN len({wanted}) > 0 THEN "
        f"len(list_intersect({wanted}, {terms_sql(haystack)}))::DOUBLE / len({wanted}) ELSE 0 END"
    )


_JUDGED = f"""rated_answers AS (
  SELECT model, query_id, question, context, answer, {_share('answer', 'context')} AS faithfulness,
    {_share('question', 'answer')} AS relevancy,
    list_distinct({words_sql('lower(answer)')}) AS p, list_distinct({words_sql('lower(question)')}) AS t
  FROM answers JOIN asked USING (query_id)),
board AS (
  SELECT model, faithfulness, relevancy, CASE WHEN len(list_intersect(p, t)) > 0
    THEN 2.0::DOUBLE * len(list_intersect(p, t)) / (len(p) + len(t)) ELSE 0 END AS f1 FROM rated_answers)"""


@query("a2_a3_judged_answers", with_ctes(*ANSWERED, _JUDGED) + """
SELECT model, query_id, round(faithfulness, 6) AS faithfulness, round(relevancy, 6) AS relevancy
FROM rated_answers""")
def a2(spark, sf_dir):
    rows = judged(answered(spark, sf_dir))
    return rows.select(
        "model", "query_id", rounded("faithfulness").alias("faithfulness"),
        rounded("relevancy").alias("relevancy"),
    )


@query("a2_a3_judge_prompts", with_ctes(*ANSWERED) + f"""
SELECT model, query_id,
  {fill_sql(FAITHFULNESS_PROMPT, question='question', context='context', answer='answer')} AS faithfulness_prompt,
  {fill_sql(RELEVANCY_PROMPT, question='question', answer='answer')} AS relevancy_prompt
FROM answers JOIN asked USING (query_id)""")
def a2_prompts(spark, sf_dir):
    question, context, reply = (F.col(c) for c in ("question", "context", "answer"))
    return answered(spark, sf_dir).select(
        "model", "query_id",
        faithfulness_prompt(question, context, reply).alias("faithfulness_prompt"),
        relevancy_prompt(question, reply).alias("relevancy_prompt"),
    )


_REPLY = """CASE WHEN value > 100 THEN 'inf' WHEN event_type = 'click' THEN ' ' || value / 50 || ' '
  WHEN event_type = 'view' THEN '-' || value WHEN event_type = 'signup' THEN 'Score: ' || value
  WHEN event_type = 'purchase' THEN CASE WHEN value > 50 THEN 'NaN' ELSE '' END ELSE props END"""


@query("a4_judge_score", f"""
WITH replies AS (SELECT event_id, trim({_REPLY}) AS reply FROM events)
SELECT event_id, round(CASE WHEN reply IN ('inf', 'NaN') THEN 1
    ELSE least(1, greatest(0, coalesce(try_cast(reply AS DOUBLE), 0))) END, 6)::DOUBLE AS score,
  try_cast(reply AS DOUBLE) IS NULL AS failed FROM replies""")
def a4(spark, sf_dir):
    """Judge replies of many shapes, built from event values and types."""
    replies = table(spark, sf_dir, "events").select("event_id", F.expr(_REPLY).alias("reply"))
    return replies.select(
        "event_id", rounded(judge_score(F.col("reply"))).alias("score"),
        judge_failed(F.col("reply")).alias("failed"),
    )


@query("a5_evaluate_models", with_ctes(*ANSWERED, _JUDGED) + """
SELECT model, count(*) AS samples, round(avg(f1), 6) AS f1, round(avg(faithfulness), 6) AS faithfulness,
  round(avg(relevancy), 6) AS relevancy, 0::BIGINT AS judge_failures FROM board GROUP BY model""")
def a5(spark, sf_dir):
    return round_measures(leaderboard(score_answers(answered(spark, sf_dir))))


@query("a6_leaderboard", with_ctes(*ANSWERED, _JUDGED) + """
SELECT model, metric, round(value, 6) AS value FROM (
  UNPIVOT (SELECT model, avg(f1) AS f1, avg(faithfulness) AS faithfulness,
    avg(relevancy) AS relevancy FROM board GROUP BY model)
  ON f1, faithfulness, relevancy INTO NAME metric VALUE value)""")
def a6(spark, sf_dir):
    board = long_form(leaderboard(score_answers(answered(spark, sf_dir))))
    return board.withColumn("value", rounded("value"))
