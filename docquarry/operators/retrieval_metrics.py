"""Retrieval quality: one row per question, then one row per configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.fuzzy import with_token_set_match

# Fixed value: a hit's score must exceed this to count as a match.
MATCH_ABOVE = 70.0


def fuzzy_matches(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits with `match`: does the hit text fit the question's reference text?"""
    pairs = hits.join(questions.select("query_id", "reference_text"), "query_id")
    return with_token_set_match(
        pairs, F.col("reference_text"), F.col("text"), "match", MATCH_ABOVE
    ).drop("reference_text")


def coverage(questions: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Per question: do all its hits together, joined by spaces, match the reference?"""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    joined = (
        hits.groupBy(*keys)
        .agg(F.array_join(F.transform(ordered, lambda h: h["text"]), " ").alias("all_text"))
        .join(questions.select("query_id", "reference_text"), "query_id")
    )
    return with_token_set_match(
        joined, F.col("reference_text"), F.col("all_text"), "covered", MATCH_ABOVE
    ).select(*keys, "covered")


def per_question(questions: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """top1, hit and reciprocal rank of each question; questions without hits score 0."""
    scored = matches.groupBy(*keys).agg(
        F.bool_or((F.col("rank") == 1) & F.col("match")).alias("top1"),
        F.bool_or("match").alias("hit"),
        F.min(F.when(F.col("match"), F.col("rank"))).alias("first"),
    )
    return questions.join(scored, keys, "left").select(
        *questions.columns,
        F.coalesce("top1", F.lit(False)).cast("int").alias("top1"),
        F.coalesce("hit", F.lit(False)).cast("int").alias("hit"),
        F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def report(scored: DataFrame, by: list[str]) -> DataFrame:
    """Means over all samples. Without samples the total is 0 and the means are null."""
    measures = [
        F.count("*").alias("total_samples"),
        F.avg("top1").alias("top1_accuracy"),
        F.avg("hit").alias("hit_rate_at_k"),
        F.avg("reciprocal_rank").alias("mrr"),
    ]
    if "covered" in scored.columns:
        measures.append(F.avg(F.col("covered").cast("int")).alias("answer_coverage_at_k"))
    return scored.groupBy(*by).agg(*measures) if by else scored.agg(*measures)


def evaluate_retrieval(
    questions: DataFrame, hits: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """The full report. `questions` holds query_id, reference_text and the `by`
    columns, once per configuration; `hits` holds ranked texts with the same columns."""
    by = by or []
    keys = [*by, "query_id"]
    base = questions.select(*keys)
    texts = questions.select("query_id", "reference_text").distinct()
    scored = per_question(base, fuzzy_matches(texts, hits), keys)
    covered = coverage(texts, hits, keys)
    scored = scored.join(covered, keys, "left").withColumn(
        "covered", F.coalesce("covered", F.lit(False))
    )
    return report(scored, by)


def compare(reports: DataFrame, base: str, by: str = "config") -> DataFrame:
    """Differences of each configuration to a base one."""
    measures = [c for c in reports.columns if c not in (by, "total_samples")]
    first = reports.filter(F.col(by) == base).agg(
        *[F.first(m).alias(f"_{m}") for m in measures]
    ).withColumn("_base", F.lit(base))
    return (
        reports.withColumn("_base", F.lit(base))
        .join(F.broadcast(first), "_base")  # exactly one row
        .select(by, *[(F.col(m) - F.col(f"_{m}")).alias(f"{m}_delta") for m in measures])
    )
