"""Answer quality: token F1, faithfulness and relevancy per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.scores import judge_failed, judge_score, share_found, token_f1
from docquarry.operators.generation import UserGenerator
from docquarry.operators.prompting import faithfulness_prompt, relevancy_prompt


def judged(answers: DataFrame, judge: UserGenerator | None = None) -> DataFrame:
    """Add `faithfulness`, `relevancy` and `judge_failures` to
    (question, context, answer) rows.

    A judge is a generator at temperature 0; its reply is read as one number. The
    native judge takes the share of answer terms found in the context, and the share
    of question terms found in the answer.
    """
    question, context, answer = (F.col(c) for c in ("question", "context", "answer"))
    if judge is None:
        faith = share_found(answer, context).cast("string")
        relevant = share_found(question, answer).cast("string")
        replies = answers.withColumns({"_faith": faith, "_relevant": relevant})
    else:
        columns = answers.columns
        replies = judge.run(
            answers.withColumn("_prompt", faithfulness_prompt(question, context, answer)), "_prompt", "_f"
        ).select(*columns, F.col("_f.answer").alias("_faith"))
        replies = judge.run(
            replies.withColumn("_prompt", relevancy_prompt(question, answer)), "_prompt", "_r"
        ).select(*columns, "_faith", F.col("_r.answer").alias("_relevant"))
    failures = judge_failed(F.col("_faith")).cast("int") + judge_failed(F.col("_relevant")).cast("int")
    return replies.withColumns({
        "faithfulness": judge_score(F.col("_faith")),
        "relevancy": judge_score(F.col("_relevant")),
        "judge_failures": failures,
    }).drop("_faith", "_relevant")


def score_answers(answers: DataFrame, judge: UserGenerator | None = None) -> DataFrame:
    """Judged answers plus `f1` against `ground_truth_answer`."""
    f1 = token_f1(F.coalesce("answer", F.lit("")), F.col("ground_truth_answer"))
    return judged(answers, judge).withColumn("f1", f1)


def leaderboard(scored: DataFrame) -> DataFrame:
    return scored.groupBy("model").agg(
        F.count("*").alias("samples"),
        F.avg("f1").alias("f1"),
        F.avg("faithfulness").alias("faithfulness"),
        F.avg("relevancy").alias("relevancy"),
        F.sum("judge_failures").alias("judge_failures"),
    )


def long_form(board: DataFrame) -> DataFrame:
    """(model, metric, value) rows."""
    return board.unpivot("model", ["f1", "faithfulness", "relevancy"], "metric", "value")
