"""Answer scores as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.text import terms, word_set


def token_f1(prediction: Column, truth: Column) -> Column:
    """F1 of the two sets of lower-cased words; 0 when they share none."""
    p, t = word_set(prediction), word_set(truth)
    common = F.size(F.array_intersect(p, t))
    precision, recall = common / F.size(p), common / F.size(t)
    return F.when(common > 0, 2 * (precision * recall) / (precision + recall)).otherwise(0.0)


def judge_number(output: Column) -> Column:
    """A judge's whole reply as a number, or null.

    Python's number syntax decides: underscores between digits are fine, a type
    suffix such as ``0.5d`` is not.
    """
    bare = F.lower(F.regexp_replace(output, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    digits = r"[0-9](_?[0-9])*"
    number = rf"^[+-]?({digits}(\.({digits})?)?|\.{digits})(e[+-]?{digits})?$"
    named = r"^[+-]?(inf|infinity)$"
    plain = F.when(bare.rlike(number) | bare.rlike(named), F.replace(bare, F.lit("_"), F.lit("")))
    return F.when(bare.rlike(r"^[+-]?nan$"), F.lit(float("nan"))).otherwise(plain.try_cast("double"))


def judge_score(output: Column) -> Column:
    """The reply clamped to [0, 1]; anything but a number is 0, not-a-number is 1."""
    value = F.coalesce(judge_number(output), F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.nanvl(value, F.lit(1.0))))


def judge_failed(output: Column) -> Column:
    return judge_number(output).isNull()


def share_found(needles: Column, haystack: Column) -> Column:
    """Share of the distinct terms of one text that also occur in another; 0 if it has none."""
    wanted = F.array_distinct(terms(needles))
    found = F.size(F.array_intersect(wanted, terms(haystack)))
    return F.when(F.size(wanted) > 0, found / F.size(wanted)).otherwise(0.0)
