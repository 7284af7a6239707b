"""Cleaning and normalising elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docquarry.functions.html import table_to_markdown
from docquarry.functions.text import collapse_whitespace, course_of, has_text

_HTML = "metadata.text_as_html"


def clean_elements(elements: DataFrame) -> DataFrame:
    """Drop elements without text and collapse the white space of the others."""
    return elements.filter(has_text(F.col("text"))).withColumn(
        "text", collapse_whitespace(F.col("text"))
    )


def _is_table():
    return F.coalesce((F.col("type") == "Table") & (F.col(_HTML) != ""), F.lit(False))


def convert_tables(elements: DataFrame) -> DataFrame:
    """Add `markdown_text` to table elements with HTML and change their type."""
    table = _is_table()
    return elements.withColumns({
        "markdown_text": F.when(table, table_to_markdown(F.col(_HTML))),
        "type": F.when(table, F.lit("markdown_text")).otherwise(F.col("type")),
    })


def _present(column: str):
    return F.coalesce(F.col(column) != "", F.lit(False))


def normalize_elements(elements: DataFrame) -> DataFrame:
    """The strict record: type, text, coursename, coursecode (and where it came from).

    Markdown is preferred to text if there is any; empty counts as missing. Elements
    with neither are dropped.
    """
    name, code = course_of(F.coalesce(F.col("metadata.filename"), F.lit("")))
    # Text is asked first: where it is present, the filter needs no Markdown.
    usable = elements.filter(_present("text") | _present("markdown_text"))
    text = F.when(_present("markdown_text"), F.col("markdown_text")).otherwise(F.col("text"))
    return usable.select(
        "source_file", "seq", "type", text.alias("text"),
        name.alias("coursename"), code.alias("coursecode"),
    )


def prepare_elements(elements: DataFrame) -> DataFrame:
    """Clean, then convert tables, then normalise."""
    return normalize_elements(convert_tables(clean_elements(elements)))


def _counters() -> list:
    kept = F.coalesce(has_text(F.col("text")), F.lit(False))
    return [
        F.count("*").alias("processed"),
        F.count_if(~kept).alias("removed"),
        F.count_if(kept).alias("remaining"),
        F.count_if(kept & _is_table()).alias("converted"),
        F.count_if(kept).alias("normalized"),
        F.lit(0).cast("long").alias("skipped"),
    ]


def stage_counters(elements: DataFrame) -> DataFrame:
    """Per source file, what each stage keeps; one aggregation over the raw elements."""
    return elements.groupBy("source_file").agg(*_counters())


def observed(elements: DataFrame) -> tuple[DataFrame, Observation]:
    """The raw elements, and their counters, which are taken while the elements pass by in
    the one job that uses them; `observation.get` has the totals afterwards."""
    seen = Observation("stages")
    return elements.observe(seen, *(c for c in _counters()[:-1])), seen


def split_failures(df: DataFrame, value: str, error: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of a frame whose rows carry an error message or a value.

    A failing row goes to quarantine with its message; the others go on.
    """
    return (
        df.filter(F.col(error).isNull()).drop(error),
        df.filter(F.col(error).isNotNull()).drop(value),
    )
