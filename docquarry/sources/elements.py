"""Readers that turn raw inputs into ordered, typed elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.arrays import unnest
from docquarry.functions.html import html_blocks
from docquarry.schemas import METADATA

# Fixed value: the document kinds that are accepted.
SUPPORTED_EXTENSIONS = ("pdf", "doc", "docx")
_SUPPORTED = r"(?i)\.(" + "|".join(SUPPORTED_EXTENSIONS) + r")$"


def is_supported(path: Column) -> Column:
    return path.rlike(_SUPPORTED)


def require_supported(path: Column) -> Column:
    """The lower-cased extension; an unsupported one fails the query."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    return F.when(is_supported(path), extension).otherwise(
        F.raise_error(F.concat(F.lit("Unsupported file type: "), extension))
    )


def list_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Supported files directly inside a folder. Contents are only read if selected."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .load(folder)
        .filter(is_supported(F.col("path")))
    )


def _element(source_file: Column, seq: Column, kind: Column, text: Column) -> list[Column]:
    return [
        source_file.alias("source_file"),
        seq.cast("long").alias("seq"),
        F.concat_ws("#", source_file, seq.cast("string")).alias("element_id"),
        kind.alias("type"),
        text.alias("text"),
    ]


def elements_from_text(df: DataFrame, source_file: Column, text: Column, filename: Column) -> DataFrame:
    """One element per line of plain text."""
    keep = [source_file.alias("_f"), filename.alias("_n")]
    lines = unnest(df, keep, F.split(text, "\n"), "_p", "_t")
    metadata = F.struct(
        F.col("_n").alias("filename"), F.lit(None).cast("string").alias("text_as_html")
    )
    return lines.select(
        *_element(F.col("_f"), F.col("_p"), F.lit("NarrativeText"), F.col("_t")),
        metadata.alias("metadata"),
    )


def elements_from_html(df: DataFrame, source_file: Column, html: Column) -> DataFrame:
    """One element per block of a web page; blank blocks keep their place but are left out."""
    blocks = unnest(df, [source_file.alias("_f")], html_blocks(html), "_p", "_b")
    metadata = F.struct(
        F.col("_f").alias("filename"), F.lit(None).cast("string").alias("text_as_html")
    )
    return blocks.filter(F.col("_b.text") != "").select(
        *_element(F.col("_f"), F.col("_p"), F.col("_b.type"), F.col("_b.text")),
        metadata.alias("metadata"),
    )


def read_json_files(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, content) of every JSON file of a folder. Spark lists no file of zero bytes."""
    return spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(
        F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("content"))


def split_json_array(content: Column) -> Column:
    """Raw items of a JSON array in order; null when the text is not one array."""
    items = F.from_json(content, "array<string>")
    return F.when(F.btrim(content, F.lit(" \t\r\n")).endswith("]"), items)


def _string_at(item: Column, path: str) -> Column:
    """A string field of a parsed item; values of another type give null."""
    value = F.try_variant_get(item, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(item, path, "string"))


def elements_from_json(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(elements, quarantine) from JSON arrays, one array per row.

    Array items that are not objects keep their place and become elements without
    text, so the stage counters see them. Files that hold no array go to quarantine.
    """
    parsed = files.select("source_file", "content", split_json_array(F.col("content")).alias("_items"))
    quarantine = parsed.filter(F.col("_items").isNull()).select("source_file", "content")
    items = unnest(parsed, ["source_file"], F.col("_items"), "_p", "_raw")
    v = F.try_parse_json("_raw")
    metadata = F.struct(
        _string_at(v, "$.metadata.filename").alias("filename"),
        _string_at(v, "$.metadata.text_as_html").alias("text_as_html"),
    ).cast(METADATA)
    elements = items.select(
        "source_file",
        F.col("_p").cast("long").alias("seq"),
        _string_at(v, "$.element_id").alias("element_id"),
        _string_at(v, "$.type").alias("type"),
        _string_at(v, "$.text").alias("text"),
        metadata.alias("metadata"),
    )
    return elements, quarantine


def samples_from_json(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, quarantine) from (data_set, content) rows, one JSON array of samples each.

    A sample's id is its data set and its place there, so ids of several sets differ; `item`
    is the place. Data sets that hold no array go to quarantine; items that are not
    objects keep their place and become samples without text.
    """
    item = "struct<question string, ground_truth_answer string, reference_text string, source_file string>"
    parsed = files.select("data_set", "content", split_json_array(F.col("content")).alias("_items"))
    quarantine = parsed.filter(F.col("_items").isNull()).select("data_set", "content")
    items = unnest(parsed, ["data_set"], F.col("_items"), "_p", "_raw").withColumn("_s", F.from_json("_raw", item))
    samples = items.select(
        F.concat_ws("#", "data_set", F.col("_p").cast("string")).alias("sample_id"),
        "data_set", F.col("_p").cast("int").alias("item"), "_s.*")
    return samples, quarantine


def read_samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(samples, quarantine) of all evaluation sets of a folder."""
    return samples_from_json(read_json_files(spark, folder).withColumnRenamed("source_file", "data_set"))
