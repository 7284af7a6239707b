"""Declared schemas of the records that pass between stages."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("text_as_html", T.StringType()),
])

# One parsed element. `seq` is its place in the source file.
ELEMENT = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("element_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", METADATA),
])

NORMALIZED = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("coursename", T.StringType()),
    T.StructField("coursecode", T.StringType()),
])

CHUNK = T.StructType([
    T.StructField("config", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("chunk_id", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

# What a question generator is asked to return.
QA_ITEMS = "array<struct<question string, answer string, support string>>"

SAMPLE = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("ground_truth_answer", T.StringType()),
    T.StructField("reference_text", T.StringType()),
    T.StructField("source_file", T.StringType()),
])
