"""A training corpus from raw documents: the stages in order, each on what the last one kept.

Every stage takes tables with `doc_id`, `text` and `lang`; other columns, of any name, are
carried along, and all stages but the last return the columns they were given. A null
text is empty, a null language a language of its own, and a null id an id like any other.
An empty table stays empty. Long texts are handled whole, in their row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import own
from docquarry.llm.decontamination import decontaminate, question_and_answer
from docquarry.llm.packing import pack, token_pieces
from docquarry.llm.pii import redact
from docquarry.llm.quality_rules import quality_rules
from docquarry.llm.queries import tokenizer_path
from docquarry.llm.simhash import one_of_each
from docquarry.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and short texts among them.

    Equal rows are judged alike, so all of them stay or go.
    """
    # Columns that bear a result's name are set apart, so that they come back as they were.
    others = [c for c in docs.columns if c not in ("text", "lang")]
    judged = quality_rules(docs.select("text", "lang", F.struct(*others).alias(own("others"))))
    return judged.filter("kept").select("text", "lang", f"{own('others')}.*").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: one with the smallest id.

    Of rows with that id the one with the least hash of all columns stays, of equal rows one.
    """
    return one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; without items all stay, and so do empty texts."""
    return decontaminate(docs, question_and_answer(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; a column `n_chars` follows the new text, where
    there is one. A null text stays null."""
    clean = redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence they go to and their place in it; an empty or null text
    is its closing token alone. Equal rows are packed one by one."""
    return pack(token_pieces(docs.select("doc_id", "text"), tokenizer_path()))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("best_fit_packing", packing),
]

#: Tokenization, fingerprints and packing have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
