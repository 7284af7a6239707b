"""The whole jobs a user runs: prepare, index, search, ask, evaluate.

Encoders, tokenizers, generators and judges are plug-ins; each has a native default.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.answer_metrics import leaderboard, score_answers
from docquarry.operators.chunking import ChunkConfig, chunk_elements
from docquarry.operators.elements import observed, prepare_elements, stage_counters
from docquarry.operators.encoding import HashedIdf, UserEncoder, to_points
from docquarry.operators.evalset import (
    PROMPT_CHARACTERS, document_heads, first_samples, native_qa_output, parse_qa, qa_prompts, sample_files,
)
from docquarry.operators.generation import NATIVE_MODELS, UserGenerator, answer, with_models
from docquarry.operators.prompting import context_of
from docquarry.operators.retrieval import drop_empty_hits, hits_as_array, top_k
from docquarry.operators import retrieval_metrics
from docquarry.session import stage
from docquarry.sources.collections import Collection
from docquarry.sources.elements import elements_from_json, read_json_files
from docquarry.sources.stages import in_waves

Encoder = HashedIdf | UserEncoder


class Retriever(Protocol):
    """Ranked hits (query_id, rank, id, score, text) for (query_id, question, source_file)
    rows; a null source file means no filter."""

    def __call__(self, questions: DataFrame, k: int) -> DataFrame: ...


def prepare_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(normalised elements, stage counters, unreadable files) of a folder of element JSON."""
    elements, unreadable = elements_from_json(read_json_files(spark, folder))
    return prepare_elements(elements), stage_counters(elements), unreadable


def write_prepared(elements: DataFrame, path: str) -> dict[str, int]:
    """Write the normalised elements; returns the stage counters, taken in the same pass."""
    passing, counters = observed(elements)
    prepare_elements(passing).write.parquet(path)
    return {**counters.get, "skipped": 0}


def chunk(elements: DataFrame, configs: list[ChunkConfig]) -> DataFrame:
    """Chunks of normalised elements under every configuration."""
    parts = [chunk_elements(elements, c) for c in configs]
    chunks = parts[0]
    for part in parts[1:]:
        chunks = chunks.unionByName(part)
    return chunks


def index(
    chunks: DataFrame, collection: Collection, encoder: Encoder | None = None,
    ids: str = "uuid", metric: str = "cosine", replace_sources: bool = False,
) -> Encoder:
    """Encode chunks and upsert them as points; returns the encoder to ask with.

    The native encoder is fitted on the chunks first.
    """
    if encoder is None:
        encoder = HashedIdf().fit(chunks)
    points = to_points(encoder.encode(chunks), ids)
    dim = encoder.dim
    if dim is None:
        # The encoder tells its dimension by what it returns; encode once.
        points = stage(points, "points")
        first = points.select(F.size("embedding")).first()
        if first is None:
            raise ValueError("no chunks to index")
        dim = first[0]
    collection.create(dim, metric).upsert(points, replace_sources=replace_sources)
    return encoder


@dataclass
class CollectionRetriever:
    """Exact search in a collection. Hits without text are dropped after the ranking
    where the store works that way."""

    collection: Collection
    encoder: Encoder
    metric: str | None = None
    drop_empty: bool = True

    def __call__(self, questions: DataFrame, k: int = 5) -> DataFrame:
        metric = self.metric or self.collection.properties()["metric"]
        asked = self.encoder.encode(questions.select("query_id", "question", "source_file"), "question")
        hits = top_k(
            asked, self.collection.read(), k, metric, filters=["source_file"],
            carry=["source_file", "text"],
        )
        return drop_empty_hits(hits) if self.drop_empty else hits


def ask(
    questions: DataFrame, retriever: Retriever, models: list[str], k: int = 5,
    generators: dict[str, UserGenerator] | None = None,
) -> DataFrame:
    """(query_id, question, context, model, answer, error): one retrieval, one answer per model.

    A question without hits is asked with an empty context.
    """
    unknown = set(models) - set(NATIVE_MODELS) - set(generators or {})
    if unknown:
        raise ValueError(f"no such models: {sorted(unknown)}")
    found = hits_as_array(retriever(questions, k))
    rows = questions.join(found, "query_id", "left").withColumn(
        "context", context_of(F.coalesce("texts", F.array().cast("array<string>")))
    ).drop("texts")
    return answer(with_models(stage(rows, "asked"), models), generators)


def make_evaluation_set(
    elements: DataFrame, num_files: int = 5, samples_per_file: int = 5,
    generator: UserGenerator | None = None, seed: str = "0", progress: str | None = None,
    max_chars: int = PROMPT_CHARACTERS, wave: int = 64,
) -> DataFrame:
    """Samples (sample_id, question, ground_truth_answer, reference_text, source_file) of
    sampled files, as the evaluators take them. Replies are asked for once and written.

    With `progress`, files go in waves of about `wave`, and each wave's replies are
    appended to that table before the next one is asked for: a run that dies loses one wave
    at most, and a rerun asks only for what is missing. A file whose call failed is not
    finished; one whose reply held no usable pair is, and has no samples.
    """
    files = elements.select("source_file").distinct()
    if files.isEmpty():
        raise ValueError("no normalised files found")
    files = sample_files(files, num_files, seed)

    def replied(files: DataFrame) -> DataFrame:
        """(source_file, output) of the calls that did not fail."""
        heads = document_heads(elements.join(files, "source_file", "left_semi"), max_chars)
        prompts = qa_prompts(heads, samples_per_file)
        if generator is None:
            return prompts.select("source_file", native_qa_output(F.col("head"), samples_per_file).alias("output"))
        calls = generator.run(prompts, "prompt", "reply").filter(F.col("reply.error").isNull())
        return calls.select("source_file", F.col("reply.answer").alias("output"))

    if progress:
        replies = in_waves(stage(files, "files"), replied, progress, "source_file string, output string", wave)
    else:
        replies = stage(replied(files), "replies")
    samples, _ = parse_qa(replies)
    sample_id = F.concat_ws("#", "source_file", F.col("item").cast("string")).alias("sample_id")
    return samples.select(sample_id, "*")


def _questions(samples: DataFrame, max_samples: int | None) -> DataFrame:
    """Samples (sample_id, question, reference_text, source_file, ...) as questions."""
    return first_samples(samples, max_samples).withColumnRenamed("sample_id", "query_id")


def evaluate_retrieval(
    samples: DataFrame, retriever: Retriever, k: int = 5, max_samples: int | None = None
) -> DataFrame:
    """One row: total_samples, top1_accuracy, hit_rate_at_k, mrr, answer_coverage_at_k."""
    questions = _questions(samples, max_samples)
    hits = stage(retriever(questions, k).select("query_id", "rank", "text"), "hits")
    return retrieval_metrics.evaluate_retrieval(questions, hits)


def evaluate_retrievers(
    samples: DataFrame, retrievers: dict[str, Retriever], k: int = 5, max_samples: int | None = None
) -> DataFrame:
    """The same report for several models, chunk sizes or stores, one row per name."""
    questions = _questions(samples, max_samples)
    parts = [
        r(questions, k).select(F.lit(name).alias("config"), "query_id", "rank", "text")
        for name, r in retrievers.items()
    ]
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    named = questions.withColumn("config", F.explode(F.array(*map(F.lit, retrievers))))
    return retrieval_metrics.evaluate_retrieval(
        named.select("config", "query_id", "reference_text"), stage(hits, "hits"), ["config"]
    )


def evaluate_models(
    samples: DataFrame, retriever: Retriever, models: list[str], k: int = 5,
    max_samples: int | None = None, generators: dict[str, UserGenerator] | None = None,
    judge: UserGenerator | None = None,
) -> DataFrame:
    """One row per model: f1, faithfulness, relevancy, and how often the judge failed."""
    answers = ask(_questions(samples, max_samples), retriever, models, k, generators)
    return leaderboard(score_answers(answers, judge))
