"""Fixed-size token windows with overlap.

Windows of `chunk_size` tokens start every `chunk_size - overlap` tokens and run
across element borders, not across files. What is left after the last full window
(at least the overlap) is one more chunk, so a file of exactly `chunk_size` tokens
gives two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.text import words
from docquarry.operators.sequence import with_start
from docquarry.session import stage


@dataclass(frozen=True)
class Tokenizer:
    """Text to tokens and back, as columns."""

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]


def _join(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


WHITESPACE = Tokenizer(words, _join)
# Lower-cased runs of letters and digits, and single other signs.
WORDS_AND_SIGNS = Tokenizer(
    lambda text: F.regexp_extract_all(
        F.lower(text), F.lit(r"(?U)[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0)
    ),
    _join,
)


def user_tokenizer(
    encode: Callable[[str], list[int]], decode: Callable[[list[int]], str], word_batch: int = 50
) -> Tokenizer:
    """A tokenizer given as two Python functions, run on Arrow batches.

    Text is handed over in runs of `word_batch` words.
    """

    @F.pandas_udf("array<int>")
    def encode_batch(texts: pd.Series) -> pd.Series:
        def one(text):
            parts = text.split()
            runs = (parts[i:i + word_batch] for i in range(0, len(parts), word_batch))
            return [t for run in runs for t in encode(" ".join(run))]

        return texts.map(one)

    @F.pandas_udf("string")
    def decode_batch(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda ids: decode(list(ids)))

    return Tokenizer(encode_batch, decode_batch)


@dataclass(frozen=True)
class ChunkConfig:
    name: str
    chunk_size: int
    overlap: int
    tokenizer: Tokenizer = field(default=WHITESPACE)
    max_tokens: int | None = None

    def __post_init__(self):
        if self.chunk_size <= self.overlap:
            raise ValueError("chunk_size must be greater than overlap")
        if self.overlap < 1:
            raise ValueError("overlap must be at least 1")
        if self.max_tokens is not None and self.chunk_size > self.max_tokens:
            raise ValueError(f"chunk_size must be at most {self.max_tokens}")

    @property
    def step(self) -> int:
        return self.chunk_size - self.overlap


def chunk_count(tokens: Column, config: ChunkConfig) -> Column:
    """How many chunks a file of so many tokens gives."""
    full = F.floor((tokens - config.chunk_size) / config.step) + 2
    return F.when(tokens == 0, 0).when(tokens < config.chunk_size, 1).otherwise(full).cast("int")


def _windows(tokens: Column, config: ChunkConfig) -> Column:
    last = chunk_count(F.size(tokens), config) - 1
    chunks = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            F.lit(config.name).alias("config"),
            i.alias("chunk_id"),
            F.slice(tokens, i * config.step + 1, config.chunk_size).alias("tokens"),
        ),
    )
    return F.when(last >= 0, chunks)


def chunk_documents(
    documents: DataFrame, source_file: Column, text: Column, configs: list[ChunkConfig]
) -> DataFrame:
    """Chunks of whole document texts, for all configurations.

    Each document is cut inside its own row, without a shuffle. Configurations whose
    tokens are read back the same way share one scan.
    """
    scans: dict[Callable, list[ChunkConfig]] = {}
    for config in configs:
        scans.setdefault(config.tokenizer.decode, []).append(config)
    parts = []
    for decode, shared in scans.items():
        encoders = list(dict.fromkeys(c.tokenizer.encode for c in shared))
        column = {e: F.col(f"_tokens{i}") for i, e in enumerate(encoders)}
        tokens = documents.select(
            source_file.alias("source_file"),
            *[e(text).alias(f"_tokens{i}") for i, e in enumerate(encoders)],
        )
        windows = [_windows(column[c.tokenizer.encode], c) for c in shared]
        whole = windows[0] if len(windows) == 1 else F.flatten(F.array_compact(F.array(*windows)))
        cut = tokens.select("source_file", F.inline(whole))
        parts.append(cut.select("config", "source_file", "chunk_id", decode(F.col("tokens")).alias("text")))
    return reduce(DataFrame.unionByName, parts)


def chunk_elements(elements: DataFrame, config: ChunkConfig) -> DataFrame:
    """Chunks of ordered elements (`source_file, seq, text`), files of any size.

    Each element learns the place of its first token in the file, then sends every
    chunk it touches its own slice. Groups are single chunks, so none exceeds
    `chunk_size` tokens, however long its file is. Tokens are made once, in a written
    table; the running totals read only their numbers.
    """
    encoded = elements.select("source_file", "seq", config.tokenizer.encode(F.col("text")).alias("tokens"))
    tokens = stage(encoded, "tokens").withColumn("n", F.size("tokens"))
    placed = with_start(tokens.filter("n > 0"), "source_file", "seq", "n", total="total")
    last = chunk_count(F.col("total"), config) - 1
    size, step = config.chunk_size, config.step
    start, end = F.col("start"), F.col("start") + F.col("n")
    first_touched = F.greatest(F.lit(0), F.floor((start - size) / step) + 1)
    last_touched = F.least(last, F.floor((end - 1) / step))

    def piece(chunk_id: Column) -> Column:
        # Places of the shared part, counted from the first token of the element.
        begin = F.greatest(chunk_id * step - start, F.lit(0))
        stop = chunk_id * step + size - start
        return F.struct(
            chunk_id.cast("int").alias("chunk_id"),
            F.slice("tokens", (begin + 1).cast("int"), (stop - begin).cast("int")).alias("piece"),
        )

    # The slices are cut before the rows multiply, so no row carries all the tokens.
    pieces = placed.select(
        "source_file", "start",
        F.inline(F.transform(F.sequence(first_touched, last_touched), piece)),
    )
    ordered = F.array_sort(F.collect_list(F.struct("start", "piece")))
    chunk = F.flatten(F.transform(ordered, lambda p: p["piece"]))
    return pieces.groupBy("source_file", "chunk_id").agg(chunk.alias("tokens")).select(
        F.lit(config.name).alias("config"), "source_file", "chunk_id",
        config.tokenizer.decode(F.col("tokens")).alias("text"),
    )


# The configurations that are compared.
COMPARED = [
    ChunkConfig("words_256_26", 256, 26),
    ChunkConfig("signs_256_26", 256, 26, WORDS_AND_SIGNS, 512),
    ChunkConfig("signs_512_52", 512, 52, WORDS_AND_SIGNS, 512),
]
