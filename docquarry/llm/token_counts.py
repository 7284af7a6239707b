"""Token counts by section: whole documents are encoded once, tokens go to character spans.

A token has the character span that the tokenizer maps it to. Spans are joined with the
sections' intervals (both in order, by binary search). A token that crosses a boundary
counts for the section that holds most of its characters, of equal ones for the first; a
token that no section holds counts for none. So a document's counts add up to its tokens.

Work stays in the document's row: no shuffle, and a long document costs what its tokens
cost. Edge cases: a null text has no tokens; null sections are none; empty sections get
none; sections must not overlap, and are taken in order of their start. Repeated rows are
counted one by one. Columns named like a result are replaced, others are carried along. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import let, own, refuse_clash, running_totals
from docquarry.llm.packing import Encoder

SECTION = T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType())])
RESULTS = ("section", "name", "start", "end", "n_tokens", "n_crossing")


class SpanEncoder(Encoder):
    """Character spans of the tokens of whole texts."""

    def __init__(self, path: str):
        super().__init__(path)
        if self.ranks:
            self.sizes = np.zeros(max(self.ranks.values()) + 1, dtype=np.int64)
            self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]

    def spans(self, text: str) -> np.ndarray:
        """(start, end) of each token, in characters; a token with a part of a character
        spans it whole."""
        if not self.by_ranks(text):
            found = self.tokenizer.encode_batch([text], add_special_tokens=False)[0].offsets
            return np.array(found, dtype=np.int64).reshape(-1, 2)
        sizes = self.sizes[np.frombuffer(self.encode(text), dtype="<u4")]
        ends = np.cumsum(sizes)
        bounds = np.stack((ends - sizes, ends - 1), axis=1)
        if not text.isascii():
            # The character that holds each byte: only its first is no continuation.
            held = np.cumsum(np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0 != 0x80) - 1
            bounds = held[bounds]
        bounds[:, 1] += 1
        return bounds


def allot(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section; the last entry is for no section."""
    n = len(starts)
    owner = np.full(len(spans), n)
    # The first section that ends after the token's start, the last that begins before its end.
    low = np.searchsorted(ends, spans[:, 0], side="right")
    high = np.searchsorted(starts, spans[:, 1], side="left") - 1
    one = low == high
    owner[one] = low[one]
    crossing = np.zeros(len(spans), dtype=bool)
    for i in np.flatnonzero(low < high):
        k = np.arange(low[i], high[i] + 1)
        held = np.minimum(ends[k], spans[i, 1]) - np.maximum(starts[k], spans[i, 0])
        owner[i] = k[np.argmax(held)] if held.max() > 0 else n
        crossing[i] = True
    inside = one.copy()
    inside[one] = (starts[low[one]] <= spans[one, 0]) & (ends[low[one]] >= spans[one, 1])
    crossing |= one & ~inside
    return np.bincount(owner, minlength=n + 1), np.bincount(owner[crossing], minlength=n + 1)


def section_counts(docs: DataFrame, sections: Column, path: str) -> DataFrame:
    """One row per section of each document, and one (section -1) for tokens in none.

    `sections` is an array of (name, start, end) in code points, ends exclusive.
    """
    kept = [c for c in refuse_clash(docs, *RESULTS).columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("section", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType())])
    given_sections = own("sections")
    types = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())

    def run(batches):
        encoder = SpanEncoder.of(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                rows, out = [], [[] for _ in types]
                texts = [t or "" for t in some.column("text").to_pylist()]
                for i, (text, parts) in enumerate(zip(texts, some.column(given_sections).to_pylist())):
                    parts = sorted((p for p in parts or () if p), key=lambda p: (p["start"], p["end"]))
                    spans = encoder.spans(text) if text else np.empty((0, 2), dtype=np.int64)
                    starts = np.array([p["start"] for p in parts], dtype=np.int64)
                    ends = np.array([p["end"] for p in parts], dtype=np.int64)
                    owned, crossed = allot(spans, starts, ends)
                    n = len(parts)
                    rows += [i] * (n + 1)
                    out[0] += [*range(n), -1]
                    out[1] += [p["name"] for p in parts] + [None]
                    out[2] += [p["start"] for p in parts] + [None]
                    out[3] += [p["end"] for p in parts] + [None]
                    out[4] += owned.tolist()
                    out[5] += crossed.tolist()
                columns = some.select(kept).take(pa.array(rows, pa.int64())).columns + [pa.array(x, t) for x, t in zip(out, types)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *RESULTS])

    given = docs.select(*kept, "text", sections.cast(T.ArrayType(SECTION)).alias(given_sections))
    return given.mapInArrow(run, schema)


def line_sections(text: Column) -> Column:
    """Each line is a section: the first is the title, the others are body; line feeds
    belong to none."""
    def spans(lines: Column) -> Column:
        ends = running_totals(F.transform(lines, lambda x: F.length(x) + 1))
        return F.zip_with(lines, ends, lambda x, end: F.struct(
            F.when(end == F.length(x) + 1, "title").otherwise("body").alias("name"),
            (end - F.length(x) - 1).alias("start"), (end - 1).alias("end")))

    return F.when(F.coalesce(text, F.lit("")) != "", let(F.split(text, "\n"), spans))
