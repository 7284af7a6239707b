"""Benchmark decontamination: passages query a BM25 index of test items, in block-max WAND.

Test items are cut into parts of at most `PART` words. Documents are read as passages of
2 x `PART` words, a new one every `PART` words, so a copied part lies wholly in one passage.
A passage is the query, parts are what is found; scores are BM25 as a share of the score
that the part gives itself. Parts stand in blocks; for each term and block the index has
the highest share in the block, and a passage scores only those blocks whose summed
maxima reach the threshold. Everything at or above it is found: no top-k.

What is found is checked on words: five-word shingles of the question and of the answer,
each on its own, must lie in the document to at least `overlap` (fewer words: the whole
sequence). An item without an answer is checked on its question alone.

The index is built in slices of at most `SLICE` parts, which bounds what is broadcast
(a slice has at most `SLICE` x `PART` terms); a larger benchmark means more slices, each
queried by all documents. No shuffle of texts; a document is handled within its row.

Edge cases: null or empty texts match nothing; items without a word are left out. Repeated
documents and items are matched one by one. Empty tables give empty results. Item ids may
be null; they are carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import refuse_clash
from docquarry.session import stage

PART = 64
BLOCK = 8
SLICE = 4096
#: Parts' lengths of text that are looked at together, which bounds the memory of a long text.
STRETCH = 64
K1, B = 1.2, 0.75
_SHINGLE = 5
_WORD = re.compile(r"\w+")


def _words(text: str | None) -> list[str]:
    """Letters and digits only, so that signs around a copied passage do not hide it."""
    return _WORD.findall((text or "").lower())


def _shingles(found: list[str]) -> set[tuple]:
    n = min(_SHINGLE, len(found))
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if n else set()


def _parts(found: list[str]) -> list[list[str]]:
    return [found[i:i + PART] for i in range(0, len(found), PART)]


class Index:
    """Block-max index of the parts of some items: [(item_id, question, answer)].

    `n`, `mean` and `df` are the number of parts, their mean length and the terms'
    document frequencies over all items; without them, over these ones.
    """

    def __init__(self, items: list[tuple], threshold: float, n: int = 0, mean: float = 0.0, df: dict[str, int] | None = None):
        self.threshold = threshold
        self.items = items
        self.shingles = [(_shingles(_words(q)), _shingles(_words(a))) for _, q, a in items]
        parts = [
            (number, part)
            for number, (_, q, a) in enumerate(items)
            for part in _parts(_words(q) + _words(a))
        ]
        # Parts of like length share a block, so that the block's maxima are close to each.
        parts.sort(key=lambda x: (len(x[1]), x[0]))
        self.item_of = np.array([number for number, _ in parts], dtype=np.int64)
        self.terms: dict[str, int] = {}
        if df is None:
            n, mean = len(parts), sum(len(p) for _, p in parts) / max(1, len(parts))
            df = Counter(t for _, p in parts for t in set(p))
        rows, columns, shares = [], [], []
        for row, (_, p) in enumerate(parts):
            impact = {
                t: np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1)
                / (tf + K1 * (1 - B + B * len(p) / mean))
                for t, tf in Counter(p).items()
            }
            whole = sum(impact.values())
            for t, x in impact.items():
                rows.append(row)
                columns.append(self.terms.setdefault(t, len(self.terms)))
                shares.append(x / whole)
        rows, columns, shares = np.array(rows, int), np.array(columns, int), np.array(shares)
        self.block_max = np.zeros((len(self.terms), -(-len(parts) // BLOCK)), dtype=np.float32)
        np.maximum.at(self.block_max, (columns, rows // BLOCK), shares.astype(np.float32))
        # Postings of each block: term, part within the block, share.
        order = np.argsort(rows // BLOCK, kind="stable")
        bounds = np.searchsorted((rows // BLOCK)[order], np.arange(self.block_max.shape[1] + 1))
        self.postings = [
            (columns[order[a:b]], rows[order[a:b]] % BLOCK, shares[order[a:b]])
            for a, b in zip(bounds[:-1], bounds[1:])
        ]

    def candidates(self, found: list[str]) -> dict[int, float]:
        """Item number -> best share over all passages and parts at or above the threshold."""
        get = self.terms.get
        ids = np.array([get(w, -1) for w in found], dtype=np.int64)
        at = np.flatnonzero(ids >= 0)
        best: dict[int, float] = {}
        if not len(at):
            return best
        # The maxima are 4-byte floats; the slack covers their rounding.
        floor = self.threshold - 1e-4
        in_passage = np.zeros(len(self.terms), dtype=bool)
        # Stretches of a long text overlap by a part, so that each passage lies in one.
        for begin in range(0, max(1, len(found) - PART), STRETCH * PART):
            some = at[np.searchsorted(at, begin):np.searchsorted(at, begin + (STRETCH + 1) * PART)]
            if not len(some):
                continue
            terms, places = np.unique(ids[some], return_inverse=True)
            present = np.zeros((STRETCH + 2, len(terms)), dtype=np.float32)
            present[(some - begin) // PART, places] = 1
            passages = np.maximum(present[:-1], present[1:])[:(some[-1] - begin) // PART + 1]
            # Each term of a passage counts once, with its maximum in each block.
            for k, block in np.argwhere(passages @ self.block_max[terms] >= floor):
                columns, rows, shares = self.postings[block]
                held = terms[passages[k] > 0]
                in_passage[held] = True
                hit = in_passage[columns]
                in_passage[held] = False
                scores = np.bincount(rows[hit], weights=shares[hit], minlength=BLOCK)
                for row in np.flatnonzero(scores >= self.threshold - 1e-9):
                    number = int(self.item_of[block * BLOCK + row])
                    best[number] = max(best.get(number, 0.0), float(scores[row]))
        return best

    def matches(self, text: str | None, overlap: float) -> Iterator[tuple[int, float, float, float | None]]:
        """(item number, score, question overlap, answer overlap) of verified items."""
        found = _words(text)
        near = self.candidates(found)
        if not near:
            return
        have = {n: {tuple(found[i:i + n]) for i in range(len(found) - n + 1)}
                for n in {len(next(iter(s))) for k in near for s in self.shingles[k] if s}}
        share = lambda s: len(s & have[len(next(iter(s)))]) / len(s)
        for number in sorted(near):
            question, answer = self.shingles[number]
            q, a = (share(s) if s else None for s in (question, answer))
            if all(x is None or x >= overlap for x in (q, a)):
                yield number, near[number], q, a


def statistics(items: DataFrame) -> DataFrame:
    """(term, parts, words): in how many parts of all items each term stands; the null term
    has the number of all parts and of their words."""
    def run(batches):
        for batch in batches:
            df, words = Counter(), 0
            for question, answer in zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist()):
                for part in _parts(_words(question) + _words(answer)):
                    df.update({None, *part})
                    words += len(part)
            if df:
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64()),
                    pa.array([words if t is None else 0 for t in df], pa.int64())], names=["term", "parts", "words"])

    counted = items.select("question", "answer").mapInArrow(run, "term string, parts long, words long")
    return stage(counted.groupBy("term").agg(F.sum("parts").alias("parts"), F.sum("words").alias("words")), "bm25-statistics")


def slices(items: DataFrame, threshold: float) -> Iterator[Index]:
    """Indexes over all items (item_id, question, answer), in slices of bounded size.

    Statistics are those of all items, so no score depends on where a slice ends.
    """
    counts = statistics(items)
    total = counts.filter("term IS NULL").first()
    held, parts = [], 0

    def index() -> Index:
        # At most as many terms as the slice has words.
        terms = sorted({w for _, q, a in held for w in _words(q) + _words(a)})
        wanted = items.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        df = {r["term"]: r["parts"] for r in counts.join(wanted, "term").collect()}
        return Index(held, threshold, total["parts"], total["words"] / total["parts"], df)

    for row in items.select("item_id", "question", "answer").toLocalIterator():
        n = len(_parts(_words(row[1]) + _words(row[2])))
        if n == 0:
            continue
        if held and parts + n > SLICE:
            yield index()
            held, parts = [], 0
        held.append(tuple(row))
        parts += n
    if held:
        yield index()


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8
) -> DataFrame:
    """(the documents' columns but `text`, item_id, score, question_overlap, answer_overlap)."""
    names = ["item_id", "score", "question_overlap", "answer_overlap"]
    kept = [c for c in refuse_clash(docs, *names).columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("item_id", items.schema["item_id"].dataType)]
                          + [T.StructField(c, T.DoubleType()) for c in names[1:]])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in slices(items, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows, hits = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for number, score, q, a in index.matches(text, overlap):
                        rows.append(i)
                        hits.append((index.items[number][0], score, q, a))
                if rows:
                    carried = batch.select(kept).take(pa.array(rows))
                    columns = [pa.array(x) for x in zip(*hits)]
                    table = pa.Table.from_arrays(carried.columns + columns, names=[*kept, *names])
                    fields = [*carried.schema, pa.field("item_id", columns[0].type)]
                    fields += [pa.field(c, pa.float64()) for c in names[1:]]
                    yield from table.cast(pa.schema(fields)).to_batches()

        out = out.unionByName(docs.select(*kept, "text").mapInArrow(run, schema))
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8
) -> DataFrame:
    """The documents, all columns, without those that hold a test item."""
    for index in slices(items, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                texts = batch.column("text").to_pylist()
                clean = [next(shared.value.matches(t, overlap), None) is None for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def question_and_answer(benchmark: DataFrame) -> DataFrame:
    """(item_id, question, answer) of a table of texts: the last sentence is the answer.

    A text of one sentence is a question without an answer.
    """
    text = F.trim(F.coalesce("text", F.lit("")))
    question = F.trim(F.regexp_extract(text, r"(?s)^(.*[.!?])\s+[^.!?]+[.!?]?$", 1))
    split = benchmark.select("item_id", text.alias("t"), question.alias("q"))
    alone = F.col("q") == ""
    answer = F.trim(F.expr("substring(t, length(q) + 1)"))
    return split.select(
        "item_id", F.when(alone, F.col("t")).otherwise(F.col("q")).alias("question"),
        F.when(~alone, answer).alias("answer"),
    )
