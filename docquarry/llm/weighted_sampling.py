"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its words, each with its number of occurrences. For
every term and slot, two Gamma(2, 1) numbers and a uniform one follow from a hash of the
term and the slot. With them a weight is rounded to a power of a random step, and the term
gets an arrival value; the term that arrives first gives the slot its sample, term and
rounded weight. Two documents have the same sample in a slot with a probability that equals
the generalised Jaccard similarity of their weights: the sum of the lesser weights over
the sum of the greater ones. A fingerprint keeps 16 bits of each sample.

Fingerprints need no shuffle: each is made in its row, terms in blocks, so a very long text
needs a list of its distinct words but never a table of all its samples. Neighbours (a
document and the next by id) come from one range partition of the texts, read in order;
each task holds two documents. What stands at the edges of partitions, one document each,
is put together by a join of partition numbers.

Edge cases: a null text is empty. Case of A-Z does not count. A text without words has only
zero slots, which no text with words has. Equal texts have equal fingerprints. A null id
comes first; rows of equal id are ordered by text, so equal rows are interchangeable. Of a
single row, the next one is itself. Columns named like a result are replaced, others are
carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docquarry.llm.common import own, refuse_clash
from docquarry.session import stage

SLOTS, SEED = 64, 42
#: Documents of a task's step; (term, weight) pairs whose samples are made, and held, at once;
#: words whose hashes a worker remembers.
_STEP, _BLOCK, _HELD, _WORDS = 64, 1024, 1 << 16, 200_000
RESULTS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_GOLDEN, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gamma_quantiles(bits: int = 16) -> np.ndarray:
    """Gamma(2, 1) at the middles of 2^bits equal parts of probability.

    The distribution function is 1 - (1 + x) exp(-x); Newton's steps from above settle.
    """
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    low, high = np.zeros_like(p), np.full_like(p, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return ((low + high) / 2).astype(np.float32)


_tables: list[np.ndarray] = []  # made once per worker


def arrivals(terms: np.ndarray, weights: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(log of the arrival value, rounded weight) of each term in each slot.

    With r and c from Gamma(2, 1) and b uniform, the rounded weight is
    t = floor(log(weight) / r + b), and the arrival value c * exp(-r * (t - b + 1)).
    """
    if not _tables:
        gamma = gamma_quantiles()
        _tables.extend((gamma, np.log(gamma)))
    gamma, log_gamma = _tables
    x = terms[:, None] + np.arange(1, slots + 1, dtype=np.uint64)[None] * _GOLDEN
    for shift, factor in ((30, _M1), (27, _M2)):
        x ^= x >> np.uint64(shift)
        x *= factor
    # The upper three quarters of a hash are three numbers of 16 bits.
    parts = x.astype("<u8", copy=False).view("<u2").reshape(*x.shape, 4)
    r, log_c = gamma.take(parts[..., 3]), log_gamma.take(parts[..., 2])
    b = parts[..., 1].astype(np.float32)
    b += np.float32(0.5)
    b *= np.float32(2.0**-16)
    rounded = np.zeros(x.shape, dtype=np.float32)
    many = np.flatnonzero(weights != 1)  # the logarithm of one is zero
    rounded[many] = np.floor(np.log(weights[many]).astype(np.float32)[:, None] / r[many] + b[many])
    return log_c - r * (rounded - b + 1), rounded


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """16-bit signatures (one row a document) of (terms, weights)."""
    sizes = np.array([len(t) for t, _ in documents], dtype=np.int64)
    out = np.zeros((len(documents), slots), dtype=">u2")  # zero is kept for texts without words
    best = np.full(out.shape, np.inf, dtype=np.float32)
    terms = np.concatenate([np.empty(0, np.uint64), *(t for t, _ in documents)])
    weights = np.concatenate([np.empty(0, np.int64), *(w for _, w in documents)])
    # Terms that several documents hold with the same weight are sampled once.
    keys = _mixed(terms) + weights.view(np.uint64) * _GOLDEN
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    at, group = order[new], np.empty(len(keys), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    # Of equal arrivals the lower key counts, wherever it stands.
    held = [np.sort(g) for g in np.split(group, np.cumsum(sizes)[:-1])]
    for begin in range(0, len(at), _HELD):
        some = at[begin:begin + _HELD]
        parts = [arrivals(terms[some[i:i + _BLOCK]], weights[some[i:i + _BLOCK]], slots) for i in range(0, len(some), _BLOCK)]
        arrival, rounded = (np.concatenate(x) for x in zip(*parts))
        for document, pairs in enumerate(held):
            a, b = np.searchsorted(pairs, [begin, begin + len(some)])
            if a == b:
                continue
            mine = pairs[a:b] - begin
            rows = arrival.take(mine, axis=0)
            lowest = rows.argmin(axis=0)
            value = rows[lowest, np.arange(slots)]
            slot = np.flatnonzero(value < best[document])
            best[document, slot] = value[slot]
            pair = mine[lowest[slot]]
            sample = _mixed(terms[some[pair]] + rounded[pair, slot].astype(np.int64).view(np.uint64) * _M1)
            out[document, slot] = sample % np.uint64(65535) + np.uint64(1)
    return out


class _Hashes(dict):
    """Word -> hash, worked out once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


_hashes = _Hashes()


def weighted_terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, their numbers of occurrences)."""
    if len(_hashes) > _WORDS:
        _hashes.clear()
    counts = Counter((text or "").encode("utf-8", "surrogatepass").lower().split())
    # A text's own words are never more than the text itself.
    return (np.fromiter(map(_hashes.__getitem__, counts), np.uint64, len(counts)),
            np.fromiter(counts.values(), np.int64, len(counts)))


def _hex(signature: np.ndarray) -> str:
    return signature.tobytes().hex()


def fingerprints(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The documents (without their text) with `fingerprint`, four hex digits a slot."""
    base = refuse_clash(docs, "fingerprint")
    kept = [c for c in base.columns if c != "text"]
    schema = T.StructType([base.schema[c] for c in kept] + [T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, _STEP):
                some = batch.slice(begin, _STEP)
                found = signatures([weighted_terms(t) for t in some.column("text").to_pylist()], slots)
                yield pa.RecordBatch.from_arrays(
                    [*some.select(kept).columns, pa.array(list(map(_hex, found)), pa.string())], names=[*kept, "fingerprint"])

    return base.select(*kept, "text").mapInArrow(run, schema)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots of two fingerprints: the estimated generalised Jaccard similarity."""
    slots = (F.length(a) / 4).cast("int")
    same = F.filter(F.sequence(F.lit(0), slots - 1), lambda i: F.substr(a, i * 4 + 1, F.lit(4)) == F.substr(b, i * 4 + 1, F.lit(4)))
    return F.when(slots > 0, F.size(same) / slots)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(texts: list[str], following: list[str], slots: int) -> list[pa.Array]:
    """The results of documents and the ones that follow them; those are mostly the same texts."""
    places: dict[str, int] = {}
    changed = [edited(t, f) for t, f in zip(texts, following)]
    index = [[places.setdefault(t, len(places)) for t in some] for some in (texts, changed, following)]
    made = signatures([weighted_terms(t) for t in places], slots)
    mine, theirs, after = (made[i] for i in index)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array(list(map(_hex, mine)), pa.string()), pa.array(list(map(_hex, theirs)), pa.string()),
        pa.array((mine == theirs).mean(axis=1)), pa.array((mine == after).mean(axis=1)),
    ]


_FOUND = T.StructType([
    T.StructField(n, t) for n, t in zip(RESULTS, [T.LongType(), *[T.StringType()] * 3, *[T.DoubleType()] * 2])])


def neighbour_fingerprints(docs: DataFrame, order: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """The documents (without their text) with the number of characters, fingerprints of the
    text and of the edited text, and how alike the fingerprint is to that of the edited
    text and to that of the next document; after the last comes the first."""
    row, kind, part, full = own("row"), own("kind"), own("part"), own("text")
    at, after, following = own("at"), own("after"), own("following")
    base = refuse_clash(docs, *RESULTS)
    kept = [c for c in base.columns if c != "text"]
    carried = T.StructType([base.schema[c] for c in kept])
    schema = T.StructType([*carried.fields, *_FOUND.fields, T.StructField(kind, T.StringType()),
                           T.StructField(part, T.IntegerType()), T.StructField(full, T.StringType())])
    arrow = to_arrow_schema(schema)

    def finished(rows: pa.RecordBatch, found: list[pa.Array]) -> pa.RecordBatch:
        nulls = [pa.nulls(rows.num_rows, arrow.field(c).type) for c in (kind, part, full)]
        return pa.RecordBatch.from_arrays([*rows.select(kept).columns, *found, *nulls], schema=arrow)

    def edge(one: pa.RecordBatch, name: str) -> pa.RecordBatch:
        values = {**{c: one.column(c) for c in kept}, kind: pa.array([name]),
                  part: pa.array([TaskContext.get().partitionId()], pa.int32()), full: one.column("text")}
        return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(1, f.type)) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but the last get their results; the first and the last are sent on as edges."""
        last = None
        for batch in batches:
            for begin in range(0, batch.num_rows, _STEP):
                some = batch.slice(begin, _STEP)
                if last is None:
                    yield edge(some.slice(0, 1), "first")
                else:
                    some = pa.Table.from_batches([last, some]).combine_chunks().to_batches()[0]
                texts = [t or "" for t in some.column("text").to_pylist()]
                if len(texts) > 1:
                    yield finished(some.slice(0, len(texts) - 1), _compared(texts[:-1], texts[1:], slots))
                last = some.slice(len(texts) - 1)
        if last is not None:
            yield edge(last, "last")

    keys = [F.asc_nulls_first(order), "text", row]
    spread = base.select(*kept, "text", F.monotonically_increasing_id().alias(row)).repartitionByRange(
        F.asc_nulls_first(order), F.xxhash64("text"), row)
    rows = stage(spread.sortWithinPartitions(*keys).select(*kept, "text").mapInArrow(run, schema), "fingerprints")

    # One first and one last document per partition; the next partition is the next number there is.
    firsts = rows.filter(F.col(kind) == "first").select(F.col(part).alias(at), F.col(full).alias(following))
    numbers = firsts.select(at, F.coalesce(
        F.lead(at).over(Window.orderBy(at)), F.min(at).over(Window.partitionBy())).alias(after))
    ends = rows.filter(F.col(kind) == "last").join(numbers, F.col(part) == F.col(at)).drop(at)
    pairs = ends.join(firsts, F.col(after) == F.col(at)).select(*kept, F.col(full).alias("text"), following)
    whole = T.StructType([*carried.fields, *_FOUND.fields])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                texts, nexts = ([t or "" for t in one.column(c).to_pylist()] for c in ("text", following))
                yield pa.RecordBatch.from_arrays(
                    [*one.select(kept).columns, *_compared(texts, nexts, slots)], schema=to_arrow_schema(whole))

    return rows.filter(F.col(kind).isNull()).select(*whole.names).unionByName(pairs.mapInArrow(close, whole))
