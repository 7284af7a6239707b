"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most `limit`; pieces go into sequences of `limit`
tokens. Pieces of equal length are interchangeable, so the plan is made from the number
of pieces of each length, at most `limit` numbers whatever the corpus. A bin starts with
the longest length left; a bitset subset-sum over the lengths that are left (with their
counts) finds the fullest combination that still fits, and that bin is made as often as
the counts allow. So the plan is a short list of bin patterns with repetitions.

Spark then deals out the places: every piece is numbered among the pieces of its length
(a number within its block when it is written, plus the totals of the blocks before), and
the number leads to a pattern, a repetition and a place in it. No length, however common,
is sorted or gathered in one task.

Edge cases: a null text is empty and still has its closing token. Repeated rows are packed
one by one. Columns named like a result are replaced, others are carried along. An empty
table gives an empty result. A very long text is encoded whole, in its row; pieces of
equal length are interchangeable, so ties may fall either way.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import own, refuse_clash
from docquarry.session import stage

#: Fixed value: where byte-level BPE splits a text, which `tokenizers` has built in.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of whole texts by a BPE file of the `tokenizers` library.

    A byte-level file whose merges stand in the order of their ids, and each of whose tokens
    is encoded as itself, is the same as a table of ranks: two neighbours merge if, and only
    if, their concatenation is a token, lowest id first. (Inside a token's bytes merging goes
    on as it would alone until something crosses their bounds; as the token alone comes out
    whole, its last two parts are its merge.) Such files are read as ranks by `tiktoken`, which
    takes a fraction of the time. All other files are used by `tokenizers` itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranks = rank_table(path, self.tokenizer)
        self.table, self.special = None, []
        if self.ranks:
            from tiktoken import Encoding

            self.table = Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=self.ranks, special_tokens={})
            # A text with the string of a special token is left to `tokenizers`, which gives it that token's id.
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def by_ranks(self, text: str) -> bool:
        return self.table is not None and not any(s in text for s in self.special)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder, which outlives its tasks."""
        if (cls, path) not in _encoders:
            _encoders[cls, path] = cls(path)
        return _encoders[cls, path]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if self.by_ranks(text):
            return self.table.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()


_encoders: dict = {}


def rank_table(path: str, tokenizer) -> dict[bytes, int] | None:
    """Bytes of each token -> its id, if the file is the same as a table of ranks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    special = all(t["special"] for t in spec.get("added_tokens", []))
    if not (plain and level and special) or spec.get("normalizer"):
        return None
    vocab, single = model["vocab"], _byte_letters()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    tokens = [*single, *merged]
    ids = [vocab.get(m, -1) for m in merged]
    if set(tokens) != set(vocab) or len(tokens) != len(vocab) or ids != sorted(ids):
        return None
    if any([x.id for x in tokenizer.model.tokenize(t)] != [i] for t, i in vocab.items()):
        return None
    return {bytes(single[ch] for ch in t): i for t, i in vocab.items()}


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: printable Latin-1 for itself,
    the others in order from U+0100."""
    shown = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_pieces(docs: DataFrame, path: str, limit: int = 1024, closing: int = 2) -> DataFrame:
    """(the columns but `text`, piece, start, length, ids): ids are little-endian 32-bit.

    Only documents longer than `limit` are cut; all their pieces but the first are full.
    """
    names = ("piece", "start", "length", "ids")
    kept = [c for c in refuse_clash(docs, *names).columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    end = np.array([closing], dtype="<u4").tobytes()

    def run(batches):
        encoder = Encoder.of(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                rows, pieces = [], []
                for i, text in enumerate(some.column("text").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    first = n - (-(-n // limit) - 1) * limit
                    cuts = [0, *range(first, n + 1, limit)]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        rows.append(i)
                        pieces.append((k, a, b - a, ids[4 * a:4 * b]))
                columns = [pa.array(x, t) for x, t in zip(zip(*pieces), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(some.select(kept).take(pa.array(rows)).columns + columns, names=[*kept, *names])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Length -> times of the combination with the largest total up to `room`.

    Bit s of a bitset tells that total s can be made from the lengths looked at so far.
    """
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted(counts):
        if length > room:
            break
        before, left, take = reached, min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            reached |= reached << (take * length) & mask
            left -= take
            take *= 2
        steps.append((length, before))
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            chosen[length] = chosen.get(length, 0) + 1
    return chosen


@dataclass(frozen=True)
class Plan:
    """For each (length, first number) in order: what the pieces from that number on get."""

    keys: np.ndarray
    sequence: np.ndarray
    per_bin: np.ndarray
    offset: np.ndarray

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + number, side="right") - 1
        within = number - (self.keys[at] & ((1 << 48) - 1))
        return self.sequence[at] + within // self.per_bin[at], self.offset[at] + within % self.per_bin[at] * length


def make_plan(counts: dict[int, int], limit: int) -> Plan:
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        seed = max(left)
        left[seed] -= 1
        pattern = fullest({n: c for n, c in left.items() if c}, limit - seed)
        left[seed] += 1
        pattern[seed] = pattern.get(seed, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append(((n << 48) + used[n], sequence, pattern[n], offset))
            offset += n * pattern[n]
            used[n] += times * pattern[n]
            left[n] -= times * pattern[n]
            if not left[n]:
                del left[n]
        sequence += times
    return Plan(*(np.array(x, dtype=np.int64) for x in zip(*sorted(rows)))) if rows else Plan(*[np.empty(0, np.int64)] * 4)


def _numbered(pieces: DataFrame, block: str, number: str) -> DataFrame:
    schema = T.StructType([*pieces.schema.fields, T.StructField(block, T.LongType()), T.StructField(number, T.LongType())])
    names = [*pieces.columns, block, number]

    def run(batches) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(1024, dtype=np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(length):
                continue
            if length.max() >= len(seen):
                seen = np.concatenate((seen, np.zeros(length.max() + 1 - len(seen), dtype=np.int64)))
            order = np.argsort(length, kind="stable")
            ranks = np.empty(len(length), dtype=np.int64)
            first = np.searchsorted(length[order], length[order])
            ranks[order] = np.arange(len(length)) - first
            ranks += seen[length]
            seen += np.bincount(length, minlength=len(seen))
            columns = [*batch.columns, pa.array(np.full(len(length), task, dtype=np.int64)), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return pieces.mapInArrow(run, schema)


def pack(pieces: DataFrame, limit: int = 1024) -> DataFrame:
    """The pieces with sequence_id and offset. `length` is 1 to `limit`."""
    block, number, base = own("block"), own("number"), own("base")
    written = stage(_numbered(refuse_clash(pieces, "sequence_id", "offset"), block, number), "pieces")
    counts = written.groupBy(block, "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(block, "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    # One number per length: bounded by the limit.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(make_plan(totals, limit))
    carried = [c for c in written.columns if c not in (block, number)]
    schema = T.StructType([written.schema[c] for c in carried] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            ints = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            if batch.num_rows:
                found = plan.value.places(ints("length"), ints(number) + ints(base))
                columns = batch.select(carried).columns + [pa.array(x) for x in found]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, "sequence_id", "offset"])

    return written.join(bases, [block, "length"]).select(*carried, number, base).mapInArrow(place, schema)
