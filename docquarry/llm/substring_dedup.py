"""Repeated byte strings: a distributed difference-cover algorithm for equal prefixes.

Two suffixes are alike here if their first `n` bytes are; nothing beyond decides, so the
suffix order is only built to that depth, and names (hashes) stand for ranks:

* *Sample.* Positions whose residue modulo `PERIOD` lies in a difference cover are
  sampled. For any two positions there is a step below `PERIOD` that takes both to sampled
  ones, so of two equal n-byte strings a sampled string of n - PERIOD + 1 bytes is found
  in both, at the same place. Sampled strings are named, and names sorted in buckets;
  names without an equal neighbour drop out.
* *Merge.* Only suffixes that start at most a period before a repeated sampled one can
  repeat. They are merged run by run: `RUN` neighbouring starts, dealt by their distance to
  the anchor of their n bytes, so equal strings fall into equal runs. A run is named by its
  core, the bytes that all its strings share, and by its span, the bytes that any of them
  holds. A core that occurs once has no repeat. Where all spans of a core are equal, all its
  strings repeat. Where they differ, as at the ends of a passage, its starts are named one by
  one by their first n bytes and sorted in the same way.

A suffix whose neighbour has the same name repeats, and its n bytes are removed.

Documents that take part are found first, by anchors: in every n bytes the anchor with the
least hash is chosen, so equal strings have an equal anchor. A document without an anchor
that occurs elsewhere has no repeat. Equal texts count as one, and go as a whole if they
are long enough. Texts are shuffled once, compressed, by chunk; each step reads that shuffle.
Names travel packed, by chunk of texts and bucket: within a chunk each once, so a passage
that a third of all documents hold is one name per chunk. Names have 64 bits, and buckets
come from another hash of the same string.

Edge cases: a null text is empty. Strings overlap freely, also within a document. Repeated
rows are copies of each other. Columns named like a result are replaced, others are
carried along. An empty table gives an empty result. A very long text takes some tens of
bytes per byte of it while it is hashed. There are no ties: every repeated string goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import own, refuse_clash, text_of
from docquarry.session import stage

RESULTS = ("n_bytes", "n_removed", "removed", "kept_sha256")
#: Bytes of an anchor, of a chunk of texts, and of texts per bucket of names; starts in a run.
ANCHOR, CHUNK, BUCKET, RUN = 48, 4 << 20, 32 << 20, 16
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BLOCK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """(period, cover): 6r + 4 residues whose differences are all residues of 24r^2 + 36r + 13.

    The steps between neighbours follow a fixed rule (Colbourn and Ling).
    """
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate(([0], np.cumsum(steps)))


def _power_table(base: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers:
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            t = np.full(_BLOCK + 4096, factor, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[base] = tuple(tables)
    return _powers[base]


def window_hashes(octets: np.ndarray, n: int, base: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each n-byte window (n at most 4,096), the same at any position; or of
    those that start `at` some ascending places."""
    size = max(0, len(octets) - n + 1)
    up, down = _power_table(base)
    out = np.empty(size if at is None else len(at), dtype=np.uint64)
    for begin in range(0, size, _BLOCK):
        end = min(begin + _BLOCK, size)
        first, last = (begin, end) if at is None else np.searchsorted(at, (begin, end))
        if first == last:
            continue
        some = octets[begin:end + n - 1].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(some) + 1, dtype=np.uint64)
        np.cumsum(some * up[:len(some)], out=sums[1:])
        if at is None:
            h = (sums[n:] - sums[:-n]) * down[:end - begin]
        else:
            i = at[first:last] - begin
            h = (sums[i + n] - sums[i]) * down[i]
        h ^= h >> np.uint64(32)
        out[first:last] = h * np.uint64(0xFF51AFD7ED558CCD)
    return out


def _sliding(values: np.ndarray, width: int, best: np.ufunc, worst: int) -> np.ndarray:
    """The least (or greatest) of each run of `width` values, from running values before
    and behind block borders."""
    pad = np.full(-len(values) % width, worst, dtype=values.dtype)
    blocks = np.concatenate((values, pad)).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return best(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(octets: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the anchors of all n-byte strings, one for each place; equal ones all count."""
    h = window_hashes(octets, ANCHOR, _BASES[0])
    width = n - ANCHOR + 1
    if len(h) < width:
        return h[:0]
    least = _sliding(h, width, np.minimum, np.iinfo(np.uint64).max)
    # A place is an anchor if it holds the least value of a run that it lies in.
    edge = np.zeros(width - 1, dtype=np.uint64)
    return h[h <= _sliding(np.concatenate((edge, least, edge)), width, np.maximum, 0)]


def _octets(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _packed(names: np.ndarray, buckets: np.ndarray, chunk: int) -> Iterator[dict]:
    """One row per bucket: the names that occur once in the chunk, and those that do more.

    Names may be pairs, as two rows; they travel as all first, then all second halves.
    """
    names = np.atleast_2d(names)
    order = np.lexsort((*names[::-1], buckets))
    names, buckets = names[:, order], buckets[order]
    first = np.ones(len(buckets), dtype=bool)
    first[1:] = (names[:, 1:] != names[:, :-1]).any(axis=0) | (buckets[1:] != buckets[:-1])
    at = np.flatnonzero(first)
    many = np.diff(np.append(at, len(buckets))) > 1
    names, buckets = names[:, at], buckets[at]
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(buckets)]):
        if a < b:
            yield {"bucket": int(buckets[a]), "chunk": chunk, "once": names[:, a:b][:, ~many[a:b]].tobytes(),
                   "more": names[:, a:b][:, many[a:b]].tobytes()}


_PACKED = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("chunk", T.LongType()),
                        T.StructField("once", T.BinaryType()), T.StructField("more", T.BinaryType())])
_PACKED_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])


def _packed_table(names: list[np.ndarray], buckets: list[np.ndarray], chunk: int) -> pa.Table:
    rows = list(_packed(np.concatenate(names, axis=-1), np.concatenate(buckets), chunk)) if names else []
    return pa.Table.from_pylist(rows, schema=_PACKED_ARROW)


def _unpacked(columns) -> np.ndarray:
    return np.frombuffer(b"".join(z for z in columns.to_pylist() if z), dtype=np.uint64)


def _pairs(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.uint64).reshape(2, -1)


def _repeated(packed: DataFrame) -> DataFrame:
    """(chunk, names): of each chunk's names, those that occur again anywhere."""
    def sort_bucket(table: pa.Table) -> pa.Table:
        names = np.sort(np.concatenate((_unpacked(table.column("once")), *[_unpacked(table.column("more"))] * 2)))
        again = np.unique(names[1:][names[1:] == names[:-1]])
        out = {"chunk": [], "names": []}
        for chunk, *lists in zip(*(table.column(c).to_pylist() for c in ("chunk", "once", "more"))):
            mine = np.frombuffer(b"".join(lists), dtype=np.uint64)
            mine = mine[_among(mine, again)]
            if len(mine):
                out["chunk"].append(chunk)
                out["names"].append(mine.tobytes())
        return pa.table(out, schema=pa.schema([("chunk", pa.int64()), ("names", pa.binary())]))

    return packed.groupBy("bucket").applyInArrow(sort_bucket, "chunk long, names binary")


def _judged(packed: DataFrame) -> DataFrame:
    """(chunk, names, cores): of each chunk's runs that occur again anywhere, the spans where
    all are equal, else the cores. A span of 0 leaves its text, and equals none."""
    def sort_bucket(table: pa.Table) -> pa.Table:
        rows = [(chunk, _pairs(once), _pairs(more)) for chunk, once, more in zip(
            *(table.column(c).to_pylist() for c in ("chunk", "once", "more")))]
        core, span = np.concatenate([p for _, once, more in rows for p in (once, more, more)], axis=1)
        order = np.lexsort((span, core))
        core, span = core[order], span[order]
        at = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
        last = np.append(at[1:], len(core)) - 1
        alike = (span[at] == span[last]) & (span[at] != 0)
        whole, mixed = core[at[(last > at) & alike]], core[at[(last > at) & ~alike]]
        out = {"chunk": [], "names": [], "cores": []}
        for chunk, once, more in rows:
            core, span = np.concatenate((once, more), axis=1)
            spans, cores = span[_among(core, whole)], np.unique(core[_among(core, mixed)])
            if len(spans) or len(cores):
                for c, v in zip(out, (chunk, spans.tobytes(), cores.tobytes())):
                    out[c].append(v)
        return pa.table(out, schema=pa.schema([("chunk", pa.int64()), ("names", pa.binary()), ("cores", pa.binary())]))

    return packed.groupBy("bucket").applyInArrow(sort_bucket, "chunk long, names binary, cores binary")


def _among(values: np.ndarray, sorted_names: np.ndarray) -> np.ndarray:
    if not len(sorted_names):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_names, values)
    return sorted_names[np.minimum(at, len(sorted_names) - 1)] == values


def _sampled(octets: np.ndarray, n: int, period: int, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions, and the first bytes of each from there to the sampled length."""
    size = max(0, len(octets) - (n - period))
    at = (np.arange(0, size, period)[:, None] + cover).ravel()
    at = at[:np.searchsorted(at, size)]
    return at, window_hashes(octets, n - period + 1, _BASES[0], at)


def _runs(octets: np.ndarray, n: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the cores of the starts' runs begin, and each run's core and span.

    The first of the least anchors in a start's n bytes decides, so equal strings lie at the
    same place of their runs: a run's starts are the core's first byte and `RUN` - 1 before.
    """
    h = window_hashes(octets, ANCHOR, _BASES[0])
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding(key, n - ANCHOR + 1, np.minimum, np.iinfo(np.uint64).max)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = np.unique(starts + (anchor - starts) % RUN)
    span = np.zeros(len(at), dtype=np.uint64)
    inside = (at >= RUN - 1) & (at + n <= len(octets))
    span[inside] = window_hashes(octets, n + RUN - 1, _BASES[0], at[inside] - RUN + 1)
    return at, np.stack((window_hashes(octets, n - RUN + 1, _BASES[0], at), span))


def _near(at: np.ndarray, before: int, size: int) -> np.ndarray:
    """Which of `size` places lie at `at`, or at most `before` places before."""
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, np.minimum(np.maximum(at - before, 0), size), 1)
    np.add.at(change, np.minimum(at + 1, size), -1)
    return np.cumsum(change[:size]) > 0


def _bucket(octets: np.ndarray, n: int, at: np.ndarray, buckets: int) -> np.ndarray:
    return ((window_hashes(octets, n, _BASES[1], at) >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


def repeated_strings(docs: DataFrame, n: int = 400, cover: int = 2) -> DataFrame:
    """The documents (without their text) with n_bytes, n_removed, removed (byte spans,
    start and end) and kept_sha256, after removal of all strings of n bytes that also start
    anywhere else. `cover` sets the period; n must be well above it and at most 4,096."""
    period, residues = difference_cover(cover)
    if not period + ANCHOR <= n <= 4096:
        raise ValueError(f"n must be {period + ANCHOR} to 4096")
    sha, a, b = own("sha"), own("a"), own("b")
    text = text_of()
    base = refuse_clash(docs, *RESULTS)
    half = lambda k: F.conv(F.substr(F.col(sha), F.lit(16 * k + 1), F.lit(15)), 16, 10).cast("long")
    keyed = base.withColumn(sha, F.sha2(text, 256)).withColumns({a: half(0), b: half(1)})
    rows = stage(keyed.withColumn("n_bytes", F.octet_length(text)).drop("text"), "repeats-rows")
    long_texts = keyed.filter(F.octet_length(text) >= n).select(a, b, "text")
    total = rows.filter(F.col("n_bytes") >= n).agg(F.sum("n_bytes")).first()[0] or 0
    results = stage(_resolve(long_texts, _suspects(long_texts, a, b, n), total, n, period, residues, a, b), "repeats-results")

    copies = rows.filter(F.col("n_bytes") >= n).groupBy(a, b).agg(F.count("*").alias(own("copies"))).filter(F.col(own("copies")) > 1)
    joined = rows.join(copies, [a, b], "left").join(results, [a, b], "left")
    whole = F.col(own("copies")).isNotNull()
    none = F.array().cast("array<struct<start:long,end:long>>")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").cast("long").alias("end")))
    removed = F.when(whole, all_of_it).otherwise(F.coalesce(own("spans"), none))
    return joined.select(
        *(c for c in base.columns if c != "text"),
        F.col("n_bytes").cast("long").alias("n_bytes"),
        F.aggregate(removed, F.lit(0).cast("long"), lambda x, s: x + s["end"] - s["start"]).alias("n_removed"),
        removed.alias("removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce(own("kept"), sha)).alias("kept_sha256"),
    )


def _suspects(texts: DataFrame, a: str, b: str, n: int) -> DataFrame:
    """(a, b): the texts that share an anchor, each once."""
    def find(batches):
        for batch in batches:
            parts = [[], [], [], []]
            for text, x, y in zip(*(batch.column(c).to_pylist() for c in ("text", a, b))):
                found, times = np.unique(anchors(_octets(text), n), return_counts=True)
                for part, value in zip(parts, (found.view(np.int64), times > 1, np.full(len(found), x), np.full(len(found), y))):
                    part.append(value)
            if parts[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(p)) for p in parts], names=["anchor", "twice", a, b])

    found = stage(texts.select("text", a, b).mapInArrow(find, f"anchor long, twice boolean, {a} long, {b} long"), "repeats-anchors")
    text_id = F.struct(a, b)
    shared = found.groupBy("anchor").agg(F.min(text_id).alias("x"), F.max(text_id).alias("y"), F.max("twice").alias("t")).filter(
        "t OR x <> y").select("anchor")
    return stage(found.join(shared, "anchor", "left_semi").select(a, b).distinct(), "repeats-wanted")


def _by_chunk(texts: DataFrame, a: str, b: str, chunks: int):
    """(a, b, packed, chunk) by chunk: each text compressed, once per reading task."""
    def squeeze(batches):
        packer, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            rows = {"packed": [], a: [], b: []}
            for text, x, y in zip(*(batch.column(c).to_pylist() for c in ("text", a, b))):
                if (x, y) not in seen:
                    seen.add((x, y))
                    for c, v in zip(rows, (packer.compress(_octets(text).tobytes()), x, y)):
                        rows[c].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("packed", pa.binary()), (a, pa.int64()), (b, pa.int64())]))

    small = texts.select("text", a, b).mapInArrow(squeeze, f"packed binary, {a} long, {b} long")
    return small.withColumn("chunk", F.pmod(a, F.lit(chunks))).groupBy("chunk")


def _resolve(texts: DataFrame, wanted: DataFrame, total: int, n: int, period: int, residues: np.ndarray, a: str, b: str) -> DataFrame:
    """(a, b, spans, kept) of the wanted texts that lose something, of `total` bytes of texts."""
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks, buckets = max(2 * least, 1 + total // CHUNK), max(least, 1 + total // BUCKET)
    length = n - period + 1

    def each(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
        """The chunk's wanted texts, each once."""
        left_out = set(zip(right.column(a).to_pylist(), right.column(b).to_pylist()))
        for x, y, z in zip(*(left.column(c).to_pylist() for c in (a, b, "packed"))):
            if (x, y) in left_out:
                left_out.remove((x, y))
                yield x, y, np.frombuffer(zstandard.ZstdDecompressor().decompress(z), dtype=np.uint8)

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        found, places = [], []
        for _, _, octets in each(left, right):
            at, names = _sampled(octets, n, period, residues)
            found.append(names)
            places.append(_bucket(octets, length, at, buckets))
        return _packed_table(found, places, left.column("chunk")[0].as_py() if found else 0)

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        again, found, places = np.sort(_unpacked(right.column("names"))), [], []
        for _, _, octets in each(left, right) if len(again) else ():
            at, names = _sampled(octets, n, period, residues)
            # Starts from a period before a repeated sample up to it.
            starts = np.flatnonzero(_near(at[_among(names, again)], period - 1, len(octets) - n + 1))
            if len(starts):
                at, pairs = _runs(octets, n, starts)
                found.append(pairs)
                places.append(_bucket(octets, n - RUN + 1, at, buckets))
        return _packed_table(found, places, left.column("chunk")[0].as_py() if found else 0)

    def refine(left: pa.Table, right: pa.Table) -> pa.Table:
        mixed, found, places = np.unique(_unpacked(right.column("cores"))), [], []
        for _, _, octets in each(left, right) if len(mixed) else ():
            at = np.flatnonzero(_among(window_hashes(octets, n - RUN + 1, _BASES[0]), mixed))
            starts = np.flatnonzero(_near(at, RUN - 1, len(octets) - n + 1))
            if len(starts):
                found.append(window_hashes(octets, n, _BASES[0], starts))
                places.append(_bucket(octets, n, starts, buckets))
        return _packed_table(found, places, left.column("chunk")[0].as_py() if found else 0)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out_schema = pa.schema([(a, pa.int64()), (b, pa.int64()), (own("spans"), span), (own("kept"), pa.string())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        whole, again, rows = np.unique(_unpacked(right.column("names"))), np.unique(_unpacked(right.column("cores"))), []
        for x, y, octets in each(left, right) if len(whole) or len(again) else ():
            repeats = _among(window_hashes(octets, n, _BASES[0]), again)
            # A span stands for all the starts in it.
            at = np.flatnonzero(_among(window_hashes(octets, n + RUN - 1, _BASES[0]), whole))
            starts = np.flatnonzero(repeats | _near(at + RUN - 1, RUN - 1, len(repeats)))
            if len(starts):
                breaks = np.flatnonzero(np.diff(starts) > n) + 1
                begins, ends = starts[np.append(0, breaks)], starts[np.append(breaks, len(starts)) - 1] + n
                keep, last = hashlib.sha256(), 0
                for s, e in zip(begins, ends):
                    keep.update(octets[last:s])
                    last = e
                keep.update(octets[last:])
                rows.append({a: x, b: y, own("spans"): [{"start": int(s), "end": int(e)} for s, e in zip(begins, ends)],
                             own("kept"): keep.hexdigest()})
        return pa.Table.from_pylist(rows, schema=out_schema)

    by_chunk = _by_chunk(texts, a, b, chunks)
    listed = wanted.select(F.pmod(a, F.lit(chunks)).alias("chunk"), a, b)

    kinds = f"{a} long, {b} long, {own('spans')} array<struct<start:long,end:long>>, {own('kept')} string"

    def step(function, schema, *names: DataFrame) -> DataFrame:
        right = listed.withColumns({c: F.lit(None).cast("binary") for c in ("names", "cores")})
        for some in names:
            right = right.unionByName(some, allowMissingColumns=True)
        return by_chunk.cogroup(right.groupBy("chunk")).applyInArrow(function, schema)

    samples = _repeated(step(sample, _PACKED))
    runs = _judged(step(merge, _PACKED, samples))
    single = _repeated(step(refine, _PACKED, runs))
    return step(cut, kinds, runs.select("chunk", "names"), single.withColumnRenamed("names", "cores"))
