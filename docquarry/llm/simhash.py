"""SimHash near-duplicates: fingerprints linked by a grid range join over segment bit counts.

A fingerprint becomes 16 counts, the set bits of each 4-bit segment. Flipping a bit changes
one count by one, so the Manhattan distance of the counts is at most the bit distance.
Two vectors of counts at distance d <= 2r meet in a grid point at most r from both, so
every fingerprint is entered at all grid points within half the limit, and an equi-join on
the grid point finds all pairs in range. Each pair is then checked on the bits.

Only distinct fingerprints take part: copies collapse before the join. What passes the
check is at most the number of fingerprints within the limit of another one, whatever the
size of a group of near copies; a crowded grid point is split like any skewed join. The
links, and the components over them, stay in Spark; rounds end in written tables.

Edge cases: a null text is empty; a text without words has fingerprint zero and is linked
like any other. A null id joins its component but is never its smallest id (a component
of nulls only has a null id). Repeated rows get equal results. Columns named like a result
are replaced, others are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import components, own, refuse_clash
from docquarry.session import stage

SEED = 42
#: Four bits to a segment: counts of 0 to 4 fit a 4-bit digit with room for a step.
SEGMENT_BITS = 4
#: The number of grid points grows with the power of half of this.
MAX_BITS = 6
RESULTS = ("fingerprint", "component_id", "component_key")
#: Shingle hashes that are counted at once, so that long texts need bounded memory.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit b is 1 if it is set in over half of the shingle hashes (repeats included)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for begin in range(0, n, _BLOCK):
        hashes = [digest(join(found[i:i + shingle]), SEED) for i in range(begin, min(n, begin + _BLOCK))]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = 3, name: str = "fingerprint_bits") -> DataFrame:
    """(the columns but `text`, `name` as a signed long)."""
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.LongType(), False)])

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            columns = [batch.column(c) for c in kept] + [pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def _grid_points(bits: Column, reach: int) -> Column:
    """All vectors of segment bit counts within `reach` of the fingerprint's own.

    A vector is a long with one 4-bit digit per segment. Steps below zero borrow from the
    next digit: two vectors may then share a point, which the check on the bits undoes,
    but equal vectors always do.
    """
    ones = F.lit(0x1111111111111111)
    counts = F.shiftrightunsigned(bits, 0).bitwiseAND(ones)
    for k in range(1, SEGMENT_BITS):
        counts = counts + F.shiftrightunsigned(bits, k).bitwiseAND(ones)
    moves = {0}
    for _ in range(reach):
        moves |= {m + sign * (1 << SEGMENT_BITS * i) for m in moves for i in range(64 // SEGMENT_BITS) for sign in (1, -1)}
    # The top count is at most 4, so up to three steps more stay within a long.
    reached = F.array(*(F.lit(m) for m in sorted(moves)))
    return F.transform(F.array(counts), lambda c: F.transform(reached, lambda m: c + m))[0]


def near_pairs(fingerprints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): all pairs of the distinct longs in `bits` that differ in at most `max_bits` bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    reach = (max_bits + 1) // 2
    entered = fingerprints.select("bits", F.explode(_grid_points(F.col("bits"), reach)).alias("point"))
    other = entered.withColumnRenamed("bits", "other")
    near = (F.col("bits") < F.col("other")) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= max_bits)
    met = entered.join(other.hint("merge"), (entered["point"] == other["point"]) & near)
    return met.select(F.col("bits").alias("a"), F.col("other").alias("b"))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id") -> DataFrame:
    """The documents (without their text) with fingerprint, component_id and component_key.

    `component_key` is the smallest fingerprint of the component, as a signed long; it
    names the component also where ids are null.
    """
    bits, root = own("bits"), own("root")
    rows = stage(with_fingerprints(refuse_clash(docs, *RESULTS), shingle, bits), "fingerprints")
    distinct = rows.groupBy(F.col(bits).alias("bits")).agg(F.min(id_column).alias("low"))
    roots = components(near_pairs(distinct.select("bits"), max_bits), "simhash-links")
    # Fingerprints without a link are their own component.
    owned = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "low", F.coalesce("root", "bits").alias("root"))
    owned = stage(owned, "simhash-components")
    lows = owned.groupBy("root").agg(F.min("low").alias("component_id"))
    named = owned.select(F.col("bits").alias(bits), F.col("root").alias(root)).join(
        lows.withColumnRenamed("root", root), root)
    carried = [c for c in rows.columns if c != bits]
    return rows.join(named, bits).select(
        *carried,
        F.lower(F.lpad(F.hex(F.col(bits)), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col(root).alias("component_key"),
    )


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id") -> DataFrame:
    """One document of each group, with all columns: one with the group's smallest id.

    Among rows that share that id, the hash of all columns decides; of equal rows one stays.
    """
    key = own("key")
    hashed = [F.col(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    keyed = docs.withColumn(key, F.xxhash64(*hashed))
    groups = simhash_groups(keyed.select(id_column, key, "text"), shingle, max_bits, id_column)
    best = groups.filter(F.col(id_column).eqNullSafe(F.col("component_id"))).groupBy("component_key").agg(
        F.min(key).alias(key))
    return keyed.join(best.select(key), key, "left_semi").dropDuplicates([key]).select(*docs.columns)
