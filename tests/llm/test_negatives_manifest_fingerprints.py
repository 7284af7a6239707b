"""Hard negatives, the manifest and weighted fingerprints against plain versions."""

import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docquarry.llm import hard_negatives as hn
from docquarry.llm import merkle
from docquarry.llm import weighted_sampling as ws
from docquarry.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle_manifest"])
def test_equal_sql(spark, sf, name):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, sf)
    columns = ", ".join(sorted(df.columns))
    expected = connection.execute(f"SELECT {columns} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect()))) == sorted(map(repr, expected))


# Hard negatives

def plain_negatives(rows, is_anchor, low=(1, 2), high=(19, 20)):
    """All pairs, one by one. `rows` holds (id, label, vector)."""
    good = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    coded = [(i, label, [math.floor(Fraction(x) * 256) for x in v]) for i, label, v in good]
    out = []
    for n, (anchor, label, a) in enumerate(coded):
        if not is_anchor(anchor):
            continue
        pairs = [(-sum(x * y for x, y in zip(a, v)), i is None, i or 0, m, i, lab)
                 for m, (i, lab, v) in enumerate(coded) if m != n and len(v) == len(a)]
        pairs.sort()
        for p in [p for p in pairs if p[5] == label][:5]:
            score = -p[0]
            found = [q for q in pairs if q[5] != label and low[0] * score <= -q[0] * low[1] and -q[0] * high[1] <= high[0] * score]
            out += [(anchor, p[4], k, q[4], score, -q[0]) for k, q in enumerate(found[:3], 1)]
    return sorted(out, key=repr)


VECTORS = "vec_id long, label int, embedding array<float>, row string, slice int"


def mined(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "?", 1) for r in rows], VECTORS)
    found = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, **settings)
    return sorted(map(tuple, found.collect()), key=repr)


def test_negatives_by_hand(spark, monkeypatch):
    """Several tiles, ties, a hot label, repeated rows and ids, nulls and odd vectors."""
    monkeypatch.setattr(hn, "BLOCK", 4)
    monkeypatch.setattr(hn, "SLICE", 60)
    draw = np.random.default_rng(3)
    rows = [(i, int(draw.integers(0, 3)) if i % 3 else 0, [float(x) for x in np.round(draw.normal(size=3), 1)]) for i in range(400)]
    rows += rows[:55]  # each row is one of its own
    rows += [(50, 2, [0.5, 0.5, 0.5]), (None, 0, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (450, None, [1.0, 1.0, 1.0])]
    rows += [(500, 0, None), (550, 0, [1.0, None, 1.0]), (600, 0, [1.0, float("nan"), 1.0]), (650, 0, [float("inf"), 0.0, 0.0])]
    rows += [(700, 0, [1.0]), (701, 0, [1.0]), (702, 1, [0.75]), (750, 0, []), (751, 0, []), (752, 1, []), (800, 5, [0.0, 0.0, 0.0])]
    as_float = [(i, label, v and [x if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    expected = plain_negatives(as_float, lambda i: i is not None and i % 50 == 0)
    assert mined(spark, rows) == expected
    assert any(r[0] == 750 for r in expected) and any(r[0] == 700 for r in expected)


def test_negatives_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(0, 1, [1.0])]) == []
    with pytest.raises(ValueError):
        mined(spark, [(0, 1, [1.0])], low=(2, 1))


def test_products_are_exact():
    big = np.array([[3e15, -7.0], [2.0**62, 1.0]])
    assert hn.products(big, big).tolist() == [
        [hn._LONG, hn._LONG], [hn._LONG, hn._LONG]]
    mixed = np.array([[94906267.0, 1.0]])
    assert hn.products(mixed, np.array([[94906267.0, 3.0]]))[0, 0] == 94906267**2 + 3


def test_first_of_equal_scores():
    scores = np.array([[5, 7, 7, 1, 7], [hn._LONG, hn._LONG, 0, -hn._LONG, 3]])
    rows, columns = hn.first(scores, np.array([[True, True, True, True, True], [True, True, True, True, False]]), 3)
    assert sorted(zip(rows.tolist(), columns.tolist())) == [(0, 1), (0, 2), (0, 4), (1, 0), (1, 1), (1, 2)]


# Manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        start = i // 8 * 8
        path.append(("".join(level[start:i]), "".join(level[i + 1:start + 8])))
        i //= 8
    return path


def plain_manifest(rows):
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append((plain_leaf(*row), row))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        parts[name].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {name: plain_tree([h for h, _ in parts[name]]) for name in names}
    top = plain_tree([trees[name][-1][0] for name in names])
    out = []
    for j, name in enumerate(names):
        for i, (held, row) in enumerate(parts[name]):
            path, folded = plain_path(trees[name], i) + plain_path(top, j), held
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                folded = plain_leaf(*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            for before, after in path:
                folded = digest(before, folded, after)
            proof = digest(*(before + after for before, after in path))
            out.append((row[0], row[2], held, trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def manifested(spark, rows):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, source string, lang string, n_chars int, text string, number int, Leaf string")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = merkle.manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
        F.crc32(F.col("doc_id").cast("string")) % 3 == 0, {"text": lower})
    assert "number" in found.columns
    names = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.select(*names).collect()), key=repr)


ROWS = [
    *((i, "a", "en", i, f"Text {i}") for i in range(70)), *((i, "b", "fr", i, "É ß 漢字 🙂 ABC") for i in range(9)),
    *((i, None, "es", None, None) for i in range(8)), (1, "a", "de", 1, "One"),
    (3, "a", None, 1, ""), (3, "a", None, 1, ""), (None, "a", None, 1, "Null id"), (3, "z", None, 1, "x" * 50_000),
    (5, "a", "", 1, "empty part"), *((i, "s", f"p{i}", 1, "Own Part") for i in range(12)),
]


@pytest.mark.parametrize("rows", [ROWS, ROWS[70:72], []], ids=len)
def test_manifest(spark, rows):
    assert manifested(spark, rows) == plain_manifest(rows)


# Fingerprints

def plain_samples(text, slots):
    """Samples of each slot, number by number."""
    words = Counter((text or "").encode().lower().split())
    gamma = ws.gamma_quantiles()
    mix = lambda x, full=True: _mix(x, full)
    out = []
    for j in range(1, slots + 1):
        best = None
        for word, weight in words.items():
            term = xxhash.xxh64_intdigest(word, ws.SEED)
            x = mix((term + j * int(ws._GOLDEN)) % 2**64, False)
            r, log_c = gamma[x >> 48], np.log(gamma)[x >> 32 & 0xFFFF]
            b = (np.float32(x >> 16 & 0xFFFF) + np.float32(0.5)) * np.float32(2.0**-16)
            t = np.floor(np.float32(np.log(weight)) / r + b) if weight != 1 else np.float32(0)
            arrival = log_c - r * (t - b + 1)
            if best is None or arrival < best[0]:
                best = arrival, mix((term + (int(t) % 2**64) * int(ws._M1)) % 2**64) % 65535 + 1
        out.append(best[1] if best else 0)
    return "".join(f"{x:04x}" for x in out)


def _mix(x, full):
    x = (x ^ x >> 30) * int(ws._M1) % 2**64
    x = (x ^ x >> 27) * int(ws._M2) % 2**64
    return x ^ x >> 31 if full else x


TEXTS = [(4, "b b a c c c D"), (2, None), (1, "one"), (1, "one"), (None, "A a \n b"), (9, "é 漢字 🙂 é"), (7, "word " * 3000 + "end"),
         (8, " \t"), (3, " ".join(f"w{i % 700}" for i in range(2000))), (6, "x" * 20_000), (5, "odd")]


def plain_neighbours(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        mine, theirs, next_one = (plain_samples(t, 8) for t in (text, changed, after))
        share = lambda other: sum(mine[k:k + 4] == other[k:k + 4] for k in range(0, 32, 4)) / 8
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), mine, theirs, share(theirs), share(next_one)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [len(TEXTS), 2, 1, 0])
def test_neighbours(spark, n):
    docs = spark.createDataFrame([(*r, "?", 1.0) for r in TEXTS[:n]], "doc_id long, text string, Fingerprint string, near_next double")
    found = ws.neighbour_fingerprints(docs, slots=8)
    assert found.columns == ["doc_id", *ws.RESULTS]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_neighbours(TEXTS[:n])
    assert {r["fingerprint"] for r in ws.fingerprints(docs, 8).collect()} == {plain_samples(t, 8) for _, t in TEXTS[:n]}


def test_neighbours_of_many(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(150)
    rows = list(map(tuple, docs.collect()))
    monkeypatch.setattr(ws, "_STEP", 7)
    found = ws.neighbour_fingerprints(spark.createDataFrame(rows, docs.schema).repartition(5), slots=8)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_neighbours(rows)


def test_collision_rate_is_generalised_jaccard():
    """Over many slots the share of equal samples comes close to the similarity, at several weights."""
    draw = np.random.default_rng(5)
    for spread in (2, 10, 60):
        a, b = ({f"t{i}": int(draw.integers(1, spread)) for i in draw.choice(60, 40, replace=False)} for _ in range(2))
        exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
        made = ws.signatures([ws.weighted_terms(" ".join(f"{k} " * n for k, n in x.items())) for x in (a, b)], 20_000)
        assert abs((made[0] == made[1]).mean() - exact) < 0.015


def test_blocks_give_the_same(monkeypatch):
    terms = [ws.weighted_terms(" ".join(f"v{i * k % 997}" for i in range(1500))) for k in (1, 2, 3)]
    whole = ws.signatures(terms)
    monkeypatch.setattr(ws, "_HELD", 100)
    monkeypatch.setattr(ws, "_BLOCK", 30)
    assert (ws.signatures(terms) == whole).all()


def test_likeness(spark):
    row = spark.createDataFrame([("0001000200030004", "0001000000030005")], "a string, b string").select(ws.likeness(F.col("a"), F.col("b"))).first()
    assert row[0] == 0.5
