import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.functions.text import terms
from docquarry.operators import quantised, retrieval
from docquarry.operators.cells import Cells, approximate_top_k, enough_probes, read_cells, recall, recall_by_probes
from docquarry.operators.encoding import HashedIdf, UserEncoder, slot, slot_counts, to_points, with_slots
from docquarry.operators.retrieval import drop_empty_hits, hits_as_array, top_k, top_k_single
from docquarry.plans import catalog, search
from docquarry.session import stage


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(11)
    points = rng.normal(size=(300, 8)).astype(np.float32)
    points[100:200] = points[7]  # a third of all points are copies
    points[250] = 0
    return points, rng.normal(size=(23, 8)).astype(np.float32)


def frames(spark, vectors):
    points, questions = vectors
    p = spark.createDataFrame(
        [(f"p{i:03}", v.tolist(), f"s{i % 3}" if i < 290 else None) for i, v in enumerate(points)],
        "id string, embedding array<float>, source_file string",
    ).repartition(5)
    q = spark.createDataFrame(
        [(i, v.tolist(), [f"s{i % 3}", None][i % 2]) for i, v in enumerate(questions)],
        "query_id int, embedding array<float>, source_file string",
    )
    return p, q


def brute(vectors, k, metric, filtered):
    points, questions = (v.astype(np.float64) for v in vectors)
    found = {}
    for i, q in enumerate(questions):
        scored = []
        for j, p in enumerate(points):
            own = f"s{j % 3}" if j < 290 else None
            if filtered and i % 2 == 0 and own != f"s{i % 3}":
                continue
            if metric == "cosine":
                lengths = np.linalg.norm(p) * np.linalg.norm(q)
                scored.append((-round(float(p @ q / lengths), 9) if lengths else 0.0, f"p{j:03}"))
            else:
                scored.append((round(float(((p - q) ** 2).sum()), 9), f"p{j:03}"))
        found[i] = [s[1] for s in sorted(scored)[:k]]
    return found


def ranked(hits):
    found = {}
    for r in sorted(hits.collect(), key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append(r.id)
        assert r["rank"] == len(found[r.query_id])
    return found


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("filtered", [False, True])
def test_top_k_equals_brute_force(spark, vectors, metric, filtered):
    p, q = frames(spark, vectors)
    hits = top_k(q, p, 5, metric, filters=["source_file"] if filtered else [], carry=["source_file"])
    assert ranked(hits) == brute(vectors, 5, metric, filtered)


def test_small_blocks_tiles_and_buffers(spark, vectors, monkeypatch):
    """Many question blocks, point slices and score tiles give the same hits."""
    monkeypatch.setattr(retrieval, "BLOCK", 5)
    monkeypatch.setattr(retrieval, "SLICE", 40)
    monkeypatch.setattr(retrieval, "_TILE", 100)
    p, q = frames(spark, vectors)
    assert ranked(top_k(q, p, 5)) == brute(vectors, 5, "cosine", False)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_joined_questions(spark, vectors, monkeypatch, metric):
    """Many questions with a filter meet their points in a join; large values are split on
    both sides, and questions without a filter go the other way."""
    monkeypatch.setattr(retrieval, "SENT", 2)
    monkeypatch.setattr(retrieval, "BLOCK", 2)
    monkeypatch.setattr(retrieval, "SLICE", 30)
    p, q = frames(spark, vectors)
    assert ranked(top_k(q, p, 5, metric, filters=["source_file"])) == brute(vectors, 5, metric, True)


def test_arrays_of_accepted_values(spark, vectors, monkeypatch):
    p, _ = frames(spark, vectors)
    accepted = [["s0", "s2", "s0"], None, [], ["s1", None], ["unknown"]]
    rows = [(i, vectors[1][i].tolist(), a) for i, a in enumerate(accepted)]
    q = spark.createDataFrame(rows, "query_id int, embedding array<float>, source_file array<string>")
    sent = ranked(top_k(q, p, 4, filters=["source_file"], many_values=True))
    monkeypatch.setattr(retrieval, "SENT", 0)
    assert ranked(top_k(q, p, 4, filters=["source_file"], many_values=True)) == sent
    own = {f"p{j:03}": f"s{j % 3}" if j < 290 else None for j in range(300)}
    order = brute(vectors, 300, "cosine", False)
    keep = lambda i, ok: [x for x in order[i] if ok(own[x])][:4]
    assert sent == {0: keep(0, lambda s: s in ("s0", "s2")), 1: keep(1, lambda s: True), 3: keep(3, lambda s: s == "s1")}


def test_no_text_is_shuffled_with_the_vectors(spark, sf, capsys):
    """Texts are fetched by id after the ranking; the search itself never reads them."""
    data = spark.read.parquet(f"{sf}/embeddings.parquet")
    points = data.select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("text"))
    asked = data.filter("vec_id < 3").select(F.col("vec_id").alias("query_id"), "embedding")
    top_k(asked, points).explain()
    plan = capsys.readouterr().out
    assert "label" not in plan and "WindowGroupLimit" in plan
    hits = top_k(asked, points, carry=["text"])
    expected = {r.vec_id: str(r.label) for r in data.collect()}
    assert hits.count() == 15 and all(expected[r.id] == r.text for r in hits.collect())


def test_many_filter_values(spark, vectors, monkeypatch):
    """More values than a predicate lists: a semi-join prunes the points."""
    monkeypatch.setattr(retrieval, "_LISTED", 1)
    p, q = frames(spark, vectors)
    q = q.filter("source_file IS NOT NULL")
    expected = {i: f for i, f in brute(vectors, 5, "cosine", True).items() if i % 2 == 0}
    assert ranked(top_k(q, p, 5, filters=["source_file"])) == expected


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_codes_give_the_exact_hits(spark, vectors, monkeypatch, metric):
    """Copies, a zero vector, values of all sizes: the bound keeps every hit, and few others."""
    monkeypatch.setattr(quantised, "SLICE", 70)
    points = vectors[0].copy()
    points[30:60] *= 100
    p, q = frames(spark, (points, vectors[1]))
    codes = stage(quantised.with_codes(p, metric), "codes")
    assert ranked(quantised.quantised_top_k(q, codes, p, 5, metric)) == brute((points, vectors[1]), 5, metric, False)
    assert ranked(quantised.quantised_top_k(q, codes, p, 400, metric)) == brute((points, vectors[1]), 400, metric, False)
    # A hundred copies tie, and all of them are looked at; else little more than k.
    assert quantised.candidates(q, codes, 5, metric).count() < 23 * 125
    assert codes.select(F.max(F.length("code"))).first()[0] == 8
    odd = spark.createDataFrame([("n", [float("nan")] * 8)], "id string, embedding array<float>")
    assert quantised.with_codes(odd).count() == 0


def test_k_larger_than_points_and_no_questions(spark, vectors):
    p, q = frames(spark, vectors)
    assert {len(v) for v in ranked(top_k(q, p, 1000)).values()} == {300}
    assert top_k(q.limit(0), p).count() == 0
    assert top_k(q, p.limit(0)).count() == 0


def test_wrong_vectors_fail(spark, vectors):
    p, q = frames(spark, vectors)
    for wrong in (F.lit(None), F.array(F.lit(1.0))):
        odd = F.when(F.col("id") == "p005", wrong.cast("array<float>")).otherwise(F.col("embedding"))
        with pytest.raises(Exception, match="must have 8 dimensions"):
            top_k(q, p.withColumn("embedding", odd)).count()


def test_single_question_and_filter(spark, vectors):
    p, _ = frames(spark, vectors)
    for metric in ("cosine", "l2"):
        single = [r.id for r in top_k_single(p, vectors[1][1].tolist(), 5, metric).collect()]
        assert single == brute(vectors, 5, metric, False)[1]
    only = top_k_single(p, vectors[1][0].tolist(), 5, where=F.col("source_file") == "s0")
    assert [r.id for r in only.collect()] == brute(vectors, 5, "cosine", True)[0]


def test_both_metrics_rank_unit_vectors_alike(spark, sf):
    data = spark.read.parquet(f"{sf}/embeddings.parquet")
    points = data.select(F.col("vec_id").alias("id"), "embedding")
    asked = data.filter("vec_id < 40").select(F.col("vec_id").alias("query_id"), "embedding")
    assert ranked(top_k(asked, points)) == ranked(top_k(asked, points, metric="l2"))


def test_filter_reaches_the_scan(spark, sf, capsys):
    data = spark.read.parquet(f"{sf}/embeddings.parquet")
    points = data.select(F.col("vec_id").alias("id"), "embedding", "label")
    asked = data.filter("vec_id < 3").select(F.col("vec_id").alias("query_id"), "embedding", "label")
    top_k(asked, points, filters=["label"]).explain()
    assert "PushedFilters: [In(label" in capsys.readouterr().out


@pytest.fixture(scope="module")
def clustered():
    """Points around 150 centres, and questions near points."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(150, 24))
    points = np.repeat(centres, 30, axis=0) + rng.normal(size=(4500, 24)) * 0.25
    return points.astype(np.float32), (points[::90] + rng.normal(size=(50, 24)) * 0.1).astype(np.float32)


def test_few_cells_find_nearly_all(spark, clustered, tmp_path, capsys):
    """On data with clusters nine tenths of the exact hits lie in a tenth of the points."""
    points, asked = (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, embedding array<float>")
        for x, name in zip(clustered, ("id", "query_id")))
    cells = Cells.train(points, 48, sample=2000)
    cells.write(points, str(tmp_path / "cells"))
    filed = read_cells(spark, str(tmp_path / "cells"))
    assert filed.count() == 4500
    exact = top_k(asked, points, 5)
    curve = stage(recall_by_probes(asked, filed, cells, exact), "curve")
    rows = {r.probes: r for r in curve.collect()}
    assert rows[48].recall_at_k == 1.0 and rows[48].rows_read == pytest.approx(1.0)
    probes = enough_probes(curve)
    assert rows[probes].recall_at_k >= 0.9 and rows[probes].rows_read <= 0.1
    near = approximate_top_k(asked, filed, cells, probes=probes)
    report = recall(near, exact).first()
    assert (report.exact_hits, report.found_hits) == (rows[probes].exact_hits, rows[probes].found_hits)
    one = approximate_top_k(asked.filter("query_id = 3"), filed, cells, probes=2)
    one.explain()
    assert re.search(r"PartitionFilters: \[cell#\d+ IN", capsys.readouterr().out)
    assert ranked(approximate_top_k(asked, filed, cells, probes=99)) == ranked(exact)


def test_cells_need_points(spark):
    empty = spark.createDataFrame([(1, [0.0, 0.0])], "id long, embedding array<float>")
    with pytest.raises(ValueError):
        Cells.train(empty, 4)


def test_hits_as_array_and_empty_hits(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (1, 3, ""), (2, 1, None)], "query_id int, rank int, text string"
    )
    assert hits_as_array(drop_empty_hits(hits)).collect() == [(1, ["a", "b"])]


def slow_vectors(texts, asked, dim):
    import hashlib
    import math

    edge = ".,;:!?()[]\""
    terms = lambda t: [w.strip(edge) for w in t.lower().split() if w.strip(edge)]
    slot = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:4], 16)
    frequency = {}
    for t in texts:
        for s in {slot(w) for w in terms(t)}:
            frequency[s] = frequency.get(s, 0) + 1
    out = []
    for t in asked:
        v = np.zeros(dim)
        for w in terms(t):
            v[slot(w) % dim] += math.log((len(texts) + 1) / (frequency.get(slot(w), 0) + 1))
        out.append(v / np.linalg.norm(v) if v.any() else v)
    return np.array(out)


def test_hashed_idf(spark):
    texts = ["The cat, the dog.", "a cat", "", "Über (alles) cat!", "the end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    encoder = HashedIdf(dim=16).fit(df)
    asked = [*texts, "unseen words", "cat cat dog"]
    found = encoder.encode(spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "i int, text string"))
    got = np.array([r.embedding for r in found.orderBy("i").collect()])
    assert got == pytest.approx(slow_vectors(texts, asked, 16), abs=1e-6)


def test_hashed_idf_by_configuration(spark):
    one, two = ["the cat", "the dog", "a dog"], ["cat", "cat", "the end", "bird"]
    rows = [("one", i, t) for i, t in enumerate(one)] + [("two", i, t) for i, t in enumerate(two)]
    df = spark.createDataFrame(rows, "config string, i int, text string")
    found = HashedIdf(dim=16, by="config").fit(df)
    got = {(r.config, r.i): r.embedding for r in found.encode(df).collect()}
    for name, texts in (("one", one), ("two", two)):
        expected = slow_vectors(texts, texts, 16)
        for i in range(len(texts)):
            assert got[name, i] == pytest.approx(expected[i], abs=1e-6)


def test_unknown_group_and_unfitted_encoder(spark):
    df = spark.createDataFrame([("one", "the cat"), ("new", "the cat")], "config string, text string")
    with pytest.raises(ValueError):
        HashedIdf(dim=16, by="config").encode(df)
    fitted = HashedIdf(dim=16, by="config").fit(df.filter("config = 'one'"))
    found = {r.config: r.embedding for r in fitted.encode(df).collect()}
    assert sum(x != 0 for x in found["new"]) == 2 and np.linalg.norm(found["new"]) == pytest.approx(1)


def test_counts_add_up(spark):
    """Counts of two halves, put together, fit the same encoder; staged slots too."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["the cat", "the dog", "a dog", ""])], "i int, text string")
    parts = [slot_counts(df.filter(f"i % 2 = {k}")) for k in (0, 1)]
    summed = parts[0].unionByName(parts[1]).groupBy("group", "slot").agg(F.sum("count").alias("count"))
    whole = HashedIdf(dim=16).fit(df)
    assert (HashedIdf(dim=16).fit_counts(summed).weights[None] == whole.weights[None]).all()
    staged = stage(with_slots(df), "slots")
    assert (HashedIdf(dim=16).fit(staged).weights[None] == whole.weights[None]).all()
    same = lambda d: [r.embedding for r in whole.encode(d).orderBy("i").collect()]
    assert same(staged) == same(df)


def test_user_encoder_batches(spark):
    def load():
        def encode(texts):
            assert 0 < len(texts) <= 4
            return np.array([[len(t), len(texts)] for t in texts], dtype=float)

        return encode

    df = spark.createDataFrame(
        [("c", "f", i, "x" * i) for i in range(1, 12)], "config string, source_file string, chunk_id int, text string"
    ).coalesce(1)
    points = to_points(UserEncoder(load, batch_size=4).encode(df), ids="plain")
    rows = points.orderBy("chunk_id").collect()
    assert [r.id for r in rows][:2] == ["f_1", "f_2"]
    assert all(np.hypot(*r.embedding) == pytest.approx(1) for r in rows)
    assert rows[0].embedding == pytest.approx(np.array([1, 4]) / np.hypot(1, 4))
    assert rows[-1].embedding == pytest.approx(np.array([11, 3]) / np.hypot(11, 3))


def test_vectors_that_are_not_finite_hide_no_hits(spark):
    rows = [(f"p{i}", [float(i), 1.0]) for i in range(10)] + [(f"n{i}", [float("nan"), 0.0]) for i in range(3)]
    points = spark.createDataFrame(rows, "id string, embedding array<float>").coalesce(1)
    questions = spark.createDataFrame([("q", [0.0, 1.0])], "query_id string, embedding array<float>")
    hits = top_k(questions, points, 3, "l2").orderBy("rank").collect()
    assert [h["id"] for h in hits] == ["p0", "p1", "p2"]


def test_many_equal_vectors_keep_the_first_ids(spark):
    points = spark.range(3000).selectExpr("lpad(id, 5, '0') AS id", "array(1f, 0f) AS embedding", "repeat('x', 500) AS text")
    questions = spark.range(200).selectExpr("id AS query_id", "array(1f, 0f) AS embedding")
    hits = top_k(questions, points, 2, carry=["text"])
    assert {(h["rank"], h["id"]) for h in hits.select("rank", "id").collect()} == {(1, "00000"), (2, "00001")}
    assert hits.count() == 400


def test_few_questions_are_sent(spark, vectors, monkeypatch):
    """Up to `SENT` questions, in several blocks, meet points that were never packed; more meet
    packed slices. Both give the hits of a search by brute force."""
    points, questions = frames(spark, vectors)
    packed, plain = [], retrieval._packed
    monkeypatch.setattr(retrieval, "_packed", lambda df, rows, name: (packed.append(name), plain(df, rows, name))[1])
    monkeypatch.setattr(retrieval, "BLOCK", 5)
    monkeypatch.setattr(retrieval, "SLICE", 40)
    for sent, names in ((100, ["block"]), (4, ["block", "points"])):
        monkeypatch.setattr(retrieval, "SENT", sent)
        for metric in ("cosine", "l2"):
            packed.clear()
            assert ranked(top_k(questions, points, 4, metric)) == brute(vectors, 4, metric, False)
            assert packed == names


_ODD_TEXTS = ["Alpha beta\talpha ALPHA. ", None, "", "   ", "(x) x\x1cx\x85y　ΟΔΟΣ ΟΔΟΣ.", "... [a] \"\" a\n\nb"]


def test_slots_are_those_of_the_terms(spark, capsys):
    """The same slots as the native expressions give, without hashing each word in one."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_ODD_TEXTS)], "i int, text string").repartition(1)
    rows = with_slots(df).withColumn("native", F.transform(terms(F.col("text")), slot)).collect()
    assert len(rows) == len(_ODD_TEXTS) and all(r.slots == r.native for r in rows)
    with_slots(df).explain()
    assert "md5" not in capsys.readouterr().out


def test_slots_are_counted_by_batch(spark, capsys):
    """One row per slot and batch, not per slot and chunk; null groups count as one."""
    df = spark.createDataFrame(
        [(["a", "b", None][i % 3], t) for i, t in enumerate(_ODD_TEXTS * 2)], "config string, text string")
    counts = slot_counts(with_slots(df), by="config")
    counts.explain()
    assert "Generate" not in capsys.readouterr().out
    expected = {}
    for r in df.withColumn("s", F.transform(terms(F.col("text")), slot)).collect():
        for s in {*r.s, -1}:
            expected[r.config, s] = expected.get((r.config, s), 0) + 1
    assert {(r["group"], r["slot"]): r["count"] for r in counts.collect()} == expected


def test_slots_are_not_moved_one_by_one(spark, capsys):
    df = with_slots(spark.createDataFrame([("a", "x y"), ("b", "x")], "config string, text string"))
    HashedIdf(by="config").fit(df).encode(df).explain()
    assert "lambda" not in capsys.readouterr().out


def test_many_values_prune_the_points_before_the_search(spark, vectors, monkeypatch, capsys):
    monkeypatch.setattr(retrieval, "_LISTED", 1)
    p, q = frames(spark, vectors)
    top_k(q.filter("source_file IS NOT NULL"), p, 5, filters=["source_file"]).explain()
    assert "LeftSemi" in capsys.readouterr().out


@pytest.mark.parametrize("name", ["m3_m5_own_file", "m7_report_own_file"])
def test_samples_are_made_once(spark, sf, monkeypatch, name):
    """The documents are looked through for passages once, not again by each step that uses them."""
    made, gold = [], search.gold
    monkeypatch.setattr(search, "gold", lambda *a: made.append(a) or gold(*a))
    assert catalog.QUERIES[name](spark, sf).count() == 1
    assert len(made) == 1
