"""The training-data operators against plain versions, on small and on awkward tables."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from docquarry.llm import decontamination, kneser_ney, language_id, packing, pii, quality_rules, simhash, substring_dedup
from docquarry.llm import license_scan as license_templates
from docquarry.llm.license_scan import license_scan
from docquarry.llm.queries import QUERIES, SQL, tokenizer_path
from docquarry.llm.substring_dedup import difference_cover, repeated_strings
from docquarry.llm.token_counts import allot, line_sections, section_counts

AWKWARD = [
    (9000, None, "en"), (9001, "", "en"), (9002, " \n\t ", None), (9003, "one", "en"), (9004, "one", "en"), (9004, "one", "en"),
    (None, "a b c a b c", "fr"), (9005, "x" * 30_000, "en"), (9006, "é ß 漢字 🙂 <|endoftext|> 1.2.3.4", "de"),
    (9007, "the cat sat. " * 400, "en"), (9008, "a  b\n\n c \t d \r\n", "es"),
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    # Columns with the operators' own result names come along.
    rows = [(i, t, x, "src", 1, "?", 7, "a", "b", 1, 2) for i, t, x in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars int, kept string, score int,"
        " N_WORDS string, Fingerprint string, _sections int, _l int")


@pytest.fixture(scope="module")
def texts(docs, awkward):
    return [r for d in (docs, awkward) for r in d.select("doc_id", "text", "lang").collect()]


def both(docs, awkward):
    names = ["doc_id", "text", "lang"]
    return docs.select(*names).unionByName(awkward.select(*names))


def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(docs, awkward):
    found = quality_rules.quality_rules(both(docs, awkward)).collect()
    assert len(found) == docs.count() + len(AWKWARD)
    for r in found:
        assert plain_measures(r["text"]) == tuple(r[c] for c in quality_rules.RESULTS[:5])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_quality_rules_equal_sql(spark, size):
    folder = f"/root/testdata/sf{size}"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = QUERIES["op1_quality_rules"](spark, folder)
    columns = sorted(df.columns)
    found = connection.execute(f"SELECT {', '.join(columns)} FROM ({SQL['op1_quality_rules']})")
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert {c[0]: str(c[1]) for c in found.description} == {c: kinds[t] for c, t in df.dtypes}
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))


def test_quality_many_repeated_windows(spark):
    # More than 500 different repeated windows: the second way to find their places.
    text = " ".join(str(i) for i in range(700)) + " - " + " ".join(str(i) for i in range(700))
    row = quality_rules.quality_rules(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    assert row["n_repeat_words"] == plain_measures(text)[4] == 1400


def test_jensen_shannon(spark):
    from pyspark.sql import functions as F

    p, q = F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))
    same, apart = spark.range(1).select(quality_rules.jensen_shannon(p, p), quality_rules.jensen_shannon(p, q)).first()
    assert (same, apart) == (0.0, 1.0)


def plain_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low.get(find(i)) for i in range(len(ids))]


def test_simhash_groups(docs, awkward, texts):
    found = simhash.simhash_groups(both(docs, awkward)).collect()
    prints = [plain_fingerprint(r["text"]) for r in texts]
    expected = zip([r["doc_id"] for r in texts], prints, plain_components([r["doc_id"] for r in texts], prints))
    got = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_simhash_pairs_are_complete(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63, 40)
    bits = {int(x) for x in base} | {int(np.int64(x) ^ np.int64(1) << np.int64(int(a)) ^ np.int64(1) << np.int64(int(b)))
                                     for x in base for a, b in rng.integers(0, 63, (6, 2))} | {0, -1, 1, -2**63}
    found = simhash.near_pairs(spark.createDataFrame([(x,) for x in bits], "bits long")).distinct().collect()
    mask = (1 << 64) - 1
    expected = {(a, b) for a in bits for b in bits if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert {tuple(r) for r in found} == expected


@pytest.mark.parametrize("max_bits", [3, 4])
def test_simhash_pairs_at_more_bits(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    flip = lambda x, n: int(np.int64(x) ^ np.bitwise_or.reduce(np.int64(1) << rng.choice(64, n, replace=False).astype(np.int64)))
    base = [int(x) for x in rng.integers(-2**63, 2**63, 12)] + [0, -1]
    bits = set(base) | {flip(x, n) for x in base for n in range(1, 6)} | {0x7000000000000000, 0x7, -2**63, -2**60}
    found = simhash.near_pairs(spark.createDataFrame([(x,) for x in bits], "bits long"), max_bits).distinct().collect()
    mask = (1 << 64) - 1
    expected = {(a, b) for a in bits for b in bits if a < b and ((a ^ b) & mask).bit_count() <= max_bits}
    assert {tuple(r) for r in found} == expected
    with pytest.raises(ValueError):
        simhash.near_pairs(spark.createDataFrame([], "bits long"), 7)


def test_one_of_each(docs, awkward, texts):
    kept = simhash.one_of_each(both(docs, awkward)).collect()
    groups = {plain_fingerprint(r["text"]) for r in kept}
    assert len(kept) == len(groups)
    components = set(map(str, plain_components([r["doc_id"] for r in texts], [plain_fingerprint(r["text"]) for r in texts])))
    assert len(kept) == len(components)


def test_language_held_out(spark, sf):
    rows = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.join(lang, "doc_id").filter("held_out").collect()
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_edges(awkward, docs):
    model = language_id.train(docs.select("text", "lang"))
    found = {r["doc_id"]: r for r in language_id.identify(awkward, model).collect()}
    assert [found[i]["lang_pred"] for i in (9000, 9001, 9002)] == ["und"] * 3 and found[9000]["score"] == 0.0
    none = language_id.train(docs.filter("lang IS NULL").select("text", "lang"))
    assert {r["lang_pred"] for r in language_id.identify(awkward, none).collect()} == {"und"}
    many = language_id.codewords(9)
    assert len({tuple(x) for x in many}) == 9


def test_decontamination(spark, docs, sf):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = decontamination.question_and_answer(benchmark)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()}
    inside = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in benchmark.collect() if b["text"] in (d["text"] or "")}
    assert inside <= found
    clean = decontamination.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_decontamination_by_slices(spark, docs, sf, monkeypatch):
    """Scores do not depend on how the index is cut."""
    items = decontamination.question_and_answer(spark.read.parquet(f"{sf}/benchmark.parquet")).limit(12)
    part = items.selectExpr("cast(item_id AS long) AS doc_id", "substring(question, 1, 3 * length(question) div 4) AS text")
    copies = part.unionByName(docs.select("doc_id", "text").limit(50))
    found = lambda: sorted(map(str, decontamination.contaminated(copies, items, 0.4, 0.3).collect()))
    whole = found()
    monkeypatch.setattr(decontamination, "SLICE", 3)
    assert found() == whole and whole


def test_decontamination_is_exhaustive():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["the"] * 60
    some = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, some(int(n)), None) for i, n in enumerate(rng.integers(3, 200, 60))]
    index = decontamination.Index(items, 0.6)
    for i, q, _ in items:
        words = decontamination._words(some(90) + " " + q + " " + some(150))
        assert i in index.candidates(words)
        # Every part that reaches the threshold in some passage is found.
        assert all(x >= 0.6 - 1e-6 for x in index.candidates(words).values())
    assert index.candidates([]) == {} and not list(index.matches(None, 0.8))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_pii(text):
    spans = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(spans))


def test_pii_base_spans(spark, docs, awkward):
    odd = [
        "a@b.c_x@d.e", "x@y", "é🙂 me.you@site-1.example.com, 010.1.1.255 1.2.3.256 1.2.3.4.5", "4111 1111 1111 1111 +49 (30) 123-4567",
        "+4915112345678 4111111111111112", "5" * 40_000, "a." * 20_000, "1." * 20_000 + "@", ("9@a.b " * 700).strip(),
    ]
    extra = spark.createDataFrame([(1000 + i, t, "en") for i, t in enumerate(odd)], "doc_id long, text string, lang string")
    found = pii.find_pii(both(docs, awkward).unionByName(extra).selectExpr("*", "text AS t")).select("t", pii.digest(pii.F.col("base_spans")).alias("x"))
    for r in found.collect():
        assert r["x"] == plain_pii(r["t"])


def test_pii_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"word{i} please write to user{i}@mail.example.com today or later number {i}") for i in range(12)]
    rows.append((99, "now please write to sales-at-4455 today or later"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs).collect()}
    assert [tuple(s) for s in found[99]] == [("email", 20, 33)]
    assert all(len(found[i]) == 1 for i in range(12))
    assert pii.redact(docs).filter("doc_id = 99").first()["text"] == "now please write to [EMAIL] today or later"


def test_pii_redact(spark, awkward):
    docs = spark.createDataFrame([(1, "to a@b.co from 1.2.3.4."), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()} == {1: "to [EMAIL] from [IP].", 2: None}
    assert pii.redact(awkward).columns == awkward.columns


def test_repeats(spark, docs, awkward):
    rng = np.random.default_rng(1)
    noise = lambda n: bytes(rng.integers(97, 123, n)).decode()
    shared = noise(900)
    made = [noise(300) + shared[:400] + noise(50), shared[:399] + noise(20), noise(7) + shared, "ab" * 500, noise(500) + "é" * 250]
    extra = spark.createDataFrame([(2000 + i, t, "en") for i, t in enumerate(made)], "doc_id long, text string, lang string")
    rows = both(docs, awkward).unionByName(extra)
    all_texts = [(r["text"] or "").encode() for r in rows.collect()]
    seen = Counter(t[i:i + 400] for t in all_texts for i in range(len(t) - 399))

    def plain(t):
        covered = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                covered[i:i + 400] = True
        kept = bytes(c for c, x in zip(t, covered) if not x)
        return len(t), int(covered.sum()), int((np.diff(np.append(0, covered.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()

    expected = sorted(map(plain, all_texts))
    found = repeated_strings(rows).collect()
    assert sorted((r["n_bytes"], r["n_removed"], len(r["removed"]), r["kept_sha256"]) for r in found) == expected


def plain_repeats(texts, n=400):
    """(n_bytes, spans) of each text, by counting all n-byte strings."""
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        spans = []
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + n)
                else:
                    spans.append((i, i + n))
        out.append((len(t), spans))
    return sorted(out)


def test_repeats_at_the_ends_of_runs(spark):
    """Passages of 399 to 900 bytes between different neighbours, at a text's start and end,
    in two and more texts, twice in one text, and with one byte changed."""
    rng = np.random.default_rng(5)
    noise = lambda n: bytes(rng.integers(97, 101, n).astype("u1")).decode()
    made = []
    for n in (399, 400, 401, 407, 414, 415, 416, 430, 500, 650, 900):
        p = noise(n)
        made += [noise(3) + p + noise(700), p + noise(30), noise(500) + p, noise(90) + p + noise(60) + p[:-1], p[1:] + noise(9)]
        made += [noise(40) + p[:n // 2] + "z" + p[n // 2 + 1:] + noise(40)]
    made += ["ab" * 450 + noise(100), noise(20) + "ab" * 300, "abc" * 200, noise(5000), noise(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string").repartition(5)
    found = repeated_strings(docs).collect()
    expected = plain_repeats([t.encode() for t in made])
    assert sorted((r["n_bytes"], [(s["start"], s["end"]) for s in r["removed"]]) for r in found) == expected
    assert sum(len(s) for _, s in expected) > 40


def test_repeats_show_which_passages_went(spark, tmp_path):
    """The 400 bytes decide, not the words: cut by its spans, a text loses a passage of 60 long
    words and keeps one of 60 short ones; n_bytes tells neither."""
    rng = np.random.default_rng(7)
    words = lambda n, size: " ".join(bytes(rng.integers(97, 123, size).astype("u1")).decode() for _ in range(n))
    long, short, line = words(60, 9), words(60, 5), words(2, 210)
    made = [f"é {words(30, 6)} {p} {words(20, 6)} ß" for p in (long, long, short, short, line, line)] + [words(80, 8), words(70, 8), None]
    spark.createDataFrame([*enumerate(made)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op9_substring_dedup"](spark, str(tmp_path)).collect()}
    assert len(short) < 400 < len(line) < len(long) and len(rows) == len(made)
    for i, text in enumerate(made):
        r, octets = rows[i], (text or "").encode()
        spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]
        kept = b"".join(octets[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(octets)]))
        assert r["n_bytes"] == len(octets) and r["n_spans"] == len(spans) and r["n_removed"] == len(octets) - len(kept)
        assert hashlib.sha256(kept).hexdigest() == r["kept_sha256"]
        assert not any(p.encode() in kept for p in (long, line)) and (short.encode() in kept) == (i in (2, 3))
        assert (len(spans) > 0) == (i in (0, 1, 4, 5))


def test_repeats_name_runs(spark, monkeypatch):
    """Long passages in two texts each cost a few bytes of names per byte, not a name per start."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    noise = lambda n: bytes(rng.integers(97, 123, n).astype("u1")).decode()
    made = [noise(200) + p + noise(200) for p in (noise(30_000) for _ in range(20)) for _ in "ab"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    sizes = []
    for name in ("_repeated", "_judged"):
        def spy(packed, then=getattr(substring_dedup, name, None)):
            sizes.append(packed.agg(F.sum(F.octet_length("once") + F.octet_length("more"))).first()[0])
            return then(packed)

        monkeypatch.setattr(substring_dedup, name, spy, raising=False)
    found = repeated_strings(docs).collect()
    assert all(30_000 <= r["n_removed"] < 30_010 for r in found) and len(found) == 40
    assert 0 < sum(sizes) < 3 * sum(map(len, made))


def test_difference_covers():
    for r in (1, 2, 3):
        period, cover = difference_cover(r)
        assert {int(a - b) % period for a in cover for b in cover} == set(range(period))


def test_packing(docs, awkward, texts):
    pieces = packing.token_pieces(both(docs, awkward).drop("lang"), tokenizer_path())
    rows = packing.pack(pieces).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    whole = Counter(np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for r in texts)
    by_document = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and (r["piece"] == 0 or r["length"] == 1024)
        by_document.setdefault(r["doc_id"], []).append(r)
    single = Counter(b"".join(r["ids"] for r in sorted(v, key=lambda r: r["piece"])) for k, v in by_document.items() if k != 9004)
    single[np.array(tokenizer.encode("one").ids + [2], "<u4").tobytes()] += 2
    assert single == whole
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 1024
    assert len(ends) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 2


def test_fullest_is_exact():
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(60):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 30, 4), rng.integers(1, 4, 4))}
        room = int(rng.integers(0, 60))
        best = max(s for ks in product(*(range(c + 1) for c in counts.values())) if (s := sum(n * k for n, k in zip(counts, ks))) <= room)
        chosen = packing.fullest(counts, room)
        assert sum(n * k for n, k in chosen.items()) == best and all(k <= counts[n] for n, k in chosen.items())


def test_token_counts(docs, awkward, texts):
    from pyspark.sql import functions as F

    rows = section_counts(both(docs, awkward).drop("lang"), line_sections(F.col("text")), tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert sum(r["n_tokens"] for r in rows) == sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in texts)


def test_crossing_tokens():
    spans = np.array([[0, 4], [4, 9], [9, 10], [10, 14], [14, 16], [20, 22]])
    owned, crossed = allot(spans, np.array([0, 6, 12]), np.array([6, 12, 16]))
    # 4-9 holds two characters of the first and three of the second; 10-14 two of each.
    assert owned.tolist() == [1, 3, 1, 1] and crossed.tolist() == [0, 2, 0, 0]


def test_licences(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.txt", "some words here"), ("a/b/y.txt", "text\nLicensed under CC BY-NC 4.0."),
        ("z/w.txt", "nothing"), ("a/b/c/COPYING", "Licensed under the Apache License, Version 2.0."), (None, None), ("a/b/v.txt", "The licence of the city"),
    ]
    found = {r["path"]: (r["own_licence"], r["licence"], r["licence_from"]) for r in license_scan(
        spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["a/LICENSE"] == ("MIT", "MIT", "own")
    assert found["a/b/c/x.txt"] == (None, "Apache-2.0", "a/b/c")
    assert found["a/b/y.txt"] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "own")
    assert found["a/b/v.txt"][0] is None and found["z/w.txt"] == (None, None, None) and found[None] == (None, None, None)


def plain_cosine(text, template, texts):
    """TF-IDF cosine of a passage and a template, as the operator's formula says."""
    term = lambda t: Counter(re.findall(license_templates._TERM, t.lower()))
    df = Counter(x for t in texts for x in term(t))
    weigh = lambda c: {x: (1 + np.log(n)) * (np.log((len(texts) + 1) / (df[x] + 1)) + 1) for x, n in c.items()}
    a, b = weigh(term(text)), weigh(term(template))
    norm = lambda v: np.sqrt(sum(x * x for x in v.values()))
    return sum(x * b.get(t, 0) for t, x in a.items()) / norm(a) / norm(b)


@pytest.mark.parametrize("comment, width", [("", 60), ("# ", 44), (" * ", 72), ("// ", 30)])
def test_wrapped_notices(spark, comment, width):
    """Every template, wrapped as a header would be, between other lines, is found under its name."""
    import textwrap

    rows, expected = [], {}
    for name, texts in license_templates.TEMPLATES.items():
        for k, t in enumerate(texts):
            lines = [t] if t.startswith("SPDX") else textwrap.wrap(t, width, break_on_hyphens=False)
            lines = [comment + line for line in lines]
            rows.append((f"{name}/{k}", "\n".join([comment + "Some module of ours.", comment, *lines, comment, "value = 1", "x = 2"])))
            expected[f"{name}/{k}"] = name
    rows.append(("prose", "The licence\nof the city. Permission came\nlate in the year. " + "word " * 900))
    rows.append(("long", "word " * 395 + "Licensed under CC BY-NC 4.0. " + "word " * 700))
    found = {r["path"]: r["own_licence"] for r in license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found.pop("prose") is None and found.pop("long") is None  # a notice is no tenth of the long line
    assert found == expected


def test_cosines_by_hand(spark):
    texts = [t for some in license_templates.TEMPLATES.values() for t in some]
    lines = ["Licensed under the Apache License, Version 2.0 and more", "licensed under CC BY-SA 4.0", "SPDX-License-Identifier: MIT", "Released by us"]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(lines)], "row long, line int, text string")
    found = {r["line"]: (r["licence"], r["cosine"]) for r in license_templates.own_licences(df, 0.3).collect()}
    for i, line in enumerate(lines):
        best = max((round(plain_cosine(line, t, texts), 9), name) for name, some in license_templates.TEMPLATES.items() for t in some)
        if best[0] >= 0.3:
            assert found[i][1] == pytest.approx(best[0], abs=1e-8)
    assert found[2] == ("MIT", 1.0)


def test_kneser_ney_adds_up(spark):
    rows = [("en", "abracadabra"), ("en", "the cat sat on the mat"), ("en", "aab")]
    model = kneser_ney.train(spark.createDataFrame(rows, "lang string, text string"))
    (_, _, shards), = kneser_ney._shards(model)
    shard = shards["en"]
    seen = [chr(p) for p in shard.points if p != 2]
    for history in ("", "a", "ab", "abr", "the ", "zzz"):
        mass = sum(np.exp(shard.score(history + c)[0] - shard.score(history)[0]) for c in [*seen, "\x7f"])
        assert abs(mass - 1) < 1e-6


def test_kneser_ney_shards_agree(spark, docs, monkeypatch):
    trusted = docs.filter("doc_id % 2 = 0").select("doc_id")
    one = {r["doc_id"]: r["perplexity"] for r in kneser_ney.classify(docs, trusted).collect()}
    monkeypatch.setattr(kneser_ney, "SHARD", 8_000)
    for r in kneser_ney.classify(docs, trusted).collect():
        assert abs(r["perplexity"] - one[r["doc_id"]]) < 1e-6 * one[r["doc_id"]]


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_tables(spark, awkward, empty):
    """Nulls, repeated rows and clashing names everywhere; and no rows at all."""
    docs = awkward.filter("false") if empty else awkward
    n = docs.count()
    ids = docs.select("doc_id")
    items = spark.createDataFrame([(1, "x y", None), (None, None, None)], "item_id long, question string, answer string")
    from pyspark.sql import functions as F

    assert quality_rules.quality_rules(docs).count() == n
    assert license_scan(docs.withColumn("path", F.col("source"))).count() == n
    assert simhash.simhash_groups(docs).count() == n
    assert kneser_ney.classify(docs, ids).count() == n
    assert pii.find_pii(docs).count() == n
    assert language_id.identify(docs, language_id.train(docs.select("text", "lang"))).count() == n
    assert repeated_strings(docs).count() == n
    assert decontamination.decontaminate(docs, items).count() == n
    assert packing.pack(packing.token_pieces(docs, tokenizer_path())).filter("piece = 0").count() == n
    assert section_counts(docs, line_sections(F.col("text")), tokenizer_path()).filter("section = -1").count() == n


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for _, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), corpus_pipeline.stage(function(spark, docs, sf), "test")
        assert docs.columns == names and docs.count() <= before
    assert not any(plain_pii(r["text"]) for r in docs.collect())
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}


def test_documents_of_ids(spark):
    """The bitmaps give exactly the rows of the listed ids, over several ranges, signs and nulls."""
    draw = np.random.default_rng(6)
    some = {0, 1, -1, 32767, 32768, 32769, 65536, -32768, -32769, *map(int, draw.integers(-200_000, 200_000, 300))}
    listed = {i for i in some if i % 3}
    docs = spark.createDataFrame([(i, "x") for i in some] * 2 + [(None, "y")], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in listed], "doc_id long")
    found = kneser_ney._of_ids(docs, ids)
    assert found.columns == docs.columns
    assert sorted(r["doc_id"] for r in found.collect()) == sorted([*listed, *listed])
    named = docs.selectExpr("cast(doc_id AS string) AS doc_id", "text")
    assert kneser_ney._of_ids(named, ids.selectExpr("cast(doc_id AS string) AS doc_id")).count() == 2 * len(listed)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_on_awkward_tables(spark, sf, awkward, empty):
    """Nulls, repeated rows, no `n_chars`, foreign columns; each stage on its own, and no rows at all."""
    long_text = " ".join(f"word{i} item{7 * i} thing{3 * i} number{i}." for i in range(40))
    good = [(9100, long_text, "en"), (9100, long_text, "en"), (9101, long_text + " Write to jane.doe@example.org now.", None)]
    extra = spark.createDataFrame([(*r, "src", "?", 7, "a", "b", 1, 2) for r in good], awkward.drop("n_chars").schema)
    docs = awkward.drop("n_chars").unionByName(extra)
    docs = docs.filter("false") if empty else docs
    rows = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        found = function(spark, docs, sf)
        assert found.columns == docs.columns
        rows[name] = sorted(map(str, found.collect()))
    packed = corpus_pipeline.packing(spark, docs, sf).collect()
    if empty:
        assert not any(rows.values()) and not packed
        return
    given = sorted(map(str, docs.collect()))
    assert [r for r in rows["quality_rules"] if "doc_id=9100" in r] == [r for r in given if "doc_id=9100" in r]
    assert not any(f"doc_id={i}," in r for r in rows["quality_rules"] for i in (9000, 9001, 9002, 9003))
    kept = rows["simhash_near_dedup"]
    assert len(kept) == len(set(kept)) < len(given) and set(kept) <= set(given)
    assert sum("doc_id=9004" in r or "doc_id=9003" in r for r in kept) == 1
    assert rows["benchmark_decontamination"] == given
    assert sum("jane.doe@example.org" in r for r in rows["pii"]) == 0 and len(rows["pii"]) == len(given)
    assert sum("text=None" in r for r in rows["pii"]) == 1
    assert sum(r["piece"] == 0 for r in packed) == len(given)
