import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docquarry.functions.places import by_places, places
from docquarry.operators.elements import (
    clean_elements, convert_tables, normalize_elements, prepare_elements, split_failures, stage_counters,
)
from docquarry.schemas import ELEMENT
from docquarry import session
from docquarry.session import scratch_path, shared_folder, stage
from docquarry.sources.collections import Collection, last_write
from docquarry.sources.elements import (
    elements_from_html, elements_from_json, elements_from_text, list_raw, read_json_files,
    read_samples, require_supported,
)
from docquarry.sources.stages import append_progress, in_waves, load_chunks, remaining, write_stage


def test_list_raw(spark, tmp_path):
    for name in ("a.pdf", "b.DOC", "c.docx", "d.txt", "pdf", "e.pdf.bak"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "dir.pdf").mkdir()
    (tmp_path / "dir.pdf" / "inner.pdf").write_bytes(b"x")
    found = {r.path.rsplit("/", 1)[1] for r in list_raw(spark, str(tmp_path)).select("path").collect()}
    assert found == {"a.pdf", "b.DOC", "c.docx"}


def test_unsupported_kind_fails(spark):
    df = spark.createDataFrame([("x.PDF",)], "p string")
    assert df.select(require_supported(F.col("p"))).first()[0] == ".pdf"
    with pytest.raises(Exception, match="Unsupported file type: .txt"):
        spark.createDataFrame([("x.txt",)], "p string").select(require_supported(F.col("p"))).collect()


TABLE = "<table><tr><th>A</th></tr><tr><td>1</td></tr></table>"
FILES = {
    "good_pdf.json": json.dumps([
        {"type": "Title", "text": "  Hello  world ", "element_id": "1", "metadata": {"filename": "Intro_C1.pdf"}},
        "a string", 5, None, [1],
        {"type": "Text", "text": 7},
        {"type": "Text", "text": "  "},
        {"type": "Table", "text": "A 1", "metadata": {"filename": "Intro_C1.pdf", "text_as_html": TABLE}},
        {"type": "Table", "text": "", "metadata": {"text_as_html": TABLE}},
        {"type": "Table", "text": "plain", "metadata": {"filename": "Plan.pdf", "text_as_html": ""}},
    ], indent=2, ensure_ascii=False),
    "broken.json": '[{"text": "a"},',
    "object.json": '{"text": "a"}',
    "trailing.json": '[{"text": "a"}] and more',
    "empty.json": "[]",
    "notes.txt": "[]",
}


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parsed")
    for name, content in FILES.items():
        (folder / name).write_text(content, encoding="utf-8")
    return elements_from_json(read_json_files(spark, str(folder)))


def test_json_elements(spark, parsed):
    elements, bad = parsed
    assert elements.schema == ELEMENT or elements.schema.simpleString() == ELEMENT.simpleString()
    assert {r.source_file for r in bad.collect()} == {"broken.json", "object.json", "trailing.json"}
    rows = elements.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(10))
    assert rows[0].text == "  Hello  world " and rows[0].metadata.filename == "Intro_C1.pdf"
    assert [r.text for r in rows[1:6]] == [None] * 5


def test_cleaning_and_normalising(spark, parsed):
    elements, _ = parsed
    assert [r.text for r in clean_elements(elements).orderBy("seq").collect()] == ["Hello world", "A 1", "plain"]
    done = [tuple(r)[2:] for r in prepare_elements(elements).orderBy("seq").collect()]
    assert done == [
        ("Title", "Hello world", "Intro", "C1"),
        ("markdown_text", "| A |\n| --- |\n| 1 |", "Intro", "C1"),
        ("Table", "plain", "Plan.pdf", None),
    ]
    # Without cleaning first, a table's Markdown stands in for its missing text.
    loose = normalize_elements(convert_tables(elements)).filter("type = 'markdown_text'")
    assert loose.count() == 2


def test_counters(spark, parsed):
    row = stage_counters(parsed[0]).first()
    assert (row.processed, row.removed, row.remaining, row.converted, row.normalized) == (10, 7, 3, 1, 3)


def test_text_and_html(spark):
    df = spark.createDataFrame([("f", "a\n\n b \nc", "n.pdf")], "f string, t string, n string")
    rows = elements_from_text(df, F.col("f"), F.col("t"), F.col("n")).orderBy("seq").collect()
    assert [(r.seq, r.text) for r in rows] == [(0, "a"), (1, ""), (2, " b "), (3, "c")]
    page = (
        "<html><head><title>T &amp;lt; x</title><style>p{}</style>\n<script>var t='</p>';</script></head>"
        "<body><!-- <p>no</p> --><h1>Head</h1><ul><li>one<li><b>t</b>wo</ul><p>open <i>text</i><p>next<br>line"
        "<div> </div>&copy;&middot;&#39;</body>"
    )
    html = spark.createDataFrame([("p", page)], "f string, h string")
    rows = elements_from_html(html, F.col("f"), F.col("h")).orderBy("seq").collect()
    assert [(r.type, r.text) for r in rows] == [
        ("Title", "T &lt; x"), ("Title", "Head"), ("ListItem", "one"), ("ListItem", "two"),
        ("NarrativeText", "open text"), ("NarrativeText", "next"), ("NarrativeText", "line"),
        ("NarrativeText", "©·'"),
    ]


def test_samples_from_json(spark, tmp_path):
    data = [{"question": f"q{i}", "ground_truth_answer": "a", "reference_text": "r", "source_file": "s"} for i in range(12)]
    (tmp_path / "x.json").write_text(json.dumps(data) + "\n")
    (tmp_path / "y.json").write_text("[3, " + json.dumps(data[0]) + "]")
    (tmp_path / "broken.json").write_text(json.dumps(data)[:-1])
    (tmp_path / "blank.json").write_text("\n")
    (tmp_path / "notes.txt").write_text("[]")
    samples, bad = read_samples(spark, str(tmp_path))
    rows = {r.sample_id: r.question for r in samples.collect()}
    assert rows == {**{f"x.json#{i}": f"q{i}" for i in range(12)}, "y.json#0": None, "y.json#1": "q0"}
    assert {r.data_set for r in bad.collect()} == {"broken.json", "blank.json"}


def test_stage_tables(spark):
    path = scratch_path(spark, "stage")
    df = spark.createDataFrame([("a", "f", 0, "x"), ("b", "f", 0, "y")], "config string, source_file string, chunk_id int, text string")
    write_stage(df, path)
    write_stage(df.filter("config = 'a'").withColumn("text", F.lit("z")), path)
    assert {(r.config, r.text) for r in load_chunks(spark, path).collect()} == {("a", "z"), ("b", "y")}
    assert [r.text for r in load_chunks(spark, path, "b").collect()] == ["y"]


def test_progress(spark):
    path = scratch_path(spark, "progress")
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    append_progress(work.filter("source_file = 'a'"), path)
    append_progress(work.filter("source_file = 'c'"), path)
    assert [r[0] for r in remaining(work, spark.read.parquet(path)).collect()] == ["b"]


def test_waves(spark):
    """A run that dies in its second wave keeps the first; the rerun does only the rest."""
    path, schema = scratch_path(spark, "waves"), "source_file string, n long"
    work = spark.createDataFrame([(f"f{i}",) for i in range(40)] + [("no row",)], "source_file string")
    done = []

    def do(wave, last):
        if len(done) == last:
            raise RuntimeError("gone")
        done.append({r[0] for r in wave.collect()})
        return wave.filter("source_file <> 'no row'").withColumn("n", F.lit(1))

    with pytest.raises(RuntimeError):
        in_waves(work, lambda wave: do(wave, 1), path, schema, 10)
    assert {r.source_file for r in spark.read.parquet(path).collect()} == done[0] - {"no row"}
    first = done.pop()
    found = in_waves(work, lambda wave: do(wave, 99), path, schema, 10)
    assert sorted(r.source_file for r in found.collect()) == sorted(f"f{i}" for i in range(40))
    assert not first & set.union(*done) - {"no row"} and len(done) > 1
    done.clear()
    assert in_waves(work, lambda wave: do(wave, 99), path, schema, 10).count() == 40
    assert done == [{"no row"}]
    assert in_waves(work.limit(0), lambda wave: do(wave, 0), path, schema, 10).count() == 0


def test_split_failures(spark):
    df = spark.createDataFrame([(1, "v", None), (2, None, "bad")], "i int, value string, error string")
    good, bad = split_failures(df, "value", "error")
    assert good.collect() == [(1, "v")] and bad.collect() == [(2, "bad")]


def points(spark, rows):
    return spark.createDataFrame(
        [(i, [float(v), 0.0], f"s{i[0]}", at) for i, v, at in rows],
        "id string, embedding array<float>, source_file string, at int",
    )


def values(collection):
    return {r.id: r.embedding[0] for r in collection.read().collect()}


def test_collection(spark):
    root = scratch_path(spark, "collections")
    collection = Collection(spark, root, "c")
    assert not collection.exists()
    with pytest.raises(ValueError):
        collection.properties()
    collection.create(2).create(2)
    assert collection.properties() == {"dim": 2, "metric": "cosine", "version": 0, "deltas": 0}
    with pytest.raises(ValueError):
        Collection(spark, root, "c").create(3)
    with pytest.raises(ValueError):
        collection.read()
    collection.upsert(points(spark, [("a1", 1, 1)]).limit(0))
    assert collection.properties()["version"] == 0
    first = points(spark, [("a1", 1, 1), ("a2", 2, 1), ("b1", 3, 1), ("a1", 4, 2)])
    collection.upsert(first, order=F.col("at"))
    assert values(collection) == {"a1": 4, "a2": 2, "b1": 3}
    again = points(spark, [("a1", 5, 1), ("c1", 6, 1)])
    assert values(collection.upsert(again)) == {"a1": 5, "a2": 2, "b1": 3, "c1": 6}
    assert values(collection.upsert(again)) == {"a1": 5, "a2": 2, "b1": 3, "c1": 6}
    assert values(collection.upsert(again, replace_sources=True)) == {"a1": 5, "b1": 3, "c1": 6}
    assert Collection(spark, root, "c").properties()["version"] == 4


def test_deltas(spark):
    """Reads equal a plain replay of the writes, before and after compaction."""
    draw = random.Random(4)
    collection, kept = Collection(spark, scratch_path(spark, "collections"), "deltas").create(2), {}
    for step in range(7):
        rows = [(f"{draw.choice('abcd')}{draw.randrange(6)}", step * 100 + i, i) for i in range(draw.randrange(1, 6))]
        replaced = step in (2, 5)
        collection.upsert(points(spark, rows), order=F.col("at"), replace_sources=replaced)
        if replaced:
            gone = {i[0] for i, _, _ in rows}
            kept = {i: v for i, v in kept.items() if i[0] not in gone}
        kept |= {i: v for i, v, _ in rows}
        assert values(collection) == kept and collection.read().count() == len(kept)
        assert collection.written().orderBy(F.desc("version")).first().rows == len({r[0] for r in rows})
        if step == 3:
            assert values(collection.compact()) == kept and collection.properties()["deltas"] == 0
    assert collection.compact().compact().properties()["version"] == 9
    with pytest.raises(ValueError):
        collection.create(2, "l2")


def test_wrong_dimension_leaves_the_collection_alone(spark):
    collection = Collection(spark, scratch_path(spark, "collections"), "d").create(2)
    collection.upsert(points(spark, [("a1", 1, 1)]))
    wrong = points(spark, [("a2", 2, 1)]).withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    with pytest.raises(Exception, match="expected 2 dimensions, found 1"):
        collection.upsert(wrong)
    assert values(collection) == {"a1": 1}


def test_ids_that_come_twice_in_a_batch(spark):
    """One row of an id is stored, a null id among them, the one of the greatest hash; a row that is left out may be of any length."""
    schema = "id string, embedding array<float>, source_file string, at int"
    rows = [("a1", [1.0, 2.0], "a", 1), ("a1", [1.0, 2.0], "a", 1), ("a2", [3.0, 0.0], "a", 1), ("a2", [4.0, 0.0], "a", 2),
            (None, [5.0, 0.0], "n", 1), (None, [6.0, 0.0], "n", 2), ("b1", [7.0, 0.0], None, 1)]
    short = spark.createDataFrame([("c", [1.0, 0.0], "c", 0)] + [("c", [1.0], "c", i) for i in range(1, 20)], schema)
    first = short.orderBy(F.xxhash64(*short.columns)).collect()
    longest = next(i for i, r in enumerate(first) if len(r.embedding) == 2)
    rows += [tuple(r) for r in first[:longest + 1]]
    frame = spark.createDataFrame(rows, schema)
    collection = Collection(spark, scratch_path(spark, "collections"), "twice").create(2).upsert(frame)
    expected = sorted(map(str, last_write(frame, F.xxhash64(*frame.columns)).collect()))
    assert sorted(map(str, collection.read().collect())) == expected and len(expected) == 5
    assert len(list(Path(collection.folder.removeprefix("file:")).glob("points-*"))) == 1
    worse = spark.createDataFrame([("c", [1.0], "c", i) for i in range(2)], schema)
    with pytest.raises(Exception, match="expected 2 dimensions, found 1"):
        collection.upsert(worse)
    assert sorted(map(str, collection.read().collect())) == expected


def test_points_in_one_delta_are_not_shuffled(spark):
    """Points are moved for a read only if their id or their source may have come again."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    new = lambda name: Collection(spark, scratch_path(spark, "collections"), name).create(2)
    collection = new("one").upsert(points(spark, [("a1", 1, 1), ("a2", 2, 1)])).upsert(points(spark, [("b1", 3, 1)]), replace_sources=True)
    assert "Exchange" not in plan(collection.read()) and values(collection) == {"a1": 1, "a2": 2, "b1": 3}
    collection.upsert(points(spark, [("a3", 4, 1), ("b2", 5, 1)])).upsert(points(spark, [("a1", 6, 1)]), replace_sources=True)
    collection.upsert(points(spark, [("b2", 7, 1)]))
    for value in (8, 9):
        collection.upsert(points(spark, [("n", value, 1)]).withColumn("id", F.lit(None).cast("string")))
    assert values(collection) == {"a1": 6, "b1": 3, "b2": 7, None: 9}


def test_places(spark):
    """Every row with a key is among those that may have one; nearly no other row is."""
    rows = spark.range(20000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("key"))
    keys = rows.filter("key % 97 = 0 OR key IS NULL")
    held = places(keys, F.xxhash64("key"))
    without, some = by_places(rows, held, F.xxhash64("key"))
    assert held.num_rows <= 131072 and some.columns == rows.columns
    assert without.count() + some.count() == 20000 and some.filter("key % 97 = 0 OR key IS NULL").count() == keys.count() == 207
    assert some.count() < 230
    nothing = places(keys.limit(0), F.xxhash64("key"))
    assert [part.count() for part in by_places(rows, nothing, F.xxhash64("key"))] == [20000, 0]


def test_last_write(spark):
    rows = [("a", 1, 1), ("a", 9, 3), ("a", 5, 2), ("b", 2, 1)]
    assert {(r.id, r.embedding[0]) for r in last_write(points(spark, rows), F.col("at")).collect()} == {("a", 9), ("b", 2)}


def test_shared_folder_is_the_one_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_staged_tables_are_removed(spark, tmp_path, monkeypatch):
    """Only what this application staged goes."""
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    other = tmp_path / "docquarry" / "another-application" / "table"
    other.mkdir(parents=True)
    staged = stage(spark.range(3), "some")
    assert staged.count() == 3
    assert session.remove_staged(spark) and other.exists()
    assert [p.name for p in (tmp_path / "docquarry").iterdir()] == ["another-application"]
