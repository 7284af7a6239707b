import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.operators.chunking import ChunkConfig, chunk_documents
from docquarry.operators.encoding import HashedIdf, UserEncoder, slot_counts
from docquarry.operators.generation import UserGenerator
from docquarry.plans import jobs
from docquarry.session import scratch_path
from docquarry.sources.collections import Collection
from docquarry.plans.streams import _refreshed
from docquarry.streaming.refresh import _follow, current_counts, reencode, refresh

TOPICS = {
    "Algebra_M1": "groups rings fields modules ideals homomorphisms kernels quotients",
    "Botany_B2": "roots stems leaves petals pollen seeds chlorophyll xylem",
    "Cooking_C3": "flour butter sugar yeast oven dough knead simmer",
}


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parsed")
    for name, topic in TOPICS.items():
        words = topic.split()
        items = [
            {"type": "NarrativeText", "text": f"The  {a} and the {b} belong together.", "metadata": {"filename": f"{name}.pdf"}}
            for a, b in zip(words, words[1:])
        ] + [{"type": "NarrativeText", "text": " "}]
        (folder / f"{name}.json").write_text(json.dumps(items))
    (folder / "broken.json").write_text("[")
    return jobs.prepare_folder(spark, str(folder))


@pytest.fixture(scope="module")
def samples(spark):
    rows = [
        (i, f"what about {w}?", f"the {w} and", f"the {w} and", f"{name}.json")
        for i, (name, w) in enumerate((n, w) for n, t in TOPICS.items() for w in t.split()[:3])
    ]
    return spark.createDataFrame(
        rows, "sample_id long, question string, ground_truth_answer string, reference_text string, source_file string"
    )


@pytest.fixture(scope="module")
def retriever(spark, prepared):
    chunks = jobs.chunk(prepared[0], [ChunkConfig("c", 8, 2)])
    collection = Collection(spark, scratch_path(spark, "jobs"), "c")
    encoder = jobs.index(chunks, collection)
    return jobs.CollectionRetriever(collection, encoder)


def test_prepare(prepared):
    elements, counters, unreadable = prepared
    assert [r.source_file for r in unreadable.collect()] == ["broken.json"]
    assert {(r.processed, r.removed) for r in counters.collect()} == {(8, 1)}
    row = elements.filter("source_file = 'Algebra_M1.json'").orderBy("seq").first()
    assert (row.text, row.coursename, row.coursecode) == ("The groups and the rings belong together.", "Algebra", "M1")


def test_batch_retrieval_equals_one_by_one(spark, retriever, samples):
    questions = samples.withColumnRenamed("sample_id", "query_id")
    together = {(r.query_id, r["rank"], r.id) for r in retriever(questions, 3).collect()}
    alone = set()
    for i in (0, 4, 8):
        alone |= {(r.query_id, r["rank"], r.id) for r in retriever(questions.filter(F.col("query_id") == i), 3).collect()}
    assert alone == {t for t in together if t[0] in (0, 4, 8)}


def test_filter_and_no_filter(spark, retriever):
    questions = spark.createDataFrame(
        [(1, "pollen", None), (2, "pollen", "Algebra_M1.json"), (3, "pollen", "no such file")],
        "query_id int, question string, source_file string",
    )
    rows = retriever(questions, 2).collect()
    assert {r.source_file for r in rows if r.query_id == 1 and r["rank"] == 1} == {"Botany_B2.json"}
    assert {r.source_file for r in rows if r.query_id == 2} == {"Algebra_M1.json"}
    assert not [r for r in rows if r.query_id == 3]


def test_evaluate_retrieval(retriever, samples):
    row = jobs.evaluate_retrieval(samples, retriever, k=3).first()
    assert row.total_samples == 9
    assert 0.5 < row.top1_accuracy <= row.mrr <= row.hit_rate_at_k <= 1
    assert jobs.evaluate_retrieval(samples, retriever, k=3, max_samples=4).first().total_samples == 4


def test_stores_with_either_metric_agree(spark, prepared, samples, retriever):
    chunks = jobs.chunk(prepared[0], [ChunkConfig("c", 8, 2)])
    other = Collection(spark, scratch_path(spark, "jobs"), "l2")
    encoder = jobs.index(chunks, other, ids="plain", metric="l2")
    both = {"cosine": retriever, "l2": jobs.CollectionRetriever(other, encoder, drop_empty=False)}
    rows = {r.config: tuple(r)[1:] for r in jobs.evaluate_retrievers(samples, both, k=3).collect()}
    assert rows["cosine"] == rows["l2"] and rows["l2"][0] == 9


def test_ask_and_evaluate_models(spark, retriever, samples):
    calls = UserGenerator(lambda: lambda prompt, t, n: prompt.split("Question:\n")[1].split("\n")[0])
    board = jobs.evaluate_models(samples, retriever, ["best_sentence", "echo"], k=3, generators={"echo": calls})
    rows = {r.model: r for r in board.collect()}
    assert rows["best_sentence"].samples == rows["echo"].samples == 9
    assert rows["best_sentence"].faithfulness == 1.0 and rows["echo"].relevancy == 1.0
    lost = spark.createDataFrame([(1, "pollen", "no such file")], "query_id long, question string, source_file string")
    row = jobs.ask(lost, retriever, ["best_sentence"]).first()
    assert (row.context, row.answer) == ("", "I don't know")


def test_make_evaluation_set(spark, prepared):
    samples = jobs.make_evaluation_set(prepared[0], num_files=2, samples_per_file=3)
    rows = samples.collect()
    assert len({r.source_file for r in rows}) == 2 and len(rows) == 6
    with pytest.raises(ValueError):
        jobs.make_evaluation_set(prepared[0].limit(0))


def test_evaluation_set_resumes(spark, prepared):
    """The service fails for one file; the rerun asks for that file only."""
    progress = scratch_path(spark, "evalset")
    log = spark.sparkContext.accumulator(0)

    def generator(broken):
        def load():
            def call(prompt, t, n):
                log.add(1)
                if broken and "pollen" in prompt:
                    raise ConnectionError("connection lost")
                return json.dumps([{"question": "q", "answer": "a", "support": "s"}])

            return call

        return UserGenerator(load, 0.7)

    run = lambda broken: jobs.make_evaluation_set(
        prepared[0], num_files=3, generator=generator(broken), progress=progress
    )
    assert run(True).count() == 2 and log.value == 3
    assert run(False).count() == 3 and log.value == 4
    assert run(False).count() == 3 and log.value == 4


def test_evaluation_set_outlives_a_dead_run(spark, prepared):
    """The run dies after some waves; their files are kept and not asked for again."""
    progress, log = scratch_path(spark, "evalset"), spark.sparkContext.accumulator(0)

    def generator(deadly):
        def load():
            def call(prompt, t, n):
                log.add(1)
                if "pollen" in prompt and deadly:
                    raise SystemExit("the worker is gone")
                return "no array" if "flour" in prompt else json.dumps([{"question": "q", "answer": "a", "support": "s"}])

            return call

        return UserGenerator(load)

    def run(deadly):
        return jobs.make_evaluation_set(prepared[0], num_files=3, generator=generator(deadly), progress=progress, wave=1)

    try:
        run(True)
    except Exception:  # noqa: BLE001 - the job is lost; what was done is not
        pass
    kept = {r.source_file for r in spark.read.parquet(progress).collect()}
    assert "Botany_B2.json" not in kept
    before = log.value
    assert {r.source_file for r in run(False).collect()} == {"Algebra_M1.json", "Botany_B2.json"}
    assert log.value - before == 3 - len(kept)
    assert run(False).count() == 2 and log.value - before == 3 - len(kept)


def test_a_small_run_of_an_evaluation_set(spark, prepared, retriever):
    made = jobs.make_evaluation_set(prepared[0], num_files=3, samples_per_file=3)
    assert jobs.evaluate_retrieval(made, retriever, k=3, max_samples=2).first().total_samples == 2


def test_written_and_counted_at_once(spark, prepared):
    raw = spark.createDataFrame([("f", i, t) for i, t in enumerate(["a", " ", "b"])], "source_file string, seq long, text string")
    raw = raw.selectExpr("source_file", "seq", "'Title' AS type", "text", "struct('A_1.pdf' AS filename, string(null) AS text_as_html) AS metadata")
    path = scratch_path(spark, "prepared")
    assert jobs.write_prepared(raw, path) == {
        "processed": 3, "removed": 1, "remaining": 2, "converted": 0, "normalized": 2, "skipped": 0}
    assert spark.read.parquet(path).count() == 2


def test_user_encoder_in_a_job(spark, prepared):
    load = lambda: lambda texts: np.array([[len(t), t.count("e"), 1.0] for t in texts])
    chunks = jobs.chunk(prepared[0], [ChunkConfig("a", 8, 2), ChunkConfig("b", 16, 4)])
    assert {r.config for r in chunks.select("config").distinct().collect()} == {"a", "b"}
    collection = Collection(spark, scratch_path(spark, "jobs"), "own")
    jobs.index(chunks.filter("config = 'a'"), collection, UserEncoder(load))
    assert collection.properties()["dim"] == 3
    told = Collection(spark, scratch_path(spark, "jobs"), "told")
    jobs.index(chunks.filter("config = 'a'"), told, UserEncoder(load, dim=3))
    key = lambda c: {(r.id, *r.embedding) for r in c.read().collect()}
    assert key(told) == key(collection)


def test_refresh(spark, tmp_path):
    """Two deliveries; the second brings a shorter version of one document."""
    source, config = str(tmp_path / "in"), ChunkConfig("c", 4, 1)
    schema = "source_file string, text string, version int"
    deliver = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    deliver([("a", "one two three four five six", 1), ("b", "x y z", 1), ("b", "old", 0)])
    encoder = HashedIdf(dim=16).fit(spark.createDataFrame([("one two x",)], "text string"))
    collection = Collection(spark, scratch_path(spark, "streams"), "s").create(16)
    checkpoint = scratch_path(spark, "stream")

    def run():
        arriving = spark.readStream.schema(schema).parquet(source)
        refresh(arriving, collection, encoder, config, checkpoint, newest="version").awaitTermination()
        return {(r.source_file, r.chunk_id, r.text) for r in collection.read().collect()}

    assert run() == {("a", 0, "one two three four"), ("a", 1, "four five six"), ("b", 0, "x y z")}
    deliver([("a", "one", 2), ("c", "new", 1)])
    expected = {("a", 0, "one"), ("b", 0, "x y z"), ("c", 0, "new")}
    assert run() == expected
    assert run() == expected


def test_frequencies_follow(spark, tmp_path):
    """After deliveries, replacements and a repeated batch the counts are those of what is there."""
    source, config = str(tmp_path / "in"), ChunkConfig("c", 4, 1)
    collection = Collection(spark, scratch_path(spark, "streams"), "f").create(16)
    first = spark.createDataFrame([("a", "one two three four five six"), ("b", "x y")], "source_file string, text string")
    second = spark.createDataFrame([("a", "one two"), ("c", "x new new")], "source_file string, text string")
    encoder, counts, checkpoint = HashedIdf(dim=16).fit(first), scratch_path(spark, "counts"), scratch_path(spark, "stream")
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(batch.schema).parquet(source)
        refresh(arriving, collection, encoder, config, checkpoint, frequencies=counts).awaitTermination()
    followed = lambda: {(r["slot"], r["count"]) for r in current_counts(spark, counts).collect()}
    fresh = {(r["slot"], r["count"]) for r in slot_counts(collection.read()).collect()}
    assert followed() == fresh
    # The batch comes again, its counts and points are there already.
    _follow(chunk_documents(second, F.col("source_file"), F.col("text"), [config]), collection, counts, 1, True)
    assert followed() == fresh
    fitted = HashedIdf(dim=16).fit_counts(current_counts(spark, counts))
    texts = {r.text: r.embedding for r in reencode(collection, fitted).read().collect()}
    assert texts == {r.text: r.embedding for r in fitted.encode(collection.read().drop("embedding")).collect()} and len(texts) == 3


def test_batches_do_not_grow_with_files(spark, tmp_path):
    """The arriving documents make four batches, however many files a write is in; the counts
    and the points are those of the last version of each document."""
    rows = [(i, f"common w{i} " + "x y z " * (i % 5)) for i in range(48)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    frame.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    collection, frequencies = _refreshed(spark, str(tmp_path))
    assert spark.read.parquet(frequencies).select("batch").distinct().count() == 4
    assert collection.properties()["deltas"] == 4
    texts = {r.source_file: r.text for r in collection.read().collect()}
    assert texts == {f"doc_{i}": " ".join((t[:len(t) // 2] if i % 8 == 0 else t).split()) for i, t in rows}
    fresh = {(r["slot"], r["count"]) for r in slot_counts(collection.read()).collect()}
    assert {(r["slot"], r["count"]) for r in current_counts(spark, frequencies).collect()} == fresh


def test_batches_leave_their_points_only(spark, tmp_path):
    """What a batch stages, and the files that came before the last write, are gone when the stream
    ends; the points are stored without the rows of their batch being shuffled."""
    rows = [(i, f"common w{i} " + "x y z " * (i % 5), "en", "s") for i in range(48)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    own = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(own.iterdir()) if own.exists() else set()
    collection, _ = _refreshed(spark, str(tmp_path))
    left = {p.name.split("-")[0]: p for p in set(own.iterdir()) - before}
    assert set(left) == {"arriving", "stream", "collections", "frequencies"}
    assert spark.read.schema("source_file string").parquet(str(left["arriving"])).count() < 16
    assert all(".zstd." in p.name for p in left["collections"].glob("*/points-*/*.parquet"))
    assert collection.read().select("source_file").distinct().count() == 48


def test_read_of_some_sources(spark):
    """Points of some sources, with some columns: the newest of each id, without replaced ones."""
    collection = Collection(spark, scratch_path(spark, "some"), "s").create(1)
    point = lambda i, text, source: (i, [1.0], text, 0, source)
    write = lambda rows, **how: collection.upsert(
        spark.createDataFrame(rows, "id string, embedding array<float>, text string, chunk_id int, source_file string"), **how)
    write([point("a0", "base", "a"), point("b0", "base", "b")]).compact()
    write([point("a1", "old", "a"), point("b1", "old", "b")])
    write([point("b1", "new", "b"), point("c0", "new", "c")])
    write([point("a2", "replaced", "a")], replace_sources=True)
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "source_file string")
    some = collection.read(only=wanted, columns=["id", "text"])
    found = sorted((r.id, r.text) for r in some.collect())
    assert found == [("a2", "replaced"), ("b0", "base"), ("b1", "new")]
    assert found == sorted((r.id, r.text) for r in collection.read().collect() if r.source_file in "ab")
