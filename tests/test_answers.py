import json

import pytest
from pyspark.sql import functions as F

from docquarry.operators.answer_metrics import judged, leaderboard, long_form, score_answers
from docquarry.operators import evalset
from docquarry.operators.evalset import (
    containing_files, document_heads, document_texts, first_samples, native_qa_output, parse_qa, qa_prompts, sample_files,
)
from docquarry.operators.generation import UserGenerator, answer, best_sentence, with_models
from docquarry.operators.prompting import ANSWER_PROMPT, answer_prompt, context_of, fill
from docquarry.operators.retrieval_metrics import compare, evaluate_retrieval, per_question, report


def test_prompts_keep_every_sign(spark):
    odd = "50% {question} \\ 'x' {{y}}"
    df = spark.createDataFrame([(["a", "b"], odd)], "texts array<string>, q string")
    got = df.select(answer_prompt(context_of(F.col("texts")), F.col("q"))).first()[0]
    expected = ANSWER_PROMPT.replace("{context}", "a\n\nb").replace("{question}", odd, 1).strip()
    assert got == expected
    assert got.startswith("You are") and got.endswith("Answer:")
    assert df.select(fill("{a}-{b}", b=F.lit("x"), a=F.lit(None).cast("string"))).first()[0] == "-x"


def test_best_sentence(spark):
    rows = [
        ("It rains. The cat sleeps! Cats, cat and dog?", "Where does the cat sleep"),
        ("One. Two.", "nothing shared"), ("", "x"), ("A b. B a.", "a b"),
    ]
    df = spark.createDataFrame(rows, "c string, q string")
    got = [r[0] for r in df.select(best_sentence(F.col("c"), F.col("q"))).collect()]
    assert got == ["The cat sleeps!", "I don't know", "I don't know", "A b."]


def test_user_generator_isolates_failures(spark):
    def load():
        def call(prompt, temperature, max_tokens):
            if "bad" in prompt:
                raise RuntimeError("no connection")
            return f"{prompt}|{temperature}|{max_tokens}"

        return call

    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "fine")], "i int, prompt string")
    rows = {r.i: r.reply for r in UserGenerator(load, 0.7, 9).run(df).collect()}
    assert rows[1].answer == "ok|0.7|9" and rows[1].error is None
    assert rows[2].answer is None and "no connection" in rows[2].error
    assert rows[3].answer == "fine|0.7|9"


def test_models_native_and_own(spark):
    own = UserGenerator(lambda: lambda prompt, t, n: prompt.splitlines()[0][:7])
    df = spark.createDataFrame([(1, "the cat", "A dog. The cat.\n\nMore.")], "query_id int, question string, context string")
    rows = answer(with_models(df, ["best_sentence", "first_passage", "first_sentence", "mine"]), {"mine": own})
    assert {r.model: r.answer for r in rows.collect()} == {
        "best_sentence": "The cat.", "first_passage": "A dog. The cat.", "first_sentence": "A dog.", "mine": "You are",
    }


def test_judge(spark):
    def load():
        def call(prompt, temperature, max_tokens):
            assert temperature == 0
            return "2" if "grounded in context" in prompt else "about half"

        return call

    df = spark.createDataFrame(
        [("m", "q", "c", "a", "a b")], "model string, question string, context string, answer string, ground_truth_answer string"
    )
    row = score_answers(df, UserGenerator(load, temperature=0.0)).first()
    assert (row.faithfulness, row.relevancy, row.judge_failures) == (1.0, 0.0, 1)
    assert row.f1 == pytest.approx(2 / 3)
    native = judged(spark.createDataFrame([("cat dog", "the cat.", "Cat bird")], "question string, context string, answer string"))
    assert native.select("faithfulness", "relevancy", "judge_failures").first() == (0.5, 0.5, 0)
    board = leaderboard(score_answers(df))
    assert {r.metric for r in long_form(board).collect()} == {"f1", "faithfulness", "relevancy"}


def elements(spark, rows):
    return spark.createDataFrame(rows, "source_file string, seq long, text string, coursename string, coursecode string")


def test_document_heads(spark):
    rows = [("f", i, f"  line {i}  ", "" if i < 2 else f"name{i}", None if i < 5 else "c") for i in range(50)]
    rows += [("g", 0, " ", "n", "c"), ("h", 0, "x" * 90, "_n", None), ("h", 1, "y", "", "")]
    found = {r.source_file: r for r in document_heads(elements(spark, rows), 60).collect()}
    assert set(found) == {"f", "h"}
    assert found["f"].head == "\n".join(f"line {i}" for i in range(50))[:60]
    assert (found["f"].coursename, found["f"].coursecode, found["f"].course_key) == ("name2", "c", "name2_c")
    assert found["h"].head == "x" * 60
    assert found["h"].course_key == "n"
    prompt = qa_prompts(document_heads(elements(spark, rows), 60), 4).filter("source_file = 'h'").first().prompt
    assert "generate 4 high-quality" in prompt and prompt.endswith("x" * 60 + "\n        ")


def test_sample_files(spark):
    files = spark.createDataFrame([(f"f{i}",) for i in range(20)], "source_file string")
    picked = [r[0] for r in sample_files(files, 5, "1").collect()]
    assert len(set(picked)) == 5 and picked == [r[0] for r in sample_files(files.repartition(7), 5, "1").collect()]
    assert picked != [r[0] for r in sample_files(files, 5, "2").collect()]
    assert sample_files(files, 99).count() == 20


def test_parse_qa(spark):
    good = {"question": " q ", "answer": "a", "support": "s"}
    replies = [
        ("1", "no array"), ("2", '[{"question":"q"},{"question":]'), ("3", "Sure:\n" + json.dumps([good]) + "\nDone."),
        ("4", json.dumps([good, {"question": "q", "answer": "", "support": "s"}, {"question": "q"}])), ("5", "[]"),
        ("6", json.dumps([good]) + " and [more"),
    ]
    df = spark.createDataFrame(replies, "source_file string, output string")
    samples, bad = parse_qa(df)
    assert {r.source_file for r in bad.collect()} == {"1", "2"}
    rows = samples.orderBy("source_file").collect()
    assert [(r.source_file, r.question, r.ground_truth_answer, r.reference_text) for r in rows] == [
        (s, "q", "a", "s") for s in ("3", "4", "6")
    ]


def test_native_questions_can_be_parsed(spark):
    text = 'He said "yes [no]". Short. A much longer sentence with \\ signs, and a tab.'
    df = spark.createDataFrame([("f", text)], "source_file string, head string")
    samples, bad = parse_qa(df.withColumn("output", native_qa_output(F.col("head"), 2)))
    assert bad.count() == 0
    assert [r.reference_text for r in samples.orderBy("item").collect()] == [
        "A much longer sentence with \\ signs, and a tab.", 'He said "yes [no]".',
    ]


def test_containing_files(spark):
    words = [f"w{i}" for i in range(40)]
    documents = [
        ("a", "x" + " ".join(words[:30]) + "y"), ("b", " ".join(words)), ("c", " ".join(reversed(words))),
        ("d", "\n".join(words)), ("e", " ".join(words[:12])), ("f", "w1 w2"),
    ]
    passages = [(1, " ".join(words[5:15])), (2, " ".join(words[:12])), (3, "w1 w2 w3")]
    d = spark.createDataFrame(documents, "source_file string, text string")
    p = spark.createDataFrame(passages, "query_id int, text string")
    expected = {(q, f) for q, t in passages for f, body in documents if t in body}
    for asked in (p, p.filter("query_id < 3")):
        found = {tuple(r) for r in containing_files(asked, d).collect()}
        assert found == {e for e in expected if asked is p or e[0] < 3}


def test_short_passages_are_whole_words(spark):
    documents = [("a", "one two\tthree"), ("b", "two one"), ("c", "onetwo twothree"), ("d", "three")]
    passages = [(1, "one  two"), (2, "three"), (3, " "), (4, None), (5, "one two\tthree"), (6, "two")]
    d = spark.createDataFrame(documents, "source_file string, text string")
    p = spark.createDataFrame(passages, "query_id int, text string")
    found = {tuple(r) for r in containing_files(p, d).collect()}
    assert found == {(1, "a"), (2, "a"), (2, "d"), (5, "a"), (6, "a"), (6, "b")}


def test_passages_are_looked_up_without_a_row_per_run(spark, monkeypatch, capsys):
    """Only runs that a passage may have become rows; repeated and null rows count as before."""
    monkeypatch.setattr(evalset, "stage", lambda df, name: df.persist() if name == "looked-up" else df)
    words = [f"w{i}" for i in range(60)]
    documents = [("a", " ".join(words)), ("a", " ".join(words)), ("b", None), ("c", " ".join(words[9:])), ("c", "")]
    passages = [(i, " ".join(words[i:i + 12])) for i in range(0, 48, 6)]
    d = spark.createDataFrame(documents, "source_file string, text string")
    found = containing_files(spark.createDataFrame(passages, "query_id int, text string"), d)
    # Two rows of one name meet each other, as a join by name does.
    expected = {(i, "a"): 4 for i, _ in passages} | {(i, "c"): 1 for i, _ in passages if i >= 9}
    counted = {}
    for r in found.collect():
        counted[tuple(r)] = counted.get(tuple(r), 0) + 1
    assert counted == expected
    found.explain()
    assert "xxhash64" not in capsys.readouterr().out


def test_generator_stops_when_the_service_is_down(spark):
    def load():
        def call(prompt, temperature, max_tokens):
            if prompt == "p2":
                raise ConnectionError("down")
            return prompt.upper()

        return call

    rows = spark.createDataFrame([(f"p{i}",) for i in range(5)], "prompt string").coalesce(1)
    reply = lambda **more: {r.prompt: r.reply for r in UserGenerator(load, **more).run(rows).collect()}
    stopped, going = reply(stop_on=(ConnectionError,)), reply()
    assert [stopped[f"p{i}"].answer for i in range(5)] == ["P0", "P1", None, None, None]
    assert stopped["p2"].error == "down" and stopped["p4"].error == "not asked after: down"
    assert [going[f"p{i}"].answer for i in range(5)] == ["P0", "P1", None, "P3", "P4"]


def test_whole_texts(spark):
    """Files of one, many and no usable elements, put together level by level."""
    draw = __import__("random").Random(3)
    rows = [("long", i, draw.choice(["", " ", "x", f" word {i} "])) for i in range(700)] + [("one", 5, " a\nb "), ("none", 0, " ")]
    df = spark.createDataFrame(rows, "source_file string, seq long, text string").repartition(5)
    expected = {}
    for f, _, t in rows:
        if t.strip():
            expected.setdefault(f, []).append(t.strip())
    for fan_in in (2, 64):
        found = document_texts(df, fan_in).collect()
        assert {r.source_file: r.text for r in found} == {f: "\n".join(t) for f, t in expected.items()} and len(found) == 2
    assert document_texts(df.limit(0)).count() == 0


def test_first_samples_by_name(spark):
    rows = [(f"{f}#{i}", f, i) for f in ("b", "a") for i in range(12)]
    df = spark.createDataFrame(rows, "sample_id string, source_file string, item int")
    assert [r.sample_id for r in first_samples(df, 13).collect()] == [f"a#{i}" for i in range(12)] + ["b#0"]
    assert first_samples(df, None).count() == 24


def test_first_samples(spark):
    df = spark.range(10).toDF("sample_id")
    assert [first_samples(df, n).count() for n in (None, 0, 3, 99)] == [10, 10, 3, 10]


def test_ranks(spark):
    matches = spark.createDataFrame(
        [(1, 1, True), (1, 2, True), (2, 1, False), (2, 3, True), (3, 1, False)], "query_id int, rank int, match boolean"
    )
    questions = spark.createDataFrame([(1,), (2,), (3,), (4,)], "query_id int")
    row = report(per_question(questions, matches, ["query_id"]), []).first()
    assert (row.total_samples, row.top1_accuracy, row.hit_rate_at_k) == (4, 0.25, 0.5)
    assert row.mrr == pytest.approx((1 + 1 / 3) / 4)


def test_report_and_comparison(spark):
    questions = spark.createDataFrame(
        [("x", 1, "the cat sat"), ("y", 1, "the cat sat"), ("x", 2, "nothing"), ("y", 2, "nothing")],
        "config string, query_id int, reference_text string",
    )
    hits = spark.createDataFrame(
        [("x", 1, 1, "a dog"), ("x", 1, 2, "The CAT sat down"), ("y", 1, 1, "the cat sat")],
        "config string, query_id int, rank int, text string",
    )
    reports = evaluate_retrieval(questions, hits, ["config"])
    rows = {r.config: r for r in reports.collect()}
    assert tuple(rows["x"])[1:] == (2, 0.0, 0.5, 0.25, 0.5)
    assert tuple(rows["y"])[1:] == (2, 0.5, 0.5, 0.5, 0.5)
    deltas = {r.config: r for r in compare(reports, "x").collect()}
    assert deltas["y"].mrr_delta == 0.25 and deltas["x"].mrr_delta == 0.0


def test_empty_evaluation_set(spark):
    questions = spark.createDataFrame([], "query_id int, reference_text string")
    hits = spark.createDataFrame([], "query_id int, rank int, text string")
    assert tuple(evaluate_retrieval(questions, hits).first()) == (0, None, None, None, None)
