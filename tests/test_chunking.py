import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docquarry.operators.chunking import (
    COMPARED, ChunkConfig, WORDS_AND_SIGNS, chunk_documents, chunk_elements, user_tokenizer,
)
from docquarry.operators.sequence import with_start


def loop_chunks(tokens, size, overlap):
    """The step-wise rule: fill a buffer, cut at `size`, keep the overlap, flush the rest."""
    chunks, buffer = [], []
    for token in tokens:
        buffer.append(token)
        if len(buffer) == size:
            chunks.append(list(buffer))
            buffer = buffer[-overlap:]
    return chunks + ([buffer] if buffer else [])


def from_documents(spark, texts, config):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "f string, t string")
    rows = chunk_documents(df, F.col("f"), F.col("t"), [config]).collect()
    found = [[] for _ in texts]
    for r in sorted(rows, key=lambda r: r.chunk_id):
        assert r.chunk_id == len(found[int(r.source_file)])
        found[int(r.source_file)].append(r.text.split(" "))
    return found


def from_elements(spark, lines, config):
    rows = [(str(i), s, t) for i, parts in enumerate(lines) for s, t in enumerate(parts)]
    df = spark.createDataFrame(rows, "source_file string, seq long, text string")
    found = [[] for _ in lines]
    for r in sorted(chunk_elements(df, config).collect(), key=lambda r: r.chunk_id):
        assert r.chunk_id == len(found[int(r.source_file)])
        found[int(r.source_file)].append(r.text.split(" "))
    return found


@pytest.mark.parametrize("size,overlap", [(4, 2), (4, 1), (4, 3), (2, 1), (7, 3)])
def test_windows_equal_the_loop(spark, size, overlap):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(26)]
    expected = [loop_chunks(t.split(), size, overlap) for t in texts]
    config = ChunkConfig("c", size, overlap)
    assert from_documents(spark, texts, config) == expected
    rng = random.Random(3)
    lines = []
    for text in texts:
        parts, words = [], text.split()
        while words:
            n = rng.randint(0, 9)
            parts.append(" ".join(words[:n]))
            words = words[n:]
        lines.append(parts or [""])
    assert from_elements(spark, lines, config) == expected


def test_hand_worked_windows(spark):
    ten = " ".join("abcdefghij")
    starts = lambda c: [chunk[0] for chunk in from_documents(spark, [ten], c)[0]]
    assert starts(ChunkConfig("c", 4, 2)) == list("acegi")
    assert starts(ChunkConfig("c", 4, 1)) == list("adgj")
    assert [len(c) for c in from_documents(spark, ["a b c d"], ChunkConfig("c", 4, 1))[0]] == [4, 1]
    assert from_documents(spark, ["", "a b c"], ChunkConfig("c", 4, 1)) == [[], [["a", "b", "c"]]]


def test_chunks_rebuild_the_document(spark):
    text = " ".join(f"w{i}" for i in range(101))
    chunks = from_documents(spark, [text], ChunkConfig("c", 10, 3))[0]
    assert chunks[0] + [w for c in chunks[1:] for w in c[3:]] == text.split()


def test_parameters():
    for size, overlap in ((4, 4), (4, 5), (4, 0)):
        with pytest.raises(ValueError):
            ChunkConfig("c", size, overlap)
    with pytest.raises(ValueError):
        ChunkConfig("c", 513, 1, WORDS_AND_SIGNS, 512)
    assert [(c.chunk_size, c.overlap) for c in COMPARED] == [(256, 26), (256, 26), (512, 52)]


def test_user_tokenizer(spark):
    """Characters as tokens; words arrive in runs of two."""
    tokenizer = user_tokenizer(lambda t: [ord(c) for c in t], lambda ids: "".join(map(chr, ids)), 2)
    config = ChunkConfig("chars", 6, 2, tokenizer)
    text = "ab cd ef gh"
    tokens = [c for run in ("ab cd", "ef gh") for c in run]
    expected = ["".join(c) for c in loop_chunks(tokens, 6, 2)]
    df = spark.createDataFrame([("f", 0, text)], "source_file string, seq long, text string")
    for chunks in (
        chunk_documents(df, F.col("source_file"), F.col("text"), [config]), chunk_elements(df, config),
    ):
        assert [r.text for r in chunks.orderBy("chunk_id").collect()] == expected


def test_signs_tokenizer_and_many_configs(spark):
    df = spark.createDataFrame([("f", "Ab, c-d é1! Ab")], "f string, t string")
    configs = [ChunkConfig("w", 3, 1), ChunkConfig("s", 4, 1, WORDS_AND_SIGNS)]
    rows = chunk_documents(df, F.col("f"), F.col("t"), configs).collect()
    found = {c: [r.text for r in sorted(rows, key=lambda r: r.chunk_id) if r.config == c] for c in "ws"}
    assert found["w"] == ["Ab, c-d é1!", "é1! Ab"]
    assert found["s"] == ["ab , c -", "- d é1 !", "! ab"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 7))
def test_running_start(spark, lengths, block):
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate(lengths)], "g string, o long, n int")
    rows = with_start(df, "g", "o", "n", total="total", block=block).orderBy("o").collect()
    assert [r.start for r in rows] == [sum(lengths[:i]) for i in range(len(lengths))]
    assert {r.total for r in rows} == {sum(lengths)}
    early = with_start(df, "g", "o", "n", before=12, block=block).orderBy("o").collect()
    assert [r.o for r in early] == [i for i in range(len(lengths)) if sum(lengths[:i]) < 12]


def test_each_text_is_encoded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def encode(text):
        calls.add(1)
        return [len(w) for w in text.split()]

    config = ChunkConfig("own", 4, 1, user_tokenizer(encode, lambda ids: " ".join("x" * n for n in ids)))
    rows = [(f"f{i % 3}", i, "a bb ccc") for i in range(12)]
    chunks = chunk_elements(spark.createDataFrame(rows, "source_file string, seq long, text string"), config)
    assert {r.text for r in chunks.collect()} >= {"x xx xxx x"} and calls.value == 12
