"""The table of ranks gives what `tokenizers` gives, ids and character spans."""

import random

import numpy as np
import pytest

from docquarry.llm.queries import tokenizer_path
from docquarry.llm.token_counts import SpanEncoder


@pytest.fixture(scope="module")
def encoder():
    return SpanEncoder(tokenizer_path())


def same(encoder, texts):
    found = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, one in zip(texts, found):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == one.ids, text[:80]
        assert encoder.spans(text).tolist() == [list(o) for o in one.offsets], text[:80]


def test_all_kinds_of_characters(encoder):
    assert encoder.table
    points = [c for c in range(0, 0x110000, 29) if not 0xD800 <= c < 0xE000] + list(range(0x3000))
    same(encoder, [f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)}  {chr(c)}" for c in points])


def test_awkward_texts(encoder):
    draw = random.Random(5)
    mixed = "".join(draw.choice("ab é漢🙂\n\t 1'!s") for _ in range(20_000))
    same(encoder, ["", " ", "\n\n \n", "a<|endoftext|>b", "a" * 50_000, " " * 50_000 + "x", "1" * 20_000, mixed,
                   "".join(draw.choice("abcdefghij") for _ in range(50_000))])


def test_special_strings(encoder):
    """An untouched tokenizer gives the string of a special token its id; so does the encoder."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x" * 3, "<|endoftext|", "é<|endoftext|>\n漢"]
    same(encoder, texts)
    assert 50256 in np.frombuffer(encoder.encode(texts[0]), "<u4")


def test_other_files_are_used_as_they_are():
    other = SpanEncoder(tokenizer_path("word_bpe_49k.json"))
    assert other.table is None
    same(other, ["Some words, and some more.", "é漢"])
