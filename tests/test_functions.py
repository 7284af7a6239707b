import math
import uuid

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docquarry.functions.fuzzy import (
    common_subsequence, with_token_set_bounds, with_token_set_match, with_token_set_ratio,
)
from docquarry.functions import html
from docquarry.functions.html import table_to_markdown, unescape
from docquarry.functions.ids import uuid5
from docquarry.functions.scores import judge_failed, judge_score, token_f1
from docquarry.functions.text import (
    collapse_whitespace, course_key, course_of, has_text, stage_file_name, words,
)
from docquarry.functions.vectors import cosine, l2_normalize, squared_l2


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


SPACES = ["  a　b\x1cc \n", "", " ", "a  b", "a b", " x y ", " a", "a ", "a \t b\x85c", "\x1f"]


def test_whitespace_equals_python(spark):
    assert column(spark, SPACES, collapse_whitespace) == [" ".join(s.split()) for s in SPACES]
    assert column(spark, SPACES, words) == [s.split() for s in SPACES]
    assert column(spark, SPACES, has_text) == [bool(s.strip()) for s in SPACES]
    assert column(spark, [None], words) == [[]]
    assert column(spark, [None], has_text) == [False]


def test_every_space_character(spark):
    characters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    found = column(spark, [f"a{c}b" for c in characters], words)
    assert found == [f"a{c}b".split() for c in characters]


def test_course_of_filename(spark):
    names = ["Intro_CSE1.pdf", "a_b_c.docx", "Plan.pdf", "x_Y.PDF", " a _ b.doc", ""]
    got = column(spark, names, lambda v: F.struct(*[c.alias(n) for c, n in zip(course_of(v), "nc")]))
    assert [tuple(r) for r in got] == [
        ("Intro", "CSE1"), ("a", "b_c"), ("Plan.pdf", None), ("x", "Y.PDF"), ("a", "b"), ("", None),
    ]


def test_stage_file_name_and_key(spark):
    names = ["a_pdf.json", "a_doc.json", "a_docx.json", "a.json", "a_pdf_x.json"]
    assert column(spark, names, stage_file_name) == ["a.json", "a.json", "a.json", "a.json", "a_pdf_x.json"]
    key = spark.createDataFrame([("a", "b"), ("a", None), (None, "b"), (None, None)], "n string, c string")
    assert [r[0] for r in key.select(course_key(F.col("n"), F.col("c"))).collect()] == ["a_b", "a", "b", ""]


def test_tables(spark):
    tables = [
        "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>",
        "<table><tr><td>1</td><td>2</td></tr></table>",
        "<table>\n<thead><tr><th colspan='2'>W</th></tr></thead>\n<tr><td> x  y</td><td>a_b*</td></tr></table>",
        "<p>no &lt;table&gt;</p>",
        "<TABLE><TR><TH>a</TH></TR><TR><TD>b<br>c</TD></TR></TABLE>",
    ]
    assert column(spark, tables, table_to_markdown) == [
        "| A | B |\n| --- | --- |\n| 1 | 2 |",
        "|  |  |\n| --- | --- |\n| 1 | 2 |",
        "| W | |\n| --- | --- |\n| x y | a\\_b\\* |",
        "no <table>",
        "| a |\n| --- |\n| bc |",
    ]


def test_tables_in_bad_shape(spark):
    tables = [
        "<table><tr><td>one<td>two<tr><td>three<td>four</table>",
        "<table><caption>Prices</caption><tr><th>a|b</th><th>c</th></tr><tr><td>1</td><td>2</td></tr></table>",
        "<table><tr><td>x<table><tr><td>y</td></tr></table></td><td>z</td></tr></table>",
    ]
    open_cells, caption, nested = column(spark, tables, table_to_markdown)
    assert open_cells == "|  |  |\n| --- | --- |\n| one | two |\n| three | four |"
    assert caption == "Prices\n\n| a|b | c |\n| --- | --- |\n| 1 | 2 |"
    assert all(x in nested for x in "xyz") and "<" not in nested


def test_entities(spark):
    import html

    texts = ["&eacute;&#8211;&#x1F600;&lt;b&gt;", "&amp;lt; a & b &unknown; &#0; &#xD800;", "no", "&&;&copy;", "&nbsp;&#160;x"]
    expected = [html.unescape(t) for t in texts]
    expected[1], expected[4] = "&lt; a & b &unknown; &#0; &#xD800;", "  x"
    assert column(spark, texts, unescape) == expected
    assert column(spark, [None], unescape) == [None]


def test_uuid5(spark):
    names = ["a.json_0", "", "Ünïcode 文_12", "x" * 300] + [f"doc_{i}_{i}" for i in range(50)]
    assert column(spark, names, uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def python_score(text):
    try:
        return max(0.0, min(1.0, float(text.strip())))
    except ValueError:
        return 0.0


REPLIES = ["0.9", "-3", "nan", "inf", "-inf", "Score: 1", "", " 0.5\n", "0.5d", "1_0", "1__0", "1e-3", ".5",
           "5.", "+0.25", "1e400", "0x1", "NaN", "-nan", "Infinity", "０.5", "1 0", "0.5f", "_1"]


def test_judge_score(spark):
    expected = [python_score(r) for r in REPLIES]
    # Digits of other scripts are not read.
    expected[REPLIES.index("０.5")] = 0.0
    assert column(spark, REPLIES, judge_score) == expected
    failed = column(spark, ["0.3", "x", None, "nan"], judge_failed)
    assert failed == [False, True, True, False]


def python_f1(pred, truth):
    p, t = set(pred.lower().split()), set(truth.lower().split())
    if not p & t:
        return 0.0
    precision, recall = len(p & t) / len(p), len(p & t) / len(t)
    return 2 * precision * recall / (precision + recall)


def test_token_f1(spark):
    pairs = [("a b b", "b c"), ("", ""), ("A", "a"), ("x", "y"), ("a b c", "c b a"), ("a, b", "a b")]
    df = spark.createDataFrame(pairs, "p string, t string")
    got = [r[0] for r in df.select(token_f1(F.col("p"), F.col("t"))).collect()]
    assert got == pytest.approx([python_f1(*p) for p in pairs])


def slow_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd é", max_size=30), st.text("abcd é", max_size=30))
def test_common_subsequence(a, b):
    assert common_subsequence(a, b) == slow_lcs(a, b)


def slow_ratio(left, right):
    l, r = set(left.lower().split()), set(right.lower().split())
    if not l or not r:
        return 0.0
    common, a, b = (" ".join(sorted(s)) for s in (l & r, l - r, r - l))
    if common and (not a or not b):
        return 100.0
    gap = 1 if common else 0
    p, q = len(common) + gap + len(a), len(common) + gap + len(b)
    scores = [100 * (1 - (len(a) + len(b) - 2 * slow_lcs(a, b)) / (p + q))]
    if common:
        scores.append(100 * (1 - (gap + len(a)) / (len(common) + p)))
        scores.append(100 * (1 - (gap + len(b)) / (len(common) + q)))
    return max(scores)


def test_token_set_ratio(spark):
    rng = np.random.default_rng(7)
    vocabulary = ["the", "fox", "foxes", "jumps", "jumped", "over", "a", "lazy", "dog", "Dogs", "é,"]
    text = lambda: " ".join(rng.choice(vocabulary, rng.integers(0, 9)))
    pairs = [("a b", "b a c"), ("", "a"), ("abc", "xyz"), ("fuzzy was a bear", "fuzzy fuzzy was a bear")]
    pairs += [(text(), text()) for _ in range(150)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, l string, r string")
    expected = [slow_ratio(*p) for p in pairs]
    args = (F.col("l"), F.col("r"))
    exact = [r.s for r in with_token_set_ratio(df, *args, "s").orderBy("i").collect()]
    assert exact == pytest.approx(expected)
    assert exact[:4] == [100.0, 0.0, 0.0, 100.0]
    for row in with_token_set_bounds(df, *args).orderBy("i").collect():
        assert row.score_low - 1e-9 <= expected[row.i] <= row.score_high + 1e-9
    matches = [r.m for r in with_token_set_match(df, *args, "m", 70.0).orderBy("i").collect()]
    assert matches == [e > 70 for e in expected]
    assert 0 < sum(matches) < len(matches)


def test_vectors(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    got = df.select(l2_normalize(a).alias("u"), cosine(a, b).alias("c"), squared_l2(a, b).alias("d")).collect()
    assert list(got[0].u) == pytest.approx([0.6, 0.8]) and list(got[1].u) == [0.0, 0.0]
    assert got[0].c == pytest.approx(24 / 25) and got[1].c == 0.0
    assert got[0].d == pytest.approx(2.0) and math.isclose(got[1].d, 1.0)


def test_plain_tables_take_the_same_form(spark):
    """Tables of plain rows and cells give what the same tables with an attribute give, which are
    read row by row and cell by cell."""
    cells = ["", " ", "a", " a  b ", "x | y", "A &amp;lt; &lt;b&gt;", "&eacute;&#65;", "*s* _t_", "colspan='2'", "&amp", "<b>in</b>", "\n1"]
    row = lambda i, n, tag: "<tr>" + "".join(f"<{tag}>{cells[(i + k) % len(cells)]}</{tag}>\n"[:None if k % 2 else -1] for k in range(n)) + "</tr>"
    tables = [
        "<table>" + gap + row(i, n, tag) + gap + "".join(row(i + j + 1, 1 + j % 3, "td") + gap * (j % 2) for j in range(more)) + "</table>"
        for i in range(len(cells)) for n in (1, 3) for tag in ("td", "th") for more in (0, 1, 4) for gap in ("", "\n ")]
    tables += ["<table></table>", "<table><tr></tr></table>", "<table>c<tr><td>a</td></tr></table>", "<table><tr><td>a</td></tr>c</table>",
               "<table><tr>" + "<td>a</td>" * 3000 + "</tr></table>", "<table>" + "<tr><td>a</td></tr>" * 3000 + "</table>"]
    frame = spark.createDataFrame([(t, t.replace("<table>", "<table id=1>")) for t in tables], "plain string, other string")
    bare = collapse_whitespace(F.regexp_replace("plain", html.INLINE_TAG, ""))
    found = frame.select(
        table_to_markdown(F.col("plain")).alias("a"), table_to_markdown(F.col("other")).alias("b"), bare.rlike(html._PLAIN_TABLE).alias("is_plain")).collect()
    assert [r.a for r in found] == [r.b for r in found]
    assert sum(r.is_plain for r in found) == len(tables) - 4
