"""Quality rules: how far a text's letters and common words are from its language.

Two histograms per document, of character classes and of the language's common words,
are compared with the language's own reference by the Jensen-Shannon distance (base 2,
0 to 1). Guards: texts that are too short are not judged, nor are languages with too
little text for a reference.

References come from all documents of the language. A common word makes up at least
`COMMON_SHARE` of the language's words, so there are at most 1 / `COMMON_SHARE` of them,
and a reference is one small row per language. It is a written table; Spark broadcasts it
if its size on disk allows, else it is joined by a shuffle. The distances themselves are
computed inside the row: no shuffle of texts, and long or hot documents need no care.

Edge cases: a null text is empty (no words, base rules fail). Documents without a
language form a group of their own. Repeated rows are judged one by one. Columns named
like a result are replaced; others, of any name, are carried along. An empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import SPACE, let, own, refuse_clash, text_of, words
from docquarry.session import stage

COMMON_SHARE = 0.005
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "char_distance", "word_distance", "kept",
)
#: Character classes; a-z and white space are the rest.
_CLASSES = ["[#*$%&|<>]+", "[A-Z]+", "[0-9]+", r"[!\"'(-),-/:;=?@\[-`{}~+]+", r"[^\x00-\x7F]+"]


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Fewer words than this: the distances are not looked at.
    judged_words: int = 50
    #: A language with fewer words than this has no reference.
    reference_words: int = 20_000
    max_char_distance: float = 0.35
    max_word_distance: float = 0.45


def _words_of_repeated_windows(w: Column, size: int = 3) -> Column:
    """Words in windows of `size` that occur twice or more in the text, first included.

    Windows are compared by their 64-bit hashes; those that equal a neighbour once sorted
    repeat. The starts of repeated windows cover `size` words each, less what the next
    start covers too. Few repeated windows are looked up in a list, many by a second sort;
    both give the same starts.
    """
    add = lambda a, b: a + b
    hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, size)))), F.lit(1), F.size(w) - size + 1)
    repeated = lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i - 1) == x))
    tagged = lambda g: F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    listed = lambda g, r: F.filter(
        F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.array_contains(r, F.get(g, i)))
    sorted_twice = lambda g: let(F.sort_array(tagged(g)), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])),
        lambda x: x["p"],
    )))
    covered = lambda d: F.aggregate(
        F.transform(d, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(d, i + 1) - p, F.lit(size)))), F.lit(0), add)
    count = lambda g: let(let(F.sort_array(g), repeated), lambda r: F.when(F.size(r) == 0, 0).otherwise(
        let(F.when(F.size(r) <= 500, listed(g, r)).otherwise(sorted_twice(g)), covered)))
    return F.when(F.size(w) > size, let(hashes, count)).otherwise(0)


def _unusual(text: Column) -> Column:
    """The text without a-z and white space: what is left is short, and cheap to look through."""
    return F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", "")


def _classes(unusual: Column) -> list[Column]:
    return [F.length(unusual) - F.length(F.regexp_replace(unusual, c, "")) for c in _CLASSES]


def _shares(counts: Column, total: Column) -> Column:
    """Shares of the counted classes, and of what is left."""
    shares = lambda total: F.transform(counts, lambda n: n / F.greatest(total, F.lit(1)))
    return let(total, lambda n: let(shares(n), lambda s: F.concat(
        s, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(s, F.lit(0.0), lambda a, b: a + b))))))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two histograms whose shares add up to 1."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total / 2)))


def references(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(lang, char_ref, common, longest, word_ref): one row per language with enough text.

    `longest` is the length of the longest common word; no longer word needs a look-up.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    rows = rows.filter(F.length("text") > 0)
    shares = let(_unusual(F.col("text")), lambda x: _shares(F.array(*_classes(x)), F.length("text")))
    chars = rows.select("lang", shares.alias("c"), F.size(words(F.col("text"))).alias("n")).groupBy("lang").agg(
        F.array(*(F.avg(F.get("c", F.lit(i))) for i in range(len(_CLASSES) + 1))).alias("char_ref"),
        F.sum("n").alias("total"),
    )
    totals = stage(chars.filter(F.col("total") >= limits.reference_words), "quality-totals")
    counts = rows.select("lang", F.explode(words(F.col("text"))).alias("word")).groupBy("lang", "word").count()
    common = counts.join(totals, "lang").filter(F.col("count") >= COMMON_SHARE * F.col("total"))
    lists = common.groupBy("lang").agg(F.sort_array(F.collect_list(
        F.struct("word", (F.col("count") / F.col("total")).alias("share")))).alias("x"))
    return stage(
        totals.join(lists, "lang").select(
            "lang", "char_ref", F.col("x.word").alias("common"),
            F.array_max(F.transform("x.word", F.length)).alias("longest"),
            # The last share is that of all other words.
            F.concat(F.col("x.share"), F.array(1 - F.aggregate("x.share", F.lit(0.0), lambda a, b: a + b))).alias("word_ref"),
        ),
        "quality-references",
    )


def _common_shares(w: Column, common: Column, longest: Column) -> Column:
    """The text's shares of the common words, and of all others last.

    Words become their places in the list; sorted, with one of each place put in between,
    the counts are the distances between the places' first positions.
    """
    k = F.size(common)
    looked_up = F.filter(w, lambda x: F.length(x) <= longest)
    places = F.concat(F.transform(looked_up, lambda x: F.array_position(common, x).cast("int")), F.sequence(F.lit(0), k))
    first = lambda s: F.transform(F.sequence(F.lit(1), k), lambda j: F.array_position(s, j))
    ends = lambda s, f: F.transform(f, lambda at, j: F.coalesce(F.get(f, j + 1), F.size(s) + 1) - at - 1)
    shares = lambda c: F.concat(
        F.transform(c, lambda n: n / F.size(w)),
        F.array(1 - F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b) / F.size(w)),
    )
    return let(F.sort_array(places), lambda s: let(first(s), lambda f: let(ends(s, f), shares)))


def _measures(text: Column, ref: str, limits: Limits) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    judged = lambda w: (F.size(w) >= limits.judged_words) & F.col(ref).isNotNull()
    return let(words(text), lambda w: let(_unusual(text), lambda x: let(F.array(*_classes(x)), lambda c: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        c[0].cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _words_of_repeated_windows(w).cast("long").alias("n_repeat_words"),
        F.when(judged(w), jensen_shannon(_shares(c, F.length(text)), F.col(f"{ref}.char_ref"))).alias("char_distance"),
        F.when(judged(w), jensen_shannon(
            _common_shares(w, F.col(f"{ref}.common"), F.col(f"{ref}.longest")), F.col(f"{ref}.word_ref"))).alias("word_distance"),
    ))))


def quality_rules(docs: DataFrame, limits: Limits = Limits(), reference: DataFrame | None = None) -> DataFrame:
    """The documents with measures, distances and the verdict `kept`.

    A distance is null where a guard holds; a null distance never rejects.
    """
    reference = references(docs, limits) if reference is None else reference
    lang, ref, m = own("lang"), own("ref"), own("m")
    ref_columns = F.struct("char_ref", "common", "longest", "word_ref").alias(ref)
    base = refuse_clash(docs, *RESULTS)
    joined = base.withColumn(lang, F.coalesce("lang", F.lit("und"))).join(
        reference.select(F.col("lang").alias(lang), ref_columns), lang, "left")
    out = joined.withColumn(m, _measures(text_of(), ref, limits)).select(*base.columns, f"{m}.*")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    far = F.coalesce(F.col("char_distance") > limits.max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > limits.max_word_distance, F.lit(False)
    )
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~far)
