"""Personal data: four base patterns, and what their contexts give away.

Base kinds (e-mail, IP address, card and phone number) are found by pattern and checked.
They are the seeds of a bootstrap: the words around a seed are lexical patterns, and
tokens that look like identifiers but match no base pattern stand in contexts too. On the
graph of patterns and instances Spark scores, in turn, patterns by the share of their
instances that are known to be of a kind, and unknown instances by the patterns they stand
in. Occurrences of well-scored unknown instances in well-scored patterns become further
spans. All scores are groupings and equi-joins over the whole corpus, without caps.

Everything is a DataFrame expression. Positions are in code points, ends exclusive; they
come from the lengths of the texts between matches. Regular expressions are written so
that a long text is passed once: possessive, and tried only where a match can begin.

Edge cases: a null text is empty. Repeated rows count for the graph once per value, and
get equal spans. Columns named like a result are replaced; others are carried along. An
empty table gives an empty result. Patterns need at least `min_support` different seeds of
a kind, so small tables add nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import let, own, refuse_clash, running_totals, text_of
from docquarry.session import stage

KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 2
    #: Different seeds of a kind that a pattern must hold.
    min_support: int = 5
    min_pattern_score: float = 0.8
    min_instance_score: float = 0.9
    #: Characters on either side that are looked at for context words.
    window: int = 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """From the right, every second digit is doubled, less 9 when above 9."""
    def weighed(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros aside, four digits are above 255.
        part = lambda p: let(F.regexp_replace(p, "^0+(?=[0-9])", ""), lambda x: F.when(
            F.length(x) <= 3, x.cast("int") <= 255).otherwise(False))
        return F.forall(F.split(value, r"\."), part)
    low, high = (12, 19) if kind == "card" else (9, 15)
    return let(_digits(value), lambda d: F.when(
        F.length(d).between(low, high), _luhn(d) if kind == "card" else F.lit(True)).otherwise(False))


def _located(text: Column, pattern: str) -> Column:
    """array of (value, start, end) of all matches, leftmost and non-overlapping."""
    def spans(m: Column) -> Column:
        gaps = F.split(text, pattern)
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, x: F.length(g) + F.length(x))
        return let(lengths, lambda n: let(running_totals(n), lambda e: F.zip_with(m, e, lambda x, end: F.struct(
            x.alias("value"), (end - F.length(x)).alias("start"), end.alias("end")))))

    none = F.array().cast("array<struct<value:string,start:int,end:int>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(none))


def _spans_of_kind(text: Column, k: int, kind: str) -> Column:
    named = lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    found = F.transform(F.filter(_located(text, _PATTERNS[kind]), lambda s: _valid(kind, s["value"])), named)
    none = F.array().cast("array<struct<start:int,k:int,end:int,kind:string>>")
    return F.when(F.contains(text, F.lit(_HINTS[kind])), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """array of (start, k, end, kind) in order of start, then kind as listed."""
    return F.sort_array(F.concat(*(_spans_of_kind(text, k, kind) for k, kind in enumerate(KINDS))))


def _identifiers(text: Column, base: Column) -> Column:
    """Tokens with a digit or @ and at least four digits or an @, outside of all base spans."""
    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["value"], r"^[^A-Za-z0-9+@]*", 0))
        tail = F.length(F.regexp_extract(s["value"], r"[^A-Za-z0-9]*+$", 0))
        return F.struct(
            F.substr(s["value"], lead + 1, F.length(s["value"]) - lead - tail).alias("value"),
            (s["start"] + lead).alias("start"), (s["end"] - tail).alias("end"))

    likely = lambda s: F.contains(s["value"], F.lit("@")) | (F.length(_digits(s["value"])) >= 4)
    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    tokens = F.transform(F.filter(_located(text, _TOKEN), likely), trimmed)
    return F.filter(tokens, lambda s: (s["start"] < s["end"]) & likely(s) & apart(s))


def _contexts(text: Column, s: Column, window: int) -> Column:
    """Lexical patterns of a span: two words before; one word before and one after."""
    cut = F.greatest(s["start"] - window, F.lit(0))
    before = F.filter(F.split(F.lower(F.substr(text, cut + 1, s["start"] - cut)), r"\s+"), lambda w: w != "")
    after = F.filter(F.split(F.lower(F.substr(text, s["end"] + 1, F.lit(window))), r"\s+"), lambda w: F.length(w) > 1)
    return let(before, lambda b: let(after, lambda a: F.filter(F.array(
        F.concat(F.get(b, F.size(b) - 2), F.lit(" "), F.get(b, F.size(b) - 1), F.lit(" _")),
        F.concat(F.get(b, F.size(b) - 1), F.lit(" _ "), F.get(a, F.lit(0))),
    ), lambda p: p.isNotNull())))


def _scan(docs: DataFrame, settings: Bootstrap, keep_text: bool) -> tuple[DataFrame, str, str, str]:
    """One pass over the texts: base spans, and the occurrences that take part in the graph."""
    row, base, seen = own("row"), own("base"), own("seen")
    text = text_of()
    both = let(base_spans(text), lambda b: F.struct(b.alias("base"), F.transform(
        F.concat(
            F.transform(b, lambda s: F.struct(
                s["kind"].alias("kind"), F.substr(text, s["start"] + 1, s["end"] - s["start"]).alias("value"),
                s["start"].alias("start"), s["end"].alias("end"))),
            F.when(text.rlike("[0-9@]"), F.transform(_identifiers(text, b), lambda s: F.struct(
                F.lit(None).cast("string").alias("kind"), s["value"].alias("value"),
                s["start"].alias("start"), s["end"].alias("end")))).otherwise(
                    F.array().cast("array<struct<kind:string,value:string,start:int,end:int>>")),
        ),
        lambda s: F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"), s["start"].alias("start"),
                           s["end"].alias("end"), _contexts(text, s, settings.window).alias("patterns")),
    ).alias("seen")))
    carried = [c for c in docs.columns if keep_text or c != "text"]
    found = docs.withColumn(base, both).select(
        *carried, F.monotonically_increasing_id().alias(row), F.col(f"{base}.base").alias(base), F.col(f"{base}.seen").alias(seen))
    return stage(found, "pii-scan"), row, base, seen


def _learn(seen: DataFrame, settings: Bootstrap) -> DataFrame:
    """(pattern, value, kind): unknown values that well-scored patterns give a kind."""
    edges = stage(seen.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct(), "pii-edges")
    seeds = edges.filter("kind IS NOT NULL")
    known = seeds.select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    unknown = edges.filter("kind IS NULL").select("pattern", "value").join(
        known.select("value").distinct(), "value", "left_anti")
    support = seeds.groupBy("pattern", "kind").agg(F.count_distinct("value").alias("support")).filter(
        F.col("support") >= settings.min_support)
    size = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
    candidates = stage(support.join(size, "pattern"), "pii-candidates")
    # Only patterns with support matter from here on.
    links = stage(edges.select("pattern", "value").distinct().join(
        candidates.select("pattern").distinct(), "pattern", "left_semi"), "pii-links")
    unknown = unknown.join(candidates.select("pattern").distinct(), "pattern", "left_semi")
    scores = known
    for _ in range(settings.rounds):
        patterns = links.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("mass")).join(
            candidates, ["pattern", "kind"]).withColumn("pattern_score", F.col("mass") / F.col("n"))
        patterns = patterns.filter(F.col("pattern_score") >= settings.min_pattern_score)
        told = unknown.join(patterns, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("pattern_score"), F.lit(1e-6)))))).alias("score"))
        scores = stage(known.unionByName(told), "pii-scores")
    best = scores.join(known.select("value").distinct(), "value", "left_anti").filter(
        F.col("score") >= settings.min_instance_score).groupBy("value").agg(
        F.max(F.struct("score", "kind"))["kind"].alias("kind"))
    return unknown.join(best, "value").select("pattern", "value", F.col("kind").alias("told"))


def _with_spans(docs: DataFrame, settings: Bootstrap, keep_text: bool) -> tuple[DataFrame, str, str]:
    """The scanned rows with the arrays of base and of added spans."""
    scan, row, base, seen = _scan(docs, settings, keep_text)
    occurrences = scan.select(row, F.explode(seen).alias("s")).select(row, "s.*")
    learned = _learn(occurrences, settings)
    unknown = occurrences.filter("kind IS NULL").select(row, "value", "start", "end", F.explode("patterns").alias("pattern"))
    order = F.element_at(F.create_map(*(F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k))), F.col("told"))
    # At most the identifiers of one text come together.
    added = stage(unknown.join(learned, ["pattern", "value"]).select(row, F.struct(
        "start", order.alias("k"), "end", F.col("told").alias("kind")).alias("s")).groupBy(row).agg(
        F.sort_array(F.collect_set("s")).alias(seen)), "pii-added")
    joined = scan.drop(seen).join(added, row, "left").drop(row)
    none = F.array().cast("array<struct<start:int,k:int,end:int,kind:string>>")
    return joined.withColumn(seen, F.coalesce(seen, none)), base, seen


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def find_pii(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """The documents (without their text) with `base_spans` and `spans`, arrays of
    (kind, start, end) by start, then kind."""
    rows, base, added = _with_spans(refuse_clash(docs, "base_spans", "spans"), settings, False)
    return rows.withColumns({
        "base_spans": _plain(F.col(base)), "spans": _plain(F.sort_array(F.concat(base, added))),
    }).drop(base, added)


def redact(docs: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """The documents with every span replaced by its kind, as in ``[EMAIL]``.

    Of overlapping spans the first keeps its name; what another one has beyond it is
    replaced too. A null text stays null.
    """
    rows, base, added = _with_spans(docs, settings, True)
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.when(s["start"] > acc["at"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        name = F.when(s["end"] > acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], between, name).alias("out"))

    spans = F.sort_array(F.concat(base, added))
    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    changed = F.when(F.size(base) + F.size(added) > 0, clean).otherwise(text)
    return rows.withColumn("text", changed).select(*docs.columns)


def digest(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
