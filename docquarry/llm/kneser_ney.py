"""Quality classifier: perplexity under a modified Kneser-Ney model of trusted text.

One model per language, over characters of the lower-cased text (n-grams of up to `ORDER`,
interpolated, three discounts per order). Counting, continuation counts, discounts and the
interpolation with the next lower order are groupings and equi-joins in Spark; the counts
grow with the trusted text and are never gathered whole.

Scoring goes shard by shard: a shard holds the n-grams whose history ends in some of the
characters, at most about `SHARD` rows, and every shard meets all documents. A position's
probability and all back-off weights on its way are in one shard, so the shards' sums add
up to the document's log probability. A larger model means more shards, not larger ones.

A document is kept if its perplexity is at most the language's threshold: a quantile over
the trusted documents, with some slack.

Edge cases: a null text is empty; empty texts, and languages without trusted text, have no
perplexity and are kept. Documents without a language are a group of their own. Repeated
rows get equal results. Columns named like a result are replaced, others are carried
along. An empty table gives an empty result; without trusted text everything is kept. A
perplexity equal to the threshold is kept. A very long text is scored in its row, with
some arrays of a number per character.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import own, refuse_clash, text_of
from docquarry.session import stage

ORDER = 4
SHARD = 2_000_000
RESULTS = ("perplexity", "threshold", "kept")
#: Stands before a text's first character.
_START = "\x02"
_FLUSH = 500_000


def _count_grams(trusted: DataFrame) -> DataFrame:
    """(lang, g, c): n-grams of the highest order, with their counts."""
    def run(batches):
        held: dict[str, Counter] = {}

        def rows():
            for lang, counter in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter)), pa.array(list(counter)), pa.array(list(counter.values()), pa.int64())],
                    names=["lang", "g", "c"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                t = _START * (ORDER - 1) + text.lower()
                held.setdefault(lang, Counter()).update(map("".join, zip(*(t[i:] for i in range(ORDER)))))
                if sum(map(len, held.values())) > _FLUSH:
                    yield from rows()
        yield from rows()

    return trusted.mapInArrow(run, "lang string, g string, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the numbers of n-grams seen once to four times."""
    n = [F.count(F.when(F.col("c") == k, 1)) for k in range(1, 5)]
    raw = counts.groupBy("lang").agg(*(x.alias(f"n{k}") for k, x in enumerate(n, 1)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    bounded = lambda k: F.when(
        (F.col("n1") > 0) & (F.col(f"n{k}") > 0),
        F.least(F.lit(k - 0.05), F.greatest(F.lit(0.05), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))),
    ).otherwise(k / 2)
    return raw.select("lang", *(bounded(k).alias(f"d{k}") for k in (1, 2, 3)))


def train(trusted: DataFrame) -> DataFrame:
    """(lang, g, logp, backoff): log probabilities of n-grams, log weights of histories.

    The history "" and the n-gram "" (any unseen character) are rows too.
    """
    levels = [stage(_count_grams(trusted), "kn-counts")]
    for _ in range(ORDER - 1):
        # Lower orders count how many different characters come before.
        levels.append(stage(levels[-1].groupBy("lang", F.expr("substring(g, 2)").alias("g")).agg(F.count("*").alias("c")), "kn-counts"))
    lower, rows = None, []
    for order, counts in enumerate(reversed(levels), 1):
        history = F.expr(f"substring(g, 1, {order - 1})")
        c = F.col("c")
        d = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = counts.join(F.broadcast(_discounts(counts)), "lang").withColumn("d", d).withColumn("h", history)
        histories = cut.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("taken"), F.count("*").alias("types"))
        joined = cut.join(histories, ["lang", "h"])
        left, weight = (c - F.col("d")) / F.col("total"), F.col("taken") / F.col("total")
        if lower is None:
            # Characters that were seen, and one for all others, share what is left.
            uniform = 1 / (F.col("types") + 1)
            p = joined.select("lang", "g", (left + weight * uniform).alias("p"))
            unseen = histories.select("lang", F.lit("").alias("g"), (weight * uniform).alias("p"))
            rows.append(unseen.select("lang", "g", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff")))
        else:
            base = lower.select("lang", F.col("g").alias("s"), F.col("p").alias("q"))
            p = joined.withColumn("s", F.expr("substring(g, 2)")).join(base, ["lang", "s"]).select(
                "lang", "g", (left + weight * F.col("q")).alias("p"))
            rows.append(histories.select("lang", F.col("h").alias("g"), F.lit(None).cast("double").alias("logp"), F.log(weight).alias("backoff")))
        lower = stage(p, "kn-probabilities")
        rows.append(lower.select("lang", "g", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff")))
    model = rows[0]
    for part in rows[1:]:
        model = model.unionByName(part)
    return stage(model, "kn-model")


class Shard:
    """Sorted keys of one language's n-grams and histories, by length."""

    def __init__(self, grams: list[str], logp: np.ndarray, backoff: np.ndarray):
        alphabet = sorted({ch for g in grams for ch in g})
        self.codes = {ord(ch): i + 1 for i, ch in enumerate(alphabet)}
        self.base = np.uint64(len(alphabet) + 1)
        self.points = np.array([ord(ch) for ch in alphabet], dtype=np.uint32)
        self.tables = {}
        lengths = np.array([len(g) for g in grams])
        for kind, values in (("p", logp), ("b", backoff)):
            for k in range(ORDER + 1):
                at = np.flatnonzero((lengths == k) & ~np.isnan(values))
                keys = np.array([self._key(grams[i]) for i in at], dtype=np.uint64)
                order = np.argsort(keys)
                self.tables[kind, k] = keys[order], values[at][order]
        self.unseen = float(self.tables["p", 0][1][0]) if len(self.tables["p", 0][1]) else -20.0

    def _key(self, gram: str) -> int:
        key = 0
        for ch in gram:
            key = key * int(self.base) + self.codes[ord(ch)]
        return key

    def _look_up(self, kind: str, k: int, keys: np.ndarray, default: float) -> np.ndarray:
        known, values = self.tables[kind, k]
        if not len(known):
            return np.full(len(keys), default)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[at], default)

    def score(self, text: str, number: int = 0, shards: int = 1) -> tuple[float, int]:
        """(sum of log probabilities, positions) where the character before belongs to the
        shard of that number."""
        points = np.frombuffer((_START * (ORDER - 1) + text.lower()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        codes = np.where(self.points[at] == points, at + 1, 0).astype(np.uint64)
        keys = [np.zeros(len(points), dtype=np.uint64)]
        for k in range(1, ORDER + 1):  # keys[k][i]: the k characters up to and with i
            shifted = np.concatenate((np.zeros(1, np.uint64), keys[-1][:-1])) if k > 1 else keys[0]
            keys.append(shifted * self.base + codes)
        where = np.arange(ORDER - 1, len(points))
        where = where[points[where - 1] % np.uint32(shards) == number]
        whole, times = np.unique(keys[ORDER][where], return_counts=True)
        # The shorter keys are the last digits of the whole one; code 0 is an unknown character.
        total = np.zeros(len(whole))
        open_ = np.arange(len(whole))
        for k in range(ORDER, 0, -1):
            digits = whole[open_] % self.base ** np.uint64(k)
            p = self._look_up("p", k, digits, np.nan)
            missing = np.isnan(p)
            total[open_[~missing]] += p[~missing]
            open_, digits = open_[missing], digits[missing]
            if not len(open_):
                break
            if k > 1:
                total[open_] += self._look_up("b", k - 1, digits // self.base, 0.0)
        total[open_] += self.unseen
        return float(total @ times), len(where)


def _shards(model: DataFrame) -> Iterator[tuple[int, int, dict[str, Shard]]]:
    """(number, shards, models by language): each collects about `SHARD` rows at most."""
    n = -(-model.count() // SHARD)
    for number in range(n):
        # The character that ends the history: of a history the last, of an n-gram the last but one.
        ends = F.when(F.col("logp").isNull(), F.expr("right(g, 1)")).otherwise(F.expr("substring(g, length(g) - 1, 1)"))
        mine = (F.length("g") < 2) | (F.pmod(F.ascii(ends), F.lit(n)) == number)
        rows = model.filter(mine).groupBy("lang", "g").agg(F.max("logp").alias("p"), F.max("backoff").alias("b")).toArrow()
        languages = rows.column("lang").to_numpy(zero_copy_only=False)
        grams = rows.column("g").to_pylist()
        p, b = (rows.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("p", "b"))
        yield number, n, {
            lang: Shard([grams[i] for i in at], p[at], b[at])
            for lang in np.unique(languages.astype(str)) for at in [np.flatnonzero(languages == lang)]
        }


def perplexities(docs: DataFrame, model: DataFrame, key: str) -> DataFrame:
    """(key, perplexity) of (key, lang, text)."""
    parts = None
    for number, n, shards in _shards(model):
        shared = docs.sparkSession.sparkContext.broadcast(shards)

        def run(batches, shared=shared, number=number, n=n):
            shards = shared.value
            for batch in batches:
                out = [(k, *shards[lang].score(text, number, n)) for k, lang, text in zip(
                    *(batch.column(c).to_pylist() for c in (key, "lang", "text"))) if text and lang in shards]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.float64(), pa.int64()))], names=[key, "s", "n"])

        part = docs.select(key, "lang", "text").mapInArrow(run, f"{key} long, s double, n long")
        # Repeated rows have equal sums: one of each counts.
        part = part.groupBy(key).agg(F.max("s").alias("s"), F.max("n").alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return docs.sparkSession.createDataFrame([], f"{key} long, perplexity double")
    return parts.groupBy(key).agg(F.exp(-F.sum("s") / F.sum("n")).alias("perplexity"))


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.998, slack: float = 1.2) -> DataFrame:
    """The documents (without their text) with perplexity, threshold and kept.

    `trusted_ids` has the doc_id of the documents to learn from.
    """
    key, lang = own("key"), F.coalesce("lang", F.lit("und"))
    base = refuse_clash(docs, *RESULTS)
    ids = stage(trusted_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "kn-trusted")
    model = train(_of_ids(docs, ids).select(lang.alias("lang"), text_of().alias("text")))
    identity = F.xxhash64("doc_id", lang, text_of())
    keyed = docs.select(identity.alias(key), lang.alias("lang"), text_of().alias("text"))
    scores = stage(perplexities(keyed, model, key), "kn-scores")
    carried = base.withColumn(key, identity).select(*(c for c in base.columns if c != "text"), key)
    scored = stage(carried.join(scores, key, "left").drop(key), "kn-scored")
    # Trusted documents of a language: their quantile is a bounded sketch.
    group = own("lang")
    limits = scored.join(ids, "doc_id", "left_semi").groupBy(lang.alias(group)).agg(
        (F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold"))
    judged = scored.withColumn(group, lang).join(stage(limits, "kn-limits"), group, "left").drop(group)
    return judged.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of these ids. Whole-number ids become bitmaps, one of 4 KB for each range
    of 32,768, in a written table: Spark knows its size and sends it to the texts while it is
    small, where a list of the ids would make it shuffle the texts."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return docs.join(ids, "doc_id", "left_semi")
    number, bit, bits = own("number"), own("bit"), own("bits")
    key = F.col("doc_id").cast("long")
    maps = ids.groupBy(F.bitmap_bucket_number(key).alias(number)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(bits))
    held = docs.withColumns({number: F.bitmap_bucket_number(key), bit: F.bitmap_bit_position(key)}).join(stage(maps, "kn-bitmaps"), number)
    # Byte `bit` / 8 of the bitmap, lowest bit first.
    octet = F.conv(F.hex(F.substr(F.col(bits), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.filter(F.getbit(octet, (F.col(bit) % 8).cast("int")) == 1).drop(number, bit, bits)
