"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. For each bit a binary classifier tells the languages with
that bit set from the others: per n-gram slot the log ratio of the two sides' shares (each
language weighs the same), averaged over the text. A text goes to the codeword with the
least weighted loss, where a bit weighs as much as the bit's classifier is worth on the
training texts. The result is flagged as ambiguous when two codewords are close.

Training counts n-grams of all labelled texts in Spark (partial counts per task, summed
by language and slot); the model that is sent out has `slots` x bits numbers, a fixed size
for a fixed number of languages. N-grams of one to three letters are hashed, so no
vocabulary is gathered.

Edge cases: a text that is null or has no letter is `und` with score 0 and is not learned
from. Documents without id or language are not learned from. Without any language, all
texts are `und`; with one, that one is predicted. Ties go to the language first in order.
Columns named like a result are replaced; others are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import own, refuse_clash
from docquarry.session import stage

RESULTS = ("lang_pred", "score", "ambiguous")
_SPACE = 32
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def grams(text: str | None, slots: int) -> np.ndarray:
    """Slots of all 1- to 3-grams of letters and word borders; empty without a letter.

    Works on blocks, so long texts need bounded memory beyond the text itself.
    """
    if not text:
        return np.empty(0, dtype=np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letter_table()[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the border after a word
    p = np.where(letter, points, _SPACE)[keep].astype(np.uint64)
    p = np.concatenate(([np.uint64(_SPACE)], p))
    out = [p * np.uint64(0x9E3779B97F4A7C15)]
    for n in (1, 2):
        if len(p) > n:
            longer = out[-1][:-1] + p[n:] * np.uint64((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[n - 1])
            out.append((longer ^ (longer >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    found = np.concatenate(out)
    return ((found ^ (found >> np.uint64(32))) % np.uint64(slots)).astype(np.int64)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n distinct codewords (n x bits, of +1 and -1), no bit equal for all languages.

    Up to five languages get the exhaustive code (all splits in two); more get the best of
    some random codes of fixed length, by the smallest distance of two codewords.
    """
    if n < 2:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 5:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(n)], dtype=np.int8)
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = max(15, int(np.ceil(10 * np.log2(n))))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]
        distance = (code.shape[1] - code.astype(np.int64) @ code.T.astype(np.int64)) // 2
        np.fill_diagonal(distance, bits)
        if distance.min() > far:
            best, far = code, distance.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray  # slots x bits
    bit_weights: np.ndarray
    slots: int

    def margins(self, slots: np.ndarray) -> np.ndarray:
        total = np.zeros(self.weights.shape[1])
        for begin in range(0, len(slots), 1 << 16):
            total += self.weights[slots[begin:begin + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / len(slots)

    def decode(self, margins: np.ndarray) -> tuple[str, float, float]:
        """(language, share of the best codeword, lead of the best over the second loss)."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, 1.0
        loss = np.exp(np.clip(-self.code * margins, -30, 30)) @ self.bit_weights
        order = np.argsort(loss, kind="stable")
        share = 1 / loss
        lead = float(1 - loss[order[0]] / loss[order[1]])
        return self.languages[order[0]], float(share[order[0]] / share.sum()), lead


def train(labelled: DataFrame, slots: int = 1 << 14, smoothing: float = 0.5) -> Model:
    """Fits the binary classifiers on all rows of (text, lang)."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("slot", T.IntegerType()),
                           T.StructField("n", T.LongType())])

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found = grams(text, slots)
                if len(found):
                    if lang not in totals:
                        totals[lang] = np.zeros(slots, dtype=np.int64)
                    totals[lang] += np.bincount(found, minlength=slots)
        for lang, n in totals.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(n[used])],
                names=["lang", "slot", "n"])

    rows = labelled.filter("lang IS NOT NULL").select("text", "lang")
    counted = rows.mapInArrow(count, schema).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(set(counted.column("lang").to_pylist())))
    place = {x: i for i, x in enumerate(languages)}
    table = np.full((len(languages), slots), smoothing)
    at = np.array([place[x] for x in counted.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(table, (at, counted.column("slot").to_numpy()), counted.column("n").to_numpy())
    shares = table / table.sum(axis=1, keepdims=True) if len(languages) else table
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((slots, bits), dtype=np.float32)
    value = np.ones(bits)
    for b in range(bits):
        on, off = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0)
        # Per n-gram the evidence is small; the scale brings usual margins to about one.
        weights[:, b] = 4 * np.log(on / off)
        # How far the classifier sets apart the languages it has learned from.
        value[b] = max(1e-3, float((code[:, b] * (shares @ weights[:, b])).min()))
    return Model(languages, code, weights, value / max(value.sum(), 1e-9), slots)


def identify(docs: DataFrame, model: Model, lead: float = 0.2) -> DataFrame:
    """The documents (without their text) with lang_pred, score and ambiguous."""
    base = refuse_clash(docs, *RESULTS)
    kept = [c for c in base.columns if c != "text"]
    schema = T.StructType([base.schema[c] for c in kept] + [
        T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
        T.StructField("ambiguous", T.BooleanType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            results = []
            for text in batch.column("text").to_pylist():
                found = grams(text, model.slots)
                if not len(found) or not model.languages:
                    results.append(("und", 0.0, True))
                else:
                    lang, score, ahead = model.decode(model.margins(found))
                    results.append((lang, score, ahead < lead))
            langs, scores, flags = zip(*results) if results else ((), (), ())
            columns = [batch.column(c) for c in kept] + [
                pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score", "ambiguous"])

    return base.select(*kept, "text").mapInArrow(run, schema)
