"""Generators: a prompt goes in, an answer or an error comes out.

A generator is any object with `run(df, prompt, out)`, which adds the struct
`out<answer, error>`. A model behind a service is a `UserGenerator`. The native
ones need no model: they answer from the context by rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.text import collapse_whitespace, terms
from docquarry.operators.prompting import answer_prompt

UNKNOWN = "I don't know"
REPLY = T.StructType([
    T.StructField("answer", T.StringType()), T.StructField("error", T.StringType()),
])


@dataclass
class UserGenerator:
    """A model client given as Python code, opened once per task.

    `load` returns `call(prompt, temperature, max_tokens) -> str`. A failing call
    gives a row with an error and no answer; the other rows go on. `mapInArrow`
    makes sure no prompt is sent twice because of how the plan is optimised. After a
    failure of a class in `stop_on` (say `ConnectionError`) a task asks no more: its other
    rows have the error too, are not finished, and a rerun takes them up.
    """

    load: Callable[[], Callable[[str, float, int], str]]
    temperature: float = 0.2
    max_tokens: int = 512
    stop_on: tuple[type[Exception], ...] = ()

    def run(self, df: DataFrame, prompt: str = "prompt", out: str = "reply") -> DataFrame:
        load, temperature, max_tokens, stop_on = self.load, self.temperature, self.max_tokens, self.stop_on
        schema = T.StructType(df.schema.fields + [T.StructField(out, REPLY)])
        reply_type = pa.struct([("answer", pa.string()), ("error", pa.string())])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            call, stopped = load(), None

            def reply(text):
                nonlocal stopped
                if stopped:
                    return {"answer": None, "error": f"not asked after: {stopped}"}
                try:
                    return {"answer": call(text, temperature, max_tokens), "error": None}
                except Exception as error:  # noqa: BLE001 - any failure belongs to its row
                    if isinstance(error, stop_on):
                        stopped = str(error) or type(error).__name__
                    return {"answer": None, "error": str(error)}

            for batch in batches:
                prompts = batch.column(batch.schema.get_field_index(prompt)).to_pylist()
                replies = pa.array([reply(p) for p in prompts], reply_type)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, replies], [*batch.schema.names, out]
                )

        return df.mapInArrow(work, schema)


def sentences(text: Column) -> Column:
    """Sentences end at a full stop, question or exclamation mark before white space."""
    parts = F.split(collapse_whitespace(text), r"(?<=[.!?]) ")
    return F.array_remove(parts, "")


def best_sentence(context: Column, question: Column) -> Column:
    """The sentence that shares the most terms with the question, the first among equals."""
    asked = F.array_distinct(terms(question))
    rated = F.transform(
        sentences(context),
        lambda s, i: F.struct(
            F.size(F.array_intersect(asked, terms(s))).alias("shared"), (-i).alias("place"), s.alias("text")
        ),
    )
    best = F.array_max(rated)
    return F.when(best["shared"] > 0, best["text"]).otherwise(UNKNOWN)


def first_sentence(context: Column, question: Column) -> Column:
    return F.coalesce(F.get(sentences(context), F.lit(0)), F.lit(UNKNOWN))


def first_passage(context: Column, question: Column) -> Column:
    """The whole best hit."""
    return F.coalesce(F.nullif(F.get(F.split(context, "\n\n"), F.lit(0)), F.lit("")), F.lit(UNKNOWN))


# Native stand-ins for models, by name.
NATIVE_MODELS: dict[str, Callable[[Column, Column], Column]] = {
    "best_sentence": best_sentence,
    "first_passage": first_passage,
    "first_sentence": first_sentence,
}


def with_models(questions: DataFrame, models: list[str]) -> DataFrame:
    """Every question once per model. The list is part of the plan, so nothing is joined."""
    return questions.withColumn("model", F.explode(F.array(*map(F.lit, models))))


def answer(
    asked: DataFrame, generators: dict[str, UserGenerator] | None = None
) -> DataFrame:
    """Add `answer` and `error` to (query_id, question, context, model) rows.

    Models named in `generators` are called with the answer prompt; the others must
    be native.
    """
    generators = generators or {}
    native = F.lit(None).cast("string")
    for name, rule in NATIVE_MODELS.items():
        native = F.when(F.col("model") == name, rule(F.col("context"), F.col("question"))).otherwise(native)
    own = asked.filter(~F.col("model").isin(list(generators))) if generators else asked
    done = own.withColumn("answer", native).withColumn("error", F.lit(None).cast("string"))
    for name, generator in generators.items():
        prompted = asked.filter(F.col("model") == name).withColumn(
            "_prompt", answer_prompt(F.col("context"), F.col("question"))
        )
        replied = generator.run(prompted, "_prompt", "_reply")
        done = done.unionByName(
            replied.select(*asked.columns, F.col("_reply.answer"), F.col("_reply.error"))
        )
    return done
