"""Queries over prompts, answers and evaluation-set construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.operators.evalset import (
    document_heads, document_texts, first_samples, native_qa_output, parse_qa, qa_prompts, sample_files,
)
from docquarry.operators.elements import prepare_elements
from docquarry.operators.generation import answer, best_sentence, with_models
from docquarry.operators.prompting import ANSWER_PROMPT, QA_PROMPT, answer_prompt, context_of
from docquarry.operators.retrieval import hits_as_array
from docquarry.plans.inputs import (
    DOCS, GOLD, LINES, documents, gold, line_elements, questions, terms_sql, with_ctes, words_sql,
)
from docquarry.plans.jobs import make_evaluation_set
from docquarry.plans.registry import query, table
from docquarry.plans.search import OPEN_HITS, open_hits
from docquarry.session import stage

MODELS = ["best_sentence", "first_passage", "first_sentence"]


def literal_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fill_sql(template: str, **values: str) -> str:
    """The SQL concatenation that fills a prompt template."""
    text = literal_sql(template)
    for name, value in values.items():
        text = text.replace("{" + name + "}", f"' || {value} || '")
    return text


def asked(spark, sf_dir):
    """(query_id, question, context): each question with its retrieved context."""
    found = hits_as_array(open_hits(spark, sf_dir)).select(
        "query_id", context_of(F.col("texts")).alias("context")
    )
    return questions(spark, sf_dir).select("query_id", "question").join(found, "query_id")


ASKED = [*OPEN_HITS, """asked AS (
  SELECT query_id, any_value(b.text) AS question,
    string_agg(h.text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits h JOIN benchmark b ON item_id = query_id GROUP BY query_id)"""]


def sentences_sql(text: str) -> str:
    clean = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    return (
        f"list_filter(string_split(regexp_replace({clean}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)),"
        " lambda s: s <> '')"
    )


ANSWERED = [*ASKED, f"""sents AS (
  SELECT query_id, question, context, unnest({sentences_sql('context')}) AS s,
    generate_subscripts({sentences_sql('context')}, 1) AS place FROM asked),
rated AS (
  SELECT query_id, s, place,
    len(list_intersect(list_distinct({terms_sql('question')}), {terms_sql('s')})) AS shared
  FROM sents),
best AS (
  SELECT query_id, CASE WHEN shared > 0 THEN s ELSE 'I don''t know' END AS answer FROM rated
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, place) = 1),
answers AS (
  SELECT 'best_sentence' AS model, query_id, answer FROM best
  UNION ALL SELECT 'first_passage', query_id, string_split(context, chr(10) || chr(10))[1] FROM asked
  UNION ALL SELECT 'first_sentence', query_id, s FROM sents WHERE place = 1)"""]


@query("g1_context", with_ctes(*ASKED) + "SELECT query_id, context FROM asked")
def g1(spark, sf_dir):
    return asked(spark, sf_dir).select("query_id", "context")


@query("g2_answer_prompt", with_ctes(*ASKED) + f"""
SELECT query_id, {fill_sql(ANSWER_PROMPT.strip(), context='context', question='question')} AS prompt
FROM asked""")
def g2(spark, sf_dir):
    prompt = answer_prompt(F.col("context"), F.col("question"))
    return asked(spark, sf_dir).select("query_id", prompt.alias("prompt"))


@query("g3_extractive_answer", with_ctes(*ANSWERED) + "SELECT query_id, answer FROM best")
def g3(spark, sf_dir):
    rows = asked(spark, sf_dir)
    return rows.select("query_id", best_sentence(F.col("context"), F.col("question")).alias("answer"))


@query("g4_retrieve_and_answer", with_ctes(*ANSWERED) + """
SELECT query_id, question, answer FROM best JOIN asked USING (query_id)""")
def g4(spark, sf_dir):
    rows = with_models(asked(spark, sf_dir), ["best_sentence"])
    return answer(rows).select("query_id", "question", "answer")


@query("g5_many_models", with_ctes(*ANSWERED) + "SELECT model, query_id, answer FROM answers")
def g5(spark, sf_dir):
    """One retrieval, one answer per model."""
    return answer(with_models(asked(spark, sf_dir), MODELS)).select("model", "query_id", "answer")


def normalized(spark, sf_dir):
    """The normalised stage, written once because several passes read it."""
    return stage(prepare_elements(line_elements(spark, sf_dir)), "normalized")


_HEADS = r"""clean AS (
  SELECT source_file, seq, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM lines
  WHERE regexp_matches(text, '\S')),
whole AS (SELECT source_file, string_agg(text, chr(10) ORDER BY seq) AS text FROM clean GROUP BY 1),
heads AS (
  SELECT source_file, substr(w.text, 1, 4000) AS head, lang,
    CASE WHEN contains(filename, '_') THEN split_part(filename, '_', 1) ELSE filename END AS coursename,
    CASE WHEN contains(filename, '_') THEN replace(replace(replace(
      substr(filename, instr(filename, '_') + 1), '.pdf', ''), '.docx', ''), '.doc', '') END AS coursecode
  FROM whole w JOIN docs USING (source_file))"""
_HEAD_CTES = [DOCS, LINES, _HEADS]
_KEY = "trim(coalesce(coursename, '') || '_' || coalesce(coursecode, ''), '_')"


@query("v1_sample_files", with_ctes(DOCS) + """
SELECT source_file FROM docs ORDER BY md5('0' || source_file), source_file LIMIT 15""")
def v1(spark, sf_dir):
    return sample_files(documents(spark, sf_dir).select("source_file"), 15)


@query("v2_v4_document_heads", with_ctes(*_HEAD_CTES) + "SELECT source_file, head FROM heads")
def v2(spark, sf_dir):
    return document_heads(normalized(spark, sf_dir)).select("source_file", "head")


@query("v2_document_text", with_ctes(*_HEAD_CTES) + "SELECT source_file, text FROM whole")
def v2_whole(spark, sf_dir):
    """The whole text of every file, put together from its elements."""
    return document_texts(normalized(spark, sf_dir))


@query("v3_v5_course_keys", with_ctes(*_HEAD_CTES) + f"""
SELECT source_file, coursename, coursecode, {_KEY} AS course_key FROM heads""")
def v3(spark, sf_dir):
    heads = document_heads(normalized(spark, sf_dir))
    return heads.select("source_file", "coursename", "coursecode", "course_key")


_QA_SQL = fill_sql(QA_PROMPT.replace("{samples_per_file}", "3"), document="head")


@query("v6_qa_prompt", with_ctes(*_HEAD_CTES) + f"SELECT source_file, {_QA_SQL} AS prompt FROM heads")
def v6(spark, sf_dir):
    heads = document_heads(normalized(spark, sf_dir))
    return qa_prompts(heads, samples_per_file=3).select("source_file", "prompt")


def qa_replies(spark, sf_dir):
    """Replies of the native question writer; those for German documents lack their
    closing bracket and cannot be read."""
    heads = document_heads(normalized(spark, sf_dir)).join(
        documents(spark, sf_dir).select("source_file", "lang"), "source_file"
    )
    reply = native_qa_output(F.col("head"), 3)
    cut = F.when(F.col("lang") == "de", F.replace(reply, F.lit("]"), F.lit(""))).otherwise(reply)
    return heads.select("source_file", cut.alias("output"))


_QA_ITEMS = f"""heard AS (
  SELECT DISTINCT source_file, lang, unnest({sentences_sql('head')}) AS s FROM heads),
placed AS (
  SELECT source_file, lang, s,
    row_number() OVER (PARTITION BY source_file ORDER BY length(s) DESC, s) - 1 AS item FROM heard),
qa AS (
  SELECT source_file, item::INT AS item, lang,
    'What follows "' || array_to_string(list_slice({words_sql('s')}, 1, 5), ' ') || '"?' AS question,
    s AS ground_truth_answer, s AS reference_text
  FROM placed WHERE item < 3)"""


@query("v7_generate_questions", with_ctes(*_HEAD_CTES, _QA_ITEMS) + """
SELECT source_file, lang <> 'de' AS readable,
  count(*) FILTER (lang <> 'de')::INT AS pairs FROM qa GROUP BY source_file, lang""")
def v7(spark, sf_dir):
    items = F.size(F.from_json(
        F.regexp_extract("output", r"(?s)\[.*\]", 0), "array<struct<question string>>"
    ))
    return qa_replies(spark, sf_dir).select(
        "source_file", F.col("output").contains("]").alias("readable"),
        F.greatest(items, F.lit(0)).alias("pairs"),
    )


@query("v8_unreadable_replies", with_ctes(*_HEAD_CTES) + """
SELECT source_file FROM heads WHERE lang = 'de'""")
def v8(spark, sf_dir):
    return parse_qa(qa_replies(spark, sf_dir))[1].select("source_file")


@query("v9_qa_samples", with_ctes(*_HEAD_CTES, _QA_ITEMS) + """
SELECT source_file, item, question, ground_truth_answer, reference_text FROM qa WHERE lang <> 'de'""")
def v9(spark, sf_dir):
    samples, _ = parse_qa(qa_replies(spark, sf_dir))
    return samples.select("source_file", "item", "question", "ground_truth_answer", "reference_text")


@query("gold_containing_files", with_ctes(GOLD) + "SELECT query_id, source_file FROM gold")
def containing(spark, sf_dir):
    return gold(spark, sf_dir)


@query("m8_first_samples", """
SELECT item_id AS sample_id, text AS question FROM benchmark WHERE item_id < 20""")
def m8(spark, sf_dir):
    """The first 20 samples in file order: the evaluators' `max_samples`."""
    rows = table(spark, sf_dir, "benchmark").toDF("sample_id", "question")
    return first_samples(rows, 20)


@query("m8_first_of_evaluation_set", with_ctes(*_HEAD_CTES, _QA_ITEMS) + """
SELECT source_file || '#' || item AS sample_id, question FROM qa
WHERE source_file IN (SELECT source_file FROM docs ORDER BY md5('0' || source_file), source_file LIMIT 12)
ORDER BY source_file, item LIMIT 7""")
def m8_chain(spark, sf_dir):
    """An evaluation set of twelve files, and the first seven of its samples."""
    samples = make_evaluation_set(normalized(spark, sf_dir), num_files=12, samples_per_file=3)
    return first_samples(samples, 7).select("sample_id", "question")
