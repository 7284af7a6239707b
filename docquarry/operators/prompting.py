"""Prompts as string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prompt text. Answers depend on every character of it, as with the three below.
ANSWER_PROMPT = """
You are an expert AI assistant for answering questions based on documents.

Instructions:
- Answer ONLY using the provided context
- Do NOT make up information
- If the answer is not in the context, say "I don't know"
- Keep answers concise and accurate
- Refer to the metadata to filter relevant course-specific information and cite sources for the information you provide

Context:
{context}

Question:
{question}

Answer:
"""

# Fixed value: the prompt text.
QA_PROMPT = """
        You are generating evaluation data for a retrieval-augmented QA system.

        Given the following document, generate {samples_per_file} high-quality question-answer pairs.

        Requirements:
        - Questions must be specific and diverse
        - Each question must be answerable ONLY from the document
        - Answers must be concise and directly supported by the text
        - Avoid repetition
        - Avoid yes/no questions

        IMPORTANT:
        - For EACH QA pair, include a SHORT exact supporting text span from the document

        Output STRICTLY in JSON format:
        [
        {
            "question": "...",
            "answer": "...",
            "support": "exact supporting text"
        }
        ]

        Document:
        {document}
        """

# Fixed value: the prompt text.
FAITHFULNESS_PROMPT = """
You are evaluating a RAG system.

Question:
{question}

Context:
{context}

Answer:
{answer}

Is the answer fully supported by the context?

Score from 0 to 1:
- 1 = fully grounded in context
- 0 = hallucinated or unsupported

Only output a number.
"""

# Fixed value: the prompt text.
RELEVANCY_PROMPT = """
Question:
{question}

Answer:
{answer}

How relevant is the answer to the question?

Score from 0 to 1:
- 1 = perfectly answers
- 0 = irrelevant

Only output a number.
"""


def fill(template: str, **values: Column) -> Column:
    """Concatenate the template's fixed parts with the columns, so that signs
    inside a value are never read as template syntax."""
    places = sorted((template.index("{" + name + "}"), name) for name in values)
    parts, at = [], 0
    for begin, name in places:
        parts += [F.lit(template[at:begin]), F.coalesce(values[name].cast("string"), F.lit(""))]
        at = begin + len(name) + 2
    return F.concat(*parts, F.lit(template[at:]))


def context_of(texts: Column) -> Column:
    """Hit texts in rank order, a blank line between them."""
    return F.array_join(texts, "\n\n")


def answer_prompt(context: Column, question: Column) -> Column:
    # The template ends in fixed text, so only line breaks at its two ends go.
    return fill(ANSWER_PROMPT.strip(), context=context, question=question)


def qa_prompt(document: Column, samples_per_file: int) -> Column:
    return fill(QA_PROMPT, samples_per_file=F.lit(samples_per_file), document=document)


def faithfulness_prompt(question: Column, context: Column, answer: Column) -> Column:
    return fill(FAITHFULNESS_PROMPT, question=question, context=context, answer=answer)


def relevancy_prompt(question: Column, answer: Column) -> Column:
    return fill(RELEVANCY_PROMPT, question=question, answer=answer)
