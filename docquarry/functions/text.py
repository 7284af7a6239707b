"""Text column functions, all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, plus the four separators Python also counts as space.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# The same runs, but for single spaces, which are fine as they are.
IRREGULAR_WHITESPACE = r"(?U)(?! [^\s\x1c-\x1f])[\s\x1c-\x1f]+"
NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"
# Signs cut from the ends of a word before it is compared or hashed.
EDGE_SIGNS = ".,;:!?()[]\""


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, IRREGULAR_WHITESPACE, " "))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def has_text(text: Column) -> Column:
    """Is there any character that is not white space? False for null."""
    return F.coalesce(text.rlike(NOT_WHITESPACE), F.lit(False))


def words(text: Column) -> Column:
    """Whitespace-separated words, in order; an empty array for blank or null text."""
    parts = F.array_remove(F.split(text, WHITESPACE), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def terms(text: Column) -> Column:
    """Lower-cased words without signs at their ends, empties dropped."""
    bare = F.transform(words(F.lower(text)), lambda w: F.btrim(w, F.lit(EDGE_SIGNS)))
    return F.array_remove(bare, "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def course_of(filename: Column) -> tuple[Column, Column]:
    """(coursename, coursecode) from ``name_code.ext``.

    The first underscore splits. Without one the whole file name is the name
    and there is no code. Extensions go from the code only, in lower case only.
    """
    split_at = F.instr(filename, "_")
    has_code = split_at > 0
    code = F.substring(filename, split_at + 1, F.length(filename))
    for extension in (".pdf", ".docx", ".doc"):
        code = F.replace(code, F.lit(extension), F.lit(""))
    name = F.when(has_code, strip(F.substring(filename, F.lit(1), split_at - 1))).otherwise(filename)
    return name, F.when(has_code, strip(code))


def stage_file_name(name: Column) -> Column:
    """``x_pdf.json``, ``x_doc.json`` and ``x_docx.json`` all become ``x.json``."""
    return F.regexp_replace(name, r"_(pdf|docx?)\.json", ".json")


def course_key(coursename: Column, coursecode: Column) -> Column:
    """``name_code`` without underscores at either end; null parts count as empty."""
    joined = F.concat(
        F.coalesce(coursename, F.lit("")), F.lit("_"), F.coalesce(coursecode, F.lit(""))
    )
    return F.btrim(joined, F.lit("_"))
