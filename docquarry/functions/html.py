"""HTML to text and HTML tables to Markdown, as regular-expression columns."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.arrays import once
from docquarry.functions.text import collapse_whitespace

# Parts whose content is not text of the page.
INVISIBLE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
HEADING_TAG = r"(?i)<(h[1-6]|title)\b[^>]*>"
ITEM_TAG = r"(?i)<li\b[^>]*>"
BLOCK_TAG = (
    r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form"
    r"|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th"
    r"|thead|title|tr|ul)\b[^>]*>"
)
ANY_TAG = r"<[^>]*>"
# Control characters that carry the element kind past the tag removal.
HEADING_MARK = "\u0001"
ITEM_MARK = "\u0002"
# The public HTML entities by their first letter; a hard space is an ordinary one here.
_PUBLIC = {f"&{name}": c for name, c in html5.items() if name.endswith(";")} | {"&nbsp;": " "}
_NAMED = json.dumps({
    letter: {name: c for name, c in _PUBLIC.items() if name[1] == letter} for letter in sorted({name[1] for name in _PUBLIC})
})
# Those that nearly all texts use, which are looked at first.
_COMMON = ("&amp;", "&lt;", "&gt;", "&quot;", "&nbsp;")
# An entity that is none of these.
_UNCOMMON = r"&(?!(?:amp|lt|gt|quot|nbsp);)(?:#|[A-Za-z])"
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _character(entity: Column) -> Column:
    """What an entity stands for; unknown ones stay as they are."""
    letters = F.from_json(F.lit(_NAMED), "map<string,map<string,string>>")
    named = F.element_at(F.element_at(letters, F.substring(entity, 2, 1)), entity)
    digits = F.regexp_extract(entity, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
    base = F.when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(entity.startswith("&#"), base.try_cast("int"))
    good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numbered = F.when(code == 160, " ").when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    common = F.when(F.lit(False), "")
    for name in _COMMON:
        common = common.when(entity == name, _PUBLIC[name])
    return common.otherwise(F.coalesce(named, numbered, entity))


def unescape(text: Column) -> Column:
    """Named and numeric entities as characters, in one pass: "&amp;lt;" gives "&lt;"."""
    joined = lambda t: lambda gaps: F.concat(F.get(gaps, F.lit(0)), F.array_join(F.zip_with(
        F.transform(F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0)), _character),
        F.slice(gaps, F.lit(2), F.size(gaps) - 1), lambda c, gap: F.concat(c, gap)), ""))

    def common(t: Column) -> Column:
        # The ampersand goes last, so what it gives is not read again.
        for name in reversed(_COMMON):
            t = F.replace(t, F.lit(name), F.lit(_PUBLIC[name]))
        return t

    return once(text, lambda t: F.when(~F.contains(t, F.lit("&")), t).when(~t.rlike(_UNCOMMON), common(t)).otherwise(
        once(F.split(t, _ENTITY), joined(t))))


def html_blocks(html: Column) -> Column:
    """Block texts of a page in order, as ``array<struct<type, text>>``; may hold blanks."""
    flat = F.regexp_replace(html, r"[\r\n\x01\x02]+", " ")
    flat = F.regexp_replace(flat, INVISIBLE, "")
    flat = F.regexp_replace(flat, HEADING_TAG, "\n" + HEADING_MARK)
    flat = F.regexp_replace(flat, ITEM_TAG, "\n" + ITEM_MARK)
    flat = F.regexp_replace(flat, BLOCK_TAG, "\n")
    flat = F.regexp_replace(flat, ANY_TAG, "")
    kind = lambda b: (
        F.when(b.startswith(HEADING_MARK), "Title")
        .when(b.startswith(ITEM_MARK), "ListItem")
        .otherwise("NarrativeText")
    )
    bare = lambda b: collapse_whitespace(
        unescape(F.regexp_replace(b, r"[\x01\x02]", ""))
    )
    return F.transform(
        F.split(flat, "\n"), lambda b: F.struct(kind(b).alias("type"), bare(b).alias("text"))
    )


# Tags inside cells; those of tables, rows and cells stay.
INLINE_TAG = r"(?i)<(?!/?(table|thead|tbody|tfoot|tr|t[hd])\b)[^>]*>"


# End tags of rows and cells may be missing: the next one ends them too.
ROW = r"(?is)<tr\b[^>]*>(.*?)(?:</tr\s*>|(?=<tr\b|</?(?:table|thead|tbody|tfoot)\b)|$)"
CELL = r"(?is)(<t[hd]\b[^>]*>.*?)(?:</t[hd]\s*>|(?=<t[hd]\b)|$)"


def _cells(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(CELL), F.lit(1))


def _span(cell: Column) -> Column:
    """How many columns a cell takes."""
    named = F.when(
        F.contains(F.lower(cell), F.lit("colspan")),
        F.regexp_extract(cell, r"(?i)^<t[hd][^>]*\bcolspan\s*=\s*[\"']?(\d+)", 1).try_cast("int"),
    )
    return F.coalesce(named, F.lit(1))


def _cell(cell: Column) -> Column:
    """A cell with its opening tag, as its text and as many borders as it spans columns."""
    text = F.trim(F.regexp_replace(cell, ANY_TAG, ""))
    return F.concat(F.lit(" "), text, F.repeat(F.lit(" |"), _span(cell)))


def _table_lines(rows: Column) -> Column:
    """One Markdown line per table row."""
    line = lambda row: F.array_join(F.transform(_cells(row), _cell), "")
    return F.transform(rows, lambda row: F.concat(F.lit("|"), unescape(line(row))))


def _with_rule(lines: Column, first_row: Column) -> Column:
    columns = F.aggregate(F.transform(_cells(first_row), _span), F.lit(0), lambda a, b: a + b)
    first = F.get(lines, F.lit(0))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), columns))
    blank = F.concat(F.lit("|"), F.repeat(F.lit("  |"), columns))
    body = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.when(first_row.rlike(r"(?i)<th\b"), F.concat(F.array(first, rule), body)).otherwise(
        F.concat(F.array(blank, rule), lines)
    )


# Where something else than a row or a table tag follows a row, a table tag or the start.
_LOOSE = (
    r"(?i)(?:^|</tr\s*>|</?(?:table|thead|tbody|tfoot)\b[^>]*>)\s*"
    r"(?!\s|<tr\b|</?(?:table|thead|tbody|tfoot)\b|$)"
)


# A table of closed rows and cells without attributes, and nothing else. Possessive, so that
# long tables are matched in a loop.
_PLAIN_TABLE = r"^<table> ?(?:<tr> ?(?:<t[hd]>[^<>]*+</t[hd]> ?)++</tr> ?)++</table>$"


def _plain_table(bare: Column) -> Column:
    """What `_with_rule` and `_table_lines` make of a `_PLAIN_TABLE`, by passes over the whole."""
    first_row = F.substring_index(bare, "</tr>", 1)
    columns = F.size(F.split(first_row, "<t[hd]>")) - 1
    cells = F.regexp_replace(bare, r" ?<t[hd]> *+([^<>]*?) *+</t[hd]> ?", " $1 |")
    lines = F.regexp_replace(F.replace(cells, F.lit("<tr>"), F.lit("|")), r"</tr> ?(?:</table>$)?|^<table> ?", "\n")
    # Every line begins with a break now, the first too, and one is left at the end.
    rule = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), columns))
    blank = F.concat(F.lit("|"), F.repeat(F.lit("  |"), columns))
    with_rule = lambda x: F.when(F.contains(first_row, F.lit("<th>")), F.concat(
        F.substring_index(F.substr(x, F.lit(2)), "\n", 1), rule, F.substr(x, F.locate("\n", x, 2)))).otherwise(
        F.concat(blank, rule, x))
    return unescape(once(lines, lambda x: F.rtrim(with_rule(x), F.lit("\n"))))


def table_to_markdown(html: Column) -> Column:
    """A Markdown table. Without a header row a blank one is put first; text outside of
    the rows, such as a caption, goes before the table. Rows and cells of an inner table
    follow as rows and cells of the outer one."""
    bare = collapse_whitespace(F.regexp_replace(html, INLINE_TAG, ""))
    for sign in "*_":
        bare = F.replace(bare, F.lit(sign), F.lit("\\" + sign))
    outside = lambda b: collapse_whitespace(unescape(F.regexp_replace(F.regexp_replace(b, ROW, " "), ANY_TAG, " ")))
    before = lambda b: F.when(b.rlike(_LOOSE), once(
        outside(b), lambda o: F.when(o != "", F.concat(o, F.lit("\n\n"))).otherwise(""))).otherwise("")
    plain = collapse_whitespace(unescape(F.regexp_replace(html, ANY_TAG, " ")))
    table = lambda r: once(
        _table_lines(r), lambda lines: F.array_join(_with_rule(lines, F.get(r, F.lit(0))), "\n")
    )
    return once(bare, lambda b: F.when(b.rlike(_PLAIN_TABLE), _plain_table(b)).otherwise(once(
        F.regexp_extract_all(b, F.lit(ROW), F.lit(1)),
        lambda r: F.when(F.size(r) > 0, F.concat(before(b), table(r))).otherwise(plain))))
