"""Licence scans: what a text says itself, and what its directory says.

Lines that speak of a licence, and sentences that do and go over several lines, as those
of a header do, are compared with template texts by the cosine of sparse TF-IDF vectors:
their terms meet the terms of templates in an equi-join (templates are few and fixed, so
that side is small by construction). Tags that name a licence by its identifier are
templates too. The best template at or above `min_cosine` names the passage's licence; a
document takes its best passage. A document whose licence lines (or sentences, whichever
are more) make up a good part of its words is a licence file, and stands for its directory.

Documents without a licence of their own inherit from the nearest directory above that
has a licence file. Ancestors are listed per directory, not per document, so a directory
with many documents costs no more than one with few; it is one equi-join on paths.

Only DataFrame expressions; whole texts are looked at, in their rows, and only lines that
speak of a licence leave them.

Edge cases: a null text or path is empty (the root). Repeated rows are scanned one by one.
Of equally near lines the name first in order wins; of several licence files in a
directory the most frequent licence, then the first in order. Columns named like a result
are replaced; others are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import own, refuse_clash, text_of, words
from docquarry.session import stage

#: Public licence notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Released under the MIT License.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
}
#: Identifiers in tags; those of the GNU licences say whether later versions count.
for _name, _texts in TEMPLATES.items():
    _texts += [f"SPDX-License-Identifier: {_name}{end}" for end in ("", "-only", "-or-later")[:3 if "GPL" in _name else 1]]
_SPEAKS = r"(?i)licen[sc]|copyright|permission|redistribut|public domain|creative commons|free software|\bCC0?\b"
_TERM = "[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*"
#: A line break with the signs of a comment that begin the next line, and two or more in a row.
_BREAK, _BREAKS = r"\r?\n[\t #/*;%!-]*", r"\r?\n[\t #/*;%!-]*\r?\n[\s#/*;%!-]*"
_SENTENCE_END = "\x02|(?<=[.:;!?])\x01?\\s+(?=[A-Z])"
#: No notice is longer than this many characters.
_LONGEST = 400
RESULTS = ("own_licence", "own_cosine", "licence_file", "licence", "licence_from")


def _template_rows() -> list[tuple[str, int, str, float]]:
    """(licence, template, term, weight): unit vectors of the templates."""
    texts = [(name, Counter(re.findall(_TERM, t.lower()))) for name, some in TEMPLATES.items() for t in some]
    df = Counter(term for _, tf in texts for term in tf)
    rows = []
    for number, (name, tf) in enumerate(texts):
        weights = {t: (1 + math.log(n)) * _idf(df[t], len(texts)) for t, n in tf.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(name, number, t, w / norm) for t, w in sorted(weights.items())]
    return rows


def _idf(df: int, n: int) -> float:
    return math.log((n + 1) / (df + 1)) + 1


def _template_idf() -> tuple[dict[str, float], float]:
    texts = [set(re.findall(_TERM, t.lower())) for some in TEMPLATES.values() for t in some]
    df = Counter(term for t in texts for term in t)
    return {t: _idf(n, len(texts)) for t, n in df.items()}, _idf(0, len(texts))


def own_licences(lines: DataFrame, min_cosine: float = 0.75) -> DataFrame:
    """(row, line, licence, cosine) of (row, line, text): lines that are near a template."""
    spark = lines.sparkSession
    templates = spark.createDataFrame(_template_rows(), "licence string, template int, term string, share double")
    idf, unknown = _template_idf()
    weights = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    terms = lines.select("row", "line", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({_TERM})"), F.lit(1))).alias("term"))
    counted = terms.groupBy("row", "line", "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(F.broadcast(weights), "term", "left").withColumn(
        "weight", (1 + F.log("tf")) * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = weighed.join(F.broadcast(templates), "term").groupBy("row", "line", "licence", "template").agg(
        F.sum(F.col("weight") * F.col("share")).alias("dot"))
    cosines = dots.join(norms, ["row", "line"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
    best = cosines.filter(F.col("cosine") >= min_cosine).groupBy("row", "line").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("row", "line", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))


def _parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def license_scan(
    docs: DataFrame, path: str = "path", min_cosine: float = 0.75, file_share: float = 0.2, max_line: int = 2000
) -> DataFrame:
    """The documents (without their text) with own_licence, own_cosine, licence_file,
    licence (own or inherited) and licence_from (`own`, or the directory's path).

    Longer lines than `max_line` are looked at in pieces of that many characters, which
    overlap by more than a notice is long; longer sentences are left to their lines.
    """
    row, found, n = own("row"), own("lines"), own("words")
    base = refuse_clash(docs, *RESULTS)
    text = text_of()
    speaking = lambda parts: F.filter(parts, lambda x: x.rlike(_SPEAKS))
    step = max_line - _LONGEST
    pieces = F.flatten(F.transform(speaking(F.split(text, "\n")), lambda x: F.when(F.length(x) <= max_line, F.array(x)).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.length(x) - _LONGEST - 1) / step).cast("int")),
                    lambda i: F.substr(x, i * step + 1, F.lit(max_line))))))
    # Marks stand for line breaks, so that sentences that cross one can be told.
    joined_lines = F.regexp_replace(F.regexp_replace(text, _BREAKS, "\x02"), _BREAK, "\x01 ")
    wrapped = F.filter(speaking(F.split(joined_lines, _SENTENCE_END)), lambda x: F.contains(x, F.lit("\x01")) & (F.length(x) <= max_line))
    passage = lambda parts, over: F.transform(parts, lambda x: F.struct(x.alias("text"), F.lit(over).alias("wrapped")))
    none = F.array().cast("array<struct<text:string,wrapped:boolean>>")
    hinted = F.when(text.rlike(_SPEAKS), F.concat(passage(pieces, False), passage(wrapped, True))).otherwise(none)
    scan = stage(base.select(
        *(c for c in base.columns if c != "text"), F.monotonically_increasing_id().alias(row),
        hinted.alias(found), F.size(words(text)).alias(n)), "license-scan")
    lines = scan.select(F.col(row).alias("row"), F.posexplode(found).alias("line", "p")).select("row", "line", "p.*")
    near = own_licences(lines, min_cosine)
    sizes = lines.select("row", "line", "wrapped", F.size(words(F.col("text"))).alias("w"))
    held = lambda over: F.coalesce(F.sum(F.when(F.col("wrapped") == over, F.col("w"))), F.lit(0))
    per_row = near.join(sizes, ["row", "line"]).groupBy("row").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"), F.greatest(held(False), held(True)).alias("w"))
    own_rows = stage(per_row.select(F.col("row").alias(row), F.col("b.licence").alias("own_licence"),
                                    (-F.col("b.c")).alias("own_cosine"), F.col("w").alias(own("w"))), "license-own")
    directory = own("directory")
    marked = scan.join(own_rows, row, "left").withColumns({
        "licence_file": F.coalesce(F.col(own("w")) >= file_share * F.col(n), F.lit(False)),
        directory: _parent(F.coalesce(path, F.lit(""))),
    }).drop(row, found, n, own("w"))
    marked = stage(marked, "license-marked")
    votes = marked.filter("licence_file").groupBy(directory, "own_licence").count()
    holders = stage(votes.groupBy(F.col(directory).alias("above")).agg(
        F.min(F.struct((-F.col("count")).alias("c"), "own_licence"))["own_licence"].alias("licence")), "license-directories")
    # All prefixes of a directory's path, itself first and the root last.
    above = marked.select(directory).distinct().withColumn("parts", F.split(directory, "/")).select(
        directory, F.explode(F.transform(F.sequence(F.size("parts"), F.lit(0)), lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice("parts", F.lit(1), k), "/").alias("above")))).alias("a")).select(directory, "a.*")
    inherited = stage(above.join(holders, "above").groupBy(directory).agg(
        F.max(F.struct("depth", "above", "licence")).alias("i")), "license-inherited")
    joined = marked.join(inherited, directory, "left")
    return joined.select(
        *(c for c in base.columns if c != "text"), "own_licence", "own_cosine", "licence_file",
        F.coalesce("own_licence", "i.licence").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), "own").otherwise(F.col("i.above")).alias("licence_from"),
    )
