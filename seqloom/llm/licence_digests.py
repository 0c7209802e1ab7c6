"""Licence scan by canonical digests.

A text is brought to a canonical form: copyright lines go, ASCII letters become lower case,
equivalent spellings become one, runs of ASCII punctuation and white space become one space, and
empty lines go. The MD5 of the whole canonical text is hash-joined to the digests of known licence
texts (files in ``licences``, with and without their titles) and notices. The MD5 of every line is looked
up among those of the notices, as "Released under ..." stands alone on its line. A match is a match of an
entire text or line, never of a part of it.

Only DataFrame functions are used. The known digests are a fixed table of some hundred rows, which is
broadcast, and of notices in the row's own expression; documents are read once and never shuffled.

Rules: null, empty and wholly stripped texts have the digest of the empty string and match
nothing; each row is judged by itself, with or without doc_id, once or repeated; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import table

#: The texts of licences, a file each, named as SPDX names them.
TEXTS = Path(__file__).parent / "licences"
# How notices begin, and what they call each licence.
VERBS = (
    "Licensed under", "Released under", "Distributed under", "Available under", "Published under", "This work is licensed under", "This project is licensed under",
    "This software is licensed under", "This file is licensed under", "This program is licensed under", "This document is licensed under",
)
CALLED = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GPL, version 2", "GNU GPL v2", "GPLv2", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GPL, version 3", "GNU GPL v3", "GPLv3", "GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL, version 2.1", "LGPLv2.1", "LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL, version 3", "LGPLv3", "LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL, version 3", "AGPLv3", "AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL, version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "Unlicense": ("Unlicense",),
}


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of the known licences, with and without the title that is their first line."""
    out = []
    for file in sorted(TEXTS.glob("*.txt")):
        text = file.read_text()
        out += [(file.stem, text), (file.stem, text.strip().partition("\n")[2])]
    return out


def notices() -> list[tuple[str, str]]:
    """(licence, notice): every beginning with every name, with and without the article, and the SPDX tag."""
    out = [(name, f"{verb} {article}{called}") for name, names in CALLED.items() for called in names for verb in VERBS for article in ("", "the ", "a ")]
    out += [(name, f"SPDX-License-Identifier: {tag}") for name in CALLED for tag in (name, f"{name}-only", f"{name}-or-later")]
    return [*out, ("Unlicense", "This is free and unencumbered software released into the public domain.")]


# Spellings that count as one.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("https ", "http "),
    ("the apache license v2", "the apache license version 2"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright[ \t]*(\(c\)|©)|(copyright|\(c\))[^\n]{0,80}[0-9]{4}|©)[^\n]*"
RESERVED = "all rights reserved"
MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without empty ones."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(F.regexp_replace(out, COPYRIGHT_LINE, "\n"), MARKS, " ")
    for spelled, spelling in SPELLINGS:
        out = F.replace(out, F.lit(spelled), F.lit(spelling))
    return F.filter(F.transform(F.split(out, "\n"), lambda line: F.trim(line)), lambda line: (line != "") & (line != RESERVED))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(licence, known, length) of the known ``texts``, one row for each digest."""
    raw = spark.createDataFrame(texts, "licence string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return raw.select("licence", F.md5(whole).alias("known"), F.length(whole).alias("length")).groupBy("known").agg(F.min("licence").alias("licence"), F.first("length").alias("length"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, licence, notices) for each row of ``docs`` (doc_id, text).

    licence: of the whole text, else null; notices: the licences that its lines name, in order, joined by
    ``|``, else null.
    """
    spark = docs.sparkSession
    said = known_digests(spark, notices()).collect()  # a fixed number of notices, looked up within the row
    lengths = sorted({r["length"] for r in said})
    of_line = F.create_map(*[F.lit(x) for r in said for x in (r["known"], r["licence"])])
    candidates = F.filter("lines", lambda line: F.length(line).isin(lengths))
    named = F.array_sort(F.array_distinct(F.filter(F.transform(candidates, lambda line: F.try_element_at(of_line, F.md5(line))), lambda x: x.isNotNull())))
    lined = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    narrow = lined.select("doc_id", F.md5(F.array_join("lines", " ")).alias("digest"), F.when(F.size(named) > 0, F.array_join(named, "|")).alias("notices"))
    known = F.broadcast(known_digests(spark, whole_texts() + notices()).select("licence", "known"))  # a fixed table of some hundred rows
    return narrow.join(known, F.col("digest") == F.col("known"), "left").select("doc_id", "digest", "licence", "notices")


def op6_licence_digests(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_lines(text: str) -> str:
    out = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    out = f"regexp_replace(regexp_replace({out}, '{COPYRIGHT_LINE}', chr(10), 'g'), '{MARKS}', ' ', 'g')"
    for spelled, spelling in SPELLINGS:
        out = f"replace({out}, {_quoted(spelled)}, {_quoted(spelling)})"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND x <> '{RESERVED}')"


def sql() -> str:
    def known(texts: list[tuple[str, str]]) -> str:
        values = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in texts)
        return f"SELECT md5(array_to_string({_sql_lines('text')}, ' ')) AS known, min(licence) AS licence FROM (VALUES {values}) AS raw(licence, text) GROUP BY 1"

    return f"""
WITH known AS ({known(whole_texts() + notices())}), said AS ({known(notices())}),
narrow AS (SELECT row_number() OVER () AS row_no, doc_id, {_sql_lines("text")} AS lines FROM documents),
named AS (
  SELECT row_no, string_agg(DISTINCT licence, '|' ORDER BY licence) AS notices
  FROM (SELECT row_no, md5(unnest(lines)) AS line FROM narrow) JOIN said ON line = said.known GROUP BY row_no)
SELECT n.doc_id, md5(array_to_string(n.lines, ' ')) AS digest, k.licence, s.notices
FROM narrow n LEFT JOIN known k ON md5(array_to_string(n.lines, ' ')) = k.known LEFT JOIN named s ON n.row_no = s.row_no
"""
