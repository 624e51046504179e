"""Licence scans: canonical texts looked up by digest in a table of known licences."""

from __future__ import annotations

import hashlib
import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.llm.common import ROW, cut, read_table, with_row_id

#: Words of terms: a line with one of them says more than who holds the copyright, so it stays.
TERM_WORDS = (
    "may must shall will can is are be not stays passes remains belongs copies notice notices license licensed licence licenced licensee "
    "holder holders owner owners law laws permission granted terms"
).split()
#: Forms of a line that names a holder and no terms, as it differs between copies of one licence: the word and a sign or a year beside it, "by" and
#: a year, a sign and a year, or a name in capitals. A bare "(c)" needs a year, as clauses are numbered like that. Java and RE2 read them alike.
HOLDER_FORMS = (
    r"(?i:copyright)[^\p{L}\p{N}\n]*(\([cC]\)|©|[0-9]{4})",
    r"(?i:copyright by)[^\n]*[0-9]{4}",
    r"©[^\p{L}\p{N}\n]*((?i:copyright)|[0-9]{4})",
    r"\([cC]\)[^\p{L}\p{N}\n]*((?i:copyright)[^\n]*)?[0-9]{4}",
    r"(?i:copyright)[ \t]+(\p{Lu}[^\s]*|and|of|the|de|von|van|&)([ \t]+(\p{Lu}[^\s]*|and|of|the|de|von|van|&))*[ \t\r]*(\n|$)",
)
TERM = r"[^\p{L}\p{N}\n](?i:" + "|".join(TERM_WORDS) + r")([^\p{L}\p{N}]|$)"
COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(?=(?i:copyright)|\([cC]\)|©)(?![^\n]*" + TERM + ")(?=" + "|".join(f"(?:{f})" for f in HOLDER_FORMS) + r")[^\n]*"
#: The line that goes with it.
RESERVED_LINE = r"(^|\n)[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*(\n|$)"
NO_WORD = r"[^\p{L}\p{N}\n]+"
#: Equivalent spellings, replaced in this order in the lower-case text without punctuation.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non exclusive", "nonexclusive"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("https", "http"),
)
#: Short notices, kept as texts; their digests are computed with the same expression.
NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC0-1.0": ("Released under CC0 1.0.", "Licensed under CC0 1.0."),
}
#: Whole licences: one file each, named by its identifier, so that digests can be computed anew.
TEXTS = Path(__file__).parent / "license_texts"


def folded(text: Column) -> Column:
    """Lower case, copyright lines out, runs of other characters than letters, digits and newlines one space, one spelling in each line."""
    out = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "\n"))
    out = F.regexp_replace(F.regexp_replace(out, RESERVED_LINE, "\n"), NO_WORD, " ")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def joined(lines: Column) -> Column:
    """The canonical form of a folded text: line ends are spaces, and spellings that a line end parted are mended."""
    out = F.trim(F.regexp_replace(lines, "[ \n]+", " "))
    for a, b in SPELLINGS:
        if " " in a:
            out = F.replace(out, F.lit(a), F.lit(b))
    return out


def canonical(text: Column) -> Column:
    return joined(folded(text))


def canonical_text(text: str) -> str:
    """The same form in Python, for the fixed table and as the expectation of tests: written apart from the expressions above."""
    word = r"[^\W_]"
    kept = []
    for line in text.split("\n"):
        only = " ".join(re.findall(rf"{word}+", line.lower()))
        if not _names_holder(line) and only != "all rights reserved":
            kept.append(only)
    spelled = [_spell(x, SPELLINGS) for x in kept]
    return _spell(" ".join(x for x in spelled if x), [p for p in SPELLINGS if " " in p[0]])


def _names_holder(line: str) -> bool:
    """Whether a line names a copyright holder and no terms, token by token."""
    tokens = re.findall(r"\([cC]\)|©|[^\W_]+", line)
    low = [t.lower() for t in tokens]
    year = lambda t: re.match(r"[0-9]{4}", t) is not None
    if not low or set(re.findall(r"[^\W_]+", line.lower())) & set(TERM_WORDS):
        return False
    begins = lambda t, w: t.startswith(w)
    following = low[1] if len(low) > 1 else ""
    some_year = re.search(r"[0-9]{4}", line) is not None
    if low[0] == "(c)":
        return year(following) or begins(following, "copyright") and some_year
    if low[0] == "©":
        return year(following) or begins(following, "copyright")
    if not begins(low[0], "copyright"):
        return False
    if low[0] != "copyright":  # a year that stands at the word itself
        return year(low[0][9:])
    if following in ("(c)", "©") or year(following) or re.match(r"(?i)[^\w]*_*[^\w]*copyright by", line) and some_year:
        return True
    name = re.match(r"(?i:[\W_]*copyright)[ \t]+(.*?)[ \t\r]*$", line)
    words = re.split(r"[ \t]+", name[1]) if name else [""]
    return all(w in ("and", "of", "the", "de", "von", "van", "&") or w[:1].isupper() for w in words)


def _spell(text: str, pairs) -> str:
    for a, b in pairs:
        text = text.replace(a, b)
    return text


@cache
def known_digests() -> dict[str, str]:
    """digest -> licence of the files and notices: some dozens."""
    texts = [(f.stem, f.read_text()) for f in sorted(TEXTS.glob("*.txt"))] + [(k, t) for k, all_ in NOTICES.items() for t in all_]
    found: dict[str, str] = {}
    for name, text in texts:
        digest = hashlib.sha256(canonical_text(text).encode()).hexdigest()
        found[digest] = min(name, found.get(digest, name))
    return found


def known_licenses(spark: SparkSession) -> DataFrame:
    """(digest, license) of known_digests(), as literal rows."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{d}', '{k}')" for d, k in known_digests().items()) + " AS known(digest, license)")


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, digest, license (of the whole text, or null), n_notices, notices.

    A text is folded once; its digest and that of each of its lines, as a text of its own, are joined to
    the known digests; notices are the distinct licences of the lines, sorted. The table given is broadcast only by the
    planner's own size limit. Null texts count as empty; texts without letters have the digest of the
    empty string, which no licence has. Null and repeated ids are carried; empty in, empty out.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    known = known.where(F.col("digest") != F.sha2(F.lit(""), 256)).select(F.unhex("digest").alias("known"), "license")
    lines = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), folded(F.col(text_col)).alias("folded"))
    each = F.transform(F.filter(F.transform(F.split("folded", "\n"), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.unhex(F.sha2(x, 256)))
    rows = cut(lines.select(*ROW, "doc_id", F.unhex(F.sha2(joined(F.col("folded")), 256)).alias("whole"), each.alias("lines")), "digests")
    found = rows.select(*ROW, F.explode("lines").alias("known")).join(known, "known")
    notices = found.groupBy(*ROW).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("all"))
    whole = rows.select(*ROW, "doc_id", "whole").join(known, F.col("whole") == F.col("known"), "left").drop("known")
    return whole.join(notices, ROW, "left").select("doc_id", F.lower(F.hex("whole")).alias("digest"), "license", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("all", F.lit("")).alias("notices"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def _sql() -> str:
    """Each line is judged and folded as a row of its own; known digests are those that Python computes."""
    known = ", ".join(f"('{d}', '{k}')" for d, k in known_digests().items())
    begins = "(" + " OR ".join(rf"regexp_matches(raw, '^[^\p{{L}}\p{{N}}]*({form})')" for form in HOLDER_FORMS) + f") AND NOT regexp_matches(raw, '{TERM}')"
    parted = [p for p in SPELLINGS if " " in p[0]]
    return rf"""
WITH known(digest, license) AS (VALUES {known}), lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents
), plain AS (
  SELECT doc_id, pos, trim(regexp_replace(lower(raw), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ') AS words FROM lines WHERE NOT ({begins})
), spelled AS (
  SELECT doc_id, pos, {_nested("words", SPELLINGS)} AS words FROM plain WHERE words NOT IN ('', 'all rights reserved')
), whole AS (
  SELECT doc_id, sha256({_nested("string_agg(words, ' ' ORDER BY pos)", parted)}) AS digest FROM spelled GROUP BY doc_id
), notices AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM spelled JOIN known ON known.digest = sha256(words) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(w.digest, sha256('')) AS digest, k.license, coalesce(n.n_notices, 0)::BIGINT AS n_notices, coalesce(n.notices, '') AS notices
FROM documents AS d
LEFT JOIN whole AS w ON w.doc_id = d.doc_id
LEFT JOIN known AS k ON k.digest = w.digest
LEFT JOIN notices AS n ON n.doc_id = d.doc_id
"""


def _nested(text: str, pairs) -> str:
    for a, b in pairs:
        text = f"replace({text}, '{a}', '{b}')"
    return text
