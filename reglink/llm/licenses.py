"""Licence scan by canonical digest: texts that say the same hash the same.

A text is lower-cased, rid of copyright lines, its punctuation and white space become
single blanks and equivalent spellings become one; the SHA-256 of what stays is
hash-joined to the digests of known licence texts and notices.  Whole texts are
looked up, and each line of a text by itself.  DataFrame functions only.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that mean the same in a licence (left becomes right), after
# lower-casing and with punctuation as blanks.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("fulfil ", "fulfill "), ("judgement", "judgment"),
    ("licence", "license"), ("non commercial", "noncommercial"), ("organisation", "organization"), ("per cent", "percent"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]

# Known licence texts and notices by SPDX identifier.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZERO_BSD = ISC.replace("""granted,
provided that the above copyright notice and this permission notice appear in all copies.""", "granted.")
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = BSD_2.replace("provided with the distribution. ", """provided with the distribution. 3. Neither the name of the copyright holder nor
the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission. """)
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and
to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more
information, please refer to <https://unlicense.org>"""
KNOWN_LICENSES: list[tuple[str, str]] = [
    ("MIT", MIT),
    ("MIT", "The MIT License\n" + MIT),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("0BSD", ZERO_BSD),
    ("Zlib", ZLIB),
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
    ("Unlicense", UNLICENSE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
KNOWN_LICENSES += [(name, f"SPDX-License-Identifier: {name}") for name in (
    "MIT", "ISC", "0BSD", "Zlib", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only",
    "LGPL-3.0-only", "MPL-2.0", "CC-BY-4.0", "CC0-1.0", "Unlicense")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright( \(c\)| ©|:)? ?[0-9]|\(c\) ?[0-9]|© ?[0-9]|all rights reserved)[^\n]*"
NOT_WORD = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"

# Punctuation, blanks and format characters beyond ASCII: typographic quotes, dashes, no-break blanks.
WIDE_MARKS = "".join(c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c)[0] in "PZ" or unicodedata.category(c) in ("Cc", "Cf"))
WIDE_MARK = r"[\u0080-\uffff&&[\p{P}\p{Z}\p{Cc}\p{Cf}]]|©"
# What a line of 'copyright' goes on with in a licence's own sentences.
SENTENCES = ("act|acts|also|and|are|as|assignment|claims?|disclaimers?|holders?|holding|in|infringements?|interests?|is|law|laws|licen[cs]es?|"
             "licen[cs]ed|licensors?|means|notices?|of|on|or|owners?|ownership|permission|protection|rights?|statements?|status|to|treat(?:y|ies)|under")
GAP = r"[^\p{L}\p{N}\n]*"
# A copyright line behind any comment mark, with or without a year, in lower case.
OWNER_LINE = (rf"(^|\n)[^\p{{L}}\p{{N}}\n©(]*(?:all rights reserved|copyrights?[^\p{{L}}\p{{N}}\n(©]*(?:\(c\)|©)|copyright{GAP}[0-9]|"
              rf"copyright(?:[^\p{{L}}\p{{N}}\n]+)(?!(?:{SENTENCES})(?![\p{{L}}\p{{N}}]))\p{{L}}|©{GAP}[\p{{L}}\p{{N}}]|\(c\){GAP}(?:[0-9]|copyright)%s)[^\n]*")
LISTED, UNLISTED = OWNER_LINE % "", OWNER_LINE % rf"|\(c\){GAP}\p{{L}}"     # '(c)' after '(b)' is a point of a list


def _spelt(c: Column) -> Column:
    c = F.trim(F.regexp_replace(c, NOT_WORD, " "))
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def canonical(text: Column) -> Column:
    """Words of the text in one spelling, one blank apart, without copyright lines of a year."""
    return _spelt(F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINE, "\n"))


def _marked(text: Column) -> Column:
    """Whether ``bare`` can differ from ``canonical``."""
    c = F.translate(text, UPPER, LOWER)
    wide = (F.length(text) != F.octet_length(text)) & F.rlike(text, F.lit(WIDE_MARK))
    return (wide | F.contains(c, F.lit("copyright")) | F.contains(c, F.lit("(c)"))
            | F.contains(c, F.lit("all rights reserved")))


def bare(text: Column) -> Column:
    """``canonical`` without copyright lines of any kind and without marks beyond ASCII; as
    ``canonical`` where nothing else is in the text."""
    c = F.translate(text, UPPER + WIDE_MARKS, LOWER + " " * len(WIDE_MARKS))
    c = _spelt(F.when(F.contains(c, F.lit("(b)")), F.regexp_replace(c, LISTED, "\n")).otherwise(F.regexp_replace(c, UNLISTED, "\n")))
    return F.when(c == "", canonical(text)).otherwise(c)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def bare_digest(text: Column) -> Column:
    return F.when(_marked(text), F.sha2(bare(text), 256)).otherwise(digest(text))


def _gate(text: Column) -> Column:
    """A word that every text of this canonical or bare form holds, in lower case; empty where there is none.

    It is a longest ASCII word of both forms without any word that a spelling may have become.  The last spelling
    that touches a word leaves what it wrote there whole, so none touched this one, and it stands in the text itself."""
    made = sorted({w for _, new in SPELLINGS for w in new.split()})
    both = F.array_intersect(F.split(canonical(text), " "), F.split(bare(text), " "))
    own = F.filter(both, lambda w: F.rlike(w, F.lit("^[a-z0-9]+$")) & ~F.rlike(w, F.lit("|".join(made))))
    return F.coalesce(F.array_max(F.transform(own, lambda w: F.named_struct(F.lit("n"), F.length(w), F.lit("w"), w)))["w"], F.lit(""))


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]]) -> DataFrame:
    """(digest, license_id, gate) of known texts, canonical and bare; the smallest id where two say the same.
    ``gate``: a word without which no text has this digest (see ``_gate``)."""
    rows = spark.createDataFrame([(a, b) for a, b in known], "license_id string, text string")
    rows = rows.select("license_id", _gate(F.col("text")).alias("gate"), F.explode(F.array_distinct(F.array(digest(F.col("text")), bare_digest(F.col("text"))))).alias("known_digest"))
    return rows.groupBy("known_digest").agg(F.min("license_id").alias("license_id"), F.min("gate").alias("gate"))


def _may_match(text: Column, gates: list[str]) -> Column:
    """Whether the text holds one of the words (lower-casing all of Unicode can only add matches)."""
    if "" in gates:
        return F.lit(True)
    low, out = F.lower(text), F.lit(False)
    for g in gates:
        out = out | F.contains(low, F.lit(g))
    return out


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_digest`` of the whole canonical text,
    ``text_license`` (the known licence that it is, in canonical or bare form, else null), ``n_notices`` and
    ``notice_licenses`` (distinct known licences whose notice is a line of the text, sorted,
    comma-separated; empty where none).

    ``known`` comes from ``known_digests`` over the caller's list of licences, which a
    session holds in memory, so it is small enough to broadcast.  Null text is empty.

    Lines are hashed only where they hold the gate word of a known text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    gates = sorted({r["gate"] for r in known.select("gate").distinct().collect()})      # at most as many as known texts
    known = known.select("known_digest", "license_id")
    table = F.broadcast(known)
    bare_of = F.broadcast(known.select(F.col("known_digest").alias("bare_known"), F.col("license_id").alias("bare_license")))
    other = F.when(_marked(F.col("text")), F.sha2(bare(F.col("text")), 256))
    whole = rows.select("doc_id", "text_hash", digest(F.col("text")).alias("text_digest"), other.alias("bare_digest"))
    whole = (whole.join(table, whole.text_digest == table.known_digest, "left").join(bare_of, F.col("bare_digest") == F.col("bare_known"), "left")
             .select("doc_id", "text_hash", "text_digest", F.coalesce("license_id", "bare_license").alias("text_license")))
    lines = rows.where(_may_match(F.col("text"), gates)).select("doc_id", "text_hash", F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = lines.where(_may_match(F.col("line"), gates))
    lines = lines.select(F.col("doc_id").alias("n_id"), F.col("text_hash").alias("n_hash"), bare_digest(F.col("line")).alias("line_digest"))
    found = (lines.join(table, lines.line_digest == table.known_digest)
             .select("n_id", "n_hash", "license_id").distinct().groupBy("n_id", "n_hash")
             .agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("license_id")), ",").alias("names")))
    return (whole.join(found, whole.doc_id.eqNullSafe(found.n_id) & (whole.text_hash == found.n_hash), "left")
            .select("doc_id", "text_digest", "text_license", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
                    F.coalesce("names", F.lit("")).alias("notice_licenses")))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_spelt(c: str) -> str:
    c = f"trim(regexp_replace({c}, {_sql_text(NOT_WORD)}, ' ', 'g'), ' ')"
    for old, new in SPELLINGS:
        c = f"replace({c}, '{old}', '{new}')"
    return c


def _sql_canonical(expr: str) -> str:
    c = f"translate({expr}, '{UPPER}', '{LOWER}')"
    return _sql_spelt(f"regexp_replace({c}, {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')")


def _sql_bare(expr: str) -> str:
    """The bare form, line by line: SQL's patterns have no look-ahead, so a sentence of the licence is a pattern of its own."""
    c = f"translate({expr}, {_sql_text(UPPER + WIDE_MARKS)}, {_sql_text(LOWER + ' ' * len(WIDE_MARKS))})"
    start = r"^[^\p{L}\p{N}©(]*"
    owned = (rf"{start}(all rights reserved|copyrights?[^\p{{L}}\p{{N}}(©]*(\(c\)|©)|copyright{GAP}[0-9]|©{GAP}[\p{{L}}\p{{N}}]|\(c\){GAP}([0-9]|copyright))")
    named, said = rf"{start}copyright[^\p{{L}}\p{{N}}]+\p{{L}}", rf"{start}copyright[^\p{{L}}\p{{N}}]+({SENTENCES})($|[^\p{{L}}\p{{N}}])"
    point = rf"{start}\(c\){GAP}\p{{L}}"
    match = lambda p: f"regexp_matches(x, {_sql_text(p)})"
    keep = f"NOT ({match(owned)} OR ({match(named)} AND NOT {match(said)}) OR (NOT contains(t, '(b)') AND {match(point)}))"
    kept = f"(SELECT array_to_string(list_filter(string_split(t, chr(10)), lambda x: {keep}), chr(10)) FROM (SELECT {c} AS t))"
    return f"coalesce(nullif({_sql_spelt(kept)}, ''), {_sql_canonical(expr)})"


def license_sql(known: Iterable[tuple[str, str]] = tuple(KNOWN_LICENSES)) -> str:
    """DuckDB SQL for ``license_scan`` over ``documents``, canonical and bare form."""
    values = ", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in known)
    return f"""
WITH known AS (SELECT d, min(license_id) AS license_id FROM (
  SELECT license_id, unnest([sha256({_sql_canonical('text')}), sha256({_sql_bare('text')})]) AS d FROM (VALUES {values}) AS v(license_id, text)) GROUP BY d),
rows AS (SELECT row_number() OVER () AS any_row, doc_id, coalesce(text, '') AS text FROM documents),
whole AS (SELECT any_row, doc_id, sha256({_sql_canonical('text')}) AS text_digest, sha256({_sql_bare('text')}) AS bare_digest FROM rows),
lines AS (SELECT any_row, unnest(string_split(text, chr(10))) AS line FROM rows),
found AS (SELECT any_row, count(DISTINCT k.license_id) AS n, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS names
  FROM (SELECT any_row, sha256({_sql_bare('line')}) AS d FROM lines) l JOIN known k ON l.d = k.d GROUP BY any_row)
SELECT w.doc_id, w.text_digest, coalesce(k.license_id, b.license_id) AS text_license, coalesce(f.n, 0) AS n_notices, coalesce(f.names, '') AS notice_licenses
FROM whole w LEFT JOIN known k ON w.text_digest = k.d LEFT JOIN known b ON w.bare_digest = b.d LEFT JOIN found f ON f.any_row = w.any_row
"""
