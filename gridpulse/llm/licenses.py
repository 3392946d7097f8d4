"""Licence scan by canonical digests: entire texts, brought to one spelling, are hash-joined to the digests of known licence texts.

Canonical form: letters A-Z in lower case; copyright lines dropped; every run of other than letters and digits as one blank; equivalent
spellings as one. The digest is the SHA-256 of that form. A text is the whole document and each of its lines. Only DataFrame functions run on
the rows; the known digests come from the same expressions and are few, so the join sends them to every task.

Cases: a null text and one that is empty in canonical form match nothing; a text of any length is digested whole; a document that is one licence line is found as
document and as line; repeated rows are found each; a null id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equivalent spellings, applied in this order to canonical text.
SPELLINGS = [
    ("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("authoris", "authoriz"), ("utilis", "utiliz"), ("organis", "organiz"), ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"), ("https ", "http "),
]

# Public licence texts and the usual one-line notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies.", ".")
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "Released under the ISC License."), ("0BSD", _ZERO_BSD), ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0."), ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = r"[^\p{L}\p{N}" + "\n]+"
_COPYRIGHT_LINE = "^(copyright )?(c )?([0-9][0-9][0-9][0-9]|year|yyyy)( .*)?$"


def canonical_lines(text: Column) -> Column:
    """The text's lines in canonical form; a copyright line is empty."""
    c = F.translate(F.replace(text, F.lit("©"), F.lit("(c)")), _UPPER, _LOWER)
    c = F.regexp_replace(c, _OTHER, " ")
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.transform(F.split(c, "\n"), lambda line: _without_copyright(F.trim(line)))


def _without_copyright(line: Column) -> Column:
    dropped = (line.rlike(_COPYRIGHT_LINE) & (line.startswith("copyright ") | line.startswith("c "))) | (line == "all rights reserved")
    return F.when(dropped, "").otherwise(line)


def canonical(lines: Column) -> Column:
    """Canonical lines as one text."""
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def known_digests(spark, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license: one row for each different text."""
    frame = spark.createDataFrame(KNOWN if known is None else known, "license string, text string")
    return frame.select("license", F.sha2(canonical(canonical_lines(F.col("text"))), 256).alias("digest")).groupBy("digest").agg(
        F.min("license").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each entire text that is a known licence: doc_id, unit ('document' or 'line'), line (from 0; -1), license, digest."""
    spark = docs.sparkSession
    frame = docs.where(F.col(text_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"),
                                                              canonical_lines(F.col(text_column)).alias("lines"))
    units = F.concat(F.array(canonical(F.col("lines"))), F.col("lines"))
    texts = frame.select("doc_id", F.posexplode(units).alias("at", "form")).where("form <> ''")
    digests = F.broadcast(known_digests(spark, known))  # as many as there are known texts
    return texts.select("doc_id", (F.col("at") - 1).alias("line"), F.sha2("form", 256).alias("digest")).join(digests, "digest").select(
        "doc_id", F.when(F.col("line") < 0, "document").otherwise("line").alias("unit"), "line", "license", "digest")


def sql(table: str = "documents") -> str:
    """The same rows in DuckDB."""
    def lines(text: str) -> str:
        c = f"translate(replace({text}, '©', '(c)'), '{_UPPER}', '{_LOWER}')"
        c = f"regexp_replace({c}, '{_OTHER}', ' ', 'g')"
        for old, new in SPELLINGS:
            c = f"replace({c}, '{old}', '{new}')"
        dropped = (f"(regexp_matches(l, '{_COPYRIGHT_LINE}') AND (starts_with(l, 'copyright ') OR starts_with(l, 'c '))) "
                   "OR l = 'all rights reserved'")
        trimmed = f"list_transform(string_split({c}, chr(10)), lambda x: trim(x))"
        return f"list_transform({trimmed}, lambda l: CASE WHEN {dropped} THEN '' ELSE l END)"

    def joined(column: str) -> str:
        return f"coalesce(array_to_string(list_filter({column}, lambda l: l <> ''), ' '), '')"

    values = ", ".join(f"('{name}', '{text.replace(chr(39), 2 * chr(39))}')" for name, text in KNOWN)
    return f"""
WITH known AS (SELECT sha256({joined('lines')}) AS digest, min(license) AS license
               FROM (SELECT license, {lines('text')} AS lines FROM (VALUES {values}) AS v(license, text)) GROUP BY 1),
     canonical AS (SELECT doc_id, {lines('text')} AS lines FROM {table} WHERE text IS NOT NULL),
     units AS (SELECT doc_id, -1 AS line, {joined('lines')} AS form FROM canonical
               UNION ALL SELECT doc_id, generate_subscripts(lines, 1) - 1, unnest(lines) FROM canonical)
SELECT doc_id, CASE WHEN line < 0 THEN 'document' ELSE 'line' END AS unit, line::INTEGER AS line, license, digest
FROM units JOIN known ON sha256(form) = digest WHERE form <> ''"""
