"""Licence scan: canonical digests of whole texts, joined to known licences.

A text is put in a canonical form: lower case, anything but letters and
digits as one space, equivalent spellings made one, copyright lines left out.
The units compared are the whole document, its blocks (between blank lines)
and its single lines; a unit is a licence if all of its canonical form is that
of a known text. Units meet the known texts by digest, in a hash join.

Known texts come as (id, text) pairs; ``KNOWN`` holds some short ones.

Defined cases: null and empty texts, and units without letters or digits,
are no licence; documents without one get an empty list; an empty table gives
an empty result; other columns are not read; for repeated and null ids see
``common``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import keyed, unkeyed

#: Spellings that count as one (the first is made the second).
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"),
    ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("favour", "favor"),
    ("merchantibility", "merchantability"), ("judgement", "judgment"), ("modelling", "modeling"),
    ("programme", "program"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("non commercial", "noncommercial"),
    ("web site", "website"), ("https", "http"), ("version 2 0", "version 2"),
    ("version 3 0", "version 3"), ("v2", "version 2"), ("v3", "version 3"),
]

#: Words with which a copyright line begins, in canonical form.
COPYRIGHT = r"^(?:copyright (?:c )?(?:[0-9]{4}|by )|c [0-9]{4}|all rights reserved)"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

#: Public licence texts, header notices and one-line statements.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC), ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
                "one at https://mozilla.org/MPL/2.0/."),
]


def canonical(text: str) -> str:
    """The canonical form of a whole text (for the known ones)."""
    lines = []
    for line in text.split("\n"):
        line = " " + re.sub(r"[\W_]+", " ", line.lower()).strip() + " "
        for a, b in SPELLINGS:
            line = line.replace(f" {a} ", f" {b} ")
        line = line.strip()
        if line and not re.match(COPYRIGHT, line):
            lines.append(line)
    return " ".join(lines)


def digests(known: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """(digest, id) of known texts, one for each digest."""
    found = {hashlib.md5(canonical(t).encode()).hexdigest(): i for i, t in known if canonical(t)}
    return sorted(found.items())


def canonical_text(text: Column) -> Column:
    """A text's lines in canonical form, copyright lines left out. A space
    stands before and after each line."""
    x = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " "), F.lit(" "))
    x = F.regexp_replace(x, " *\n *", " \n ")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.regexp_replace(x, rf"(?m)^ {COPYRIGHT[1:]}[^\n]*\n?", "")


def units(d: DataFrame) -> DataFrame:
    """(doc_id, kind, digest) of the documents' units."""
    d = d.select("doc_id", canonical_text(F.col("text")).alias("x"))

    def plain(x: Column) -> Column:
        return F.trim(F.regexp_replace(x, r"[ \n]+", " "))

    def of(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p: F.struct(F.lit(kind).alias("kind"), plain(p).alias("unit")))

    kinds = F.concat(of("document", F.array("x")), of("block", F.split("x", r"\n( *\n)+")),
                     of("line", F.split("x", r"\n")))
    rows = d.select("doc_id", F.explode(kinds).alias("u")).filter("u.unit <> ''")
    return rows.select("doc_id", "u.kind", F.md5(F.col("u.unit").cast("binary")).alias("digest"))


def sql(known: Iterable[tuple[str, str]] = tuple(KNOWN)) -> str:
    """The scan in DuckDB's SQL."""
    x = r"' ' || regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\n]+', ' ', 'g') || ' '"
    x = rf"regexp_replace({x}, ' *\n *', ' ' || chr(10) || ' ', 'g')"
    for a, b in SPELLINGS:
        x = f"replace({x}, ' {a} ', ' {b} ')"
    x = rf"regexp_replace({x}, '(?m)^ {COPYRIGHT[1:]}[^\n]*\n?', '', 'g')"
    values = ", ".join(f"('{d}', '{i}')" for d, i in digests(known))
    return rf"""
with doc as (select doc_id, {x} as x from documents),
part as (select doc_id, 'document' as kind, x as p from doc
         union all select doc_id, 'block', unnest(regexp_split_to_array(x, '\n(?: *\n)+')) from doc
         union all select doc_id, 'line', unnest(string_split(x, chr(10))) from doc),
unit as (select doc_id, kind, trim(regexp_replace(p, '[ \n]+', ' ', 'g'), ' ') as u from part),
known(digest, license) as (values {values}),
met as (select doc_id, kind, license from unit join known on md5(u) = digest where u <> ''),
found as (select doc_id, max(license) filter (kind = 'document') as whole_license,
                 string_agg(distinct license, ',' order by license) as licenses,
                 count(*) filter (kind <> 'document') as n_units from met group by 1)
select doc_id, whole_license, coalesce(licenses, '') as licenses, coalesce(n_units, 0)::bigint as n_units
from documents left join found using (doc_id)"""


def scan(docs: DataFrame, known: Iterable[tuple[str, str]] = tuple(KNOWN)) -> DataFrame:
    """(doc_id, whole_license, licenses, n_units): the licence that the whole
    document is (or null), the sorted ids of all licences found in it, joined
    by commas, and the number of units that are licences."""
    spark, d = docs.sparkSession, keyed(docs)
    table = spark.createDataFrame(digests(known), "digest string, license string")
    met = units(d).join(table, "digest")
    found = met.groupBy("doc_id").agg(
        F.max(F.when(F.col("kind") == "document", F.col("license"))).alias("whole_license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.count_if(F.col("kind") != "document").alias("n_units"))
    out = d.select("doc_id").join(found, "doc_id", "left")
    return unkeyed(out.select("doc_id", "whole_license",
                              F.coalesce("licenses", F.lit("")).alias("licenses"),
                              F.coalesce("n_units", F.lit(0).cast("long")).alias("n_units")))
