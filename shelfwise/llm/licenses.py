"""Licence scans by canonical digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.llm.common import staged

# Patterns and spellings of the canonical form, in the order they are applied.
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(copyright +\(c\)|copyright +©|copyright +[0-9]{4}|\(c\) +[0-9]{4}|©|all rights reserved)[^\n]*$"
)
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("http://", "https://"),
    ("&", " and "),
    ("per cent", "percent"),
]
MARKS = r"[^\p{L}\p{N}\n]+"
TITLE_LINE = (
    r"(?m)^ ?(the )?(mit|isc|zlib|bsd( zero clause| [0-9] clause)?( new| simplified)?( or revised| or freebsd)?) license( mit| isc)? ?$"
)
GAPS = r"[ \n]+"
#: Numbers of words by which a known text is found before it is compared: the largest that it reaches.
ANCHORS = [1, 2, 4]

# Public licence texts and notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and
to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public
at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
the License for the specific language governing permissions and limitations under the License."""
KNOWN = [
    ("Apache-2.0", APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", BSD_START + BSD_END),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", BSD_START + BSD_NAMES + BSD_END),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", UNLICENSE),
    ("Zlib", ZLIB),
]


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def read_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """A known list from a folder of text files, one licence each, named by its file."""
    files = spark.read.text(folder, wholetext=True)
    return files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("license"), F.col("value").alias("text"))


def canonical(text: Column) -> Column:
    """Small letters, no copyright or title lines, one spelling of each word, a space for all marks; lines stay."""
    text = F.translate(text, UPPER, SMALL)
    text = F.regexp_replace(text, COPYRIGHT_LINE, "")
    for other, one in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(one))
    return F.regexp_replace(F.regexp_replace(text, MARKS, " "), TITLE_LINE, "")


def one_line(canonical_text: Column) -> Column:
    return F.trim(F.regexp_replace(canonical_text, GAPS, " "))


def license_scan(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    license_col: str = "license", known_text_col: str = "text",
) -> DataFrame:
    """Licences of every document, by digests of canonical texts.

    ``license`` is the known licence whose entire text the document is; ``notices`` are those whose
    entire text is a run of whole lines of it, however either is wrapped.  ``known`` (default: a list
    of public texts; a folder of files by :func:`read_licenses`) may be of any size: lines are joined
    with it by their first words, and where these agree the run of as many words is joined by digest.
    The same digest under several names counts by the first one.

    Returns one row for each input row: ``id_col``, ``digest`` (null for texts that are null or
    without letters and digits), ``license``, ``notices`` (distinct, sorted) and ``n_notices``.  Rows
    without id, repeated rows and further columns do no harm; an empty table gives none, and an empty
    list no licence.  Texts of any length are read whole, and a run is as long as the known text.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    names = known.select(known[license_col].alias("name"), one_line(canonical(known[known_text_col])).alias("line"))
    names = names.filter("line != '' AND name IS NOT NULL").groupBy(F.sha2("line", 256).alias("key")).agg(F.min("name").alias("name"), F.min("line").alias("line"))
    # As words are joined by one space, a run of lines holds a known text if it has its length and its digest.
    words = F.size(F.split("line", " "))
    first = F.greatest(*[F.when(words >= n, n) for n in ANCHORS], F.lit(0))
    anchor = F.xxhash64(F.array_join(F.slice(F.split("line", " "), 1, first), " "))
    names = staged(names.select("key", "name", anchor.alias("anchor"), words.alias("words"), F.length("line").alias("chars")), "known")

    text = docs.select(docs[id_col].alias("id"), F.split(canonical(docs[text_col]), "\n").alias("lines"))
    lines = F.filter(F.transform("lines", lambda x: F.trim(x)), lambda x: x != "")
    rows = staged(text.select(F.monotonically_increasing_id().alias("row"), "id", lines.alias("lines")), "lines")
    width = ANCHORS[-1]

    def starts(at: Column) -> Column:
        begun = F.array_join(F.slice("lines", at, width), " ")
        return F.struct(at.cast("int").alias("at"), *[F.xxhash64(F.substring_index(begun, " ", n)).alias(f"first{n}") for n in ANCHORS])

    places = rows.filter("size(lines) > 0").select("row", F.explode(F.transform(F.sequence(F.lit(1), F.size("lines")), starts)).alias("s")).select("row", "s.*")
    keys = places.select("row", "at", F.explode(F.array(*[F.col(f"first{n}") for n in ANCHORS])).alias("anchor"))
    lengths = names.select("anchor", "words", "chars").distinct()
    tries = F.collect_set(F.struct("at", "words", "chars")).alias("tries")
    begun = staged(keys.join(lengths, "anchor").groupBy("row").agg(tries), "begun")  # few: small ones are broadcast below

    def run_key(t: Column) -> Column:
        run, start = F.slice("lines", t["at"], t["words"]), F.struct(F.lit(-1).alias("chars"), F.lit(False).alias("ends"))
        longer = lambda past, x: past["chars"] + 1 + F.length(x)
        ends = F.aggregate(
            run, start, lambda past, x: F.struct(longer(past, x).alias("chars"), (past["ends"] | (longer(past, x) == t["chars"])).alias("ends"))
        )["ends"]
        return F.when(ends, F.sha2(F.substring(F.array_join(run, " "), F.lit(1), t["chars"]), 256))

    tried = begun.join(rows.select("row", "lines"), "row").select("row", F.explode(F.transform("tries", run_key)).alias("key"))
    hits = tried.filter("key IS NOT NULL").join(names.select("key", "name"), "key")
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set("name")).alias("notices"))
    line = F.array_join("lines", " ")
    whole = rows.select("row", "id", F.when(line != "", F.sha2(line, 256)).alias("digest"))
    whole = whole.join(names.select(F.col("key").alias("digest"), F.col("name").alias("license")), "digest", "left")
    none = F.array().cast("array<string>")
    return whole.join(found, "row", "left").select(
        F.col("id").alias(id_col), "digest", "license", F.coalesce("notices", none).alias("notices"),
        F.coalesce(F.size("notices"), F.lit(0)).cast("long").alias("n_notices"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    made = f"regexp_replace(translate({text}, '{UPPER}', '{SMALL}'), {_sql_text(COPYRIGHT_LINE)}, '', 'g')"
    for other, one in SPELLINGS:
        made = f"replace({made}, {_sql_text(other)}, {_sql_text(one)})"
    made = f"regexp_replace({made}, {_sql_text(MARKS)}, ' ', 'g')"
    return f"regexp_replace({made}, {_sql_text(TITLE_LINE)}, '', 'g')"


def license_sql() -> str:
    """The query over ``documents`` and the list above; runs of lines are found by a pattern for each known text."""
    listed = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in KNOWN)
    line = f"trim(regexp_replace(c, {_sql_text(GAPS)}, ' ', 'g'))"
    lines = r"regexp_replace(regexp_replace(c, ' *\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"
    return f"""
WITH listed(name, text) AS (VALUES {listed}),
names AS (SELECT line, min(name) AS name FROM (SELECT name, {line} AS line FROM (SELECT name, {_sql_canonical("text")} AS c FROM listed)) WHERE line <> '' GROUP BY 1),
docs AS (SELECT row_number() OVER () AS n, doc_id, {_sql_canonical("text")} AS c FROM documents),
plain AS (SELECT n, doc_id, {line} AS line, chr(10) || {lines} || chr(10) AS lines FROM docs),
found AS (SELECT n, string_agg(DISTINCT name, ',' ORDER BY name) AS notices, count(DISTINCT name) AS n_notices
  FROM plain JOIN names ON contains(' ' || plain.line || ' ', ' ' || names.line || ' ') AND regexp_matches(lines, chr(10) || replace(names.line, ' ', '[ \n]') || chr(10)) GROUP BY n)
SELECT doc_id, CASE WHEN p.line <> '' THEN sha256(p.line) END AS digest, names.name AS license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM plain p LEFT JOIN names ON names.line = p.line LEFT JOIN found USING (n)
"""
