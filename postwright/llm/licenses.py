"""Licence scans by Dice coefficient over word bigrams, in DataFrame operations only.

Units of a text are its lines, its paragraphs (blocks between blank lines) of
more than one line, and the whole text when it has more than one paragraph.
Units and templates are normalised to words (letters and digits, A-Z
lower-cased) and compared as sets of bigrams: 2 * common / (|A| + |B|).  A
coefficient of at least ``threshold`` t needs set sizes whose ratio lies within
t / (2 - t) and its inverse, so a unit meets only the templates within these
bounds.  The best template of a unit is reported; of equal ones, the first by
name.  Most units are left out before that by a word test that no match fails
(``markers``).

Cases: null and empty texts, and units of fewer than two words, match nothing;
texts of any length are read whole; repeated rows are reported each; an empty
table gives an empty one; extra columns are not read.

Templates are a parameter of bounded size, and so is the table that holds them
by admissible unit size; it is the broadcast side.  Nothing else is joined and
nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least coefficient that is reported.
THRESHOLD = 0.8
#: Most characters of all templates together.
MAX_TEMPLATE_CHARS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[\p{L}\p{N}]+"
#: Words too common to tell a licence from other prose.
COMMON = frozenset(
    "a all an and any are as at be but by can do for from has have if in is it may must no not of "
    "on one or other shall such that the this to under we will with without you your".split()
)
BREAK = r"\n[ \t\r]*\n"

_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain
the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written
permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""

#: Published licence texts and the notices in common use for them: (name, text), fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0 header", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.
"""),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause notice", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0 notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0 notice", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0 notice",
     "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0 header", """
This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY
or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program. If not,
see <https://www.gnu.org/licenses/>.
"""),
    ("GPL-3.0 notice",
     "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN
NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""),
    ("MIT", _MIT),
    ("MIT notice", "Released under the MIT License."),
    ("MPL-2.0 header", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.
"""),
    ("Reserved notice", "All rights reserved."),
)


def word_array(text: Column) -> Column:
    """Normalised words of a text."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def bigrams(words: str) -> Column:
    """Distinct neighbouring pairs of an array of words."""
    return F.expr(
        f"array_distinct(zip_with(slice({words}, 1, size({words}) - 1), "
        f"slice({words}, 2, size({words}) - 1), (a, b) -> concat(a, ' ', b)))"
    )


def _pairs(text: str) -> set[tuple[str, str]]:
    """Bigrams of a template (ASCII)."""
    words = re.findall(r"[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))
    return set(zip(words, words[1:], strict=False))


def markers(templates: tuple[tuple[str, str], ...], threshold: float) -> list[str]:
    """Words of which a matching unit holds at least one.

    A coefficient of t needs t / (2 - t) of a template's bigrams.  Words other
    than common ones that stand in most of the bigrams not yet covered are taken, until the
    bigrams without any of them are fewer than that; a unit without these words
    cannot match.
    """
    chosen: set[str] = set()
    for _, text in sorted(templates, key=lambda t: len(t[1])):
        pairs = _pairs(text)
        need = threshold / (2 - threshold) * len(pairs)
        while len(left := {p for p in pairs if not chosen & set(p)}) >= need - 1e-9 and left:
            words = {w for p in left for w in p}
            words = words - COMMON or words
            chosen.add(min(words, key=lambda w: (-sum(w in p for p in left), -len(w), w)))
    return sorted(chosen)


def has_marker(words: Column, wanted: list[str]) -> Column:
    """Whether an array of words holds one of the markers."""
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in wanted]))


def candidates(
    spark, templates: tuple[tuple[str, str], ...], threshold: float
) -> tuple[DataFrame, int]:
    """For each admissible number of bigrams of a unit, its templates by name; and the greatest."""
    if sum(len(t) for _, t in templates) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates exceed {MAX_TEMPLATE_CHARS} characters")
    ratio = threshold / (2 - threshold)
    low = F.ceil(F.col("t_size") * F.lit(ratio) - F.lit(1e-9)).cast("int")
    high = F.floor(F.col("t_size") / F.lit(ratio) + F.lit(1e-9)).cast("int")
    sized = (
        spark.range(1)
        .select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("license_id"), F.lit(t).alias("t")) for n, t in templates
        ])).alias("x"))
        .select("x.license_id", "x.t")
        .select("license_id", word_array(F.col("t")).alias("w"))
        .filter(F.size("w") > 1)
        .select("license_id", bigrams("w").alias("template"))
        .withColumn("t_size", F.size("template"))
        .select("*", F.explode(F.sequence(low, high)).alias("u_size"))
    )
    most = sized.agg(F.max("u_size").alias("most")).first()["most"]
    by_size = sized.groupBy("u_size").agg(
        F.sort_array(F.collect_list(F.struct("license_id", "template", "t_size"))).alias("fits")
    )
    return by_size, most or 0


def units(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, unit, unit_no, body): the lines, longer paragraphs and whole text of each document."""
    t = F.col(text)
    numbered = lambda name, parts: F.transform(
        parts, lambda x, i: F.struct(F.lit(name).alias("unit"), i.alias("unit_no"), x.alias("body"))
    )
    paragraphs = F.split(t, BREAK)
    longer = F.filter(
        numbered("paragraph", paragraphs),
        lambda p: F.contains(F.trim(p["body"]), F.lit("\n")),
    )
    whole = F.filter(numbered("text", F.array(t)), lambda _: F.size(paragraphs) > 1)
    every = F.concat(numbered("line", F.split(t, "\n")), longer, whole)
    return documents.select(key, F.explode(every).alias("u")).select(
        key, "u.unit", "u.unit_no", "u.body"
    )


def scan(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, unit, unit_no, license_id, n_bigrams, dice) of each unit that matches a template."""
    fits, most = candidates(documents.sparkSession, templates, threshold)
    words = markers(templates, threshold)
    source = documents.select(key, F.col(text).alias("_text"))
    # each step is exploded from an array of one element: a value that a filter and a later
    # step both need is made once
    made = lambda name, value: F.explode(F.array(value)).alias(name)
    kept = lambda name, value, test: F.explode(F.filter(F.array(value), test)).alias(name)
    unit = [key, "unit", "unit_no"]
    # lower() also changes letters beyond A-Z, but no word of a marker's letters comes or goes
    likely = source.filter(has_marker(
        F.regexp_extract_all(F.lower("_text"), F.lit(WORD), F.lit(0)), words
    ))
    # n different words make n - 1 different bigrams at least
    worded = units(likely, key, "_text").select(*unit, kept(
        "w", word_array(F.col("body")),
        lambda w: (F.size(w) > 1) & has_marker(w, words)
        & (F.size(F.array_distinct(w)) <= F.lit(most + 1)),
    ))
    sized = worded.select(*unit, made("b", bigrams("w"))).withColumn("n", F.size("b")).join(
        F.broadcast(fits), F.col("n") == F.col("u_size")
    )
    scored = F.expr(
        "transform(fits, (f, i) -> struct(2.0D * size(array_intersect(b, f.template)) "
        "/ (n + f.t_size) AS dice, -i AS place, f.license_id AS license_id))"
    )
    best = sized.select(*unit, "n", kept(
        "best", F.array_max(scored), lambda x: x["dice"] >= F.lit(threshold)
    ))
    return best.select(
        *unit, "best.license_id", F.col("n").cast("long").alias("n_bigrams"), "best.dice"
    )
