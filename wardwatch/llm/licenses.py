"""Licence scan: parts of a text compared with licence templates by Dice coefficient over word bigrams.

The parts of a text are the whole of it, each of its lines, and its passages: for a template of n words, n at
least `PASSAGE`, the runs of n words that begin at every eighth of n in a longer text, of which the best counts
for each template. So a notice wrapped inside a longer text is found. A part is lower-cased and cut into runs
of letters and digits; its bigrams are the distinct pairs of neighbouring words.

Two sets of sizes a and b reach a Dice coefficient of t only if b lies between a * t / (2 - t) and
a * (2 - t) / t, and if they share a * t / (2 - t) bigrams. So every template has a few words of which each
part that reaches it must hold one: those without which too few of its bigrams are left. Texts and parts without
any are left alone before they are cut, and the others meet the templates of the words they hold, by hash join.
Templates are a parameter with a bounded number of rows; they are the only broadcast. Nothing is shuffled but one
small row per match, combined before the shuffle.

Defined results: a null or empty text has no part and no match; a part with under two words has no bigram
and matches nothing; among equal coefficients the template first in order of name is the part's, and of a
template's passages the first; rows of one id and text are alike, rows of one id with other texts are judged
each by its own text. The words of a text are held in one task, some 50 bytes each.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8
WORD = "[\\p{L}\\p{N}]+"
#: Templates of so many words are looked for inside longer texts too, at every such part of their length.
PASSAGE, STEPS = 24, 8
#: What rounding may cost a bound that only leaves out what cannot match.
SLACK = 1e-9

# Lines and beginnings of well-known licence notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause line": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause line": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0 line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC notice": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.',
    "MIT line": "Released under the MIT License.",
    "MIT notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.',
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

# Whole texts and headers.
FULL_TEXTS = {
    "BSD-2-Clause text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "GPL-2.0 header": 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.',
    "GPL-3.0 header": 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.',
    "ISC text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "LGPL-2.1 header": 'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.',
    "LGPL-3.0 header": 'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>.',
    "MIT text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
}
KNOWN = TEMPLATES | FULL_TEXTS


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _bigrams(words: Column) -> Column:
    """Distinct pairs, as text; empty below two words."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(pairs)


def _shared(least: float) -> float:
    """The share of one set that another has to hold for a coefficient of `least`."""
    return least / (2 - least)


def needed_words(bigrams: list[str], least: float) -> list[str]:
    """Words without which fewer bigrams are left than a match must share; long words that end many of them first."""
    left, needed = set(bigrams), []
    while len(left) >= len(bigrams) * _shared(least) - SLACK:
        held: dict[str, int] = {}
        for pair in left:
            for word in set(pair.split(" ")):
                held[word] = held.get(word, 0) + 1
        word = max(held, key=lambda w: (len(w) >= 6, held[w], len(w), w))
        needed.append(word)
        left = {pair for pair in left if word not in pair.split(" ")}
    return needed


def template_table(spark: SparkSession, templates: dict[str, str] = KNOWN) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    words = _words(F.col("template"))
    return rows.select("license", F.size(words).alias("template_words"), _bigrams(words).alias("template_bigrams")).where(F.size("template_bigrams") > 0)


def license_matches(docs: DataFrame, templates: dict[str, str] = KNOWN, least: float = LEAST) -> DataFrame:
    """`doc_id, text_hash, part, license, dice, first_word` of what reaches `least`.

    Part 0 is the whole text and those above its lines, each with its best template. Part -1 are passages, a row
    for each template, with the place of the best one's first word (else 0).
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    rows = known.collect()  # as many as there are templates
    needed = {r.license: needed_words(r.template_bigrams, least) for r in rows}
    all_needed = sorted({w for words in needed.values() for w in words})
    names = {w: [name for name in sorted(needed) if w in needed[name]] for w in all_needed}
    if not rows:
        all_needed, names = [""], {"": []}
    low, high = _shared(least), 1 / _shared(least)
    smallest, largest = (f((len(r.template_bigrams) for r in rows), default=0) for f in (min, max))
    met = F.create_map(*[c for w in all_needed for c in (F.lit(w), F.array(*map(F.lit, names[w])).cast("array<string>"))])

    lowered = F.lower("text")
    holds = reduce(or_, [F.contains(lowered, F.lit(w)) for w in all_needed])
    # A line feed ends a word, so the words of the whole are those of its lines.
    lines = F.transform(F.split("text", "\n"), _words)
    cut = docs.where("text <> ''").where(holds).select("doc_id", F.xxhash64("text").alias("text_hash"), lines.alias("_lines"))
    several = F.when(F.size("_lines") > 1, F.col("_lines")).otherwise(F.array().cast("array<array<string>>"))
    whole = F.flatten("_lines")
    exploded = cut.select("doc_id", "text_hash", F.posexplode(F.concat(F.array(whole, whole), several)).alias("_place", "_words"))
    parts = exploded.select("doc_id", "text_hash", (F.col("_place") - 1).alias("part"), "_words").where(F.size("_words") >= 2)
    inside = F.col("part") == -1
    # Each distinct word but the first ends a bigram of its own: a part has no fewer bigrams, and no more than pairs of words.
    fewest, most = F.size(F.array_distinct("_words")) - 1, F.size("_words") - 1
    sized = parts.where(most >= smallest * low - SLACK).where(inside | (fewest <= largest * high + SLACK))
    held = F.array_intersect("_words", F.array(*map(F.lit, all_needed)))
    candidates = F.array_distinct(F.flatten(F.transform(held, lambda w: F.element_at(met, w))))
    own = sized.withColumn("_licenses", candidates).where(F.size("_licenses") > 0).withColumn("_own", _bigrams(F.col("_words")))
    near = own.withColumn("license", F.explode("_licenses")).join(F.broadcast(known), "license")
    n, shared = F.size("template_bigrams"), F.size(F.array_intersect("_own", "template_bigrams"))
    fits = (F.size("_own") >= n * low - SLACK) & (inside | (F.size("_own") <= n * high + SLACK))
    longer = ~inside | ((F.col("template_words") >= PASSAGE) & (F.size("_words") > F.col("template_words")))
    close = near.where(fits & longer).withColumn("_shared", shared).where(F.col("_shared") >= n * low - SLACK)

    def passage(start: Column) -> Column:
        pairs = _bigrams(F.slice("_words", start + 1, F.col("template_words")))
        dice = 2.0 * F.size(F.array_intersect(pairs, F.col("template_bigrams"))) / (F.size(pairs) + n)
        return F.struct(dice.alias("dice"), (-start).alias("minus"))

    step = F.greatest(F.floor(F.col("template_words") / STEPS).cast("int"), F.lit(1))
    best_passage = F.array_max(F.transform(F.sequence(F.lit(0), F.size("_words") - 1, step), passage))
    whole_part = F.struct((2.0 * F.col("_shared") / (F.size("_own") + n)).alias("dice"), F.lit(0).alias("minus"))
    scored = close.withColumn("_best", F.when(inside, best_passage).otherwise(whole_part)).where(F.col("_best.dice") >= least)
    best = F.min(F.struct((-F.col("_best.dice")).alias("minus"), "license", (-F.col("_best.minus")).alias("first_word"))).alias("best")
    grouped = scored.groupBy("doc_id", "text_hash", "part", F.when(inside, F.col("license")).alias("_of")).agg(best)
    return grouped.select("doc_id", "text_hash", "part", "best.license", (-F.col("best.minus")).alias("dice"), "best.first_word")


def sql(templates: dict[str, str] = KNOWN, least: float = LEAST) -> str:
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in sorted(templates.items()))
    bigrams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    dice = "2e0 * len(list_intersect(pb, tb)) / (len(pb) + len(tb))"
    return f"""
WITH t AS (
  SELECT license, len(w) AS n, {bigrams} AS tb FROM (
    SELECT license, regexp_extract_all(lower(text), '{WORD}') AS w FROM (VALUES {rows}) v(license, text))),
p AS (
  SELECT DISTINCT doc_id, part, line FROM (
    SELECT doc_id, 0 AS part, text AS line FROM documents WHERE text <> ''
    UNION ALL
    SELECT doc_id, generate_subscripts(l, 1) AS part, unnest(l) AS line FROM (
      SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE contains(text, chr(10))))),
b AS (SELECT doc_id, part, w, {bigrams} AS pb FROM (SELECT doc_id, part, regexp_extract_all(lower(line), '{WORD}') AS w FROM p) WHERE len(w) > 1),
s AS (SELECT doc_id, part, license, {dice} AS dice FROM b, t),
-- A passage shares no more bigrams with a template than its text does.
c AS (
  SELECT doc_id, license, w AS words, n, tb FROM b, t
  WHERE part = 0 AND n >= {PASSAGE} AND len(w) > n AND len(list_intersect(pb, tb)) >= len(tb) * {_shared(least)} - {SLACK}),
o AS (
  SELECT doc_id, license, first_word, {dice} AS dice FROM (
    SELECT doc_id, license, first_word, tb, {bigrams} AS pb FROM (
      SELECT doc_id, license, first_word, tb, list_slice(words, first_word + 1, first_word + n) AS w FROM (
        SELECT *, unnest(range(0, len(words), greatest(n // {STEPS}, 1))) AS first_word FROM c))))
SELECT doc_id, part::integer AS part, license, dice, 0 AS first_word FROM s WHERE dice >= {least}
QUALIFY row_number() OVER (PARTITION BY doc_id, part ORDER BY dice DESC, license) = 1
UNION ALL
SELECT doc_id, -1, license, dice, first_word::integer FROM o WHERE dice >= {least}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, first_word) = 1
"""
