"""Licence scans: Dice coefficient over word bigrams, in DataFrame functions alone.

A notice may stand anywhere: on a line, inside of one, wrapped over several, or be
the whole text. Texts are normalised to words, and a template is compared with
windows of the text as long as itself. Where windows begin is told by the bigrams
that text and template have in common: each says where the template would begin,
and a place counts if ``ALIGNED`` of the template's bigrams agree on it.

Sizes prune templates before that: with ``k`` of a template's ``b`` bigrams somewhere
in the text a window can neither be aligned nor similar if ``k`` is below
``ALIGNED * b``, and a window of ``a`` bigrams, cut short by an end of the text, can
reach a coefficient of ``t`` only if ``a`` is at least ``b * t / (2 - t)``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text

THRESHOLD = 0.8
#: Tenths of a template's bigrams that must stand at their places.
ALIGNED = 4

# Licence names and the notices by which texts state them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),  # noqa: E501
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),  # noqa: E501
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),  # noqa: E501
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),  # noqa: E501
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),  # noqa: E501
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),  # noqa: E501
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),  # noqa: E501
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),  # noqa: E501
]


def normal_words(text: Column) -> Column:
    """Lower-cased runs of a-z and 0-9; all else parts words."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    """The pairs of neighbouring words, in order."""
    firsts = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    seconds = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(firsts, seconds, lambda a, b: F.concat_ws(" ", a, b))


def word_bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    return F.array_distinct(word_pairs(words))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The licences that each text states: ``doc_id, license, dice, n_units``.

    A unit is a stretch of the text where windows at ``threshold`` or above overlap;
    it counts for the licence of the window that is most like its template (of
    equal ones for the first by name). ``dice`` is the best coefficient of the units
    that count for the licence, ``n_units`` their number. Null and empty texts, and
    texts of fewer than two words, match nothing. Rows that repeat an id are counted
    together. Other columns are not looked at; an empty table gives an empty one.
    Templates of fewer than two words are refused.
    """
    spark = docs.sparkSession
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    work = Workspace(spark, "licenses")
    # a parameter, so as small as its caller makes it
    filed = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(templates or TEMPLATES)],
        "template int, license string, notice string",
    ).select("template", "license", normal_words(F.col("notice")).alias("notice_words"))
    filed = filed.select("template", "license", F.size("notice_words").alias("length"), word_bigrams(F.col("notice_words")).alias("grams"),
                         word_pairs(F.col("notice_words")).alias("pairs")).collect()
    if any(not t["grams"] for t in filed):
        raise ValueError("a template needs two words at least")
    known = F.from_json(
        F.lit(json.dumps([{"grams": t["grams"]} for t in filed])), "array<struct<grams:array<string>>>"
    )
    every = F.from_json(F.lit(json.dumps(sorted({g for t in filed for g in t["grams"]}))), "array<string>")
    words = docs.select(F.col(id_col).alias("doc_id"), normal_words(clean_text(text_col)).alias("words"))
    # numbered here, so that the bigrams are made once and not for each template below
    met = words.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "words",
        F.array_intersect(word_pairs(F.col("words")), every).alias("met"),
    )
    enough = F.exists(known, lambda t: F.size(F.array_intersect(t["grams"], F.col("met"))) * 10 >= F.size(t["grams"]) * ALIGNED)
    texts = work.save(
        met.where((F.size("met") > 0) & enough).select("row", "doc_id", "words"), "texts"
    )
    # where in a template a bigram first stands
    places = spark.createDataFrame(
        [(t["template"], g, t["pairs"].index(g), len(t["grams"])) for t in filed for g in t["grams"]],
        "template int, gram string, k int, n int",
    )
    starts = (
        texts.select("row", F.posexplode(word_pairs(F.col("words"))).alias("at", "gram"))
        .join(F.broadcast(places), "gram")
        .groupBy("row", "template", (F.col("at") - F.col("k")).alias("start"))
        .agg(F.count("*").alias("aligned"), F.first("n").alias("n"))
        .where(F.col("aligned") * 10 >= F.col("n") * ALIGNED)
        .groupBy("row")
        .agg(F.collect_list(F.struct("template", "start")).alias("starts"))
    )
    whole = spark.createDataFrame(
        [(t["template"], t["license"], t["length"], t["grams"]) for t in filed],
        "template int, license string, length int, grams array<string>",
    )
    first = F.greatest("start", F.lit(0))
    past = F.least(F.col("start") + F.col("length"), F.size("words"))
    shared = F.size(F.array_intersect("window", "grams"))
    found = (
        texts.join(starts, "row")
        .select("row", "doc_id", "words", F.inline("starts"))
        .join(F.broadcast(whole), "template")
        .select("row", "doc_id", "license", "grams", first.alias("first"), past.alias("past"),
                word_bigrams(F.slice("words", first + 1, past - first)).alias("window"))
        .where(F.size("window") * (2 - threshold) >= F.size("grams") * threshold - 1e-9)
        .withColumn("dice", 2 * shared / (F.size("window") + F.size("grams")))
        .where(F.col("dice") >= threshold)
    )
    order = Window.partitionBy("row").orderBy("first", "past")
    before = F.max("past").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") < before, 0).otherwise(1)
    return (
        found.select("row", "doc_id", "license", "dice", "first", "past", fresh.alias("fresh"))
        .withColumn("unit", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "doc_id", "unit")
        .agg(F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("best"))
        .groupBy("doc_id", F.col("best.license").alias("license"))
        .agg((-F.min("best.less")).alias("dice"), F.count("*").alias("n_units"))
    )
