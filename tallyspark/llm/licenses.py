"""License scans with DataFrame functions only.

Texts and templates are reduced to words of ASCII letters and digits in lower case, and to
hashes of five-word shingles. Templates are grouped into classes by their number of shingles
(``2 ** c`` at most); a class has its own overlapping windows over a text, ``5/4`` of the class
long and a quarter of it apart, so that some window covers any place of a template and shares
at least ``0.4 * 0.8`` of their union with it when four fifths of the template are there.
MinHash with ``BANDS`` bands of one row then retrieves the template with a probability of at
least ``1 - (1 - 0.32) ** BANDS`` (0.9996 for 20 bands; 1 for templates of one shingle, whose
windows are single shingles). Retrieved pairs are verified: the share of the template's
distinct shingles in the window must reach ``MIN_CONTAINMENT``.

Two lossless filters come first. Every whole text is searched for anchor words, chosen so that a
text which holds enough of a template has one of them; and windows that share no shingle with
any template are not hashed. Templates
are a bounded parameter and are broadcast; a template with fewer than five words counts as one
shingle, and one without words is ignored. Null and empty texts match nothing. A document gives
one row per template it holds, with its best window; where templates of different licenses that
share half of one's shingles meet in a place, the one with more shingles there is reported; rows that repeat a document id are one
document. Only the id and text columns are read.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import stage

K = 5
BANDS = 20
MIN_CONTAINMENT = 0.8

# Wording of public license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)

_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_AS_IS = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
)


def _gnu_header(what: str, license_name: str, version: str) -> str:
    return (
        f"{what}; you can redistribute it and/or modify it under the terms of the {license_name} as published by the Free "
        f"Software Foundation; either version {version} of the License, or (at your option) any later version."
    )


#: The templates above and whole notices and short texts of licenses that they lack or cut.
STANDARD = (
    *TEMPLATES,
    (
        "MIT-full",
        dict(TEMPLATES)["MIT-text"] + _AS_IS + "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("BSD-2-Clause-full", _BSD_START + _BSD_TWO + _BSD_END),
    ("BSD-3-Clause-full", _BSD_START + _BSD_TWO + _BSD_THIRD + _BSD_END),
    (
        "ISC-full",
        dict(TEMPLATES)["ISC"] + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0-header", _gnu_header("This program is free software", "GNU General Public License", "2")),
    ("LGPL-2.1-header", _gnu_header("This library is free software", "GNU Lesser General Public License", "2.1")),
    ("LGPL-3.0-header", _gnu_header("This program is free software", "GNU Lesser General Public License", "3")),
    ("AGPL-3.0-header", _gnu_header("This program is free software", "GNU Affero General Public License", "3")),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    ("CC-BY-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def license_of(license_id: str) -> str:
    """The license that a template stands for: its name without the kind of template."""
    return re.sub("-(?:text|header|full|notice)$", "", license_id)


def text_shingles(text: Column) -> Column:
    """Hashes of all five-word shingles in order; of all words when there are one to four."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    clean = F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))
    words = F.split(clean, " ")

    def shingles(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - K), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(K)])
        )
        return F.when(F.size(w) >= K, runs).otherwise(F.array(F.xxhash64(w)))

    # one array of words, bound once: the outer transform runs over a single element
    made = F.get(F.transform(F.array(words), shingles), 0)
    return F.when(clean != "", made).otherwise(F.array().cast("array<bigint>"))


def anchors(templates=TEMPLATES, min_containment: float = MIN_CONTAINMENT) -> list[str]:
    """Words of which any text that holds enough of a template has at least one.

    Per template the longest words are taken until the shingles without any of them are too
    few to reach ``min_containment``.
    """
    out: set[str] = set()
    for _, template in templates:
        words = re.sub("[^a-z0-9]+", " ", template.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))).split()
        runs = {tuple(words[i : i + K]) for i in range(max(1, len(words) - K + 1))} if words else set()
        for word in sorted(set(words), key=lambda w: (w not in out, -len(w), w)):
            if sum(not out.intersection(r) for r in runs) < min_containment * len(runs):
                break
            out.add(word)
    return sorted(out)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``license_id, shingles`` (distinct), ``class`` of each template with words."""
    rows = spark.createDataFrame([(str(i), t) for i, t in templates], "license_id string, template string")
    rows = rows.select("license_id", F.array_distinct(text_shingles(F.col("template"))).alias("shingles")).where(F.size("shingles") > 0)
    rows = rows.withColumn("class", F.ceil(F.log2(F.size("shingles"))).cast("int"))
    # rivals: templates of other licenses with half of this one's shingles (a bounded parameter's pairs)
    sets = {r["license_id"]: set(r["shingles"]) for r in rows.select("license_id", "shingles").collect()}
    rivals = [(i, [j for j, b in sets.items() if license_of(j) != license_of(i) and 2 * len(a & b) >= len(a)]) for i, a in sets.items()]
    return rows.join(F.broadcast(spark.createDataFrame(rivals, "license_id string, rivals array<string>")), "license_id")


def signature(shingles: Column) -> Column:
    """One minimum per band, as an array of (band, minimum)."""

    def lowest(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[F.struct(F.lit(b).alias("band"), lowest(b).alias("low")) for b in range(BANDS)])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=STANDARD, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """``doc_id, license_id, containment, first_word`` (of the best window)."""
    spark = docs.sparkSession
    table, _ = stage(template_table(spark, templates).coalesce(1), "templates")
    classes = sorted(r[0] for r in table.select("class").distinct().collect())  # one per power of two
    # shingles of all templates, a constant: the templates are a bounded parameter
    held = sorted({h for r in table.select("shingles").collect() for h in r[0]})
    wanted = F.lit(held) if held else F.array().cast("array<bigint>")
    likely = docs.where(F.col(text_col).rlike("(?i)" + "|".join(anchors(templates, min_containment)) if templates else "$^"))
    hashed = likely.select(F.col(id_col).alias("doc_id"), text_shingles(F.col(text_col)).alias("all"))
    hashed = hashed.withColumn("row", F.monotonically_increasing_id())  # fixed by the write below
    hit_docs, _ = stage(hashed.where(F.arrays_overlap("all", wanted)), "license-documents")

    n = F.size("all")
    cells = None
    for c in classes:
        size = 2**c
        width, step = size + size // 4, max(1, size // 4)
        starts = F.sequence(F.lit(0), F.greatest(n - F.lit(width) + F.lit(step), F.lit(0)), F.lit(step))
        part = hit_docs.select("doc_id", "row", "all", F.lit(c).alias("class"), F.explode(starts).alias("start"))
        part = part.select("doc_id", "row", "class", "start", F.slice("all", F.col("start") + 1, F.lit(width)).alias("window"))
        cells = part if cells is None else cells.unionByName(part)
    if cells is None:
        return docs.select(F.col(id_col).alias("doc_id")).limit(0).selectExpr(
            "doc_id", "'' AS license_id", "0D AS containment", "0L AS first_word"
        )
    windows = cells.where((F.size("window") > 0) & F.arrays_overlap("window", wanted))
    bands = table.select("license_id", "class", F.explode(signature(F.col("shingles"))).alias("at"))
    bands = bands.select("license_id", "class", F.col("at.band").alias("band"), F.col("at.low").alias("low"))
    keyed = windows.withColumn("at", F.explode(signature(F.col("window"))))
    keyed = keyed.select("doc_id", "row", "class", "start", "window", F.col("at.band").alias("band"), F.col("at.low").alias("low"))
    found = keyed.join(F.broadcast(bands), ["class", "band", "low"])
    # the first band that retrieved the pair stands for the others
    once = found.join(F.broadcast(table.select("license_id", "rivals", F.col("shingles").alias("template"))), "license_id")
    once = once.withColumn("matched", F.size(F.array_intersect("window", "template")))
    verified = once.withColumn("containment", F.col("matched") / F.size("template")).where(F.col("containment") >= min_containment)
    # of rivals that meet in a place of a row, those with fewer shingles there go
    width = F.size("window").alias("width")
    hit = F.struct("license_id", "containment", "start", width, "matched", "rivals")
    places = verified.groupBy("doc_id", "row").agg(F.collect_set(hit).alias("hits"))

    def beaten(x: Column) -> Column:
        meets = lambda y: (y["start"] < x["start"] + x["width"]) & (x["start"] < y["start"] + y["width"])
        return F.exists("hits", lambda y: (y["matched"] > x["matched"]) & F.array_contains(x["rivals"], y["license_id"]) & meets(y))

    verified = places.select("doc_id", F.explode(F.filter("hits", lambda x: ~beaten(x))).alias("hit")).select("doc_id", "hit.*")
    best = F.max(F.struct("containment", (-F.col("start")).alias("place")))
    return (
        verified.groupBy("doc_id", "license_id")
        .agg(best.alias("best"))
        .select("doc_id", "license_id", F.col("best.containment").alias("containment"), (-F.col("best.place")).cast("long").alias("first_word"))
    )
