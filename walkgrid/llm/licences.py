"""Licence scan: canonical digests of whole texts and of notice lines, looked up by hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walkgrid.llm.common import table

#: Names of licences as notices give them, and their SPDX identifiers.
NAMES = {
    "Apache License, Version 2.0": "Apache-2.0",
    "Apache License 2.0": "Apache-2.0",
    "MIT License": "MIT",
    "ISC License": "ISC",
    "BSD 2-Clause License": "BSD-2-Clause",
    "BSD 3-Clause License": "BSD-3-Clause",
    "Mozilla Public License, version 2.0": "MPL-2.0",
    "GNU General Public License, version 2": "GPL-2.0-only",
    "GNU General Public License, version 3": "GPL-3.0-only",
    "GNU Lesser General Public License, version 2.1": "LGPL-2.1-only",
    "GNU Lesser General Public License, version 3": "LGPL-3.0-only",
    "GNU Affero General Public License, version 3": "AGPL-3.0-only",
    "Eclipse Public License, version 2.0": "EPL-2.0",
    "CC BY 4.0": "CC-BY-4.0",
    "CC BY-SA 4.0": "CC-BY-SA-4.0",
    "CC BY-NC 4.0": "CC-BY-NC-4.0",
    "CC BY-ND 4.0": "CC-BY-ND-4.0",
    "CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
    "CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
    "CC0 1.0": "CC0-1.0",
    "Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "Creative Commons Attribution-NonCommercial 4.0 International License": "CC-BY-NC-4.0",
}
#: Sentences that a notice puts a name into, with and without the article.
NOTICES = tuple(f"{what}licensed under {the}{{}}." for what in ("", "This work is ", "This file is ", "This program is ", "This software is ") for the in ("", "the "))

#: Whole licence texts.
TEXTS = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
}
#: Spellings that count as one.
SPELLINGS = {"licence": "license", "sub-licens": "sublicens", "non-commercial": "noncommercial", "non-infringement": "noninfringement", "acknowledgement": "acknowledgment", "organisation": "organization", "copyright owner": "copyright holder", "https:": "http:"}
#: Punctuation, each mark a separator.
MARKS = "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127), 169, 8211, 8212, 8216, 8217, 8220, 8221)))
#: A word part that every built-in text has. Where all known texts have it, a line without it is none of them.
IN_NOTICES = "licen"


def normalised(text: Column) -> Column:
    """Lower case; without lines that state a copyright; punctuation and white space as single blanks; one spelling."""
    low = F.lower(text)
    for old, new in SPELLINGS.items():
        low = F.replace(low, F.lit(old), F.lit(new))
    low = F.regexp_replace(low, r"(?m)^[^\p{L}\p{N}©\n]*(copyright|©)[^\n]*([12][0-9]{3}|\(c\)|©|<year>)[^\n]*$", " ")
    return F.array_join(F.array_remove(F.split(F.translate(low, MARKS + "\t\r\n\x0b\x0c", " " * (len(MARKS) + 5)), " "), ""), " ")


def known_texts(spark: SparkSession) -> DataFrame:
    """``licence, text`` of the built-in whole texts and notices."""
    rows = [(licence, text) for licence, text in TEXTS.items()] + [(licence, notice.format(name)) for name, licence in NAMES.items() for notice in NOTICES]
    return spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(a).alias("licence"), F.lit(b).alias("text")) for a, b in rows))))


def digests(known: DataFrame) -> DataFrame:
    """``digest, licence``: one licence for each canonical digest (the first by name where two share it)."""
    return known.groupBy(F.sha2(normalised(F.col("text")), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: ``doc_id, canonical_sha256`` (of the whole text), ``licence`` (whose text the whole text is,
    else null), ``n_notices`` (lines that are a known text by themselves) and ``licences`` (theirs, sorted, each once).

    Null text has no digest, no licence and no notices; an empty text is no licence. Repeated rows get the same answer each.
    ``known`` has columns ``licence, text``, whole texts and single lines alike; an empty one finds nothing. Digests are joined by equality: the built-in table is
    a few hundred rows, and a larger one is broadcast only if Spark has measured it as small.
    """
    by_digest = table(digests(known if known is not None else known_texts(docs.sparkSession)), "licences")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("k1"), F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0"))).alias("k2"))
    whole = rows.select("doc_id", "k1", "k2", F.sha2(normalised(F.col("text")), 256).alias("canonical_sha256")).join(by_digest.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left")
    others = known is not None and not known.filter(~F.contains(F.lower("text"), F.lit(IN_NOTICES))).isEmpty()
    lines = F.filter(F.split("text", "\n"), lambda x: F.contains(F.lower(x), F.lit("" if others else IN_NOTICES)) & (F.trim(x) != ""))
    lines = rows.select("k1", "k2", F.posexplode(lines).alias("at", "line"))
    found = lines.select("k1", "k2", "at", F.sha2(normalised(F.col("line")), 256).alias("digest")).join(by_digest, "digest").dropDuplicates(["k1", "k2", "at"])
    notices = found.groupBy("k1", "k2").agg(F.count("*").alias("n_notices"), F.array_sort(F.collect_set("licence")).alias("licences"))
    none = F.array().cast("array<string>")
    return whole.join(notices, ["k1", "k2"], "left").select("doc_id", "canonical_sha256", "licence", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("licences", none).alias("licences"))
