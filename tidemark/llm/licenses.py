"""License scan: lines, paragraphs and whole texts against templates, by Dice over word bigrams.

A unit of text is lower-cased, everything but letters and digits becomes one space, and the set
of its word bigrams is compared with each template's: 2 |A and B| / (|A| + |B|). A coefficient of
``least`` needs sizes within a factor (2 - least) / least, so units join only the templates whose
size allows it: an equi-join on the number of bigrams with a small table of (size, template),
bounded by the templates' sizes. Only what joins is compared. Templates are the notices here and
the whole licenses of ``license_texts``, the latter named ``-text``; ``license_sql`` has the notices.

Null and empty texts, and units of one word, have no bigrams and no license. Repeated rows give
one result row for each document id; null ids are one. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

#: Notices of common licenses, fixed values.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0-notice": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ],
    "BSD": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MIT-notice": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ],
}


@lru_cache
def templates() -> dict[str, list[str]]:
    """The notices, and the whole licenses."""
    folder = Path(__file__).parent / "license_texts"
    return TEMPLATES | {f"{p.stem}-text": [p.read_text("utf-8")] for p in sorted(folder.glob("*.txt"))}


def bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def sizes_allowed(size: int, least: float) -> range:
    """Sizes that can reach the coefficient with a template of ``size`` bigrams."""
    low = math.ceil(size * least / (2 - least) - 1e-9)
    return range(low, math.floor(size * (2 - least) / least + 1e-9) + 1)


def template_rows(least: float = LEAST) -> list[tuple[str, int, int]]:
    """license, variant, size for every size of a unit that a template may meet."""
    return [
        (name, k, n)
        for name, texts in templates().items()
        for k, text in enumerate(texts)
        for n in sizes_allowed(len(bigrams(text)), least)
    ]


def unit_bigrams(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")), " ")


def license_scan(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, license, dice (its best unit's coefficient) of every license found."""
    spark = docs.sparkSession
    # Apart from the sizes, as a whole license has thousands of both.
    sizes = template_rows(least)
    allowed = spark.createDataFrame(sizes, "license string, variant int, size int")
    wanted = spark.createDataFrame(
        [(name, k, bigrams(text)) for name, texts in templates().items() for k, text in enumerate(texts)],
        "license string, variant int, wanted array<string>",
    )
    whole = docs.where("text IS NOT NULL").select("doc_id", "text")
    units = whole.select(
        "doc_id",
        F.explode(
            F.array_distinct(
                F.concat(F.split("text", "\n"), F.split("text", r"\n\s*\n"), F.array("text"))
            )
        ).alias("unit"),
    )
    words = units.select("doc_id", unit_bigrams(F.col("unit")).alias("words"))
    # Distinct bigrams are no more than words: a unit that is too short for all is dropped early.
    shortest = min(n for _, _, n in sizes)
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("words") - 2),
        lambda i: F.concat_ws(" ", F.get("words", i), F.get("words", i + 1)),
    )
    found = words.where(F.size("words") > shortest).select("doc_id", F.array_distinct(pairs).alias("bigrams"))
    # Never null, so that no filter on it is pushed down (and the bigrams made once more).
    sized = found.withColumn("size", F.coalesce(F.size("bigrams"), F.lit(0)))
    shared = F.size(F.array_intersect("bigrams", "wanted"))
    dice = (2.0 * shared) / (F.col("size") + F.size("wanted"))
    met = sized.join(F.broadcast(allowed), "size").join(F.broadcast(wanted), ["license", "variant"])
    matched = met.withColumn("dice", dice).where(F.col("dice") >= least)
    return matched.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"))


def license_sql(least: float = LEAST) -> str:
    """The same, as SQL."""
    rows = ", ".join(
        "('{}', {})".format(name, "[" + ", ".join(f"'{b}'" for b in bigrams(text)) + "]")
        for name, texts in TEMPLATES.items()
        for text in texts
    )
    return rf"""
WITH templates(license, wanted) AS (VALUES {rows}),
units AS (
  SELECT DISTINCT doc_id, unnest(list_concat(string_split(text, chr(10)),
    regexp_split_to_array(text, '\n\s*\n'), [text])) AS unit
  FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(unit), '[^\p{{L}}\p{{N}}]+'),
                             lambda w: w <> '') AS words FROM units),
grams AS (
  SELECT doc_id, list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS grams
  FROM words WHERE len(words) > 1)
SELECT doc_id, license, max(2.0::DOUBLE * len(list_intersect(grams, wanted)) / (len(grams) + len(wanted))) AS dice
FROM grams, templates
WHERE 2.0::DOUBLE * len(list_intersect(grams, wanted)) / (len(grams) + len(wanted)) >= {least}
GROUP BY doc_id, license
"""
