"""License scans by MinHash bands over overlapping windows, in DataFrame operations only (operator 6).

Words are runs of `[a-z0-9]` in the lower-cased text; sets are of five-word shingles. A template
with s shingles belongs to the class c, the least power of two that is not below s; a text has
windows of 2c shingles at every c-th shingle, so some window holds all of a notice that starts
anywhere. A window retrieves a template if one of their minima agrees (one row a band); the
template is reported if the window holds 0.8 or more of its shingles, counted exactly.

Collision probability: a window that holds a share q >= 0.8 of a template has a Jaccard similarity of
at least 0.8 s / (2c + 0.2 s) > 0.19, as s > c / 2, and 64 bands then agree somewhere with
probability 1 - 0.81^64 > 0.999998; a whole notice alone in its window has more.

What is not computed in vain: a window's minimum can only equal a template's minimum if the very
shingle that has it is in the window. So texts without any shingle that is some template's minimum
are set aside first; they cannot agree in any band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS, BANDS, MIN_CONTAINMENT = 5, 64, 0.8

# Names of licenses and the words of their usual notices, in public use.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def license_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(words: str) -> Column:
    """Hashes of the five-word shingles of a column of words, in order; none if it has fewer words."""
    n = F.size(words)
    return F.when(n >= SHINGLE_WORDS, F.transform(F.sequence(F.lit(1), F.greatest(n - (SHINGLE_WORDS - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, SHINGLE_WORDS)))).otherwise(F.array().cast("array<bigint>"))


def minima(window: Column) -> Column:
    """The minimum of each band's hash function over a window, as array<struct<band, low>>."""

    def band(b: Column) -> Column:
        return F.struct(b.alias("band"), F.array_min(F.transform(window, lambda x: F.xxhash64(b, x))).alias("low"))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)


def windows_of(size_class: int) -> Column:
    """Windows of twice the class at each multiple of it, as array<struct<size_class, first_word, window>>."""
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(size_class))
    return F.transform(starts, lambda s: F.struct(F.lit(size_class).alias("size_class"), s.alias("first_word"), F.slice("all", s + 1, 2 * size_class).alias("window")))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, size_class, grams): as many rows as there are templates in the code."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)], "template int, license string, text string")
    rows = rows.withColumn("words", license_words(F.col("text"))).withColumn("all", shingles("words")).withColumn("grams", F.array_distinct("all"))
    size_class = F.pow(F.lit(2), F.ceil(F.log2(F.size("grams")))).cast("int")
    return rows.where(F.size("grams") > 0).select("template", "license", size_class.alias("size_class"), "grams")


def license_matches(docs: DataFrame, keep: list[str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(keep columns, license, template, first_word, containment): verified windows, one row each.

    `docs` has text. Null, empty and short texts match nothing. Texts are scanned whole; repeated
    rows give repeated matches; an empty table gives no rows.
    """
    spark, keep = docs.sparkSession, keep or ["doc_id"]
    table = template_table(spark, templates or TEMPLATES)
    # Bounded by the number of templates in the code, whatever the input.
    bands = table.select("template", "size_class", F.explode(minima(F.col("grams"))).alias("m"), "grams").select("template", "size_class", "m.band", "m.low", "grams")
    lows, classes = set(), set()
    for row in bands.select("band", "low", "size_class").collect():
        lows.add((row.band, row.low))
        classes.add(row.size_class)
    single = table.select(F.explode("grams").alias("g")).distinct().withColumn("m", F.explode(minima(F.array("g"))))
    anchors = sorted({r.g for r in single.select("g", "m.band", "m.low").collect() if (r.band, r.low) in lows})
    names = [f"__keep_{k}" for k in range(len(keep))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), license_words(F.col("text").cast("string")).alias("words"))
    # A filter on these arrays would be pushed below them and have them computed again for each element; a null window has no such effect.
    rows = rows.select(*names, shingles("words").alias("all"))
    some = F.exists("all", lambda h: h.isin(anchors))
    windows = F.filter(F.flatten(F.array(*map(windows_of, sorted(classes)))), lambda w: F.exists(w["window"], lambda h: h.isin(anchors)))
    found = rows.select(*names, F.explode_outer(F.when(some, windows)).alias("w")).where("w is not null").select(*names, "w.*")
    hits = found.select(*names, "size_class", "first_word", "window", F.explode_outer(minima(F.col("window"))).alias("m")).select(*names, "size_class", "first_word", "window", "m.band", "m.low")
    found = hits.join(F.broadcast(bands), ["size_class", "band", "low"]).dropDuplicates([*names, "size_class", "first_word", "template", "window"])
    containment = F.size(F.array_intersect("grams", "window")) / F.size("grams")
    found = found.withColumn("containment", containment).where(F.col("containment") >= MIN_CONTAINMENT)
    labels = F.create_map(*(F.lit(x) for k, (name, _) in enumerate(templates or TEMPLATES) for x in (k, name)))
    return found.select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)), labels[F.col("template")].alias("license"), "template", "first_word", "containment")


def license_summary(docs: DataFrame) -> DataFrame:
    """(doc_id, n_licenses, licenses): a row for each row of `docs`; names in order, joined by commas.

    Rows with null ids or repeated ids stay: rows that share a doc_id share their matches.
    """
    names = license_matches(docs).groupBy("doc_id").agg(F.array_sort(F.collect_set("license")).alias("names"))
    names = names.select(F.col("doc_id").alias("__doc"), "names")
    out = docs.select("doc_id").join(names, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    return out.select("doc_id", F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"), F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ROWS = ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(TEMPLATES))
#: Brute force: every window of every class against every template, by the shingles themselves.
SQL = f"""
WITH named AS (
  SELECT k, license, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM (VALUES {_ROWS}) v(k, license, t)
), templates AS (
  SELECT k, license, list_distinct(list_transform(range(1, len(w) - {SHINGLE_WORDS - 2}), lambda i: array_to_string(w[i:i+{SHINGLE_WORDS - 1}], ' '))) AS grams FROM named
), classed AS (
  SELECT *, (2 ** ceil(log2(len(grams))))::BIGINT AS c FROM templates
), docs AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents
), shingled AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - {SHINGLE_WORDS - 2}), lambda i: array_to_string(w[i:i+{SHINGLE_WORDS - 1}], ' '))) AS g,
    unnest(range(0, len(w) - {SHINGLE_WORDS - 1})) AS p FROM docs
), hits AS (
  SELECT doc_id, p, g, k, license, c, len(grams) AS s FROM shingled JOIN (SELECT *, unnest(grams) AS g FROM classed) USING (g)
), windows AS (
  SELECT doc_id, k, license, s, unnest([p // c, p // c - 1]) AS win, g FROM hits
), found AS (
  SELECT doc_id, license FROM windows WHERE win >= 0 GROUP BY doc_id, k, license, s, win HAVING count(DISTINCT g) / s >= {MIN_CONTAINMENT}
), names AS (
  SELECT doc_id, list_sort(list_distinct(list(license))) AS names FROM found GROUP BY 1
)
SELECT doc_id, coalesce(len(names), 0)::BIGINT AS n_licenses, coalesce(array_to_string(names, ','), '') AS licenses FROM documents LEFT JOIN names USING (doc_id)
"""
