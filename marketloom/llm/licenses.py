"""Licence scan: passages compared with licence templates by Dice over word bigrams.

Passages are lines, blocks between empty lines, and whole texts. Both sides are
lower-cased and reduced to letters and digits. Dice of two sets can reach a
threshold t only if their sizes differ by no more than a factor (2 - t) / t, so
a passage is compared with few templates, and most passages with none. All of it
is Spark SQL.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wording of public licence notices and short licences.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "BSD": "Use of this source code is governed by a BSD-style license.",
    "BSD-2-Clause-terms": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-terms": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _normal(text: Column) -> Column:
    """Letters, digits and line ends; everything else is one space."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9\n]+", " ")


def _bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words, as hashes."""
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, F.array_distinct(pairs)).otherwise(F.array().cast("array<bigint>"))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \n]+"), lambda w: w != "")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Licences found in every row of `docs` (doc_id, text).

    Returns one row per document and licence: doc_id, license, n_passages (distinct
    passages of the text whose best template it is; equal scores go to the first
    name) and dice (the highest). Documents without a match have no row.

    Defined cases: NULL and empty texts, and passages of fewer than two words,
    match nothing; rows that share an id are scanned together; an empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame([(name, text) for name, text in sorted(templates.items())], "license string, text string")
    table = table.select("license", _words(_normal(F.col("text"))).alias("words"))
    table = table.select("license", "words", _bigrams(F.col("words")).alias("bigrams"))
    known = [tuple(r) for r in table.collect() if r["bigrams"]]  # the given templates, not data
    literals = F.array(
        *[
            F.struct(F.lit(name).alias("license"), F.lit(len(grams)).alias("size"), F.lit(grams).alias("bigrams"))
            for name, _, grams in known
        ]
    )
    factor = (2 - threshold) / threshold
    needed = sorted({word for _, words, _ in known for word in needed_words(words, 1 / factor)})
    if not needed:
        return spark.createDataFrame([], "doc_id bigint, license string, n_passages bigint, dice double")
    # One step per select, as an expression that is used twice would be worked out twice.
    body = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _normal(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body")
    )
    passages = F.array_distinct(
        F.concat(F.split("body", "\n"), F.split("body", "\n( ?\n)+"), F.array("body"))
    )
    rows = body.select("doc_id", F.explode(passages).alias("passage"))
    rows = rows.where(reduce(or_, [F.contains("passage", F.lit(word)) for word in needed]))
    grams = rows.select("doc_id", _words(F.col("passage")).alias("words"))
    grams = grams.select("doc_id", _bigrams(F.col("words")).alias("grams"))
    size = F.size("grams")

    def dice(t: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(F.col("grams"), t["bigrams"])) / (size + t["size"])

    near = F.filter(literals, lambda t: (size > 0) & (size <= t["size"] * factor) & (t["size"] <= size * factor))
    scores = F.transform(near, lambda t: F.struct((-dice(t)).alias("order"), t["license"].alias("license")))
    best = F.filter(F.array(F.array_min(scores)), lambda x: -x["order"] >= threshold)
    found = grams.select("doc_id", F.explode(best).alias("best"))
    return found.groupBy("doc_id", F.col("best.license").alias("license")).agg(
        F.count(F.lit(1)).alias("n_passages"), F.max(-F.col("best.order")).alias("dice")
    )


def needed_words(words: Sequence[str], share: float) -> list[str]:
    """Words of a template of which every similar enough passage has one.

    Such a passage has at least `share` of the template's bigrams. Words are
    taken, those in most bigrams first, until fewer bigrams are left without any.
    """
    left = set(zip(words, words[1:], strict=False))
    least, taken = share * len(left), []
    while left and len(left) >= least - 1e-9:
        seen = Counter(word for pair in left for word in set(pair))
        # A long word is rare in other texts, so it counts more.
        taken.append(max(seen, key=lambda w: (seen[w] * (len(w) > 5), len(w), seen[w], w)))
        left = {pair for pair in left if taken[-1] not in pair}
    return taken


def oracle(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over the table `documents` in DuckDB's SQL."""
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(templates.items()))
    factor = (2 - threshold) / threshold
    normal = "regexp_replace(lower({}), '[^a-z0-9\\n]+', ' ', 'g')"
    words = "list_filter(regexp_split_to_array({}, '[ \\n]+'), lambda x: x <> '')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH templates AS (
  SELECT license, {grams} AS grams FROM (
    SELECT license, {words.format(normal.format("body"))} AS w FROM (VALUES {values}) AS t(license, body))),
texts AS (SELECT doc_id, {normal.format("coalesce(text, '')")} AS body FROM documents),
passages AS (
  SELECT doc_id, unnest(list_distinct(list_concat(list_concat(
    regexp_split_to_array(body, '\\n'), regexp_split_to_array(body, '\\n( ?\\n)+')), [body]))) AS passage FROM texts),
sets AS (
  SELECT row_number() OVER () AS passage_id, doc_id, {grams} AS grams FROM (
    SELECT doc_id, {words.format("passage")} AS w FROM passages)),
scores AS (
  SELECT passage_id, doc_id, license,
    CAST(2.0 AS DOUBLE) * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams)) AS dice
  FROM sets s JOIN templates t ON len(s.grams) > 0 AND len(t.grams) > 0
    AND len(s.grams) <= len(t.grams) * CAST({factor!r} AS DOUBLE) AND len(t.grams) <= len(s.grams) * CAST({factor!r} AS DOUBLE)),
best AS (
  SELECT doc_id, license, dice FROM scores WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY passage_id ORDER BY dice DESC, license) = 1)
SELECT doc_id, license, count(*) AS n_passages, max(dice) AS dice FROM best GROUP BY doc_id, license
"""
