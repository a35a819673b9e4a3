"""License scans by diagonal voting: word k-grams joined to templates, votes by offset diagonal, verified spans."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: A license word, in lower case: a run of digits, a-z and whatever isn't ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (phrase, label): the places where a phrase's words stand consecutively are the base of a scan.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, text) of notices as their licenses prescribe or recommend them: fixed values.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)
#: Words of a gram, and the Dice similarity that a span needs.
WIDTH, SIMILARITY = 5, 0.8
#: Neighbouring diagonals of a template are one if no further apart than this share of its words.
DRIFT = 0.1


def license_words(text: str) -> list[str]:
    """The words of a template, as the scan reads documents."""
    return re.findall(LICENSE_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _postings(phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, bool, int, int, int, str]]:
    """(template, label, base, words, width, tpos, gram) of every gram; a phrase is one gram. Template -1 is every document's mark."""
    rows = [(-1, "", False, 0, 0, 0, "")]
    for number, (label, text, base) in enumerate([(label, text, True) for text, label in phrases] + [(label, text, False) for label, text in templates]):
        words = license_words(text)
        width = len(words) if base else WIDTH
        if len(words) < width or not words or base and width > WIDTH:
            raise ValueError(f"a phrase needs 1 to {WIDTH} words and a template {WIDTH} or more: {text!r}")
        rows += [(number, label, base, len(words), width, at, " ".join(words[at : at + width])) for at in range(len(words) - width + 1)]
    return rows


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    1. Every place of every text gives the hashes of the grams that begin there, five words wide (and as wide as each
       phrase). They are joined to the grams of the templates, which are a fixed list and are broadcast; a match
       counts only if the words are equal too. It votes for the diagonal (place in the text - place in the template).
    2. Votes are summed by (row, template, diagonal) before they move. Diagonals of a template that lie no more than
       DRIFT of its words apart are neighbours and make one band, so that inserted or dropped words do no harm.
    3. A band is verified by its words: those of the template and those of the span that its equal grams cover, the
       smaller of the two doubled, over the words of template and span. From `similarity` on it is a license notice.
       A phrase is a single gram, so that every match is a verified place.

    n_base, first_word and last_word (counted from 0) are of the places of phrases; base_labels are theirs, labels
    those and the ones of the templates: distinct, sorted, joined by commas. score is the best span's similarity, 1
    with a phrase, 0 with nothing found. spans are the notices as (label, start, words, similarity) in order.

    Null text is empty, and an empty text has no words. Null and repeated ids are no matter: a row is known by its id
    and its text's hashes, and rows that are alike give a row each. A place may count for several templates. Only one
    row of text is ever held at a time; no rows give no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    listed = _postings(phrases, templates)
    widths = sorted({r[4] for r in listed if r[4]})
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    words = docs.select(F.col(id_col), F.xxhash64(text_col).alias("mark_a"), F.xxhash64(F.lit(1), F.col(text_col)).alias("mark_b"), F.regexp_extract_all(text, F.lit(LICENSE_WORD), F.lit(0)).alias("words"))
    at = lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(max(widths))])
    # the first gram of every row is empty: the row's mark, which matches template -1 alone
    grams = F.concat(F.array(F.lit("")), F.when(F.size("words") > 0, F.transform(F.sequence(F.lit(0), F.size("words") - 1), at)).otherwise(F.array().cast("array<string>")))
    places = words.select(id_col, "mark_a", "mark_b", F.size("words").cast("long").alias("n_words"), F.posexplode(grams).alias("place", "gram"))
    hashes = F.array(*[F.xxhash64(F.substring_index("gram", " ", w)) for w in widths])
    hashed = places.select("*", F.posexplode(F.when(F.col("gram") == "", F.array(F.xxhash64("gram"))).otherwise(hashes)).alias("slot", "hash"))
    postings = spark.createDataFrame(listed, "template int, label string, base boolean, size int, width int, tpos int, own string")
    slot = F.greatest(F.array_position(F.array(*map(F.lit, widths)), F.col("width")).cast("int") - 1, F.lit(0))
    postings = postings.withColumns({"own_hash": F.xxhash64("own"), "own_slot": slot})
    same = (F.col("hash") == F.col("own_hash")) & (F.col("slot") == F.col("own_slot")) & F.expr("substring_index(gram, ' ', greatest(width, 1)) = own")
    votes = hashed.join(F.broadcast(postings), same).withColumn("pos", F.col("place").cast("long") - 1)
    row = [id_col, "mark_a", "mark_b", "n_words"]
    diagonal = F.when(F.col("template") >= 0, F.when(~F.col("base"), F.col("pos") - F.col("tpos")))  # phrases: all places at once
    votes = votes.withColumn("diagonal", diagonal).groupBy(*row, "template", "label", "base", "size", "diagonal", "tpos").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    votes = votes.repartition(id_col, "mark_a", "mark_b")
    by_diagonal = Window.partitionBy(*row, "template").orderBy("diagonal", "tpos")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > F.floor(F.col("size") * F.lit(DRIFT))
    votes = votes.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("band", F.sum("apart").over(by_diagonal))
    band = Window.partitionBy(*row, "template", "band")
    covered = lambda c: F.least(F.lit(WIDTH), F.coalesce(F.lead(c).over(band.orderBy(c)) - F.col(c), F.lit(WIDTH)))
    votes = votes.withColumn("own_words", covered("tpos")).withColumn("doc_words", covered("low"))
    bands = votes.groupBy(*row, "template", "label", "base", "size", "band").agg(
        F.sum("n").alias("n"), F.min("low").alias("start"), F.max("high").alias("last"), F.sum("own_words").alias("own_words"), F.sum("doc_words").alias("doc_words")
    )
    found = F.when(F.col("base"), F.lit(1.0)).when(F.col("template") >= 0, 2.0 * F.least("own_words", "doc_words") / (F.col("size") + F.col("last") - F.col("start") + WIDTH))
    bands = bands.withColumn("similarity", found)
    verified, base, notice = F.col("similarity") >= similarity, F.col("base"), ~F.col("base") & (F.col("similarity") >= similarity)
    joined = lambda c: F.array_join(F.sort_array(c), ",")
    rows = bands.groupBy(*row).agg(
        F.max(F.when(F.col("template") < 0, F.col("n"))).alias("copies"),
        F.coalesce(F.sum(F.when(base, F.col("n"))), F.lit(0)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("last"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(verified, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(verified, F.col("similarity"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(notice, F.struct("start", (F.col("last") - F.col("start") + WIDTH).alias("words"), "label", "similarity")))).alias("spans"),
    )
    n_base = (F.col("n_base") / F.col("copies")).cast("long")  # rows that are alike voted together
    return rows.withColumn("n_base", n_base).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select(id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def _values() -> str:
    quote = lambda value: "'" + value.replace("'", "''") + "'"
    return ", ".join(f"({t}, {quote(label)}, {base}, {size}, {width}, {tpos}, {quote(gram)})" for t, label, base, size, width, tpos, gram in _postings(PHRASES, TEMPLATES) if t >= 0)


def _gram(width: Column | int) -> str:
    return f"array_to_string(w[i:i + {width} - 1], ' ')"


#: Grams are compared as texts, without hashes; bands and their cover are counted as sets of words.
SQL = f"""
WITH postings(template, label, base, size, width, tpos, gram) AS (VALUES {_values()}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{LICENSE_WORD}') AS w FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
grams AS (SELECT r, i - 1 AS pos, 2 AS width, {_gram(2)} AS gram FROM places UNION ALL SELECT r, i - 1, 3, {_gram(3)} FROM places UNION ALL SELECT r, i - 1, {WIDTH}, {_gram(WIDTH)} FROM places),
votes AS (SELECT r, pos, template, label, base, size, postings.width, tpos, pos - tpos AS diagonal FROM grams JOIN postings ON grams.width = postings.width AND grams.gram = postings.gram),
apart AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, tpos) > floor(size * {DRIFT}) THEN 1 ELSE 0 END AS new FROM votes WHERE NOT base),
banded AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal, tpos) AS band FROM apart),
words AS (SELECT r, template, label, size, band, pos, unnest(range(0, {WIDTH})) AS k, tpos FROM banded),
bands AS (SELECT r, label, 2.0 * least(count(DISTINCT tpos + k), count(DISTINCT pos + k)) / (any_value(size) + max(pos + k) + 1 - min(pos)) AS similarity FROM words GROUP BY r, template, label, band),
found AS (SELECT r, label, similarity FROM bands WHERE similarity >= {SIMILARITY} UNION ALL SELECT r, label, 1.0 FROM votes WHERE base),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM votes WHERE base GROUP BY r),
all_labels AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(similarity) AS score FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN all_labels USING (r)
"""
