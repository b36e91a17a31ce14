"""License notices: Dice coefficient over word bigrams against licence templates, DataFrame functions only.

A text is cut into segments at line ends and after ``.``, ``!`` or ``?`` followed by a blank. Segment and
template are normalised alike: lower case, every run of other characters than a-z and 0-9 one
blank. A segment carries the licence whose template has the highest Dice coefficient over sets of
word bigrams, if it is at least ``DICE`` = 0.8 (ties: the template listed first).

Wrapped notices. A sentence that runs over line ends, up to ``.``, ``!`` or ``?`` at a line's or
word's end or to a line without a-z and 0-9, is a segment as a whole, too; it counts in place of its
lines if its coefficient is higher than that of each. ``sql()`` knows segments within one line only: it gives the same for texts
without wrapped notices.

Pruning without loss. Size bounds: with a bigrams in the segment only templates of a * t / (2 - t) to
a * (2 - t) / t bigrams can reach t. Before that, a segment that reaches t holds at least two thirds
of a template's bigrams, hence one of any set of a third and one more of them; a text without any of
those bigrams is not cut into segments at all.

Null and empty texts, and segments of one word, carry no notice; repeated rows give equal results; an
empty table gives no rows; other columns are ignored. No row is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import ready

DICE = 0.8
#: Notices by which licences are declared.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is distributed under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("proprietary", "All rights reserved."),
)


def grams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:], strict=False)))


def telling() -> list[str]:
    """For each template the third and one more of its bigrams that fewest templates share."""
    every = [grams(t) for _, t in TEMPLATES]
    shared = {g: sum(g in x for x in every) for x in every for g in x}
    return sorted({g for x in every for g in sorted(x, key=lambda g: (shared[g], -len(g), g))[:len(x) // 3 + 1]})


def bounds(n: int) -> tuple[int, int]:
    """Fewest and most bigrams of a segment that can reach DICE with a template of n."""
    return -(-n * int(DICE * 1000) // int((2 - DICE) * 1000)), n * int((2 - DICE) * 1000) // int(DICE * 1000)


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")


def notices(docs: DataFrame) -> DataFrame:
    """doc_id, notices (array of license, dice, segment) for every row of docs (doc_id, text)."""
    ready(docs.sparkSession)
    sizes = [len(grams(t)) for _, t in TEMPLATES]
    least, most = min(bounds(n)[0] for n in sizes), max(bounds(n)[1] for n in sizes)
    some = F.concat(F.lit(" "), _normal(F.col("text")), F.lit(" ")).rlike(" (?:" + "|".join(telling()) + ") ")
    none = F.array().cast("array<string>")
    sentences = F.split("text", r"(?<=[.!?])[ \t]+|(?<=[.!?])\r?\n|\n[^A-Za-z0-9\n]*+(?=\n)")
    rows = docs.select("doc_id", F.when(some, sentences).otherwise(none).alias("segments"))
    part = lambda s, i, whole: F.struct(s.alias("segment"), i.alias("sentence"), F.lit(whole).alias("whole"))
    rows = rows.withColumn("segments", F.flatten(F.transform("segments", lambda s, i: F.concat(
        F.transform(F.split(s, "\n"), lambda line: part(line, i, False)),
        F.when(F.trim(s, F.lit("\n")).contains("\n"), F.array(part(s, i, True))).otherwise(F.filter(
            F.array(part(s, i, True)), lambda _: F.lit(False)))))))
    rows = rows.withColumn("segments", F.transform("segments", lambda x: F.struct(
        x["segment"].alias("segment"), x["sentence"].alias("sentence"), x["whole"].alias("whole"),
        F.split(F.trim(_normal(x["segment"])), " ").alias("words"))))
    rows = rows.withColumn("segments", F.filter("segments", lambda x: F.size(x["words"]) > least))
    rows = rows.withColumn("segments", F.transform("segments", lambda x: F.struct(
        x["segment"].alias("segment"), x["sentence"].alias("sentence"), x["whole"].alias("whole"),
        F.array_distinct(F.zip_with(F.slice(x["words"], F.lit(1), F.size(x["words"]) - 1),
                                    F.slice(x["words"], F.lit(2), F.size(x["words"]) - 1),
                                    lambda a, b: F.concat_ws(" ", a, b))).alias("grams"))))
    rows = rows.withColumn("segments", F.filter("segments", lambda x: F.size(x["grams"]).between(least, most)))

    def against(k: int, x: Column) -> Column:
        own, (low, high) = grams(TEMPLATES[k][1]), bounds(sizes[k])
        dice = 2.0 * F.size(F.array_intersect(x["grams"], F.array(*map(F.lit, own)))) / (F.size(x["grams"]) + len(own))
        return F.struct(F.when(F.size(x["grams"]).between(low, high), dice).otherwise(0.0).alias("dice"), F.lit(-k).alias("k"))

    rows = rows.withColumn("segments", F.transform("segments", lambda x: F.struct(
        x["segment"].alias("segment"), x["sentence"].alias("sentence"), x["whole"].alias("whole"), F.greatest(*[against(k, x) for k in range(len(TEMPLATES))]).alias("best"))))
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    rows = rows.withColumn("segments", F.filter("segments", lambda x: x["best"]["dice"] >= DICE))
    lines = F.filter("segments", lambda x: ~x["whole"])
    better = F.filter("segments", lambda x: x["whole"] & ~F.exists("lines", lambda y: (
        y["sentence"] == x["sentence"]) & (y["best"]["dice"] >= x["best"]["dice"])))
    rows = rows.withColumn("lines", lines).withColumn("better", F.transform(better, lambda x: x["sentence"]))
    rows = rows.withColumn("segments", F.filter(
        "segments", lambda x: x["whole"] == F.array_contains(F.col("better"), x["sentence"])))
    found = F.transform("segments", lambda x: F.struct(
        F.get(names, -x["best"]["k"]).alias("license"), x["best"]["dice"].alias("dice"), x["segment"].alias("segment")))
    return rows.select("doc_id", found.alias("notices"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_notices, licenses (distinct, sorted, joined by commas), best_dice (0: none) of every row."""
    return notices(docs).select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda x: x["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("notices", lambda x: x["dice"])), F.lit(0.0)).alias("best_dice"))


def sql() -> str:
    """The same in DuckDB SQL: every segment against every template, without pruning."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quoted(name)}, {quoted(text)})" for k, (name, text) in enumerate(TEMPLATES))

    def gram_list(words: str) -> str:
        return (f"list_distinct([CAST({words}[i] || ' ' || {words}[i + 1] AS VARCHAR) FOR i IN range(1, len({words}))])")
    return rf"""
WITH t AS (
  SELECT k, license, {gram_list("w")} AS g
  FROM (SELECT k, license, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
        FROM (VALUES {values}) v(k, license, text))),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
s AS (
  SELECT r, row_number() OVER () AS i, string_split(trim(regexp_replace(lower(segment), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM (SELECT r, unnest(string_split(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) AS segment FROM d)),
g AS (SELECT r, i, {gram_list("w")} AS g FROM s WHERE len(w) > 1),
m AS (
  SELECT g.r, g.i, t.k, t.license, 2.0::DOUBLE * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice
  FROM g JOIN t ON list_has_any(g.g, t.g)),
b AS (SELECT r, i, license, dice FROM m WHERE dice >= {DICE} QUALIFY row_number() OVER (PARTITION BY i ORDER BY dice DESC, k) = 1)
SELECT d.doc_id, count(b.i) AS n_notices, coalesce(array_to_string(list_sort(list_distinct(list(b.license))), ','), '') AS licenses,
       coalesce(max(b.dice), 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN b ON d.r = b.r GROUP BY d.r, d.doc_id
"""
