"""Licence scan: Dice coefficient over word bigrams against templates.

Units are the lines of a text, its paragraphs of several lines, and the whole
text if it has several paragraphs. A unit is normalised (lower-cased, runs of
anything but ASCII letters and digits to one space) and compared as a bag of
word bigrams. A Dice coefficient of t or more is possible only when the sizes
differ by a factor of (2 - t) / t at most; units within no template's bounds
go before their bigrams are made, and a bigram meets only the templates whose
bounds fit. Built-in functions only; bigrams are joined with the templates'
bigrams, so only shared ones are counted and shuffled.

Defined results: null and empty texts and units of fewer than two words match
nothing; a unit that reaches the threshold with several templates has a row
for each; repeated rows each have their own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Threshold as a fraction, so that bounds and comparison are exact integers.
NUM, DEN = 8, 10

# FIXED VALUES: usual notices of public licences.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-header": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Reserved": "All rights reserved. No part of this work may be reproduced without permission.",
}


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    return F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``license, text``."""
    pairs = [F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in sorted(templates.items())]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def scan(docs: DataFrame, templates: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``doc_id, unit, place, license, n_bigrams, shared, dice`` of every
    unit and template with a Dice coefficient of ``num / den`` or more."""
    t = templates.select("license", F.split(normalised(F.col("text")), " ").alias("w")).where(F.size("w") > 1)
    t = t.select("license", (F.size("w") - 1).alias("t_n"), F.explode(bigrams(F.col("w"))).alias("bigram"))
    t = t.groupBy("license", "t_n", "bigram").agg(F.count(F.lit(1)).alias("t_c"))
    fits = lambda a, b: F.lit(2 * den) * F.least(a, b) >= F.lit(num) * (a + b)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), "text")
    unit = lambda name, parts, keep: F.transform(parts, lambda x, i: F.struct(
        F.lit(name).alias("unit"), i.alias("place"), F.when(keep(x), x).alias("x")))
    paragraphs = F.split("text", "\n\n+")
    many = F.size(paragraphs) > 1
    units = F.concat(unit("line", F.split("text", "\n"), lambda x: F.lit(True)),
                     unit("paragraph", paragraphs, lambda x: F.contains(x, F.lit("\n"))),
                     unit("text", F.array("text"), lambda x: many))
    rows = rows.select("doc_id", "rid", F.explode(units).alias("u")).where("u.x is not null").select(
        "doc_id", "rid", "u.unit", "u.place", normalised(F.col("u.x")).alias("norm"))
    # words less one, before any bigram is made
    rows = rows.withColumn("n", F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit("")))).where("n > 0")
    bounds = templates.select(F.split(normalised(F.col("text")), " ").alias("w")).where(F.size("w") > 1).select(
        (F.size("w") - 1).alias("t_n")).distinct()
    # a size has one row in the table of sizes that fit a template
    sizes = bounds.select(F.explode(F.sequence(F.ceil(F.lit(num) * F.col("t_n") / (2 * den - num)).cast("int"),
                                               F.floor(F.lit(2 * den - num) * F.col("t_n") / num).cast("int"))).alias("n")).distinct()
    rows = rows.join(sizes, "n", "left_semi")
    seen = rows.select("doc_id", "rid", "unit", "place", "n", F.explode(bigrams(F.split("norm", " "))).alias("bigram"))
    met = seen.join(t, (seen["bigram"] == t["bigram"]) & fits(F.col("n"), F.col("t_n"))).drop(seen["bigram"])
    key = ["doc_id", "rid", "unit", "place", "n", "license", "t_n"]
    shared = met.groupBy(*key, "bigram", "t_c").agg(F.count(F.lit(1)).alias("c")).groupBy(*key).agg(
        F.sum(F.least("c", "t_c")).alias("shared"))
    return shared.where(F.lit(2 * den) * F.col("shared") >= F.lit(num) * (F.col("n") + F.col("t_n"))).select(
        "doc_id", "unit", F.col("place").cast("long").alias("place"), "license", F.col("n").cast("long").alias("n_bigrams"),
        "shared", (F.lit(2.0) * F.col("shared") / (F.col("n") + F.col("t_n"))).alias("dice"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SQL = r"""
WITH tt(license, text) AS (VALUES __TEMPLATES__),
tw AS (SELECT license, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM tt),
tb AS (SELECT license, len(w) - 1 AS t_n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM tw),
tc AS (SELECT license, t_n, bigram, count(*) AS t_c FROM tb GROUP BY ALL),
d AS (SELECT doc_id, row_number() OVER () AS rid, text FROM documents WHERE text IS NOT NULL),
u AS (
  SELECT doc_id, rid, 'line' AS unit, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS x FROM d
  UNION ALL
  SELECT * FROM (SELECT doc_id, rid, 'paragraph', unnest(range(len(string_split_regex(text, '\n\n+')))) AS place,
                        unnest(string_split_regex(text, '\n\n+')) AS x FROM d) WHERE contains(x, chr(10))
  UNION ALL
  SELECT doc_id, rid, 'text', 0, text FROM d WHERE len(string_split_regex(text, '\n\n+')) > 1),
nw AS (SELECT doc_id, rid, unit, place, string_split(trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u),
b AS (SELECT doc_id, rid, unit, place, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
      FROM nw WHERE len(w) > 1),
c AS (SELECT doc_id, rid, unit, place, n, bigram, count(*) AS c FROM b GROUP BY ALL),
s AS (SELECT doc_id, rid, unit, place, n, license, t_n, sum(least(c, t_c)) AS shared
      FROM c JOIN tc USING (bigram) GROUP BY ALL)
SELECT doc_id, unit, place::BIGINT AS place, license, n::BIGINT AS n_bigrams, shared::BIGINT AS shared,
       2.0::DOUBLE * shared::DOUBLE / (n + t_n)::DOUBLE AS dice
FROM s WHERE __TWO_DEN__ * shared >= __NUM__ * (n + t_n)
""".replace("__TEMPLATES__", ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in TEMPLATES.items())).replace(
    "__TWO_DEN__", str(2 * DEN)).replace("__NUM__", str(NUM))
