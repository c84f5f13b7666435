"""License notices in documents: MinHash over overlapping windows retrieves templates, exact shingle containment verifies.

Words are runs of letters and digits in lower case, shingles five words (all words of a template that has fewer). For a
template of m shingles a text's windows are 2m shingles wide, m apart, so one of them holds any notice whole: their similarity is
at least 0.36 where four fifths of the shingles are there, 0.5 for a whole notice. BANDS bands of one minimum miss that with
chances of 0.64 ** BANDS = 8e-4 and 0.5 ** BANDS = 2e-5. Windows without any shingle of a template can share no minimum and are
passed over. Each retrieved window is verified by counting the template's shingles in it.

Only DataFrame expressions run here, and no row leaves its task: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 16
CONTAINED = 0.8
#: Wording of public license notices, the texts to be found.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
}




def license_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(words: str, size: int) -> Column:
    """Hashes of all runs of `size` words of an array column, in order; none where there are fewer."""
    steps = F.sequence(F.lit(0), F.size(words) - size)
    runs = F.transform(steps, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
    return F.when(F.size(words) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def _minima(shingles: Column) -> list[Column]:
    return [F.array_min(F.transform(shingles, _seeded(i))) for i in range(BANDS)]


def _seeded(i: int) -> Callable[[Column], Column]:
    return lambda h: F.xxhash64(h, F.lit(i))


def _found_at(known: list[int]) -> Callable[[Column, Column], Column]:
    return lambda h, i: F.when(h.isin(known), i)


def _prepared(docs: DataFrame, templates: Mapping[str, str]) -> list[tuple[str, int, list[int], list[int]]]:
    """(name, shingle size, distinct shingles, minima) of each template, by the expressions that documents go through."""
    out = []
    given = docs.sparkSession.createDataFrame(list(templates.items()), "name string, text string").select("name", license_words(F.col("text")).alias("w"))
    sizes = [r["n"] for r in given.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("n")).distinct().where("n > 0").collect()]
    for size in sorted(sizes):
        own = given.where(F.least(F.size("w"), F.lit(SHINGLE)) == size).select("name", F.array_distinct(_shingles("w", size)).alias("s"))
        out += [(r["name"], size, r["s"], list(r["m"])) for r in own.select("name", "s", F.array(*_minima(F.col("s"))).alias("m")).collect()]
    return sorted(out)


def _shares(size: int, shingles: list[int], minima: list[int]) -> Column:
    """Of the windows that share a minimum with a template: how much of the template they hold, where that is enough."""
    m, all_ = len(shingles), F.col(f"s{size}")

    def starts(p: Column) -> Column:
        return F.array(F.floor(p / m), F.greatest(F.floor(p / m) - 1, F.lit(0)))

    def retrieved(w: Column) -> Column:
        hit = F.lit(False)
        for own, low in zip(_minima(w), minima):
            hit = hit | (own == low)
        return hit

    windows = F.transform(F.array_distinct(F.flatten(F.transform(f"p{size}", starts))), lambda k: F.slice(all_, (k * m + 1).cast("int"), 2 * m))
    shares = F.transform(F.filter(windows, retrieved), lambda w: F.size(F.array_intersect(w, F.lit(shingles))) / m)
    return F.filter(shares, lambda c: c >= CONTAINED)


def license_notices(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment, windows: one row per row of docs and template found in it.

    containment is the largest share of a template's shingles in a window, at least CONTAINED; windows, how many windows hold as
    much. A null or empty text has no notice; each of repeated rows has its own rows; an empty table gives none. Columns besides
    doc_id and text are not read.
    """
    ready = _prepared(docs, templates)
    words = docs.select("doc_id", license_words(F.col("text")).alias("words"))
    sizes = sorted({size for _, size, _, _ in ready})
    rows = words.select("doc_id", *(_shingles("words", size).alias(f"s{size}") for size in sizes))
    for size in sizes:
        known = sorted({h for _, n, s, _ in ready if n == size for h in s})
        at = F.transform(f"s{size}", _found_at(known))
        rows = rows.withColumn(f"p{size}", F.filter(at, lambda i: i.isNotNull()))
    # no filter here: pushed below the arrays, it would make Spark split a text anew for each of its words
    held = [F.struct(F.lit(name).alias("license"), _shares(size, shingles, minima).alias("shares")) for name, size, shingles, minima in ready]
    found = rows.select("doc_id", F.explode(F.array(*held)).alias("f")) if held else rows.selectExpr("doc_id", "named_struct('license', '', 'shares', CAST(array() AS ARRAY<DOUBLE>)) f")
    return found.where(F.size("f.shares") > 0).select("doc_id", "f.license", F.array_max("f.shares").alias("containment"), F.size("f.shares").cast("long").alias("windows"))


def oracle(templates: Mapping[str, str] = TEMPLATES) -> str:
    """DuckDB SQL: the same windows, each counted."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    cut = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    return f"""
WITH t0(license, text) AS (VALUES {values}),
t AS (SELECT license, {cut.format("text")} AS w, least(5, len(w)) AS n FROM t0),
ts AS (SELECT DISTINCT license, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: list_slice(w, i, i + n - 1))) AS s FROM t),
tm AS (SELECT license, count(*) AS m FROM ts GROUP BY license),
d AS (SELECT row_number() OVER () AS r, doc_id, {cut.format("text")} AS w FROM documents),
p AS (SELECT r, doc_id, n, unnest(range(0, len(w) - n + 1)) AS i, w FROM d, (SELECT DISTINCT n FROM ts)),
h AS (SELECT r, doc_id, license, i, s FROM p JOIN ts ON ts.n = p.n AND ts.s = list_slice(w, i + 1, i + p.n)),
k AS (SELECT r, doc_id, license, m, s, i // m AS k FROM h JOIN tm USING (license)
      UNION SELECT r, doc_id, license, m, s, i // m - 1 FROM h JOIN tm USING (license) WHERE i >= m),
c AS (SELECT r, doc_id, license, k, count(DISTINCT s) / m AS share FROM k GROUP BY r, doc_id, license, k, m)
SELECT doc_id, license, max(share) AS containment, count(*) AS windows FROM c WHERE share >= 0.8 GROUP BY r, doc_id, license"""
