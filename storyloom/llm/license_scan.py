"""License scans: MinHash bands over overlapping windows, then exact containment; DataFrame functions only.

Texts and templates are lower-cased words ``[a-z0-9]+`` in shingles of five.
Templates are classed by length; for a class the windows have twice as many
words as its longest template and overlap by half, so any occurrence lies whole
in one of them.  A window's items are its shingles that occur in some template
of the class (the others can't count towards containment).  Every band is one
MinHash value; there are so many that a window which holds a template to the
asked share is retrieved with a miss of at most ``miss``, even if the rest of
the window were full of other templates.  Retrieved pairs are verified on their
exact shingles.

Texts that hold none of a few anchor words are passed over first.  The anchors
are chosen so that no text without them can reach the asked share.

Null and empty texts match nothing.  Repeated rows are one document for the
scan: the result has one row for each doc_id (null is one, too), text and
template.  Very long texts are scanned whole, a row for each shingle that some
template has; other columns aren't looked at.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import read

#: Common notices in their usual wording.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit-disclaimer": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


@dataclass(frozen=True)
class LicenseParams:
    #: Words of a shingle.
    words: int = 5
    #: Percent of a template's shingles that a window holds at least.
    percent: int = 80
    #: Chance that a window which does isn't retrieved, at most.
    miss: float = 1e-4


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def shingles_of(text: str, k: int) -> list[str]:
    words = words_of(text)
    return sorted({" ".join(words[i : i + k]) for i in range(len(words) - k + 1)})


def anchors(templates: dict[str, str], params: LicenseParams) -> list[str]:
    """Few words such that a text without any of them falls short of every template's share."""
    chosen: list[str] = []
    short = {name: shingles_of(text, params.words) for name, text in templates.items()}

    def open_templates(words: list[str]) -> list[str]:
        return [n for n, s in short.items() if 100 * sum(not set(words) & set(x.split()) for x in s) >= params.percent * len(s)]

    while left := open_templates(chosen):
        options = sorted({w for n in left for x in short[n] for w in x.split() if len(w) >= 6} or {w for n in left for x in short[n] for w in x.split()})
        chosen.append(min(options, key=lambda w: (len(open_templates([*chosen, w])), -len(w), w)))
    return chosen


@dataclass(frozen=True)
class LengthClass:
    window: int
    stride: int
    bands: int
    templates: tuple[tuple[str, tuple[str, ...]], ...]


def classes_of(templates: dict[str, str], params: LicenseParams) -> list[LengthClass]:
    """Templates by length, each class up to twice as long as the one before."""
    by: dict[int, list] = {}
    for name, text in templates.items():
        n = len(words_of(text))
        if n < params.words:
            raise ValueError(f"{name} has fewer words than a shingle")
        by.setdefault(1 << max(3, (n - 1).bit_length()), []).append((name, tuple(shingles_of(text, params.words))))
    out = []
    for n, own in sorted(by.items()):
        most = 2 * n - params.words + 1
        least = min(math.ceil(params.percent * len(s) / 100) / max(most, len(s)) for _, s in own)
        out.append(LengthClass(2 * n, n, math.ceil(math.log(params.miss) / math.log(1 - least)), tuple(own)))
    return out


def minima(kind: Column, items: Column, bands: Column) -> Column:
    """One key for each band of a length class: class, band and the least hash of the items under it."""
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda b: F.xxhash64(kind, b, F.array_min(F.transform(items, lambda x: F.xxhash64(b, x)))))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, params: LicenseParams = LicenseParams()) -> DataFrame:
    """doc_id, license, first_word (of its first matching shingle), n_shingles (of the best window), share.

    The texts are read and cut once; the length class is a column from there on.
    """
    spark = docs.sparkSession
    k = params.words
    low = docs.select("doc_id", F.lower("text").alias("low"))
    marked = low.where(reduce(lambda a, b: a | b, (F.contains("low", F.lit(w)) for w in anchors(templates, params))))
    cut = marked.select("doc_id", F.xxhash64("low").alias("text_key"), F.regexp_extract_all("low", F.lit("[a-z0-9]+"), F.lit(0)).alias("w")).where(F.size("w") >= k)
    shingle = lambda i: F.concat_ws(" ", F.slice("w", i, k))
    rows = cut.select("doc_id", "text_key", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), shingle)).alias("at", "shingle"))

    # both are as large as the templates, which are parameters
    each = [(c.window, c.stride, c.bands, n, list(s)) for c in classes_of(templates, params) for n, s in c.templates]
    known = spark.createDataFrame(each, "win int, stride int, bands int, license string, template array<string>")
    shingles = known.select("win", "stride", "bands", F.explode("template").alias("shingle")).distinct()
    keys = known.select("license", "template", F.explode(minima(F.col("win"), F.col("template"), F.col("bands"))).alias("band"))

    held = rows.join(F.broadcast(shingles), "shingle")
    # a shingle lies in every window that starts at most win - k words before it
    windows = F.sequence(F.greatest(F.lit(0), F.ceil((F.col("at") - (F.col("win") - k)) / F.col("stride"))), F.floor(F.col("at") / F.col("stride")))
    spread = held.select("doc_id", "text_key", "win", "bands", F.explode(windows).alias("window"), "at", "shingle")
    items = spread.groupBy("doc_id", "text_key", "win", "bands", "window").agg(F.collect_set("shingle").alias("items"), F.min("at").alias("first_word"))  # a window's words at most
    banded = items.withColumn("band", F.explode(minima(F.col("win"), F.col("items"), F.col("bands"))))
    retrieved = banded.join(F.broadcast(keys), "band").groupBy("doc_id", "text_key", "win", "window", "license").agg(F.first("items").alias("items"), F.first("template").alias("template"), F.min("first_word").alias("first_word"))
    exact = retrieved.withColumn("n_shingles", F.size(F.array_intersect("items", "template"))).where(100 * F.col("n_shingles") >= params.percent * F.size("template"))
    best = exact.groupBy("doc_id", "text_key", "license").agg(F.min("first_word").cast("long").alias("first_word"), F.max("n_shingles").cast("long").alias("n_shingles"), F.max(F.size("template")).alias("whole"))
    return best.select("doc_id", "license", "first_word", "n_shingles", (F.col("n_shingles") / F.col("whole")).alias("share"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in the documents."""
    return scan(read(spark, sf_dir, "documents"))


def oracle(templates: dict[str, str] = TEMPLATES, params: LicenseParams = LicenseParams()) -> str:
    """The same spots in DuckDB's SQL: all windows against all templates of their class, exactly."""
    k = params.words
    values = ", ".join(f"({c.window}, {c.stride}, '{n}', '{s}', {len(items)})" for c in classes_of(templates, params) for n, items in c.templates for s in items)
    return f"""
    WITH template(win, stride, license, shingle, whole) AS (VALUES {values}),
    cut AS (SELECT doc_id, hash(lower(text)) AS text_key, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
    docs AS (SELECT DISTINCT doc_id, text_key, w FROM cut WHERE len(w) >= {k}),
    places AS (SELECT doc_id, text_key, w, unnest(range(len(w) - {k - 1})) AS pos FROM docs),
    spots AS (SELECT doc_id, text_key, pos, array_to_string(w[pos + 1 : pos + {k}], ' ') AS shingle FROM places),
    hits AS (SELECT r.doc_id, r.text_key, r.pos, t.* FROM spots r JOIN template t USING (shingle)),
    spread AS (SELECT *, unnest(range(greatest(0, CAST(ceil((pos - (win - {k})) / stride) AS BIGINT)), pos // stride + 1)) AS wdw FROM hits),
    best AS (SELECT doc_id, text_key, license, wdw, whole, min(win) AS win, count(DISTINCT shingle) AS n_shingles FROM spread GROUP BY ALL),
    firsts AS (SELECT doc_id, text_key, win, wdw, min(pos) AS first_word FROM spread GROUP BY ALL)
    SELECT doc_id, license, min(first_word) AS first_word, max(n_shingles) AS n_shingles, max(n_shingles) / max(whole) AS share
    FROM best JOIN firsts USING (doc_id, text_key, win, wdw)
    WHERE 100 * n_shingles >= {params.percent} * whole GROUP BY doc_id, text_key, license"""
