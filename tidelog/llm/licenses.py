"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Each template has windows of its own length: as many shingles as the template and a stride
more, begun every stride, so an occurrence lies wholly in some window. A window meets a
template if they agree in one of the bands, each of one hash function; where it holds most
of the template, all bands miss less than once in a million times (see ``miss_chance``).
What meets is decided by the share of the template's shingles that the window has.

A template of fewer than SHINGLE words is one shingle of all its words, and is looked for among
the shingles of that length.

All of it is DataFrame functions. A band can only agree where the template's least shingle
stands, so windows without any of these need no signature.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, BANDS = 5, 32
#: A window matches with this share of the template's shingles.
LEAST = 0.8

#: Public wordings of license notices.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "Apache-2.0-disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction"
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted"
    ),
    "Unlicense-dedication": (
        "This is free and unencumbered software released into the public domain."
    ),
}

#: Short notices, and versions that TEMPLATES has not. Each is one or two shingles,
#: so it is matched as a whole only; none is part of a notice in TEMPLATES.
SHORT_NOTICES = {
    "All-rights-reserved": "All rights reserved.",
    "Apache-1.0-short": "Apache License 1.0",
    "Apache-1.0-version": "Apache License, Version 1.0",
    "Apache-1.1-short": "Apache License 1.1",
    "Apache-1.1-version": "Apache License, Version 1.1",
    "Apache-2.0-short": "Apache License 2.0",
    "GPL-2.0-short": "GNU GPL v2",
    "GPL-2.0-version": "GNU General Public License, version 2",
    "GPL-3.0-short": "GNU GPL v3",
    "LGPL-2.1-short": "GNU LGPL v2.1",
    "LGPL-2.1-version": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-short": "GNU LGPL v3",
    "LGPL-3.0-version": "GNU Lesser General Public License, version 3",
    "AGPL-3.0-short": "GNU AGPL v3",
    "AGPL-3.0-version": "GNU Affero General Public License, version 3",
    "CC0-1.0-short": "CC0 1.0",
    **{
        f"CC-{kind}-{version}-short": f"CC {kind} {version}"
        for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
        for version in ("3.0", "4.0")
        if (kind, version) != ("BY-NC", "4.0")
    },
}
NOTICES = TEMPLATES | SHORT_NOTICES


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case (null: none)."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda word: word != "")


def shingles(found: Column, length: int = SHINGLE) -> Column:
    """A hash for each run of ``length`` words."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(found) - length),
        lambda i: F.xxhash64(*[F.get(found, i + step) for step in range(length)]),
    )
    return F.when(F.size(found) >= length, each).otherwise(F.array().cast("array<bigint>"))


def least_of(hashes: Column, band: Column) -> Column:
    """The least value of a window under the hash function of a band."""
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))


def _stride(size: int) -> int:
    """How far apart windows begin for a template of ``size`` shingles."""
    return max(1, size // 3)


def miss_chance(size: int, share: float = LEAST) -> float:
    """How likely every band misses a window that holds ``share`` of a template."""
    common = share * size
    return (1 - common / (size + _stride(size) + size - common)) ** BANDS


def _templates(docs: DataFrame, templates: Mapping[str, str]) -> DataFrame:
    """license, length (of its shingles), hashes, least (one for each band): one row per template."""
    rows = docs.sparkSession.createDataFrame(sorted(templates.items()), "license string, notice string")
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    rows = rows.select("license", F.explode(F.array(words(F.col("notice")))).alias("words"))
    own = shingles(F.col("words"))
    for length in range(1, SHINGLE):
        own = F.when(F.size("words") == length, shingles(F.col("words"), length)).otherwise(own)
    rows = rows.select("license", F.least(F.size("words"), F.lit(SHINGLE)).alias("length"), F.explode(F.array(own)).alias("hashes"))
    found = rows.select("license", "length", F.array_distinct("hashes").alias("hashes"))
    return found.withColumn("least", F.transform(bands, lambda b: least_of(F.col("hashes"), b)))


def license_matches(
    docs: DataFrame,
    templates: Mapping[str, str] = NOTICES,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, license, containment, first_word), one row per document and license found in it.

    ``containment`` is the best window's share of the template's shingles and ``first_word``
    where the first such window begins (words counted from 0). Null and empty texts have no
    matches. A template without words cannot be matched and is an error. Rows that repeat an id
    count as one document; other columns play no part; an empty table gives an empty table.
    ``templates`` is a parameter of some hundreds of short texts at most.
    """
    known = _templates(docs, templates).collect()  # one row per template
    wordless = [row["license"] for row in known if not row["hashes"]]
    if wordless:
        raise ValueError(f"templates without words: {wordless}")
    if not known:
        nothing = docs.select(F.col(id_col)).limit(0)
        return nothing.select(id_col, *[F.lit(None).cast(k).alias(n) for n, k in (("license", "string"), ("containment", "double"), ("first_word", "bigint"))])
    # each step is the one row of an explode, so that no later step repeats it
    rows = docs.select(F.col(id_col).alias("id_"), F.explode(F.array(words(F.col(text)))).alias("words_"))
    lengths = sorted({row["length"] for row in known})
    runs = F.struct(*[shingles(F.col("words_"), length).alias(f"hashes_{length}") for length in lengths])
    rows = rows.select("id_", F.explode(F.array(runs)).alias("runs_")).select("id_", "runs_.*")
    # which shingle has the least value under a band, found again by hashing all of them
    spread = docs.sparkSession.createDataFrame(
        [(row["license"], row["hashes"], row["least"]) for row in known],
        "license string, hashes array<bigint>, least array<bigint>",
    )
    heads = spread.select(
        "license",
        F.array_distinct(
            F.filter(
                "hashes", lambda h: F.exists(F.transform("least", lambda m, b: F.xxhash64(h, b) == m), lambda same: same)
            )
        ).alias("heads"),
    ).collect()
    minima = {row["license"]: row["heads"] for row in heads}
    meets = F.lit(False)
    for length in lengths:
        every = sorted({value for row in known if row["length"] == length for value in minima[row["license"]]})
        meets = meets | F.arrays_overlap(f"hashes_{length}", _longs(every))
    rows = rows.where(meets)
    candidates = [_windows(row["license"], row["length"], len(row["hashes"]), minima[row["license"]]) for row in known]
    windows = rows.select("id_", F.explode(F.concat(*candidates)).alias("w")).select("id_", "w.*")
    met = windows.join(F.broadcast(spread), "license").where(
        F.exists(F.transform("least", lambda m, b: least_of(F.col("window"), b) == m), lambda same: same)
    )
    share = F.size(F.array_intersect("hashes", "window")) / F.size("hashes")
    best = met.withColumn("containment", share).where(F.col("containment") >= LEAST)
    found = best.groupBy("id_", "license").agg(
        F.max(F.struct("containment", (-F.col("first_word")).alias("from_end"))).alias("best")
    )
    return found.select(
        F.col("id_").alias(id_col), "license", F.col("best.containment").alias("containment"), (-F.col("best.from_end")).alias("first_word")
    )


def _windows(name: str, length: int, size: int, heads: list[int]) -> Column:
    """The windows of a template in which one of its least shingles, ``length`` words each, stands."""
    hashes = F.col(f"hashes_{length}")
    stride, own = _stride(size), _longs(heads)
    width = size + stride
    at = F.filter(
        F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(own, F.get(hashes, i))
    )

    def over(i: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((i - width + 1) / stride))
        return F.sequence(first.cast("int"), F.floor(i / stride).cast("int"))

    def window(number: Column) -> Column:
        return F.struct(
            F.lit(name).alias("license"),
            (number * stride).cast("bigint").alias("first_word"),
            F.slice(hashes, number * stride + 1, F.lit(width)).alias("window"),
        )

    return F.transform(F.array_distinct(F.flatten(F.transform(at, over))), window)


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(value).cast("bigint") for value in values])


def oracle(templates: Mapping[str, str] = NOTICES) -> str:
    """The matches in SQL: every window of every template, without hashing."""
    notices = ", ".join(f"('{name}', '{notice.replace(chr(39), chr(39) * 2)}')" for name, notice in templates.items())
    split = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    runs = "[array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]"
    return f"""
        WITH notices(license, notice) AS (VALUES {notices}),
        t1 AS (SELECT license, {split.format('notice')} AS w FROM notices),
        -- a notice is compared by runs of five words, a shorter one by all its words
        t2 AS (SELECT license, w, CAST(least(len(w), {SHINGLE}) AS INTEGER) AS k FROM t1),
        t3 AS (SELECT license, k, list_distinct({runs}) AS want FROM t2),
        t AS (SELECT *, len(want) AS size, greatest(1, len(want) // 3) AS stride FROM t3),
        d1 AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
        d AS (
            SELECT doc_id, k, {runs} AS have
            FROM d1 JOIN (SELECT DISTINCT k FROM t2) ON len(w) >= k),
        near AS (SELECT * FROM d JOIN t USING (k) WHERE len(list_intersect(have, want)) >= {LEAST} * size),
        windows AS (
            SELECT doc_id, license, want, size, b * stride AS first_word,
                   have[b * stride + 1:b * stride + size + stride] AS got
            FROM (SELECT *, unnest(range(0, (len(have) - 1) // stride + 1)) AS b FROM near)),
        shares AS (
            SELECT doc_id, license, first_word, len(list_intersect(want, got)) / size AS containment
            FROM windows),
        best AS (
            SELECT *, row_number() OVER (
                PARTITION BY doc_id, license ORDER BY containment DESC, first_word) AS place
            FROM shares WHERE containment >= {LEAST})
        SELECT doc_id, license, containment, first_word FROM best WHERE place = 1"""
