"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies.

DataFrame functions only. Words are what white space and punctuation part, A-Z
lower-cased. A text is cut into windows of `WINDOW` words, a new one every `STEP` words;
longer templates are cut the same way, so wherever a template of m words
stands, some window holds min(m, WINDOW - STEP + 1) words in a row of it:
a resemblance J of at least 3/6 even for a template of five words. Each of the
`BANDS` bands is one MinHash value, so a window with resemblance J to a piece
retrieves it with probability 1 - (1 - J) ** BANDS: 0.996 at 3/6, and more for
longer templates, which have several windows. A template of fewer than five words
is a piece of one shingle, and its windows are every single shingle of a text:
J is 1 there, and one band retrieves it always. A window and a piece with one
MinHash value in common have the shingle of that value in common, so only texts
that hold some shingle of a template are cut into windows.

A retrieved template is verified against a stretch of words around the window
that can hold all of it: the share of its distinct shingles found there must
reach `CONTAINED`. Null and empty texts have no match; a text is never cut
short; every row is scanned and reported by itself, be its id repeated or null;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.fingerprints import LOWER, UPPER, once
from tidemark.sources.tables import table

SHINGLE, WINDOW, STEP, BANDS, CONTAINED = 3, 8, 2, 8, 0.8
SHORT = 5  # templates of fewer words are retrieved by single shingles

# Short public license notices, as commonly written.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0",
    "all-rights-reserved": "All rights reserved",
}


#: What parts words: white space, ASCII punctuation and common typographic marks.
APART = "\t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u00a0\u00a9\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u2026"


def license_words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + APART, LOWER + " " * len(APART))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingles(words: Column) -> Column:
    """The hash of every `SHINGLE` words, in order; none for fewer words."""
    n = F.size(words)
    return F.transform(F.slice(words, F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, SHINGLE)]))


def starts(n: Column) -> Column:
    """First shingles (from 1) of the windows over n shingles; the last window ends with the text."""
    span = WINDOW - SHINGLE + 1
    return F.when(n <= span, F.array(F.lit(1))).otherwise(F.array_union(F.sequence(F.lit(1), n - span + 1, F.lit(STEP)), F.array(n - span + 1)))


def band(hashes: Column, which: int) -> Column:
    """Hashes in the band's own order."""
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(which)))


def window_bands(hashes: Column) -> Column:
    """For each window (start, values): its least hash in each band's order."""
    span = WINDOW - SHINGLE + 1

    def values(s: Column, orders: list[Column]) -> Column:
        return F.struct(s.alias("start"), F.array(*[F.array_min(F.slice(o, s, F.lit(span))) for o in orders]).alias("values"))

    def deep(k: int, orders: list[Column]) -> Column:
        if k < BANDS:
            return once(band(hashes, k), lambda o: deep(k + 1, [*orders, o]))
        return F.transform(starts(F.size(hashes)), lambda s: values(s, orders))

    return deep(0, [])


def template_table(spark, templates: Mapping[str, str]) -> DataFrame:
    """template, n (words), wanted (distinct shingles)."""
    d = spark.createDataFrame(sorted(templates.items()), "template string, notice string").withColumn("words", license_words(F.col("notice")))
    return d.select("template", "words", F.size("words").alias("n"), F.array_distinct(shingles(F.col("words"))).alias("wanted"))


def retrieval_keys(found: DataFrame) -> list[dict[int, list[str]]]:
    """For each band, the templates whose pieces have a value there: as many as the parameter's pieces."""
    pieces = found.where(F.col("n") >= SHORT).select("template", F.explode(once(shingles(F.col("words")), window_bands)).alias("w"))
    keys: list[dict[int, list[str]]] = [{} for _ in range(BANDS)]
    for r in pieces.select("template", "w.values").collect():
        for b, v in enumerate(r["values"]):
            names = keys[b].setdefault(v, [])
            if r["template"] not in names:
                names.append(r["template"])
    return keys


def table_lookup(value: Column, names: Mapping[int, list[str]]) -> Column:
    """The templates of a value; none for another."""
    none = F.array().cast("array<string>")
    if not names:
        return none
    return F.coalesce(F.create_map(*[x for v, t in sorted(names.items()) for x in (F.lit(v), F.array(*map(F.lit, t)))])[value], none)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """doc_id, template, n_windows (verified windows), containment (the best), first_word (from 0): one line a row of docs and template."""
    spark = docs.sparkSession
    listed = template_table(spark, templates)
    keys = retrieval_keys(listed)
    lengths = {r["template"]: (r["n"], r["wanted"]) for r in listed.select("template", "n", "wanted").collect()}
    if any(n < SHINGLE for n, _ in lengths.values()):
        raise ValueError(f"a template needs {SHINGLE} words")
    short: dict[int, list[str]] = {}
    for k, (n, wanted) in sorted(lengths.items()):
        for v in wanted if n < SHORT else ():
            short.setdefault(v, []).append(k)

    def hits(window: Column) -> Column:
        found = F.lit(False)
        for b in range(BANDS):
            if keys[b]:
                found = found | F.get(window["values"], F.lit(b)).isin(sorted(keys[b]))
        return found

    any_ = sorted({v for _, wanted in lengths.values() for v in wanted})

    def windows(hashes: Column) -> Column:
        """Windows that retrieve something: those of the bands, then single shingles."""
        found = F.transform(F.filter(window_bands(hashes), hits), lambda w: F.struct(w["start"].alias("start"), w["values"].alias("values"), F.lit(None).cast("long").alias("one")))
        if not short:
            return found
        single = F.transform(hashes, lambda h, i: F.struct((i + 1).alias("start"), F.lit(None).cast("array<bigint>").alias("values"), h.alias("one")))
        return F.concat(found, F.filter(single, lambda w: w["one"].isin(sorted(short))))

    at = once(license_words(F.col("text")), lambda w: once(shingles(w), lambda h: F.when(F.exists(h, lambda x: x.isin(any_)), F.struct(windows(h).alias("windows"), h.alias("hashes")))))
    # a row's number tells rows of one id apart; it goes once the row's windows are added up
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), at.alias("w")).where(F.size("w.windows") > 0)
    each = found.select("doc_id", "row", F.col("w.hashes").alias("hashes"), F.explode("w.windows").alias("at"))
    names = [table_lookup(F.get(F.col("at.values"), F.lit(b)), keys[b]) for b in range(BANDS)]
    each = each.withColumn("template", F.explode(F.array_distinct(F.concat(*names, table_lookup(F.col("at.one"), short)))))
    size = F.element_at(F.create_map(*[x for k, (n, _) in sorted(lengths.items()) for x in (F.lit(k), F.lit(n))]), F.col("template"))
    wanted = F.element_at(F.create_map(*[x for k, (_, s) in sorted(lengths.items()) for x in (F.lit(k), F.array(*map(F.lit, s)))]), F.col("template"))
    each = each.withColumn("wanted", wanted).withColumn("from", F.greatest(F.lit(1), F.col("at.start") - size)).withColumn("span", 2 * size + WINDOW)
    share = F.size(F.array_intersect("wanted", F.slice("hashes", F.col("from"), F.col("span")))) / F.size("wanted")
    return (
        each.withColumn("share", share)
        .where(F.col("share") >= contained)
        .groupBy("row", "doc_id", "template")
        .agg(F.count("*").alias("n_windows"), F.max("share").alias("containment"), (F.min("at.start") - 1).cast("long").alias("first_word"))
        .drop("row")
    )


def op6_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
