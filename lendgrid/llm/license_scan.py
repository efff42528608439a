"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts are words without punctuation, lower-cased, in shingles of five. Every
document is cut into windows of ``WINDOW`` shingles that begin at every second
one; templates have a window at every shingle. Each of ``BANDS`` hash functions
gives a window its smallest shingle hash, and a band of one such value is a key:
windows that have one key in common are retrieved.

The settings guarantee retrieval: a template of a single shingle is a quarter
of a window that holds it, so that window meets it with probability
``1 - (3/4)**16 > 0.98``, and two windows hold it, each with own values; longer
templates, or several windows within them, only raise that. What is retrieved
names the template and where it would begin; the share of the template's
shingles that stand there is then computed exactly.

All of it is DataFrame functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHINGLE = 5
WINDOW, STRIDE = 4, 2
BANDS = 16
#: Share of a template's shingles that have to stand in the document.
CONTAINED = 0.8
#: Templates of so many words together are broadcast; beyond that the joins are Spark's choice.
MOST_TEMPLATE_WORDS = 100_000

# Names and notices of public licenses.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
     " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed"
     " under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"),"
     " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
     " the Software, and to permit persons to whom the Software is furnished to do so"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software"
     " Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-header", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"
     " and this permission notice appear in all copies."),
    ("bsd-endorsement", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without"
     " specific prior written permission."),
    ("lgpl-header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free"
     " Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"
     " https://www.eclipse.org/legal/epl-2.0/"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this"
     " software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of"
     " this software."),
    ("boost-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]


#: What separates words, for counting those of the templates.
NOT_WORD = re.compile(r"[\W_]+")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def shingle_hashes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``hashes``: of the shingles of their column ``words``."""
    n = F.size("words")
    return rows.withColumn("hashes", F.when(n < SHINGLE, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(SHINGLE))))))


def band_keys(rows: DataFrame, names: list[str], stride: int) -> DataFrame:
    """(names, place, key) of every window and band of the column ``hashes``."""
    n = F.size("hashes")
    windows = F.when(n == 0, F.array().cast("array<struct<place:int,h0:bigint,h1:bigint,h2:bigint,h3:bigint>>")).otherwise(F.transform(
        F.sequence(F.lit(0), n - 1, F.lit(stride)), lambda i: F.struct(i.alias("place"), *(F.get("hashes", i + j).alias(f"h{j}") for j in range(WINDOW)))))
    # The outer form: of the inner one the optimizer derives a filter on the array's size,
    # and pushes it below the projections, where the words are split anew for each element.
    held = rows.withColumn("windows", windows).select(*names, F.inline_outer("windows")).filter("place is not null")
    bands = held.select("*", F.explode(F.array(*(F.lit(b) for b in range(BANDS)))).alias("band"))
    hashed = (F.when(F.col(f"h{j}").isNotNull(), F.xxhash64("band", f"h{j}")) for j in range(WINDOW))
    return bands.select(*names, "place", F.least(*hashed).alias("key"))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license_id, words, hashes, shingles) of all templates."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license_id string, text string")
    rows = shingle_hashes(rows.withColumn("words", words_of(F.col("text"))))
    return rows.select("template", "license_id", "words", "hashes", shingles_of("words").alias("shingles"))


def short_notices(rows: DataFrame, of_templates: DataFrame) -> DataFrame:
    """Where a document holds the words of a template of fewer than ``SHINGLE`` words, in a row: such a
    template has no shingle, so it is looked for as it is."""
    short = of_templates.filter((F.size("words") > 0) & (F.size("words") < SHINGLE)).select("license_id", F.array_join("words", " ").alias("phrase"))
    n = F.size("words")

    def grams_of(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct(F.array_join(F.slice("words", i + 1, F.lit(k)), " ").alias("phrase"), i.alias("at")))
        return F.when(n < k, F.array().cast("array<struct<phrase:string,at:int>>")).otherwise(every)

    grams = F.flatten(F.array(*(grams_of(k) for k in range(1, SHINGLE))))
    held = rows.withColumn("grams", grams).select("doc_id", "text_hash", F.inline_outer("grams")).join(F.broadcast(short), "phrase")
    return held.groupBy("doc_id", "text_hash", "license_id").agg(F.min("at").alias("begin_word")).select(
        "doc_id", "text_hash", "license_id", F.lit(1.0).alias("containment"), "begin_word")


def shingles_of(words: str) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, F.lit(SHINGLE)), " ")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, text_hash, license_id, containment, begin_word): a row for every
    document and license found in it.

    ``containment`` is the largest share of a template's shingles that stand at
    one place, ``begin_word`` that place (of several, the one most bands name).
    Null, empty and very short texts hold no license; ``text_hash`` (xxhash64 of
    the text) tells rows apart that share a doc_id, exact repeats of a row give
    one result; a null doc_id stays null; an empty table gives an empty table;
    columns other than doc_id and text are not read. Texts of any length are cut into windows whole.
    Of notices that have most words in common each is reported with its own containment. A
    template of fewer than ``SHINGLE`` words is found where its words stand in a row.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    n_words = [len(NOT_WORD.sub(" ", text).split()) for _, text in templates]
    small = F.broadcast if sum(n_words) <= MOST_TEMPLATE_WORDS else (lambda df: df)
    of_all = template_table(spark, templates)
    of_templates = of_all.filter(F.size("words") >= SHINGLE)
    keys = (band_keys(of_templates.withColumn("n", F.size("words")), ["template", "n"], 1)
            .select("template", "n", F.col("place").alias("template_place"), "key").distinct())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(F.col("text")).alias("words"))
    # The words go along with the windows (as a reference: windows and bands are generated row by row and
    # meet the broadcast keys at once), so that the words around a hit are at hand without reading the text again.
    windows = band_keys(shingle_hashes(rows), ["doc_id", "text_hash", "words"], STRIDE)
    begin = F.col("place") - F.col("template_place")
    slack = F.lit(8) + F.floor(F.col("n") / 5).cast("int")
    around = F.slice("words", F.greatest(begin - slack, F.lit(0)) + 1, F.col("n") + 2 * slack)
    met = (windows.join(small(keys), "key")
           .select("doc_id", "text_hash", "template", begin.alias("begin"), around.alias("region"))
           .groupBy("doc_id", "text_hash", "template", "begin").agg(F.count("*").alias("votes"), F.first("region").alias("region")))
    region = (met.join(small(of_templates.select("template", "license_id", "shingles")), "template")
              .withColumn("begin", F.greatest("begin", F.lit(0))))
    share = F.size(F.array_intersect("shingles", shingles_of("region"))) / F.size("shingles")
    held = region.select("doc_id", "text_hash", "license_id", "begin", "votes", share.alias("containment")).filter(F.col("containment") >= CONTAINED)
    best = F.max(F.struct("containment", "votes", (-F.col("begin")).alias("minus_begin"))).alias("b")
    found = held.groupBy("doc_id", "text_hash", "license_id").agg(best).select(
        "doc_id", "text_hash", "license_id", "b.containment", (-F.col("b.minus_begin")).alias("begin_word"))
    if min(n_words, default=SHINGLE) >= SHINGLE:
        return found
    both = found.union(short_notices(rows, of_all))
    first = F.max(F.struct("containment", (-F.col("begin_word")).alias("minus_begin"))).alias("b")
    return both.groupBy("doc_id", "text_hash", "license_id").agg(first).select(
        "doc_id", "text_hash", "license_id", "b.containment", (-F.col("b.minus_begin")).alias("begin_word"))
