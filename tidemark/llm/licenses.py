"""License scans by diagonal voting.

Every rolling word pair of a document, as a hash, is joined to the positions
of that pair in the license templates.  A hit votes for the diagonal
``word - template word``; votes are summed by document, template and diagonal.
A diagonal with a vote for every pair of its template is the template word for
word.  Neighbouring diagonals of one template (inserted or dropped words) are
merged into a span, which is verified by the share of the template's pairs it
holds and by its length.

All of it is DataFrame code.  The template table is a constant of this module
of a few hundred rows, so its broadcast has a proven bound.  Hits are summed
before any shuffle, and documents meet their sums by a hash of the document.

Defined cases: a null text is empty and has no words; equal rows are labelled
one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, written

#: The phrases of the base labels.
BASE = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}
#: Opening lines of common notices, and the label of each.
NOTICES = {
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "lgpl": "GNU Lesser General Public License",
    "agpl": "GNU Affero General Public License",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "creative-commons": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "public-domain": "This is free and unencumbered software released into the public domain",
    "all-rights-reserved": "All rights reserved",
}
#: Diagonals at most so far apart belong to one span.
SLACK = 3
#: A span holds at least this share of its template's pairs, within this
#: multiple of its words.
COVERAGE, STRETCH = 0.85, 1.5

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased.  ``lower`` also maps two other characters to ASCII
    letters; where a text holds them they are first made others."""
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.lower(F.when(odd, F.translate(text, "\u212a\u0130", "\u0138\u0131")).otherwise(text))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def template_pairs(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``(template, pairs, at, pair, h)`` for each word pair of each template."""
    rows = []
    for name, text in templates.items():
        found = template_words(text)
        rows += [F.struct(F.lit(name).alias("template"), F.lit(len(found) - 1).alias("pairs"), F.lit(i).alias("at"),
                          F.lit(f"{a} {b}").alias("pair")) for i, (a, b) in enumerate(zip(found, found[1:]))]  # noqa: B905
    table = spark.range(1).select(F.inline(F.array(*rows)))
    return table.withColumn("h", F.xxhash64("pair"))


def hits(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``(k1, k2, template, pairs, diagonal, votes, low, high, ats, n_words)``:
    the votes of each diagonal and which pairs of the template they are; and
    for each document with words a row without template with their number."""
    spark = docs.sparkSession
    split = docs.select(*row_key(), words(F.col("text")).alias("w"))
    # the pair of the last word is null and stands for the document's end
    pairs = split.select("k1", "k2", F.posexplode(F.zip_with(
        "w", F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.concat(a, F.lit(" "), b))).alias("pos", "pair"))
    pairs = pairs.withColumn("h", F.xxhash64("pair"))
    table = F.broadcast(template_pairs(spark, templates).withColumnRenamed("pair", "own"))
    met = (pairs.join(table, (pairs["h"] == table["h"]) & (F.col("pair") == F.col("own")), "left")
           .where(F.col("template").isNotNull() | F.col("pair").isNull()))
    # equal documents share a key and give each vote again: a set counts it once
    return (met.groupBy("k1", "k2", "template", "pairs", (F.col("pos") - F.col("at")).alias("diagonal"))
            .agg(F.collect_set("at").alias("ats"), F.max(F.when(F.col("pair").isNull(), F.col("pos") + 1)).alias("n_words"))
            .select("*", F.size("ats").alias("votes"), F.array_min("ats").alias("low"), F.array_max("ats").alias("high")))


def spans(found: DataFrame) -> DataFrame:
    """Verified spans ``(k1, k2, template, first, last, coverage)`` of merged
    neighbouring diagonals, in words from 0."""
    near = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    start = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(near) > SLACK)
                       | (F.lag("votes").over(near) == F.col("pairs")) | (F.col("votes") == F.col("pairs")), F.lit(True))
    merged = (found.withColumn("cut", start.cast("int"))
              .withColumn("span", F.sum("cut").over(near.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("k1", "k2", "template", "pairs", "span")
              .agg(F.min(F.col("diagonal") + F.col("low")).alias("first"), F.max(F.col("diagonal") + F.col("high") + 1).alias("last"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held")))
    return (merged.withColumn("coverage", F.col("held") / F.col("pairs"))
            .where((F.col("coverage") >= COVERAGE) & (F.col("last") - F.col("first") + 1 <= STRETCH * (F.col("pairs") + 1)))
            .select("k1", "k2", "template", "first", "last", "coverage"))


def scanned(docs: DataFrame, notices: dict[str, str] = NOTICES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The places of base phrases ``(k1, k2, label, word)``, the verified spans
    of all templates, and ``(k1, k2, n_words)`` of the documents with words."""
    base = {f"base:{label}": phrase for label, phrase in BASE.items()}
    found = written(hits(docs, base | notices), "license-hits")
    places = (found.where(F.col("template").startswith("base:") & (F.col("votes") == F.col("pairs")))
              .select("k1", "k2", F.expr("substring(template, 6)").alias("label"), F.col("diagonal").alias("word")))
    return places, spans(found.where(F.col("template").isNotNull())), found.where(F.col("template").isNull()).select("k1", "k2", "n_words")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    places, verified, sizes = scanned(docs)
    base = (places.groupBy("k1", "k2").agg(F.count("*").alias("n_base"), F.min("word").alias("first_word"), F.max("word").alias("last_word"),
                                           F.array_sort(F.collect_set("label")).alias("base_labels")))
    label = F.regexp_replace("template", "^base:", "")
    more = verified.groupBy("k1", "k2").agg(F.collect_set(label).alias("labels"), F.max("coverage").alias("score"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key())
    both = sizes.join(base, ["k1", "k2"], "left").join(more, ["k1", "k2"], "left")
    none = F.array().cast("array<string>")
    return (rows.join(both, ["k1", "k2"], "left")
            .select("doc_id", F.coalesce(F.col("n_words").cast("long"), F.lit(0).cast("long")).alias("n_words"), F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
                    F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
                    F.array_join(F.coalesce("base_labels", none), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(F.coalesce("base_labels", none), F.coalesce("labels", none))), ",").alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
