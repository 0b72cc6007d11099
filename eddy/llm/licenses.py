"""Operator 3: licence scan by diagonal voting.

Every rolling word k-gram of every document (k = 2 and 4) is hashed and
joined with the positions of the same k-grams in the licence templates.  A
hit votes for the diagonal ``document position - template position``.  Votes
are added up for each diagonal, neighbouring diagonals (up to ``drift`` words
apart, for inserted or missing words) are merged, and the merged span is
verified: the share of the template's k-grams that it holds.

Templates of up to three words vote with 2-grams, longer ones with 4-grams.
A base phrase counts each place where all its 2-grams stand on one diagonal.

Defined cases: a null or empty text has no words, labels '' and score 0; rows
are answered one by one, so repeated rows get equal answers; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import once, text_key, words

# Base phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Opening passages of public licence notices.
NOTICES = [
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit-text", "The above copyright notice and this permission notice shall be included in all copies or "
                 "substantial portions of the Software"),
    ("apache-text", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                    "except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-text", "Unless required by applicable law or agreed to in writing, software distributed under the "
                    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted"),
    ("mpl-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution"),
    ("cc", "Licensed under CC BY"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "Licensed under CC BY-SA 4.0"),
    ("all-rights-reserved", "All rights reserved"),
]

DRIFT = 3
COVER = 0.6
PIECE = 60  # template positions whose votes one bit mask holds

TEMPLATES = [(t, label, True) for t, label in PHRASES] + [(t, label, False) for label, t in NOTICES]


def _rolled(grams: Column, step: int) -> Column:
    """Hash of each gram with the one ``step`` places on."""
    n = F.greatest(F.size(grams) - step, F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), n), F.slice(grams, F.lit(1 + step), n),
                      lambda a, b: F.xxhash64(a, b))


def rolling_grams(text: Column) -> Column:
    """Two arrays: the hashes of all word 2-grams of a text, and of its
    4-grams, in the order of their first word."""
    hashes = F.transform(words(text), lambda x: F.xxhash64(x))
    pairs = lambda g2: F.array(g2, _rolled(g2, 2))
    return once(hashes, lambda h: once(_rolled(h, 1), pairs))


def template_positions(spark: SparkSession, templates=None) -> DataFrame:
    """``(gram, tid, label, base, need, tpos)``: each k-gram of each template
    ``(text, label, base)`` with its position; ``need`` counts the k-grams."""
    t = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("tid"), F.lit(text).alias("text"), F.lit(label).alias("label"), F.lit(base).alias("base"))
        for i, (text, label, base) in enumerate(TEMPLATES if templates is None else templates)])))
    w = F.size(words(F.col("text")))
    grams = F.when(w < 4, F.col("g")[0]).otherwise(F.col("g")[1])
    return (t.select("tid", "label", "base", "text", rolling_grams(F.col("text")).alias("g"))
            .select("tid", "label", "base", grams.alias("g"))
            .select("tid", "label", "base", F.size("g").alias("need"), F.posexplode("g").alias("tpos", "gram")))


def diagonals(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """Votes by diagonal: ``(doc_id, tk, tid, label, base, need, diag, n, lo,
    hi, masks)``; ``n`` counts the template positions that voted (each once,
    however often a row is repeated), ``masks`` has them as bits, ``lo`` and
    ``hi`` are places of their first and last k-gram in the document."""
    key = ["doc_id", "tk"]
    # Outer, as Spark would compute the grams once more to filter empty arrays.
    g = docs.select("doc_id", text_key(F.col("text")).alias("tk"),
                    F.explode_outer(rolling_grams(F.col("text"))).alias("g"))
    hits = (g.select(*key, F.posexplode_outer("g").alias("pos", "gram"))
            # as many rows as the templates, a parameter, have words
            .join(F.broadcast(positions), "gram"))
    one = F.lit(1).cast("long")
    named = ["tid", "label", "base", "need"]
    return (hits.groupBy(*key, *named, (F.col("pos") - F.col("tpos")).alias("diag"),
                         F.expr(f"tpos div {PIECE}").alias("piece"))
            .agg(F.bit_or(F.call_function("shiftleft", one, F.col("tpos") % PIECE)).alias("mask"),
                 F.min("pos").alias("lo"), F.max("pos").alias("hi"))
            .groupBy(*key, *named, "diag")
            .agg(F.sum(F.bit_count("mask")).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                 F.collect_list(F.struct("piece", "mask")).alias("masks")))


def license_spans(diags: DataFrame, drift: int = DRIFT, cover: float = COVER) -> DataFrame:
    """Verified spans: ``(doc_id, tk, tid, label, base, start, stop, cover)``.
    Phrases (``base``) need all their k-grams on one diagonal.  Others are
    spans if one diagonal has enough of them; what is left may be spread over
    neighbouring diagonals, merged where they are at most ``drift`` apart, and
    each template position counts once, however many of them have it.  Merged
    diagonals are cut into stretches of half the template's length, twice, the
    second time shifted by half a stretch, so endless chains hide no span."""
    key, named = ["doc_id", "tk", "tid"], ["label", "base", "need"]
    share = (F.col("n") / F.col("need")).alias("cover")
    columns = [*key, "label", "base", F.col("lo").alias("start"), F.col("hi").alias("stop"), share]
    whole = F.when(F.col("base"), F.col("n") == F.col("need")).otherwise(F.col("n") >= cover * F.col("need"))
    w = Window.partitionBy(*key).orderBy("diag")
    fresh = F.coalesce(F.col("diag") - F.lag("diag").over(w) > drift, F.lit(True))
    width = F.greatest(F.lit(drift + 1), F.ceil(F.col("need") / 2))
    islands = (diags.where(~F.col("base") & ~whole).withColumn("fresh", fresh.cast("int"))
               .withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1))))
               .withColumn("stretch", F.floor((F.col("diag") + F.col("shift") * F.floor(width / 2)) / width)))
    group = [*key, *named, "island", "shift", "stretch"]
    merged = (islands.select(*group, "lo", "hi", F.inline("masks"))
              .groupBy(*group, "piece").agg(F.bit_or("mask").alias("mask"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .groupBy(*group).agg(F.sum(F.bit_count("mask")).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .where(whole & (F.col("hi") - F.col("lo") < 1.5 * F.col("need") + drift)))
    return diags.where(whole).select(*columns).union(merged.select(*columns).distinct())


def scan(docs: DataFrame, templates=None) -> DataFrame:
    """For each row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``."""
    spans = license_spans(diagonals(docs, template_positions(docs.sparkSession, templates)))
    base = F.col("base")
    found = (spans.groupBy("doc_id", "tk")
             .agg(F.count(F.when(base, 1)).alias("n_base"),
                  F.min(F.when(base, F.col("start"))).alias("first_word"),
                  F.max(F.when(base, F.col("start"))).alias("last_word"),
                  F.sort_array(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
                  F.sort_array(F.collect_set("label")).alias("labels"), F.max("cover").alias("score")))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("tk"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    on = [F.col("c.doc_id").eqNullSafe(F.col("p.doc_id")), F.col("c.tk").eqNullSafe(F.col("p.tk"))]
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return (rows.alias("c").join(found.alias("p"), on, "left")
            .select("c.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    F.col("first_word").cast("long").alias("first_word"),
                    F.col("last_word").cast("long").alias("last_word"),
                    joined("base_labels").alias("base_labels"), joined("labels").alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
