"""License passages by diagonal voting (operator 6), in DataFrame functions only.

All rolling ``K``-word windows of every text are hashed and joined to the places where the templates
have the same window.  A hit at word p of a text and word q of a template votes for the diagonal
p - q.  Neighbouring diagonals of a text and template (``NEAR`` words apart at most, as an inserted or
dropped word shifts them) merge, and a merged run whose hits cover ``COVER`` of the template's words is a
passage: hits carry their words, so a hash alone is no evidence.  Its label joins those of the base
phrases.

The templates are some hundred windows, a fixed table of this file, so they are broadcast.  Only hits are
shuffled.

Defined cases: a null or empty text has no words; each row is judged by its own text, whatever its doc_id, so rows that
repeat a doc_id are a row each and a null doc_id stays null; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtline.llm.shared import saved, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
NEAR = 3
COVER = 0.8

# fixed values: the base phrases with their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: notices as their licenses word them, with the label of each
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "licensed under a Creative Commons Attribution"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc0", "dedicated to the public domain under the CC0"),
    ("as-is", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
]


def words(text: Column) -> Column:
    """The words of a text.  Lower case is taken of all letters: of the others only the Kelvin sign turns into an
    ASCII letter, and no phrase or template has a k, so places and counts are those of A-Z alone."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def _windows(w: Column) -> Column:
    """(hash, first word) of each K-word window."""
    return F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - (K - 1), F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, *[F.get(w, i + k) for k in range(1, K)]).alias("h"), x.alias("word")))


def template_windows(spark: SparkSession) -> DataFrame:
    """(template, label, size, at, h, word): the places of every window of every template."""
    t = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(TEMPLATES)], "template int, label string, text string")
    t = t.select("template", "label", words(F.col("text")).alias("w"))
    t = t.select("template", "label", F.size("w").alias("size"), F.posexplode(_windows(F.col("w"))).alias("at", "x"))
    return t.select("template", "label", "size", "at", F.col("x.h").alias("h"), F.col("x.word").alias("word"))


def _key() -> Column:
    """What passages are gathered by: a digest of the text, as rows of equal texts hold the same ones."""
    return F.md5(F.encode("text", "UTF-8")).alias("key")


def _text_passages(docs: DataFrame) -> DataFrame:
    """Verified passages by text: key, label, template, first_word, last_word (exclusive), cover."""
    t = F.broadcast(template_windows(docs.sparkSession))
    d = text_of(docs).select(_key(), words(F.col("text")).alias("w"))
    d = d.select("key", F.posexplode(_windows(F.col("w"))).alias("p", "x"))
    d = d.select("key", "p", F.col("x.h").alias("h"), F.col("x.word").alias("own"))
    hits = d.join(t, "h").filter(F.col("own") == F.col("word"))
    votes = hits.groupBy("key", "template", "label", "size", (F.col("p") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("p").alias("low"), F.max("p").alias("high"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True)).cast("int")
    runs = votes.withColumn("run", F.sum(fresh).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("key", "template", "label", "size", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.min("low").alias("first_word"),
        (F.max("high") + K).alias("last_word"))
    held = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + (K - 1))))))
    cover = held / F.col("size")
    return merged.select("key", "label", "template", "first_word", "last_word", cover.alias("cover")).filter(F.col("cover") >= COVER)


def passages(docs: DataFrame) -> DataFrame:
    """Verified passages of each row: doc_id, label, template, first_word, last_word (exclusive), cover."""
    found = saved(_text_passages(docs), "license-passages")
    return text_of(docs).select("doc_id", _key()).join(found, "key").drop("key")


def _base(docs: DataFrame) -> DataFrame:
    """Counts and places of the base phrases; each word stands between two spaces of its own."""
    d = text_of(docs).select("doc_id", _key(), words(F.col("text")).alias("w"))
    d = d.select("doc_id", "key", F.size("w").cast("long").alias("n_words"),
                 F.concat(F.lit(" "), F.array_join("w", "  "), F.lit(" ")).alias("s"))
    count_of = lambda part: (F.length(part) - F.length(F.replace(part, F.lit(" ")))) / 2
    n, first, last, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        p = " " + phrase.replace(" ", "  ") + " "
        has = F.contains(F.col("s"), F.lit(p))
        n.append(F.when(has, (F.length("s") - F.length(F.replace(F.col("s"), F.lit(p)))) / len(p)).otherwise(0))
        first.append(F.when(has, count_of(F.substring_index("s", p, 1))))
        last.append(F.when(has, F.col("n_words") - count_of(F.substring_index("s", p, -1)) - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    return d.select("doc_id", "key", "n_words", sum(n[1:], n[0]).cast("long").alias("n_base"),
                    F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
                    F.array_sort(F.array_compact(F.array(*labels))).alias("base"))


def licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the largest share of a template that a passage covers, and 1 where a base phrase stands.
    """
    found = _text_passages(docs).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"))
    # written first, so that Spark can split the join of a text that many rows hold
    d = _base(docs).join(saved(found, "license-labels"), "key", "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(F.coalesce("cover", F.lit(0.0)), F.lit(1.0)))
    return d.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                    F.array_join(every, ",").alias("labels"), score.alias("score"))
