"""License scan: a positional index of rare words, in DataFrame operations only.

The notices' words with the highest inverse document frequency (over all documents) are
posted with their place in the notice. A document's places of these words are joined with
the postings; places that agree on where the notice would start vote for it with their
weight, and a notice is accepted when most of its weight votes for one start and its
mandatory phrase stands in the document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from roadlark.session import literal_rows, materialise

# Phrases every scan counts, and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Fixed values: (label, notice, phrase that must be there).
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files", "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software"),
]

RARE_WORDS = 4  # words of each notice that are indexed
LEAST_WEIGHT = 0.6  # share of a notice's weight that must agree on one start


def _spaced(text: Column) -> Column:
    """Words joined by single spaces, one space at either end. ``lower`` also changes
    letters beyond ASCII, which no phrase or notice has and which part no words."""
    words = F.regexp_replace(F.lower(text), r"[^0-9a-z\x{80}-\x{10FFFF}]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _has(phrase: str) -> Column:
    return F.col("_spaced").contains(f" {phrase} ")


def _idf(spaced: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word, over all rows."""
    found = F.array_distinct(F.filter(F.split("_spaced", " "), lambda w: w.isin(vocabulary)))
    per_word = spaced.select(F.explode(found).alias("word")).groupBy("word").count()
    count = spaced.count()
    # One row per word of the fixed notices.
    seen = {r["word"]: r["count"] for r in per_word.collect()}
    return {w: math.log((count + 1) / (seen.get(w, 0) + 1)) + 1e-9 for w in vocabulary}


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    A null or empty text, or one without a word, has no words and labels, null places and
    score 0. Words are counted from 0. ``score`` is the largest share of weight among the
    accepted notices, 1 where a base phrase stands. Repeated rows are scanned each for
    itself; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    spaced = docs.select(F.col(f"`{id_column}`").alias("_id"), _spaced(text).alias("_spaced"))

    notices = [notice.split() for _, notice, _ in NOTICES]
    idf = _idf(spaced, sorted({w for words in notices for w in words}))
    postings = []
    for number, words in enumerate(notices):
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE_WORDS]
        places = [(w, i) for i, w in enumerate(words) if w in rare]
        whole = sum(idf[w] for w, _ in places)
        postings += [(w, number, i, idf[w] / whole) for w, i in places]
    indexed = sorted({w for w, *_ in postings})

    def hits(words: Column) -> Column:
        placed = F.transform(words, lambda w, i: F.when(w.isin(indexed), F.struct(w.alias("word"), i.alias("place"))))
        return F.filter(placed, lambda x: x.isNotNull())

    verified = F.filter(
        F.array(*[F.when(_has(phrase), F.lit(i)) for i, (_, _, phrase) in enumerate(NOTICES)]),
        lambda x: x.isNotNull(),
    )
    n_words = F.when(F.length("_spaced") <= 2, 0).otherwise(_spaces(F.col("_spaced")) - 1)
    parts = [
        F.when(_has(p), F.split("_spaced", f"(?<= ){p}(?= )")).alias(f"_parts{i}")
        for i, p in enumerate(BASE)
    ]
    found = spaced.select("_id", "_spaced", n_words.alias("_n"), verified.alias("_verified"), *parts)

    counts, firsts, lasts, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE.items()):
        pieces = F.col(f"_parts{i}")
        counts.append(F.coalesce(F.size(pieces) - 1, F.lit(0)))
        firsts.append(_spaces(F.element_at(pieces, 1)) - 1)
        lasts.append(F.col("_n") + 1 - _spaces(F.element_at(pieces, -1)) - len(phrase.split()))
        labels.append(F.when(pieces.isNotNull(), F.lit(label)))
    base = F.array_sort(F.filter(F.array(*labels), lambda x: x.isNotNull()))
    narrow = materialise(
        found.select(
            F.monotonically_increasing_id().alias("_row"),
            "_id",
            F.col("_n").cast("long").alias("n_words"),
            sum(counts[1:], counts[0]).cast("long").alias("n_base"),
            F.least(*firsts).cast("long").alias("first_word"),
            F.greatest(*lasts).cast("long").alias("last_word"),
            base.alias("_base"),
            "_verified",
            # Only a document with a mandatory phrase can have a notice.
            F.when(F.size("_verified") > 0, hits(F.split(F.trim("_spaced"), " "))).alias("_hits"),
        ),
        "license-hits",
    )

    index = literal_rows(spark, postings, "word string, notice int, at int, weight double")
    names = literal_rows(spark, [(i, n[0]) for i, n in enumerate(NOTICES)], "notice int, label string")
    votes = (
        narrow.where(F.col("_hits").isNotNull())
        .select("_row", "_verified", F.explode("_hits").alias("_hit"))
        .select("_row", "_verified", "_hit.*")
        .join(F.broadcast(index), "word")
        .where(F.array_contains("_verified", F.col("notice")))
        .groupBy("_row", "notice", (F.col("place") - F.col("at")).alias("start"))
        .agg(F.sum("weight").alias("weight"))
        .where(F.col("weight") >= LEAST_WEIGHT)
        .join(F.broadcast(names), "notice")
        .groupBy("_row")
        .agg(F.collect_set("label").alias("_more"), F.max("weight").alias("_weight"))
    )
    every = F.array_sort(F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("_weight", F.lit(0.0))))
    return narrow.drop("_hits", "_verified").join(votes, "_row", "left").select(
        F.col("_id").alias(id_column),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )
