"""License scans by a positional index of template words; DataFrame functions only."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import durable

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label, mandatory key phrase and opening words of common licences and of the notices that name them.
TEMPLATES = [
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache license version 2 0", "you may not use this file except in compliance with the license you may obtain a copy of the license at licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "creative commons attribution 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc0-1.0", "cc0 1 0 universal", "the person who associated a work with this deed has dedicated the work to the public domain cc0 1 0 universal"),
    ("gpl-2.0", "gnu general public license version 2", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-any", "gnu general public license as published", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit-notice", "released under the mit license", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
]
#: Words of each template that are looked up: those of highest inverse document frequency among those that any text has.
RAREST = 8
#: A template's label holds from this share of the weight of its looked-up words on.
LEAST_SCORE = 0.6
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced_words(text: Column) -> Column:
    """The text's words, capital ASCII letters made small, with one space before and after each."""
    return F.translate(F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), _SEPARATORS, " "), _CAPITALS, _SMALL)


def word_count(spaced: Column) -> Column:
    return (F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) - 1).cast("long")


def phrase_places(words: Column, spaced: Column, phrase: str) -> Column:
    """First words of the places where the phrase's words stand, in order."""
    first, *rest = phrase.split()

    def place(every: Column, word: Column, i: Column) -> Column:
        here = word == first
        for k, other in enumerate(rest, 1):
            here = here & (F.get(every, i + k) == other)
        return F.when(here, i.cast("long"))

    found = F.transform(F.array(words), lambda every: F.filter(F.transform(every, lambda w, i: place(every, w, i)), lambda x: x.isNotNull()))[0]
    return F.when(spaced.contains(f" {phrase} "), found).otherwise(F.array().cast("array<long>"))


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., n_words, places, base_labels, labels, score): licence phrases and notices in each text.

    places: array of the first words of all PHRASES places, in order. base_labels: their labels,
    distinct and sorted. labels: with those of the templates found. score: the largest share of a
    template's weight that stands at one relative position, 1 where a base phrase stands.

    The method: of each template whose mandatory key phrase stands in the text, the RAREST words of
    highest inverse document frequency over all rows (words that no row has tell nothing) are looked up in an index of template positions;
    hits vote for the template at a relative position with that frequency as their weight, and the
    template holds if the voted weight is LEAST_SCORE of the weight of its looked-up places.

    A null or empty text has no words, no labels and score 0. Repeated rows each give a row. An
    empty table gives no rows. Texts are not shuffled, only positions of template words in texts with
    a key phrase; the index is a constant of a few hundred rows, and only its words' document
    frequencies (as many values as the templates have words) pass through the driver. A kept column
    named like one of the results gives way to it.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c.lower() not in ("n_words", "places", "base_labels", "labels", "score"))
    vocabulary = sorted({w for _, _, t in TEMPLATES for w in t.split()})
    index_words = F.array(*(F.lit(w) for w in vocabulary))
    spaced = F.col("__spaced")
    words = F.split(F.trim(spaced), " ")
    hits = F.filter(F.transform(words, lambda w, i: F.struct(i.cast("long").alias("at"), w.alias("word"))), lambda s: s["word"].isin(vocabulary))
    nothing = F.array().cast("array<struct<at:long,word:string>>")
    keyed = F.filter(F.array(*(F.when(spaced.contains(f" {phrase} "), F.lit(k)) for k, (_, phrase, _) in enumerate(TEMPLATES))), lambda x: x.isNotNull())
    named = F.greatest(*(spaced.contains(f" {phrase} ") for phrase in sorted({phrase for _, phrase, _ in TEMPLATES})))
    base = docs.select(*keep, spaced_words(F.col(text_col)).alias("__spaced"))
    found = base.select(
        *keep,
        word_count(spaced).alias("n_words"),
        *(phrase_places(words, spaced, p).alias(f"__p{k}") for k, p in enumerate(PHRASES)),
        F.array_intersect(words, index_words).alias("__seen"),
        F.when(named, hits).otherwise(nothing).alias("__hits"),
        keyed.alias("__keyed"),
    )
    found = durable(found.withColumn("__row", F.monotonically_increasing_id()))

    counted = found.select(F.explode("__seen").alias("word")).groupBy("word").count().collect()  # a row for each template word at most
    total = found.count()
    weights = {w: log(1 + (1 + total) / (1 + n)) for w, n in counted}
    rare = [sorted(set(t.split()) & weights.keys(), key=lambda w: (-weights[w], w))[:RAREST] for _, _, t in TEMPLATES]
    postings = [(k, i, w, float(weights[w])) for k, (_, _, t) in enumerate(TEMPLATES) for i, w in enumerate(t.split()) if w in rare[k]]
    index = spark.createDataFrame(postings, "template int, place int, word string, weight double")

    hit = found.where(F.size("__keyed") > 0).select("__row", "__keyed", F.explode("__hits").alias("h")).select("__row", F.explode("__keyed").alias("template"), "h.at", "h.word")
    votes = hit.join(F.broadcast(index), ["template", "word"])
    votes = votes.groupBy("__row", "template", (F.col("at") - F.col("place")).alias("shift")).agg(F.sum("weight").alias("voted"))
    whole = F.create_map(*(x for k in range(len(TEMPLATES)) for x in (F.lit(k), F.lit(sum(w for n, _, _, w in postings if n == k)))))
    best = votes.select("__row", "template", F.least(F.lit(1.0), F.col("voted") / whole[F.col("template")]).alias("share")).groupBy("__row")
    names = F.array(*(F.lit(label) for label, _, _ in TEMPLATES))
    best = best.agg(F.max("share").alias("share"), F.collect_set(F.when(F.col("share") >= LEAST_SCORE, F.element_at(names, F.col("template") + 1))).alias("more"))

    places = F.array_sort(F.concat(*(F.col(f"__p{k}") for k in range(len(PHRASES)))))
    labels = F.array_sort(F.filter(F.array(*(F.when(F.size(f"__p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values()))), lambda x: x.isNotNull()))
    out = found.join(best, "__row", "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    score = F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(*keep, "n_words", places.alias("places"), labels.alias("base_labels"), F.array_sort(F.array_union(labels, more)).alias("labels"), score.alias("score"))
