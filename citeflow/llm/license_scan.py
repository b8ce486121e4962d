"""License texts in documents, by diagonal voting; DataFrame operations only.

Every rolling pair of words of every document is joined by its hash with the pairs of the
templates (the pair itself is compared too, so a match is exact). A matching pair votes for the
diagonal on which it lies: its place in the document less its place in the template. A template
that stands in a text word for word gives all its votes to one diagonal. Inserted or missing
words move the rest to neighbouring diagonals, which are merged; the votes of a merged group are
the distinct pairs of the template that it holds.

Phrases count where all their pairs are on one diagonal. Longer templates count from ``MIN_SHARE``
of their pairs.

Defined results: a null or empty text has no words and no labels; repeated rows give the same
result each; an empty table gives an empty table. Texts are told apart by id and a hash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 2
# Diagonals of at least so many votes, at most so far apart, are merged.
MIN_VOTES = 3
MAX_SHIFT = 3
MIN_SHARE = 0.6
# Templates are broadcast; so many pairs are about one megabyte.
MAX_PAIRS = 20_000


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False


#: Phrases counted place by place.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
#: Sentences of well-known licenses, in lower case without punctuation.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files the software to deal in the software without restriction"),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except "
             "in compliance with the license"),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the "
             "license is distributed on an as is basis without warranties or conditions of any kind"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)

_BREAK = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# lower() works on all letters. Only the Kelvin sign becomes an ASCII letter on its own, so it is
# put out of the way; other letters than A-Z stand in no template.
_WORDS = (
    r"array_remove(split(lower(replace(coalesce(text, ''), 'K', 'ĸ')), "
    f"'{_BREAK}', -1), '')"
)


def template_pairs(templates: tuple[Template, ...]) -> list[tuple]:
    """``template, place, pair`` of all templates."""
    pairs = []
    for number, template in enumerate(templates):
        words = template.text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {template}")
        pairs += [(number, at, f"{a} {b}") for at, (a, b) in enumerate(zip(words, words[1:]))]
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"at most {MAX_PAIRS} pairs")
    return pairs


def _votes(keyed: DataFrame, spark: SparkSession, pairs: list[tuple]) -> DataFrame:
    """``doc_id, h, template, diagonal, seen``: the template's places found on each diagonal."""
    listed = F.array(*(F.struct(F.lit(t).alias("template"), F.lit(at).alias("place"), F.lit(p).alias("pair"))
                       for t, at, p in pairs))
    wanted = spark.range(1).select(F.inline(listed)).withColumn("code", F.xxhash64("pair"))
    worded = keyed.select("doc_id", "h", F.expr(_WORDS).alias("w"))
    rolled = worded.select("doc_id", "h", F.posexplode(F.expr(
        "CASE WHEN size(w) > 1 THEN transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1])) "
        "ELSE array() END"
    )).alias("at", "pair")).withColumn("code", F.xxhash64("pair"))
    met = rolled.join(F.broadcast(wanted), ["code", "pair"])
    return met.groupBy("doc_id", "h", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("seen")  # no larger than the template
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row.

    ``score`` is the largest share of a template's pairs found together: 1 where a phrase stands.
    """
    spark = docs.sparkSession
    templates = (*phrases, *notices)
    pairs = template_pairs(templates)
    sizes = [len(t.text.split()) - 1 for t in templates]
    size = F.element_at(F.array(*map(F.lit, sizes)), F.col("template") + 1)
    label = F.element_at(F.array(*(F.lit(t.label) for t in templates)), F.col("template") + 1)

    body = F.col(f"`{text}`")
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"))
    votes = _votes(keyed, spark, pairs)
    is_phrase = F.col("template") < len(phrases)
    useful = votes.where(F.when(is_phrase, F.size("seen") == size).otherwise(
        F.size("seen") >= F.least(F.lit(MIN_VOTES), size)))
    # Within a document and template: a new group where the next diagonal is not near. Every
    # place of a phrase is a group of its own.
    along = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    marked = useful.withColumn("new", F.when(is_phrase | gap.isNull() | (gap > MAX_SHIFT), 1).otherwise(0))
    merged = marked.withColumn("part", F.sum("new").over(along)).groupBy(
        "doc_id", "h", "template", "part").agg(
        F.min("diagonal").alias("start"), F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("n"),
    ).withColumn("share", F.col("n") / size)
    found = merged.groupBy("doc_id", "h").agg(
        F.count(F.when(is_phrase, 1)).alias("n_base"),
        F.min(F.when(is_phrase, F.col("start"))).alias("first_word"),
        F.max(F.when(is_phrase, F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(is_phrase, label))).alias("base"),
        F.array_sort(F.collect_set(F.when(F.col("share") >= MIN_SHARE, label))).alias("all"),
        F.max("share").alias("share"),
    )
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0))
    rows = keyed.select("doc_id", "h", n_words.cast("long").alias("n_words"))
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["h"] == found["h"])
    return rows.join(found, same, "left").select(
        rows["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )
