"""License scans by diagonal voting, in DataFrame functions only.

All rolling word 3-grams of all documents are hash-joined to the positions they have in license templates.  A copy of a
template makes hits whose document position less template position is constant, a diagonal: votes are counted there,
neighbouring diagonals (words put in or left out) are merged, and each merged span is verified: its hits must follow each
other in the template's order, word by word, and cover enough different places of it.  Short templates
are phrases and must vote whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import none_as_empty, stored

#: What parts the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
_SIGN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN = rf"{_SIGN}++"
#: Words of a gram; diagonals merged at most so far apart; share of a long template's grams that must vote.
GRAM, GAP, COVERAGE = 3, 3, 0.6
#: Templates of up to so many words are phrases.
PHRASE = 8

# The contract's phrases, then well-known license names and openings of license texts.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3", "bsd 3 clause"),
    ("bsd-2", "bsd 2 clause"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal"),
)


def words(text: str = "text") -> Column:
    """The words of a text: what stands between separators, without the empty ends (a split is linear in the text, while
    extracting all matches copies the text for each)."""
    lower = F.translate(none_as_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(lower, rf"\A{BETWEEN}|(?<!{_SIGN}){BETWEEN}\z", ""), BETWEEN)


def _grams(w: str) -> Column:
    """Hashes of all rolling grams of an array of words."""
    gram = ", ".join(f"{w}[i + {j}]" for j in range(GRAM))
    return F.expr(f"CASE WHEN size({w}) >= {GRAM} THEN transform(sequence(0, size({w}) - {GRAM}), i -> xxhash64({gram})) ELSE cast(array() AS array<bigint>) END")


def _templates(spark: SparkSession, base: tuple, more: tuple) -> DataFrame:
    """(template, label, base, length, place, gram), a few hundred rows at most: bounded by the parameters."""
    rows = [(i, label, i < len(base), phrase) for i, (label, phrase) in enumerate((*base, *more))]
    if short := [phrase for *_, phrase in rows if len(phrase.split()) < GRAM]:
        raise ValueError(f"templates of fewer than {GRAM} words: {short}")
    values = ", ".join(f"({i}, '{label}', {str(of_base).lower()}, '{phrase}')" for i, label, of_base, phrase in rows)
    out = spark.sql(f"SELECT template, label, base, split(phrase, ' ') AS w FROM VALUES {values} AS t(template, label, base, phrase)")
    return out.select("template", "label", "base", F.size("w").alias("length"), F.posexplode(_grams("w")).alias("place", "gram"))


#: Of the hits of a span, by place in the template: a step back in the document, or one that drifts by more than GAP words,
#: is no part of it.  `n` counts the places that follow each other, `at` is where the last of them stands.
_CHAIN = f"""aggregate(hits, named_struct('n', 0, 'place', -1, 'at', -1, 'start', -1), (s, x) ->
  IF(s.n = 0, named_struct('n', 1, 'place', x.place, 'at', x.at, 'start', x.at),
  IF(x.place > s.place AND x.at > s.at AND abs((x.at - s.at) - (x.place - s.place)) <= {GAP}, named_struct('n', s.n + 1, 'place', x.place, 'at', x.at, 'start', s.start), s)))"""


def scan(docs: DataFrame, base: tuple = BASE, more: tuple = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts all places where a base phrase stands, overlapping ones too; first_word and last_word are their least
    and greatest first words, or null.  labels also has those of the other templates; spans lists (label, start, end,
    score) of all, words from 0, end exclusive; score is the best of them, 0 without any.  A null text is empty; rows
    equal in doc_id and text get equal results, as do rows without a doc_id; other columns are ignored; an empty table
    gives an empty result.  Grams are compared by 64-bit hashes: even over 10**14 words a chance match with any template
    has a probability below one in a hundred.
    """
    spark = docs.sparkSession
    templates = _templates(spark, base, more)
    # the hashes of the templates, bounded by the parameters, keep all other grams out of the join
    known = ", ".join(f"{r[0]}L" for r in templates.select("gram").distinct().collect())
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), words().alias("w"))
    rows = rows.withColumn("w", F.when(F.get("w", F.lit(0)) != "", F.col("w")).otherwise(F.expr("cast(array() AS array<string>)")))
    rows = rows.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(_grams("w")).alias("at", "gram"))
    hit, first = F.expr(f"gram IN ({known})"), F.coalesce("at", F.lit(0)) == 0
    # the one pass over the texts; what it leaves is narrow: the hits, and a first row for each text
    rows = rows.filter(hit | first).select("doc_id", "h", "n_words", first.alias("first"), "at", F.when(hit, F.col("gram")).alias("gram"))
    rows = stored(rows, "grams")
    grams = rows.filter("gram is not null").select("doc_id", "h", "gram", "at")
    hits = grams.join(templates, "gram").select("doc_id", "h", "template", "label", "base", "length", "at", "place", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    key = ["doc_id", "h", "template", "label", "base", "length"]
    votes = hits.groupBy(*key, "diagonal").agg(F.count("*").alias("votes"), F.collect_list(F.struct("place", "at")).alias("hits"))
    need = F.col("length") - (GRAM - 1)

    # a phrase stands on one diagonal; a long template's neighbouring diagonals make one span
    along = W.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    apart = (F.col("length") <= PHRASE) | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(True))
    spans = (
        votes.withColumn("run", F.sum(apart.cast("int")).over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .groupBy(*key, "run")
        .agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
        .withColumn("c", F.expr(_CHAIN))
        .withColumn("score", F.col("c.n") / need)
        .filter(F.col("score") >= F.when(F.col("length") <= PHRASE, 1.0).otherwise(coverage))
        .withColumn("start", F.col("c.start"))
        .withColumn("end", F.col("c.at") + GRAM)
    )
    of_base = F.col("base") & (F.col("c.n") == need)
    found = spans.groupBy("doc_id", "h").agg(
        F.count_if(of_base).alias("n_base"), F.min(F.when(of_base, F.col("start"))).alias("first_word"), F.max(F.when(of_base, F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(of_base, F.col("label")))).alias("base_labels"), F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"), F.array_sort(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans"),
    ).select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
    out = rows.filter("first").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce(F.array_join("base_labels", ","), F.lit("")).alias("base_labels"), F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", F.expr("cast(array() AS array<struct<start:int,end:int,label:string,score:double>>)")).alias("spans"),
    )
