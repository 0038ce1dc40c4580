"""License scan: fixed phrases by consecutive words, and an exact set-similarity join with templates.

The join finds every block of text (a sentence or a paragraph, over all its lines) that holds at least
``CONTAINMENT`` of a template's distinct words, so a notice counts however its lines are wrapped.  Template words are ordered by how many documents hold them, rarest first,
over the whole corpus.  A block can only qualify if it has one of the first ``size - needed + 1`` words
of a template in that order (prefix filter) and at least ``needed`` template words at all (length filter),
and if enough words remain on both sides after a first shared one (positional filter).  What passes is
counted exactly.

All is DataFrame work.  The template table is a constant of this module and is the only thing
broadcast; blocks are exploded and filtered inside the scan, so only hits are shuffled, and hot
documents or sources play no role.

Defined results: a null text is an empty one: no words, no labels, score 0.  Repeated rows all get
their own row.  Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: phrases and the labels they give
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CONTAINMENT = 0.9
# the end of a sentence, or a blank line; a single newline ends nothing
BLOCK_END = r"[.!?][ \t\r\n]+|\n[ \t\r]*\n"
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc",
    "cc-by-sa": "licensed under cc by sa",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl": "under the terms of the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "subject to the terms of the mozilla public license",
    "rights-notice": "all rights reserved",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
VOCABULARY = sorted({w for t in TEMPLATES.values() for w in t.split()})
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ``lower`` is the faster way where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))


def spaced(low: Column) -> Column:
    """The words with one space before and after each, or a single space."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, F.lit(SEPARATORS), F.lit(" "))), F.lit(" "))


def spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_columns(words: Column, n_words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word, base_labels for texts given as ``spaced``."""
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        needle = f" {phrase} "
        there = words.contains(needle)
        again = F.lit(f" {phrase}(?= )")  # the space behind may begin the next place
        tail = F.element_at(F.split(words, again), -1)
        places.append(F.when(there, F.regexp_count(words, again)).otherwise(0))
        firsts.append(F.when(there, spaces(F.left(words, F.instr(words, F.lit(needle)))) - 1))
        lasts.append(F.when(there, n_words - (spaces(tail) - 1) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return {
        "n_base": sum(places[1:], places[0]).cast("long"),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "base_labels": F.array_compact(F.array(*labels)),
    }


def template_order(docs: DataFrame) -> dict[str, int]:
    """Rank of each template word by the number of documents that hold it, over all documents."""
    words = F.split(spaced(lowered(F.col("text"))), " ")
    held = docs.select(F.explode(F.array_intersect(words, F.array(*map(F.lit, VOCABULARY)))).alias("word"))
    counted = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(VOCABULARY, key=lambda w: (counted.get(w, 0), w)))}


def contained(keyed: DataFrame, keys: list[str], order: dict[str, int], threshold: float = CONTAINMENT) -> DataFrame:
    """Per key with a hit: the template labels and the best containment.  ``keyed`` has keys and low (text)."""
    spark = keyed.sparkSession
    prefixes = []
    for label, text in TEMPLATES.items():
        ranks = sorted({order[w] for w in text.split()})
        needed = math.ceil(threshold * len(ranks) - 1e-9)
        prefixes += [(ranks[i], label, i, len(ranks), needed, ranks) for i in range(len(ranks) - needed + 1)]
    index = spark.createDataFrame(prefixes, "word int, label string, place int, size int, needed int, ranks array<int>")
    word_of = {rank: word for word, rank in order.items()}
    first_words = sorted({word_of[p[0]] for p in prefixes})
    least = min(p[4] for p in prefixes)
    rank = F.create_map(*[F.lit(x) for w in VOCABULARY for x in (w, order[w])])
    hopeful = keyed.filter(F.col("low").rlike("|".join(first_words)))
    blocks = hopeful.select(*keys, F.explode(F.split("low", BLOCK_END)).alias("block")).filter(F.col("block").rlike("|".join(first_words)))
    held = F.array_intersect(F.split(spaced(F.col("block")), " "), F.array(*map(F.lit, VOCABULARY)))
    ranked = blocks.select(*keys, F.array_sort(F.transform(held, lambda w: F.element_at(rank, w))).alias("own"))
    ranked = ranked.filter(F.size("own") >= least)
    met = ranked.select(*keys, "own", F.posexplode("own").alias("at", "word")).join(F.broadcast(index), "word")
    met = met.filter(F.size("own") >= F.col("needed")).filter(
        1 + F.least(F.col("size") - F.col("place") - 1, F.size("own") - F.col("at") - 1) >= F.col("needed")
    )
    share = F.size(F.array_intersect("own", "ranks")) / F.col("size")
    hits = met.withColumn("share", share).filter(F.size(F.array_intersect("own", "ranks")) >= F.col("needed"))
    # at most one entry per template
    return hits.groupBy(*keys).agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))


def scan(docs: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    docs = docs.select("doc_id", "text")
    order = template_order(docs)
    low = docs.select("doc_id", F.xxhash64("text").alias("__text"), lowered(F.col("text")).alias("low"))
    words = low.select("doc_id", "__text", spaced(F.col("low")).alias("words"))
    counted = words.withColumn("n_words", F.when(F.col("words") == "  ", 0).otherwise(spaces(F.col("words")) - 1).cast("long"))
    based = counted.withColumns(phrase_columns(F.col("words"), F.col("n_words"))).drop("words")
    # rows of one id and text share their hits
    hits = contained(low, ["doc_id", "__text"], order, threshold).select(
        F.col("doc_id").alias("__doc"), F.col("__text").alias("__hit"), "found", "share"
    )
    joined = based.join(hits, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__hit")), "left")
    every = F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
