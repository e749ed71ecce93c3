"""License scan: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of BLOCK_WORDS words; windows start every BLOCK_WORDS / 2 words. A template meets a block
when the block has THRESHOLD of the template's distinct words or more. Only words of some template can
count, so documents are cut down to these words and their places once, and that small table is staged.
Their counts over all documents give the global order, rarest first. By the threshold, a block that meets
a template shares one of the template's first words in that order (prefix filter), holds enough
template words at all (length filter), and has enough of them from the shared word on (positional
filter). What is left is compared exactly. A block that lacks a template's required words, those that name
the license, its version or its terms, doesn't meet it; and of templates of one family, a block meets those it
has most words of, so a name that holds another one's words counts alone.

Templates and the order of their words are a short list, an argument, so joins with them are
broadcast; nothing that grows with the corpus is.

Defined cases: a null text counts as empty, with no words and a score of 0; every row gets its own
result row, repeated ones and null doc_ids too; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, ascii_lower, text_key, whole_text

# fixed values: the contract's words, phrases and labels
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# fixed values: family, label, required words, and opening or granting sentence of public licenses
TEMPLATES = (
    ("mit", "mit", "mit", "Released under the MIT License"),
    ("mit", "mit", "permission hereby granted charge software",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction"),
    ("apache", "apache-2", "apache 2", "Licensed under the Apache License, Version 2.0"),
    ("apache", "apache-2", "file compliance obtain",
     "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gnu", "gpl-2", "gnu general public 2", "This work is licensed under the GNU General Public License, version 2"),
    ("gnu", "gpl-2", "gnu general public 2",
     "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 2 of the License, or any later version"),
    ("gnu", "gpl-3", "gnu general public 3", "This work is licensed under the GNU General Public License, version 3"),
    ("gnu", "gpl-3", "gnu general public 3",
     "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or any later version"),
    ("gnu", "lgpl-2", "gnu lesser general public 2",
     "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
     "either version 2.1 of the License, or any later version"),
    ("gnu", "lgpl-3", "gnu lesser general public 3",
     "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or any later version"),
    ("gnu", "agpl-3", "gnu affero general public 3",
     "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or any later version"),
    ("bsd", "bsd", "redistribution source binary conditions",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("mpl", "mpl-2", "mozilla 2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc", "cc-by", "creative commons attribution",
     "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc", "cc-by-nc", "creative commons attribution noncommercial",
     "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc", "cc-by-sa", "creative commons attribution sharealike",
     "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc", "cc-by-nc-sa", "creative commons attribution noncommercial sharealike",
     "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc0", "cc0", "dedicated public domain", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "unlicense", "unencumbered domain", "This is free and unencumbered software released into the public domain"),
    ("reserved", "reserved", "reproduced permission publisher",
     "No part of this publication may be reproduced, distributed, or transmitted in any form without the "
     "prior written permission of the publisher"),
)

THRESHOLD = 0.8
BLOCK_WORDS = 64
STEP = BLOCK_WORDS // 2
TEMPLATE_WORD = re.compile(r"[0-9a-z]+")


class Template(NamedTuple):
    number: int
    family: str
    label: str
    words: list[str]
    required: list[str]


def template_sets(templates=TEMPLATES) -> list[Template]:
    """Distinct and required words of each (family, label, required words, text)."""
    words = lambda text: sorted(set(TEMPLATE_WORD.findall(text.lower())))
    return [Template(i, family, label, words(text), words(required)) for i, (family, label, required, text) in enumerate(templates)]


def least_overlap(n_words: int, threshold: float) -> int:
    return math.ceil(round(threshold * n_words, 9))


def template_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, row, n_words, and of the words that the vocabulary has an array of (place, word)."""
    texts = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id", text_key(F.col("text")).alias("row"), ascii_lower(F.col("text")).alias("text")
    )
    words = texts.select("doc_id", "row", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word")))
    hits = F.filter(placed, lambda x: x["word"].isin(vocabulary))
    return words.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def phrase_places(hits: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other."""
    words = phrase.split()

    def begins(hit: Column, i: Column) -> Column:
        out = hit["word"] == words[0]
        for k, word in enumerate(words[1:], 1):
            later = F.get(hits, i + k)
            out = out & (F.coalesce(later["word"], F.lit("")) == word) & (later["place"] == hit["place"] + k)
        return F.coalesce(out, F.lit(False))

    return F.transform(F.filter(hits, begins), lambda hit: hit["place"])


def template_matches(rows: DataFrame, templates: list[Template], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row, label and containment of each (block, template) pair that meets the threshold and has the
    template's required words, the pairs of most overlap of each block and family."""
    spark = rows.sparkSession
    counted = rows.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in counted.collect()}  # at most the vocabulary
    vocabulary = sorted({w for t in templates for w in t.words}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(vocabulary)}

    prefixes, sets = [], []
    for t in templates:
        ordered, least = sorted(rank[w] for w in t.words), least_overlap(len(t.words), threshold)
        sets.append((t.number, t.family, t.label, ordered, [rank[w] for w in t.required], least))
        prefixes += [(r, t.number, i, len(ordered), least) for i, r in enumerate(ordered[: len(ordered) - least + 1])]
    index = spark.createDataFrame(prefixes, "word int, template int, t_at int, t_size int, least int")
    whole = spark.createDataFrame(sets, "template int, family string, label string, t_words array<int>, required array<int>, least int")

    first_words = [vocabulary[r] for r in sorted({p[0] for p in prefixes})]
    seeds = F.filter("hits", lambda x: x["word"].isin(first_words))
    windows = F.array_distinct(F.flatten(F.transform(seeds, lambda x: F.array(
        F.floor(x["place"] / STEP), F.greatest(F.floor(x["place"] / STEP) - 1, F.lit(0).cast("long"))
    ))))
    blocks = rows.select("doc_id", "row", "hits", F.explode(windows).alias("window"))
    inside = F.filter(
        "hits", lambda x: (x["place"] >= F.col("window") * STEP) & (x["place"] < F.col("window") * STEP + BLOCK_WORDS)
    )
    order = F.array([F.lit(w) for w in vocabulary])
    ranks = F.transform(F.array_distinct(F.transform(inside, lambda x: x["word"])), lambda w: F.array_position(order, w).cast("int") - 1)
    blocks = blocks.select("doc_id", "row", "window", F.array_sort(ranks).alias("b_words"))
    # length filter for the least demanding template, then the block's own prefix
    least_of_all = min(least for *_, least in sets)
    blocks = blocks.filter(F.size("b_words") >= least_of_all)
    opened = blocks.select("*", F.posexplode(F.slice("b_words", F.lit(1), F.size("b_words") - least_of_all + 1)).alias("b_at", "word"))
    candidates = opened.join(F.broadcast(index), "word").filter(
        (F.size("b_words") >= F.col("least"))
        & (F.least(F.col("t_size") - F.col("t_at"), F.size("b_words") - F.col("b_at")) >= F.col("least"))
    )
    # a pair is met at its first shared word only: no earlier word of the block is in the template
    compared = candidates.join(F.broadcast(whole.drop("least")), "template").filter(
        F.size(F.array_intersect(F.slice("b_words", F.lit(1), F.col("b_at")), "t_words")) == 0
    )
    overlap = F.size(F.array_intersect("b_words", "t_words"))
    has_required = F.size(F.array_except("required", "b_words")) == 0
    met = compared.withColumn("overlap", overlap).filter((F.col("overlap") >= F.col("least")) & has_required)
    most = F.max("overlap").over(Window.partitionBy("doc_id", "row", "window", "family"))
    return met.withColumn("most", most).filter("overlap = most").select(
        "doc_id", "row", "label", (F.col("overlap") / F.col("t_size")).alias("containment")
    )


def scan_licenses(docs: DataFrame, texts=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for each row of docs.

    texts are (family, label, required words, text), the required words words of the text.
    """
    templates = template_sets(texts)
    vocabulary = sorted({w for t in templates for w in t.words} | {w for p in PHRASES.values() for w in p.split()})
    scratch = Scratch(docs.sparkSession, "license-scan")
    rows = scratch.stage("words", template_words(docs, vocabulary))
    met = (
        template_matches(rows, templates, threshold).groupBy("doc_id", "row")
        .agg(F.collect_set("label").alias("met"), F.max("containment").alias("containment"))
        .withColumnsRenamed({"doc_id": "m_id", "row": "m_row"})
    )  # a set of labels has no more members than the template list
    places = rows.select(
        "doc_id", "row", "n_words", *(phrase_places(F.col("hits"), p).alias(f"at_{i}") for i, p in enumerate(PHRASES.values()))
    )
    found = places.join(
        met, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("row") == F.col("m_row")), "left"
    )
    at = [f"at_{i}" for i in range(len(PHRASES))]
    base = F.array_compact(F.array(*(F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, PHRASES))))
    named = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    all_places = F.concat(*at)
    none = F.array().cast("array<string>")
    return found.select(
        "doc_id", "n_words", F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
        named(base).alias("base_labels"),
        named(F.concat(base, F.coalesce("met", none))).alias("labels"),
        F.when(F.size(all_places) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
