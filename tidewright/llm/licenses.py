"""License notices: fixed phrases, and templates by exact set-similarity join.

Blocks are the paragraphs of a text (parted by blank lines). A block meets a
template when it holds at least `threshold` of the template's distinct words.
The join follows the usual filters, each of them exact:

* tokens are ordered by their count over all documents, rarest first;
* prefix: a pair that meets the threshold shares one of the template's first
  `size - need + 1` tokens;
* length: a block needs at least `need` template tokens;
* position: with a shared token at place p of the template and q of the block,
  the overlap is at most `1 + min(p, q) + min(rest of template, rest of block)`;
* what is left is verified by the full intersection.

Tokens that no template has can't add to an overlap, so blocks keep only the
templates' vocabulary. Everything is built-in expressions; no Python runs on
executors.

Defined cases: null text is empty and has no words; an empty block meets
nothing; repeated rows get equal results; null ids are kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.llm.common import NOT_ALNUM

# Phrases of the scan and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Opening sentences of public license notices.
TEMPLATES = {
    "agpl": "This program is free software you can redistribute it and or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the Apache License Version 2.0 you may not use this file except in compliance "
    "with the License",
    "bsd": "Redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution ShareAlike License",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution License",
    "cc0": "To the extent possible under law the author has waived all copyright and related or neighboring "
    "rights to this work",
    "gpl-notice": "This program is free software you can redistribute it and or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "mit": "Permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved-notice": "Copyright all rights reserved no part of this publication may be reproduced without the "
    "prior written permission of the publisher",
}
THRESHOLD = 0.8
BLANK_LINES = r"\n[ \t\r]*\n"
# Templates are a parameter held in the plan; their words must stay under this.
MAX_TEMPLATE_WORDS = 50_000


def _fold_case(text: Column) -> Column:
    """A-Z in lower case. `lower` makes ASCII letters of two others, which are replaced by another letter first."""
    return F.lower(F.regexp_replace(text, "[\u212A\u0130]", "\u00DF"))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_fold_case(text), NOT_ALNUM), "")


def _places(words: Column, phrase: list[str]) -> Column:
    """Starts, from 0, of all places where the phrase's words stand consecutively."""
    first, *rest = phrase

    def here(word: Column, i: Column) -> Column:
        same = word == first
        for k, other in enumerate(rest, 1):
            same = same & (F.get(words, i + k) == other)
        return F.when(same, i)

    return F.array_compact(F.transform(words, here))


def phrase_scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, text_col: str = "text") -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base_labels (array)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("scan_words", _words(text)).withColumn("scan_fold", F.lower(text))
    none = F.array().cast("array<int>")
    labels, places = [], []
    for phrase, label in phrases.items():
        words = phrase.split()
        # The search runs only where all words of the phrase are in the text.
        there = F.lit(True)
        for word in dict.fromkeys(words):
            there = there & F.contains(F.col("scan_fold"), F.lit(word))
        found = F.when(there, _places(F.col("scan_words"), words)).otherwise(none)
        places.append(found)
        labels.append(label)
    rows = rows.withColumn("scan_places", F.array(*places))
    every = F.flatten(F.col("scan_places"))
    named = F.array_compact(
        F.array(*[F.when(F.size(F.col("scan_places")[i]) > 0, F.lit(label)) for i, label in enumerate(labels)])
    )
    return rows.withColumns(
        {
            "n_words": F.size("scan_words").cast("long"),
            "n_base": F.size(every).cast("long"),
            "first_word": F.array_min(every).cast("long"),
            "last_word": F.array_max(every).cast("long"),
            "base_labels": F.array_sort(F.array_distinct(named)),
        }
    ).drop("scan_words", "scan_fold", "scan_places")


def template_words(templates: Mapping[str, str]) -> dict[str, list[str]]:
    words = {label: sorted(set(text.lower().split())) for label, text in templates.items()}
    words = {label: [w.strip(".,;:()\"") for w in found] for label, found in words.items()}
    words = {label: sorted({p for w in found for p in w.split(".") if p}) for label, found in words.items()}
    if sum(map(len, words.values())) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates exceed MAX_TEMPLATE_WORDS; scan them in parts")
    return words


def blocks(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """One row per paragraph with its words of the vocabulary, in the vocabulary's order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = F.array(*[F.lit(w) for w in vocabulary])
    return (
        docs.select(
            F.col(id_col).alias("of_id"),
            F.xxhash64(F.col(text_col)).alias("of_text"),
            F.explode(F.split(text, BLANK_LINES)).alias("block"),
        )
        .select("of_id", "of_text", F.array_intersect(known, _words(F.col("block"))).alias("tokens"))
        .where(F.size("tokens") > 0)
    )


def template_matches(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(of_id, of_text, template, containment) of every block and template that meet the threshold."""
    spark = docs.sparkSession
    words = template_words(templates)
    vocabulary = sorted({w for found in words.values() for w in found})
    # Rarest first over all documents: in how many blocks each token is.
    counts = blocks(docs, id_col, text_col, vocabulary).select(F.explode("tokens").alias("t")).groupBy("t").count()
    seen = {r.t: r["count"] for r in counts.collect()}
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = []
    for label, found in words.items():
        ranked = sorted(found, key=rank.__getitem__)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        prefixes += [(w, label, p, need, ranked) for p, w in enumerate(ranked[: len(ranked) - need + 1])]
    index = spark.createDataFrame(
        prefixes, "token string, template string, p int, need int, template_tokens array<string>"
    )
    firsts = F.array(*[F.lit(w) for w in sorted({x[0] for x in prefixes})])
    probes = (
        blocks(docs, id_col, text_col, order)
        .where(F.arrays_overlap("tokens", firsts))
        .select("of_id", "of_text", "tokens", F.posexplode("tokens").alias("q", "token"))
    )
    t, b = F.size("template_tokens"), F.size("tokens")
    pairs = (
        # Bounded by MAX_TEMPLATE_WORDS.
        probes.join(F.broadcast(index), "token")
        .where(b >= F.col("need"))
        .where(1 + F.least("p", "q") + F.least(t - 1 - F.col("p"), b - 1 - F.col("q")) >= F.col("need"))
    )
    overlap = F.size(F.array_intersect("tokens", "template_tokens"))
    return (
        pairs.select("of_id", "of_text", "template", "need", overlap.alias("overlap"), t.alias("size"))
        .where("overlap >= need")
        .select("of_id", "of_text", "template", (F.col("overlap") / F.col("size")).alias("containment"))
    )


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: Mapping[str, str] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Phrase places and template labels of every document.

    `score` is 1 where a phrase stands, else the largest containment of a
    template that meets the threshold, else 0.
    """
    base = phrase_scan(docs.select(id_col, text_col), phrases, text_col).withColumn(
        "of_text", F.xxhash64(F.col(text_col))
    )
    matched = (
        template_matches(docs, templates, threshold, id_col, text_col)
        .groupBy("of_id", "of_text")
        .agg(F.collect_set("template").alias("found"), F.max("containment").alias("containment"))
    )
    own = base.drop(text_col).withColumnRenamed("of_text", "own_text")
    joined = own.join(
        matched, F.col(id_col).eqNullSafe(F.col("of_id")) & F.col("own_text").eqNullSafe(F.col("of_text")), "left"
    )
    found = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    return joined.select(
        id_col,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        F.array_sort(F.array_union("base_labels", found)).alias("labels"),
        F.greatest(
            F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("containment", F.lit(0.0))
        ).alias("score"),
    )
