"""License scans: exact phrase places, and an exact set-similarity join of text blocks with templates.

DataFrame operations only. A template's blocks are the windows of ``1 / threshold`` times its length in words, at
every place of the text and across its line breaks. The templates' words are put in order of their frequency over
the whole table, rarest first. A window that holds at least the threshold of a template's words must hold one of
the template's first ``size - need + 1`` words (prefix filter), so only the windows around such a word are looked
at, and only where the words within reach of it are enough (length filter) and enough of the ordered words from
their first match on (positional filter); what passes is counted exactly, window by window. Of a template of fewer
than ten words the words of its label's name must be there. The template side is a fixed list, so it stands in the
plan and the documents need no shuffle.

Defined results: a null or empty text has no words, labels '' and score 0; repeated rows are scanned alike;
very long texts are read whole; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.llm.shared import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: phrase -> label
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Usual licence notices, one text block each.
TEMPLATES = {
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


SHORT = 10                       # words; a template of fewer needs those of its label's name


def all_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def words_of(text: str) -> list[str]:
    return list(dict.fromkeys(all_words(text)))


def label_words(label: str, template: list[str]) -> list[str]:
    """The words that a block must hold: of a short template those of the label's name."""
    return [w for w in words_of(label) if w in template] if len(template) < SHORT else []


def tokens(text: Column) -> Column:
    """The words in order: what stands between runs of other characters."""
    return F.array_remove(F.split(lower_ascii(text), BETWEEN, -1), "")


def literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def frequency_order(docs: DataFrame, text_col: str, vocabulary: list[str]) -> list[str]:
    """The templates' words by the documents that hold them, rarest first (their number bounds what reaches the driver)."""
    held = F.explode(F.array_intersect(literal(vocabulary), tokens(F.col(text_col))))
    counts = {r["w"]: r["n"] for r in docs.select(held.alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Word indexes at which the phrase's words stand one after another."""
    own = phrase.split(" ")
    ends = F.filter(F.transform(words, lambda w, i: F.when(w == own[-1], i - (len(own) - 1))), lambda i: i.isNotNull())
    return F.filter(ends, lambda i: F.coalesce(F.forall(
        F.array(*(F.get(words, i + k) == w for k, w in enumerate(own[:-1]))), lambda x: F.coalesce(x, F.lit(False))),
        F.lit(False)))


def containment(block: Column, order: Column, template: list[str], threshold: float) -> Column:
    """Part of the template's words that the block (its distinct words) holds, 0 where it is under the threshold."""
    need = math.ceil(threshold * len(template) - 1e-9)
    prefix = template[:len(template) - need + 1]
    known = F.array_intersect(order, block)                         # the block's known words, rarest first
    first = F.array_intersect(literal(prefix), block)[0]            # its first match in the template's order
    left_in_template = len(template) + 1 - F.array_position(literal(prefix), first)
    left_in_block = F.size(known) + 1 - F.array_position(known, first)
    common = F.size(F.array_intersect(literal(template), block))
    return F.when((F.size(block) >= need) & F.arrays_overlap(block, literal(prefix)), F.when(
        F.least(left_in_template, left_in_block) >= need, F.when(common >= need, common / len(template)))).otherwise(None)


def _placed(label: Column):
    return lambda i: F.struct(i.cast("int").alias("start"), label)


def window_matches(words: Column, anchors: Column, order: Column, label: str, template: list[str], length: int,
                   threshold: float) -> Column:
    """(start, block, label, part) of the first best window around each anchor that is in the template's prefix."""
    prefix = template[:len(template) - math.ceil(threshold * len(template) - 1e-9) + 1]
    needed = label_words(label, template)

    def part(first: Column, size: Column) -> Column:
        block = F.array_distinct(F.slice(words, first + 1, size))
        held = containment(block, order, template, threshold)
        return F.when(F.size(F.array_intersect(literal(needed), block)) == len(needed), held) if needed else held

    def best(i: Column) -> Column:
        first = F.greatest(i - (length - 1), F.lit(0))
        places = F.filter(F.sequence(first, i), lambda s: F.get(words, s).isin(template))
        parts = F.transform(places, lambda s: F.struct(part(s, F.lit(length)).alias("part"), (-s).alias("back")))
        return F.when(part(first, i - first + length).isNotNull(), F.array_max(F.filter(parts, lambda p: p["part"].isNotNull())))

    found = F.transform(F.filter(anchors, lambda i: F.get(words, i).isin(prefix)), best)
    return F.transform(F.array_distinct(F.filter(found, lambda m: m.isNotNull())), lambda m: F.struct(
        (-m["back"]).cast("int").alias("start"), F.array_join(F.slice(words, 1 - m["back"], length), " ").alias("block"),
        F.lit(label).alias("label"), m["part"].alias("part")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] | None = None,
         templates: Mapping[str, list[str]] | None = None, threshold: float = 0.8) -> DataFrame:
    """One row per document: word and phrase counts, places, labels, score and the windows that matched."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    sets = [(label, words_of(t)) for label, texts in templates.items() for t in texts]
    lengths = [math.ceil(len(all_words(t)) / threshold) for texts in templates.values() for t in texts]
    order = frequency_order(docs, text_col, sorted({w for _, own in sets for w in own}))
    rank = {w: i for i, w in enumerate(order)}
    sets = [(label, sorted(own, key=rank.get)) for label, own in sets]
    firsts = sorted({w for _, own in sets for w in own[:len(own) - math.ceil(threshold * len(own) - 1e-9) + 1]})
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col), tokens(text).alias("words"))

    def places(words: Column) -> Column:
        each = [(phrase_starts(words, p), F.lit(label).alias("label")) for p, label in phrases.items()]
        return F.concat(*(F.transform(at, _placed(label)) for at, label in each))

    anchors = F.filter(F.transform("words", lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    matches = F.concat(*(window_matches(F.col("words"), F.col("anchors"), literal(order), label, own, length, threshold)
                         for (label, own), length in zip(sets, lengths, strict=True)))
    seen = F.struct(places(F.col("words")).alias("base"), matches.alias("matches"))
    nothing = F.struct(F.array().cast("array<struct<start:int,label:string>>").alias("base"),
                       F.array().cast("array<struct<start:int,block:string,label:string,part:double>>").alias("matches"))
    hit = F.arrays_overlap("words", literal(sorted({*firsts, *(p.split(" ")[-1] for p in phrases)})))
    slim = slim.withColumn("anchors", F.when(F.arrays_overlap("words", literal(firsts)), anchors).otherwise(F.array().cast("array<int>")))
    found = slim.select(id_col, F.size("words").cast("long").alias("n_words"), F.when(hit, seen).otherwise(nothing).alias("seen"))
    found = found.select(id_col, "n_words", "seen.*")
    starts, base = F.col("base.start"), F.array_distinct(F.col("base.label"))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("matches.part")), F.lit(0.0)))
    return found.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("matches.label"))), ",").alias("labels"),
        score.alias("score"), "matches")
