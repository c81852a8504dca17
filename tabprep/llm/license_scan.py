"""License scan by an exact set-similarity join (native).

Base: places where the words of a fixed phrase stand consecutively. The
method finds, for every template (a licence notice as a set of words), each
text block that holds at least ``THRESHOLD`` of the template's words. Blocks
are windows of ``2 * SPAN`` words every ``SPAN`` words over the whole text,
so any ``SPAN`` consecutive words lie in one block; templates have at most
``SPAN`` words.

1. Template words are ordered by the number of documents of the whole corpus
   that hold them, rarest first (ties by the word).
2. Prefix filter: a block that holds ``need`` of a template's ``size`` words
   holds one of its ``size - need + 1`` rarest. Documents without any such
   word are done; only the others are cut into blocks.
3. A block's template words, in the same order, look up the prefix index:
   word -> (template, position, size, need).
4. Length filter: the block has at least ``need`` words of that order.
   Positional filter: after a common word at place j of the block and i of the
   template, 1 + min(size - i, rest of the block) words can still be common.
5. What is left is verified by intersecting the two sets.

Templates are a parameter of bounded size, so the index is a literal of the
plan: a document meets it where it is read, and no row is shuffled, whatever
the corpus repeats. Only words' document counts are aggregated.

Contracts: A-Z count as lower case; a null or empty text has no words and no
labels; repeated rows and null doc_ids are scanned each; an empty table gives
none; a label found several times is listed once; other columns pass
untouched (one named ``lic`` is replaced).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9
SPAN = 48
#: Runs of word characters, before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases of the base rule and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Public licence notices and the label that each stands for.
#: Up to nine different words must all occur, so short ones tell versions apart.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("gpl-2", "GNU General Public License, version 2"),
    ("gpl-3", "GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]


def words(text: str) -> list[str]:
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(WORD, low)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # distinct, rarest first
    need: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[:len(self.words) - self.need + 1]


def corpus_words(text: Column) -> Column:
    """A text's words; A-Z lower case, all other characters as they are."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, GAP), lambda w: w != "")


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def fit(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> tuple[list[Template], dict]:
    """(templates with their words rarest first, documents per word); the
    counts read every document, and a row per template word reaches the
    driver."""
    sets = [(label, sorted(set(words(text)))) for label, text in (TEMPLATES if templates is None else templates)]
    sets = [(label, w) for label, w in sets if w]
    if any(len(w) > SPAN for _, w in sets):
        raise ValueError(f"a template has more than {SPAN} different words")
    known = sorted({x for _, w in sets for x in w})
    held = docs.select(F.explode(F.array_intersect(corpus_words(F.col("text")), _array(known))).alias("w"))
    count = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [Template(label, tuple(sorted(w, key=lambda x: (count.get(x, 0), x))), max(1, math.ceil(threshold * len(w) - 1e-9))) for label, w in sets], count


def _places(ws: Column, phrase: str, label: str) -> Column:
    """First words of the places of a phrase, with its label; only where its
    first word stands are the others compared."""
    parts = phrase.split(" ")

    def begins(x: Column) -> Column:
        return (x["w"] == parts[0]) & (F.array_join(F.slice(ws, x["i"] + 1, len(parts)), " ") == phrase)

    numbered = F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    at = F.transform(F.filter(numbered, begins), lambda x: F.struct(x["i"].cast("long").alias("at"), F.lit(label).alias("label")))
    return F.when(F.array_contains(ws, parts[0]), at).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def scan(docs: DataFrame, model: tuple, phrases=None) -> DataFrame:
    """``docs`` and a struct ``lic``: n_words, places (first words of base
    phrases with their label) and found (template label, block, score) of every
    block that reaches a template's threshold."""
    templates, count = model
    phrases = PHRASES if phrases is None else phrases
    ordered = sorted({w for t in templates for w in t.words}, key=lambda x: (count.get(x, 0), x))
    entries: dict[str, list] = {}
    for k, t in enumerate(templates):
        for i, w in enumerate(t.prefix):
            entries.setdefault(w, []).append((k, i, len(t.words), t.need))
    entry = lambda e: F.struct(*[F.lit(v).alias(c) for c, v in zip(("t", "i", "size", "need"), e, strict=True)])
    # one entry per prefix word at least, or an empty index
    index = F.create_map(*[x for w, es in entries.items() for x in (F.lit(w), F.array(*[entry(e) for e in es]))]) if entries else None
    sets = F.array(*[_array(t.words) for t in templates]) if templates else None
    labels, needs, sizes = _array([t.label for t in templates]), [t.need for t in templates], [len(t.words) for t in templates]

    def blocks(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - SPAN - 1, F.lit(0)), F.lit(SPAN))
        return F.transform(starts, lambda s: F.slice(ws, s + 1, 2 * SPAN))

    def hits(block: Column, b: Column) -> Column:
        held = F.array_intersect(_array(ordered), block)  # in the global order

        def met(w: Column, j: Column) -> Column:
            some = F.coalesce(F.element_at(index, w), F.array().cast("array<struct<t:int,i:int,size:int,need:int>>"))
            possible = lambda e: (F.size(held) >= e["need"]) & (1 + F.least(e["size"] - e["i"] - 1, F.size(held) - j - 1) >= e["need"])
            return F.transform(F.filter(some, possible), lambda e: e["t"])

        near = F.array_distinct(F.flatten(F.transform(F.filter(F.transform(held, lambda w, j: F.struct(w.alias("w"), j.alias("j"))), lambda x: F.array_contains(_array(list(entries)), x["w"])), lambda x: met(x["w"], x["j"]))))
        common = lambda t: F.size(F.array_intersect(F.get(sets, t), held))
        checked = F.transform(near, lambda t: F.struct(t.alias("t"), common(t).alias("n")))
        need, size = F.array(*[F.lit(x) for x in needs]), F.array(*[F.lit(x) for x in sizes])
        return F.transform(F.filter(checked, lambda x: x["n"] >= F.get(need, x["t"])),
                           lambda x: F.struct(F.get(labels, x["t"]).alias("label"), b.cast("long").alias("block"), (x["n"] / F.get(size, x["t"])).alias("score")))

    none = F.array().cast("array<struct<label:string,block:bigint,score:double>>")
    found = none
    if templates:
        each = F.flatten(F.transform(blocks(F.col("lic_words")), lambda block, b: hits(block, b)))
        found = F.when(F.arrays_overlap(F.col("lic_words"), _array(list(entries))), each).otherwise(none)
    places = F.concat(*[_places(F.col("lic_words"), p, label) for p, label in phrases.items()])
    got = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "lic"]).alias("lic_row"), corpus_words(F.col("text")).alias("lic_words"))
    got = got.select("lic_row", F.struct(F.size("lic_words").cast("long").alias("n_words"), places.alias("places"), found.alias("found")).alias("lic"))
    return got.select("lic_row.*", "lic")


def report(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score: the largest share of a template in a block, 1 for a base phrase."""
    at, base, found = F.col("lic.places.at"), F.col("lic.places.label"), F.col("lic.found.label")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return scan(docs.select("doc_id", "text"), model).select(
        "doc_id", "lic.n_words", F.size("lic.places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, found)).alias("labels"),
        F.when(F.size("lic.places") > 0, 1.0).otherwise(F.coalesce(F.array_max("lic.found.score"), F.lit(0.0))).alias("score"))
