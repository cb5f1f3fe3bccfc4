"""Licence scan: passages compared with licence templates by Dice's coefficient over word bigrams.

A passage is a line, a paragraph (lines up to a blank one, if it has several) or the whole text (if it has
several paragraphs). Passages and templates are lower-cased and reduced to words. For sets of bigrams A and
B, Dice = 2 |A and B| / (|A| + |B|) can reach t only if |A| lies between |B| t / (2 - t) and |B| (2 - t) / t;
templates outside are never compared, and passages inside no template's bounds are dropped before their
bigrams are made. Only DataFrame functions are used, and the templates are literals of the plan.

Defined cases: null and empty texts have no passages; a passage or template of one word has that word as
its only element; of several templates every one that reaches the threshold is reported; repeated rows give
repeated results; extra columns are ignored.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8
# Notices by which public licences are named, and short licence texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
           "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
           "to do so, subject to the following conditions:",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
                      "of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
                      "http://mozilla.org/MPL/2.0/.",
}


def plain_bigrams(text: str) -> list[str]:
    """Bigrams of a template, in Python; `_bigrams` does the same to columns."""
    w = [x for x in re.split(r"[^a-z0-9]+", text.lower()) if x]
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)} or set(w))


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.when(n > 1, F.array_distinct(pairs)).otherwise(words)


def bounds(size: int, dice: float) -> tuple[float, float]:
    """Sizes a partner's bigram set can have."""
    return size * dice / (2 - dice) - 1e-9, size * (2 - dice) / dice + 1e-9


def passages(docs: DataFrame, longest: int) -> DataFrame:
    """Rows doc_id, unit, place, passage; passages over `longest` characters lie above every size bound only if their words do, so none is dropped here."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    lines = d.select("doc_id", F.lit("line").alias("unit"), F.posexplode(F.split("_t", "\n", -1)).alias("place", "passage"))
    blocks = d.where(F.col("_t").contains("\n")).select("doc_id", F.split("_t", r"\n[ \t\r]*\n", -1).alias("_b"))
    paragraphs = blocks.select("doc_id", F.lit("paragraph").alias("unit"), F.posexplode("_b").alias("place", "passage")).where(F.col("passage").contains("\n"))
    whole = blocks.where(F.size("_b") > 1).select("doc_id", F.lit("text").alias("unit"), F.lit(0).alias("place"), F.array_join("_b", "\n\n").alias("passage"))
    return lines.unionByName(paragraphs).unionByName(whole)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, dice: float = DICE) -> DataFrame:
    """Per passage and licence that reach the threshold: doc_id, unit, place, license, dice."""
    known = {k: plain_bigrams(v) for k, v in (TEMPLATES if templates is None else templates).items()}
    known = {k: v for k, v in known.items() if v}
    lows = {k: bounds(len(v), dice) for k, v in known.items()}
    if not known:
        return docs.select("doc_id", F.lit("").alias("unit"), F.lit(0).alias("place"), F.lit("").alias("license"), F.lit(0.0).alias("dice")).where("false")
    p = passages(docs, 0)
    # a set of n bigrams has more than n words, and a word takes two characters with its blank: too short to reach the lowest bound
    least = min(lo for lo, _ in lows.values())
    p = p.where(F.length("passage") >= int(least))
    words = F.filter(F.split(F.lower("passage"), "[^a-z0-9]+", -1), lambda x: x != "")
    # exploding a one-element array keeps the optimizer from copying the words into every later filter
    p = p.select("doc_id", "unit", "place", F.explode(F.array(words)).alias("_w")).where(F.size("_w") >= max(1, int(least)))
    p = p.select("doc_id", "unit", "place", F.explode(F.array(_bigrams(F.col("_w")))).alias("_g")).withColumn("_n", F.size("_g"))
    inside = [F.col("_n").between(lo, hi) for lo, hi in lows.values()]
    fits = inside[0]
    for c in inside[1:]:
        fits = fits | c
    scored = []
    for (name, grams), (lo, hi) in zip(known.items(), lows.values(), strict=True):
        both = F.size(F.array_intersect("_g", F.split(F.lit("|".join(grams)), r"\|")))
        value = F.when(F.col("_n").between(lo, hi), 2.0 * both / (F.col("_n") + len(grams)))
        scored.append(F.struct(F.lit(name).alias("license"), value.alias("dice")))
    hits = p.where(fits).select("doc_id", "unit", "place", F.explode(F.filter(F.array(*scored), lambda x: x["dice"] >= dice)).alias("x"))
    return hits.select("doc_id", "unit", F.col("place").cast("long").alias("place"), F.col("x.license").alias("license"), F.round("x.dice", 6).alias("dice"))
