"""License scan: windows of words against licence templates by the Dice coefficient of their word bigrams.

Text and templates are normalised alike: lower case, runs of other characters than letters and digits become one blank. A window matches a
template if 2 |A & B| / (|A| + |B|) >= ``MIN_DICE`` for their sets of bigrams. Windows are laid on words, wherever lines and paragraphs
break: they begin and end with a bigram of the template (without such ends the coefficient is only smaller). For each begin the
best end counts (ties: the nearer). A window is dropped where one of another licence overlaps it and is better (larger coefficient, then
longer, then the later name); so a text isn't taken for a relative of its licence.

Bounds leave out what can't match, and nothing else. Size: the coefficient is reached only with at least MIN_DICE / (2 - MIN_DICE) of the
template's bigrams, in a set of at most (2 - MIN_DICE) / MIN_DICE as many; windows have that many positions at most, and begins need that many of the
template's bigrams within reach. Anchors: of any larger remainder of a template's bigrams a match has at least one; the remainders with the longest
words make one pattern by which texts are picked, and pick the templates of a text. Only DataFrame functions run; templates are a literal whose size is theirs.

Cases: null and empty texts match nothing; rows of one id count as one document; a null id is a document of its own name; ties
between windows go to the shorter, then to the earlier one; an empty table gives an empty result; only id and text columns are read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_DICE = 0.8
#: Positions of a cell by which overlapping windows meet.
CELL = 64

#: Public licence notices (fixed values): licence, text.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def template_bigrams(text: str) -> list[str]:
    w = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def anchors(grams: list[str], min_dice: float) -> list[str]:
    """As many of a template's bigrams, those with the longest words first, as no match can miss all of."""
    missing = int(len(grams) * (1 - min_dice / (2 - min_dice)) + 1e-9)
    return sorted(grams, key=lambda g: (-len(g), g))[: missing + 1]


def bounds(n: int, min_dice: float) -> tuple[int, int]:
    """For a template of n bigrams: how many of them a window has at least, and how many positions at most."""
    return math.ceil(n * min_dice / (2 - min_dice) - 1e-9), math.floor(n * (2 - min_dice) / min_dice + 1e-9)


def _tree(words: list[str]) -> str:
    """A pattern for any of the words (blank: any gap), branching by character."""
    branches = []
    for c in sorted({w[:1] for w in words}):
        rest = [w[1:] for w in words if w[:1] == c]
        branches.append((r"[^\p{L}\p{N}]+" if c == " " else c) + _tree(rest) if c else "")
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def _hits(src: DataFrame, literal: Column, min_dice: float) -> DataFrame:
    """``id, row, license, dice, at, size, line, last_line``: the best window of each begin (positions of bigrams from 0)."""
    one = lambda c: F.explode(F.array(c))  # noqa: E731  (a generator, so that a column isn't computed again wherever it is used)
    # words of each line with the line's number
    of_line = lambda x, i: F.transform(F.filter(F.split(normalised(x), " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), (i + 1).alias("line")))
    rows = src.select("id", "row", one(F.flatten(F.transform(F.split("text", "\n"), of_line))).alias("w")).filter(F.size("w") > 1)
    pairs = F.zip_with(F.slice("w.w", F.lit(1), F.size("w") - 1), F.slice("w.w", F.lit(2), F.size("w") - 1), lambda x, y: F.concat(x, F.lit(" "), y))
    rows = rows.select("id", "row", F.col("w.line").alias("lines"), one(pairs).alias("g"))
    rows = rows.select("id", "row", "lines", "g", F.explode_outer(F.filter(literal, lambda t: F.arrays_overlap(t["anchors"], F.col("g")))).alias("t")).filter("t is not null")
    own = F.filter(F.sequence(F.lit(0), F.size("g") - 1), lambda i: F.array_contains(F.col("t.grams"), F.get("g", i)))
    rows = rows.select("id", "row", "lines", "g", "t", one(own).alias("p")).filter(F.size("p") >= F.col("t.need"))
    reach = lambda a, b: F.get("p", b) - F.get("p", a) < F.col("t.span")
    begins = F.filter(F.sequence(F.lit(0), F.size("p") - F.col("t.need")), lambda a: reach(a, a + F.col("t.need") - 1))

    def window(a: Column, b: Column) -> Column:
        at, size = F.get("p", a), F.get("p", b) - F.get("p", a) + 1
        grams = F.slice("g", at + 1, size)
        dice = F.lit(2.0) * F.size(F.array_intersect(grams, F.col("t.grams"))) / (F.size(F.array_distinct(grams)) + F.col("t.n"))
        return F.struct(dice.alias("dice"), (-size).alias("size"), at.alias("at"))

    def best(a: Column) -> Column:
        ends = F.sequence(a + F.col("t.need") - 1, F.least(a + F.col("t.span") - 1, F.size("p") - 1))
        return F.array_max(F.transform(F.filter(ends, lambda b: reach(a, b)), lambda b: window(a, b)))

    rows = rows.select("id", "row", "lines", F.col("t.license").alias("license"), F.explode_outer(F.filter(F.transform(begins, best), lambda x: x["dice"] >= F.lit(min_dice))).alias("x"))
    at, size = F.col("x.at"), -F.col("x.size")
    return rows.filter("x is not null").select(
        "id", "row", "license", "x.dice", at.alias("at"), size.alias("size"), F.get("lines", at).alias("line"), F.get("lines", at + size).alias("last_line")
    )


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """``id, license, dice, line, n_lines, word, n_words``: the best window for each document and licence found in it (``word`` from 0)."""
    known = [(name, template_bigrams(t)) for name, t in templates]
    pairs = sorted({a for _, grams in known for a in anchors(grams, min_dice)})
    loose = r"(?iu)(?<![\p{L}\p{N}])" + _tree(pairs) + r"(?![\p{L}\p{N}])"

    def entry(name: str, grams: list[str]) -> Column:
        need, span = bounds(len(grams), min_dice)
        words = lambda x: F.array(*map(F.lit, x))
        return F.struct(
            F.lit(name).alias("license"), F.lit(len(grams)).alias("n"), F.lit(need).alias("need"), F.lit(span).alias("span"),
            words(grams).alias("grams"), words(anchors(grams, min_dice)).alias("anchors"),
        )

    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter(F.col("text").rlike(loose))
    src = src.select("id", F.xxhash64("id", "text").alias("row"), "text")
    # rows that repeat an id and its text have the same hits: once is enough
    hits = materialize(_hits(src, F.array(*[entry(*k) for k in known]), min_dice).distinct(), "licenses")
    # overlapping windows of one text meet in a cell; a cell holds at most CELL begins of each template
    spots = hits.select("row", "license", "dice", "size", "at", F.explode(F.sequence(F.floor(F.col("at") / CELL), F.floor((F.col("at") + F.col("size") - 1) / CELL))).alias("cell"))
    other = spots.select("row", "cell", *[F.col(c).alias(f"{c}2") for c in ("license", "dice", "size", "at")])
    better = (F.col("license") != F.col("license2")) & (F.col("at") < F.col("at2") + F.col("size2")) & (F.col("at2") < F.col("at") + F.col("size"))
    better = better & (F.struct("dice2", "size2", "license2") > F.struct("dice", "size", "license"))
    key = ["row", "license", "at", "size"]
    beaten = spots.join(other, ["row", "cell"]).filter(better).select(*key).distinct()
    left = hits.join(beaten, key, "left_anti")
    best = left.groupBy("id", "license").agg(F.max(F.struct("dice", (-F.col("size")).alias("size"), (-F.col("at")).alias("at"), "line", "last_line")).alias("b"))
    return best.select(
        "id", "license", F.col("b.dice").alias("dice"), F.col("b.line").cast("long").alias("line"),
        (F.col("b.last_line") - F.col("b.line") + 1).cast("long").alias("n_lines"), (-F.col("b.at")).cast("long").alias("word"), (1 - F.col("b.size")).cast("long").alias("n_words"),
    )
