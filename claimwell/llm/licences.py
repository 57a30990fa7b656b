"""Licence notices found by a trained paragraph classifier and confirmed by templates."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches

# Usual wordings of public licence notices, by SPDX family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
    "Proprietary": (
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Copyright. All rights reserved.",
    ),
}
# Notices of no listed family, for the class of unknown licences.
UNKNOWN = (
    "Licensed under the Sample Licence.",
    "Released under the terms of the Project License, version 1.",
    "This work is licensed under the Example Public License.",
    "See the license file for the terms of use.",
    "Distributed under the Company License Agreement.",
    "SPDX-License-Identifier: LicenseRef-Example",
)
NONE, OTHER = "none", "unknown"
#: Lines of the corpus, at most, that stand for paragraphs without a notice.
NEGATIVES = 4000
#: A family is confirmed where the paragraph holds this share of a template's words.
CONFIRMED = 0.6
#: An n-gram has to hold a word of this length of a template; such words are searched for.
ANCHOR = 5
#: Words, at most, of short lines that are judged together as a notice of no listed family.
JOINED = 40

_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_TEXT = re.compile(r"[^\W_]")


#: What tells families apart, searched for in the words of a notice.
_MARKS = {
    name: re.compile(rf"(?<![a-z\d])(?:{wording})(?![a-z\d])")
    for name, wording in {
        "gnu": r"gnu|[al]?gpl(?:v?\d[\d.]*)?",
        "affero": r"affero|agpl(?:v?\d[\d.]*)?",
        "lesser": r"lesser|lgpl(?:v?\d[\d.]*)?|gnu library",
        "free documentation": r"free documentation|gfdl",
        "mit": "mit(?!-)",
        "no attribution": "no attribution|mit-0",
        "apache": "apache",
        "bsd": "bsd",
        "mozilla": "mozilla|mpl",
        "cc": r"creative commons|cc(?!0)",
        "cc0": "cc0",
        "nc": r"nc|(?:attribution-?)?non[- ]?commercial",
        "sa": r"sa|(?:attribution-?)?share[- ]?alike",
        "nd": r"nd|(?:attribution-?)?no[- ]?deriv(?:ative)?s?(?: works)?",
        "all reserved": "all rights reserved",
        "some reserved": "some rights reserved|no rights reserved",
        "clauses": r"(?:\d|two|three|four)[- ]clause",
    }.items()
}
_VERSION = re.compile(
    r"(?:version|(?<![a-z])v|licen[sc]e|gpl|mpl|apache|bsd|cc0|(?<![a-z])(?:by|nc|sa|nd)|attribution|commercial|alike|"
    r"derivatives|derivs|international)[- ]?v?(\d{1,2}(?:\.\d{1,2})*)(?![\d]|\.\d|[- ]clause)"
)
_CLAUSES = {"two": "2", "three": "3", "four": "4"}


def marks(text: list[str]) -> frozenset[str]:
    """The deciding words of a notice: whose licence, its kind, its version."""
    joined = " ".join(text)
    found = {name for name, wording in _MARKS.items() if name != "clauses" and wording.search(joined)}
    found |= {"version " + re.sub(r"(\.0)+$", "", v) for v in _VERSION.findall(joined)}
    found |= {"clauses " + _CLAUSES.get(x[0], x[0]) for x in (re.split("[- ]", c) for c in _MARKS["clauses"].findall(joined))}
    return frozenset(found)


def words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def ngrams(paragraph: str) -> Counter:
    w = words(paragraph)
    return Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))


def trigrams(paragraph: str) -> set[str]:
    """Three words in a row with a long one, also if hyphens join them."""
    w = words(paragraph)
    joined = {x for x in w if x.count("-") >= 2}
    return joined | {" ".join(w[i : i + 3]) for i in range(len(w) - 2) if any(len(x) >= ANCHOR for x in w[i : i + 3])}


@dataclass(frozen=True)
class Template:
    """A wording of a family. Of its words, at least `least` long ones are in a confirmed
    notice, and all of them within `reach` words. Its marks, and no other, are there too."""

    family: str
    words: frozenset
    pairs: frozenset
    marks: frozenset
    least: int
    reach: int

    @classmethod
    def of(cls, family: str, text: str) -> Template:
        w = words(text)
        own = frozenset(w)
        short = sum(len(x) < ANCHOR for x in own)
        return cls(family, own, frozenset(zip(w, w[1:])), marks(w), max(1, math.ceil(CONFIRMED * len(own)) - short), 2 * len(w) + 6)

    def spans(self, text: list[str], least: float = CONFIRMED) -> Iterator[tuple[float, int, int]]:
        """(share of the words, begin, end) of stretches that do not overlap, each the fullest
        one there, then the one most in order, then the shortest. With `least`, only those with the wording's marks and no other count."""
        held: Counter = Counter()
        places = [i for i, w in enumerate(text) if w in self.words]
        left, best = 0, None
        for at in places:
            held[text[at]] += 1
            while held[text[places[left]]] > 1 or at - places[left] >= self.reach:
                held[text[places[left]]] -= 1
                if not held[text[places[left]]]:
                    del held[text[places[left]]]
                left += 1
            begin, share = places[left], len(held) / len(self.words)
            if best and begin >= best[2]:
                if self.decided(text, best, least):
                    yield best[:3]
                best = None
            if share >= least and (best is None or share >= best[0]):
                rank = share, self.shared(text[begin : at + 1]), begin - at
                if best is None or rank > best[3]:
                    best = share, begin, at + 1, rank
        if best and self.decided(text, best, least):
            yield best[:3]

    def decided(self, text: list[str], best: tuple, least: float) -> bool:
        first, last = self.whole(text, best[1], best[2])
        return not least or marks(text[first:last]) == self.marks

    def whole(self, text: list[str], begin: int, end: int) -> tuple[int, int]:
        """A stretch with the words around it that are neighbours in the wording."""
        while begin and (text[begin - 1], text[begin]) in self.pairs:
            begin -= 1
        while end < len(text) and (text[end - 1], text[end]) in self.pairs:
            end += 1
        return begin, end

    def shared(self, text: list[str]) -> int:
        """Pairs of neighbours of the wording that are neighbours in the text."""
        return len(self.pairs & set(zip(text, text[1:])))


def _variants(paragraph: str, filler: list[str], draw: random.Random) -> Iterator[str]:
    """The paragraph itself, and with words lost or put around it, but none that decide."""
    yield paragraph
    own = marks(words(paragraph))
    for _ in range(24):
        w = paragraph.split()
        kept = [x for x in w if draw.random() > 0.12] or w
        if marks(words(" ".join(kept))) != own:
            kept = w
        before, after = ([draw.choice(filler) for _ in range(draw.randint(0, 6))] for _ in "ab")
        yield " ".join([*before, *kept, *after])


@dataclass
class LicenceModel:
    """Softmax weights over the n-grams of the notices, and how sure they may be."""

    classes: list[str]
    grams: dict[str, int]
    weights: np.ndarray
    heat: float
    anchors: list[str]
    templates: list[Template] = field(default_factory=list)

    def chances(self, paragraph: str) -> np.ndarray:
        score = self.weights[-1].copy()
        for gram, times in ngrams(paragraph).items():
            if (at := self.grams.get(gram)) is not None:
                score += self.weights[at] * min(times, 2)
        score = score / self.heat
        score = np.exp(score - score.max())
        return score / score.sum()

    def nearest(self, text: list[str], family: str) -> float:
        """The largest share of a template's words that a stretch of the text holds."""
        return max((x[0] for t in self.templates if t.family == family for x in t.spans(text, 0)), default=0.0)

    def judge(self, paragraph: str) -> tuple[str, float, float] | None:
        """(family, probability, likeness to its template), None without a notice.

        Of the families that a template confirms the likeliest counts; `unknown` if there is
        none.
        """
        chances = self.chances(paragraph)
        by_class = dict(zip(self.classes, chances.tolist()))
        if by_class.get(NONE, 1.0) >= 0.5:
            return None
        text = words(paragraph)
        near: dict[str, float] = {}
        for t in self.templates:
            near[t.family] = max([near.get(t.family, 0.0), *(x[0] for x in t.spans(text))])
        confirmed = [f for f, share in near.items() if share]
        if confirmed:
            family = max(confirmed, key=lambda f: by_class[f])
            return family, by_class[family], near[family]
        family = max((c for c in self.classes if c != NONE), key=lambda c: by_class[c])
        return OTHER, 1 - by_class[NONE], self.nearest(text, family)

    def _confirmed(self, lines: list[list[str]], hits: list[set[str]]) -> list[tuple]:
        """(judged, first, last) of lines that hold a confirmed notice, from the one with the
        most neighbours of a template on; none overlaps another."""
        sizes = np.cumsum([0, *map(len, lines)]).tolist()
        found = []
        for t in self.templates:
            places = [(i, w) for i, own in enumerate(hits) for w in own if w in t.words]
            held: Counter = Counter()
            left, ranges = 0, []
            for at, word in places:
                held[word] += 1
                while sizes[at] - sizes[min(places[left][0] + 1, at)] >= t.reach:
                    held[places[left][1]] -= 1
                    left += 1
                if sum(n > 0 for n in held.values()) >= t.least:
                    first, last = places[left][0], at
                    while first and sizes[places[left][0]] - sizes[first - 1] <= t.reach:
                        first -= 1
                    while last + 1 < len(lines) and sizes[last + 2] - sizes[at + 1] <= t.reach:
                        last += 1
                    if ranges and first <= ranges[-1][1]:
                        ranges[-1][1] = max(last, ranges[-1][1])
                        ranges[-1][0] = min(first, ranges[-1][0])
                    else:
                        ranges.append([first, last])
            for first, last in ranges:
                text = [w for own in lines[first : last + 1] for w in own]
                owner = [i for i in range(first, last + 1) for _ in lines[i]]
                for share, begin, end in t.spans(text):
                    begin, end = t.whole(text, begin, end)
                    own = text[begin:end]
                    found.append((t.shared(own), owner[begin] - owner[end - 1], share, -owner[begin], t.family, " ".join(own)))
        taken: set[int] = set()
        out = []
        for _, length, _, first, family, own in sorted(found, reverse=True):
            first, last = -first, -first - length
            if not taken.isdisjoint(range(first, last + 1)):
                continue
            if (judged := self.judge(own)) and judged[0] == family:
                taken.update(range(first, last + 1))
                out.append((judged, first, last))
        return out

    def _others(self, lines: list[str], sizes: list[int], hits: list[set[str]], free: list[bool]) -> Iterator[tuple]:
        """(judged, first, last) of the other notices among the free lines.

        Lines are judged alone, and short ones with those after them, which join where that
        halves the doubt; touching unknown ones are one notice.
        """
        ranges = []
        for i, own in enumerate(hits):
            if not own or not free[i]:
                continue
            best, last, size = self.judge(lines[i]), i, sizes[i]
            for j in range(i + 1, len(lines)):
                size += sizes[j]
                if size > JOINED or not free[j] or (best and best[0] != OTHER):
                    break
                if hits[j] and (x := self.judge(" ".join(lines[i : j + 1]))):
                    if best is None or 1 - x[1] < (1 - best[1]) / 2:
                        best, last = x, j
            if best:
                ranges.append((i, last, best))
        now = None
        for first, last, x in sorted(ranges, key=lambda r: r[:2]):
            if now and first <= now[2] + 1 and x[0] == now[0][0] == OTHER:
                now = max(now[0], x, key=lambda y: y[1]), now[1], max(now[2], last)
            else:
                if now:
                    yield now
                now = x, first, last
        if now:
            yield now

    def notices(self, text: str, search) -> list[tuple]:
        """(first line, begin, end, family, probability, likeness) of each notice of a text.

        A notice is one or more lines without a blank one between them; `search` finds the
        anchors.
        """
        found: list[tuple] = []
        block: list[tuple] = []

        def close() -> None:
            hits = [b[3] for b in block]
            if any(hits):
                lines = [b[2] for b in block]
                split = [words(x) for x in lines]
                known = self._confirmed(split, hits)
                free = [True] * len(lines)
                for _, first, last in known:
                    free[first : last + 1] = [False] * (last + 1 - first)
                for judged, first, last in [*known, *self._others(lines, list(map(len, split)), hits, free)]:
                    found.append((block[first][0], block[first][1], block[last][1] + len(lines[last]), *judged))
            block.clear()

        begin = 0
        for number, line in enumerate(text.split("\n")):
            if _TEXT.search(line):
                block.append((number, begin, line, {w for _, w in search.iter(line.lower())}))
            else:
                close()
            begin += len(line) + 1
        close()
        return sorted(found)


def _softmax_fit(x: np.ndarray, y: np.ndarray, k: int, rounds: int = 400) -> np.ndarray:
    weights, seen = np.zeros((x.shape[1], k)), np.full((x.shape[1], k), 1e-12)
    share = np.bincount(y, minlength=k)
    each = (1 / (k * np.maximum(share, 1)))[y]
    for _ in range(rounds):
        score = x @ weights
        score = np.exp(score - score.max(1, keepdims=True))
        chance = score / score.sum(1, keepdims=True)
        chance[np.arange(len(y)), y] -= 1
        slope = x.T @ (chance * each[:, None]) + 1e-4 * weights
        seen += slope * slope
        weights -= 0.3 * slope / np.sqrt(seen)
    return weights


def train(negatives: list[str], seed: int = 7) -> LicenceModel:
    """Fit on variants of the templates, of notices of no family, and on ordinary lines.

    N-grams without a word of ANCHOR letters of a template are left out, however common the
    word is in the corpus. A fifth of the examples sets the heat that makes probabilities
    fit. Ordinary lines that hold most of a template, or three of its words in a row as the
    lines of a wrapped notice do, are left out as well.
    """
    templates = [Template.of(f, t) for f, texts in TEMPLATES.items() for t in texts]
    known = {g for own in (*TEMPLATES.values(), UNKNOWN) for t in own for g in trigrams(t)}

    def plain_line(line: str) -> bool:
        w = set(words(line))
        return known.isdisjoint(trigrams(line)) and not any(len(t.words & w) >= CONFIRMED * len(t.words) for t in templates)

    plain = [n for n in negatives if plain_line(n)]
    draw = random.Random(seed)
    filler = sorted({w for n in plain for w in n.split()})[:5000] or ["text"]
    examples = [(v, f) for f, texts in TEMPLATES.items() for t in texts for v in _variants(t, filler, draw)]
    examples += [(v, OTHER) for t in UNKNOWN for v in _variants(t, filler, draw)]
    anchor = {w for own in (*TEMPLATES.values(), UNKNOWN) for t in own for w in words(t) if len(w) >= ANCHOR}
    classes = [NONE, OTHER, *TEMPLATES]
    counted = Counter(g for text, _ in examples for g in ngrams(text))
    kept = sorted(g for g, n in counted.items() if n >= 3 and any(w in anchor for w in g.split(" ")))
    grams = {g: i for i, g in enumerate(kept)}
    examples += [(n, NONE) for n in plain] or [("plain text", NONE)]
    x = np.zeros((len(examples), len(grams) + 1))
    x[:, -1] = 1
    for i, (text, _) in enumerate(examples):
        for gram, times in ngrams(text).items():
            if gram in grams:
                x[i, grams[gram]] = min(times, 2)
    y = np.array([classes.index(c) for _, c in examples])
    held = np.arange(len(y)) % 5 == 4
    weights = _softmax_fit(x[~held], y[~held], len(classes))
    score = x[held] @ weights
    heats = np.geomspace(0.25, 4, 33)
    losses = []
    for heat in heats:
        s = score / heat
        s = s - s.max(1, keepdims=True)
        losses.append(float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), y[held]]).mean()))
    return LicenceModel(classes, grams, weights, float(heats[int(np.argmin(losses))]), sorted(anchor), templates)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", negatives: int = NEGATIVES) -> LicenceModel:
    """Train with about `negatives` lines of the corpus, at most 4 of a document, taken by hash."""
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("body")).where("body is not null")
    total = rows.count()
    parts = 1 << 30
    rate = min(parts, negatives * parts // max(1, total) + 1)
    place = F.xxhash64("key", "body")
    chosen = rows.where(F.pmod(place, F.lit(parts)) < rate).select(place.alias("place"), "body").orderBy("place").limit(negatives)

    def lines(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [[x[:400] for x in t.split("\n") if x.strip()] for t in b["body"]]
            some = [(p, x) for p, own in zip(b["place"], found) for x in own[:: max(1, len(own) // 4)][:4]]
            yield {"place": [p for p, _ in some], "line": [x for _, x in some]}

    found = [tuple(r) for r in map_batches(chosen, lines, "place bigint, line string").collect()]
    return train([line for _, line in in_hash_order(found)[:negatives]])


def in_hash_order(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Lines with the hashes of their documents, in an order that no alphabet has a part in."""
    return sorted(found, key=lambda x: (hashlib.sha256(f"{x[0]} {x[1]}".encode("utf-8", "surrogatepass")).digest(), x))


def scan(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each paragraph with a licence notice: (id, paragraph, begin, end, family,
    probability, likeness).

    A notice is a line, or lines that follow each other without a blank one, as where it is
    hard-wrapped; `paragraph` is its first line, counted from 0 in the whole text, `begin` and
    `end` are code points of its lines. Only lines with a long word of a template, or between
    such lines, can be part of one; those words are searched for in one pass. NULL and empty
    texts have no paragraphs, repeated and NULL ids are rows of their own, other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["key"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        import ahocorasick

        search = ahocorasick.Automaton()
        for word in model.anchors:
            search.add_word(word, word)
        search.make_automaton()
        names = ("key", "paragraph", "begin", "end", "family", "probability", "likeness")
        for b in batches:
            found: list[tuple] = []
            for key, text in zip(b["key"], b["body"]):
                if not text or not model.anchors or next(search.iter(text.lower()), None) is None:
                    continue
                found += ((key, *notice) for notice in model.notices(text, search))
            if found:
                yield dict(zip(names, map(list, zip(*found))))

    return map_batches(
        rows, work, f"key {kind}, paragraph int, begin int, end int, family string, probability double, likeness double"
    ).withColumnRenamed("key", id_col)
