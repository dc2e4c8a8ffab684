"""License scan by patience alignment.

A template and a text are aligned the patience way: words that occur once in
the template and once in the piece of text at hand are anchors; the longest
increasing subsequence of their positions is kept, and the gaps between kept
anchors are aligned again, where other words have become unique.  Coverage is
the share of the template's words that are aligned.

A text is first asked for a template's rare words: at coverage c at most a
share 1 - c of the template may be missing, so of any (1 - c) m + 1 of its m
words one must be present.  Then runs of two template words in order seed the
places to align; seeds of a template closer than its length share a place.  A
place may chain several copies, so windows of about one template length slide
over it, and its whole is aligned only where no window covers the template.
Texts are mapped whole, one batch at a time; templates are a fixed list (or a
given one) of bounded size.

Defined results: a null or empty text has no license; every place where a
template is covered is one row, overlapping places of one template keep the
best; of templates covered by the same words of the text the longest stays;
repeated rows are each scanned; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVERAGE = 0.8

# fixed values: common notices and the opening of common licenses
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation""",
    "GPL-notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at""",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-notice": "Licensed under CC BY-NC 4.0.",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-rights-reserved": "All rights reserved.",
}

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first, with increasing seconds."""
    tails: list[int] = []
    tops: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tails, b)
        back.append(tops[at - 1] if at else -1)
        if at == len(tails):
            tails.append(b)
            tops.append(i)
        else:
            tails[at], tops[at] = b, i
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned (place in a, place in b) of a patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places: dict[str, list[int]] = {}
        for i in range(a0, a1):
            places.setdefault(a[i], [0, 0, -1, -1])
            places[a[i]][0] += 1
            places[a[i]][2] = i
        for j in range(b0, b1):
            if b[j] in places:
                places[b[j]][1] += 1
                places[b[j]][3] = j
        unique = sorted((p[2], p[3]) for p in places.values() if p[0] == p[1] == 1)
        kept = longest_increasing(unique)
        if kept:
            edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
            out += kept
            todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def densest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run of aligned pairs that is worth most, a pair counting 1 and a
    word of the text between two pairs -1/2: strays at the ends fall off."""
    best, at, worth, first = 0.0, (0, 0), 0.0, 0
    for i, (_, b) in enumerate(pairs):
        worth -= (b - pairs[i - 1][1] - 1) / 2 if i else 0
        if worth < 0:
            worth, first = 0.0, i
        worth += 1
        if worth > best:
            best, at = worth, (first, i + 1)
    return pairs[at[0]:at[1]]


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.words = {name: words_of(text) for name, text in templates.items() if words_of(text)}
        self.asked: dict[str, list[str]] = {}  # rare word -> templates that ask for it
        self.seeds: dict[tuple[str, str], list[tuple[str, int]]] = {}
        for name, w in self.words.items():
            missing = int(len(w) * (1 - coverage) + 1e-9)
            rare, n = sorted(set(w), key=lambda x: (-len(x), x)), 0
            for x in rare:  # counts occurrences, so that the share holds for words, not kinds
                self.asked.setdefault(x, []).append(name)
                n += w.count(x)
                if n > missing:
                    break
            for i, two in enumerate(zip(w, w[1:], strict=False)):
                self.seeds.setdefault(two, []).append((name, i))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, word after the last)."""
        t = words_of(text)
        wanted = {name for x in self.asked.keys() & set(t) for name in self.asked[x]}
        if not wanted:
            return []
        at: dict[str, list[int]] = {}
        for j, two in enumerate(zip(t, t[1:], strict=False)):
            for name, i in self.seeds.get(two, ()):
                if name in wanted:
                    at.setdefault(name, []).append(j - i)
        found = []
        for name, starts in at.items():
            w = self.words[name]
            m, starts = len(w), sorted(starts)
            places: list[list[int]] = []
            for s in starts:
                if places and s - places[-1][1] < max(2, m // 2):
                    places[-1][1] = s
                else:
                    places.append([s, s])
            kinds, known = set(w), [0]
            for x in t if len(starts) > 1 else ():
                known.append(known[-1] + (x in kinds))
            need = self.coverage * m - 1e-9
            for lo, hi in places:
                here = []
                if hi > lo:
                    step = max(1, m // 8)
                    inside = starts[bisect_left(starts, lo):bisect_right(starts, hi)]
                    for a in sorted({max(0, s) for s in inside} | set(range(max(0, lo - m // 4), hi + 1, step))):
                        z = min(len(t), a + m + m // 4 + step + 1)
                        if a < z and known[z] - known[a] >= need:
                            pairs = align(w, t[a:z])
                            dense = densest(pairs)
                            pairs = dense if len(dense) >= need else pairs
                            if len(pairs) >= need:
                                here.append((name, len(pairs) / m, a + pairs[0][1], a + pairs[-1][1] + 1))
                a, z = max(0, lo - m // 4), min(len(t), hi + m + m // 4 + 1)
                pairs = align(w, t[a:z])
                if len(pairs) >= need:
                    whole = (name, len(pairs) / m, a + pairs[0][1], a + pairs[-1][1] + 1)
                    if all(whole[3] <= f[2] or whole[2] >= f[3] for f in here):
                        here.append(whole)
                found += here
        return self._best(found)

    def _best(self, found):
        out = []
        for f in sorted(found, key=lambda f: (-len(self.words[f[0]]) * f[1], f[2], f[0])):
            if all(f[3] <= g[2] or f[2] >= g[3] for g in out):
                out.append(f)
        return sorted(out, key=lambda f: f[2])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         coverage: float = COVERAGE) -> DataFrame:
    """(id, license, coverage, start, end), one row per place found."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(texts, coverage)
        for batch in batches:
            owner, rows = [], []
            for i, text in enumerate(batch.column(1)):
                got = scanner.scan(text.as_py())
                rows += got
                owner += [i] * len(got)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 *(pa.array([r[j] for r in rows], pa.int64()) for j in (2, 3))], names=["id", "license", "coverage", "start", "end"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, license string, coverage double, start long, end long")
