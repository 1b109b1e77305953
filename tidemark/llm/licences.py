"""License scans by patience alignment.

A template is aligned with a stretch of text by the words that occur once in both: the longest
run of them that is in the same order on both sides anchors the alignment, and the gaps
between anchors are aligned in the same way, where words may be unique that weren't before.
The share of the template's words that are aligned is its coverage.

Stretches are found without loss: where enough words of a template are aligned, at least one
of any sufficiently large set of its words is, so the rarest such set in the document leads to
every stretch worth aligning.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed texts of public license notices, as they are commonly written.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "gpl-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
#: share of a template's words that must be aligned, and of the words between the first and the last that are
MIN_COVERAGE = 0.8
MIN_DENSITY = 0.5

WORD = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")
SCHEMA = "doc_id long, license string, coverage double, n_aligned long, start_word long, end_word long, occurrences long"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _longest_rise(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence, by piles as in the card game."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
        before[i] = piles[k - 1] if k else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions in both that are aligned, in order. Gaps wait on a list, so depth has no limit."""
    out: list[tuple[int, int]] = []
    waiting = [(0, len(text), 0, len(template))]
    while waiting:
        a, a_end, b, b_end = waiting.pop()
        # equal ends of a gap need no anchor
        while a < a_end and b < b_end and text[a] == template[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        in_text, in_template = Counter(text[a:a_end]), Counter(template[b:b_end])
        once = {w: i for i, w in enumerate(template[b:b_end], b) if in_template[w] == 1 and in_text.get(w) == 1}
        anchors = [(i, once[w]) for i, w in enumerate(text[a:a_end], a) if w in once]
        if not anchors:
            continue
        anchors = [anchors[k] for k in _longest_rise([j for _, j in anchors])]
        out += anchors
        edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
        waiting += [(i + 1, i_to, j + 1, j_to) for (i, j), (i_to, j_to) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    """Templates, ready to be met with documents."""

    def __init__(self, templates: dict[str, str], coverage: float, density: float):
        self.coverage, self.density = coverage, density
        self.templates = {name: words_of(t) for name, t in sorted(templates.items())}
        self.templates = {name: t for name, t in self.templates.items() if t}
        self.vocabulary = {w for t in self.templates.values() for w in t}

    def scan(self, text: str) -> list[tuple[str, float, int, int, int, int]]:
        """(template, coverage, aligned, first word, word after the last, occurrences) of all that the text holds."""
        words = words_of(text)
        there: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.vocabulary:
                there.setdefault(w, []).append(i)
        out = []
        for name, template in self.templates.items():
            if sum(w in there for w in template) < self.coverage * len(template):
                continue
            found = self._occurrences(words, there, template)
            if found:
                best = max(found, key=lambda f: (f[0], -f[1]))
                out.append((name, best[0] / len(template), best[0], best[1], best[2], len(found)))
        return out

    def _occurrences(self, words: list[str], there: dict[str, list[int]], template: list[str]) -> list[tuple[int, int, int]]:
        """(aligned, first word, word after the last) of stretches that don't overlap, best first where they would."""
        most = Counter(template)
        # Words that may be missing fill no more than this many places: of rarer ones beyond, one is aligned.
        spare = len(template) - int(-(-self.coverage * len(template) // 1))
        seeds, places = [], 0
        for w in sorted(most, key=lambda w: (len(there.get(w, ())), w)):
            seeds.append(w)
            places += most[w]
            if places > spare:
                break
        reach = int(len(template) / self.density) + 1
        stretches: list[list[int]] = []
        for p in sorted(p for w in seeds for p in there.get(w, ())):
            low, high = max(0, p - reach), min(len(words), p + reach + 1)
            if stretches and low <= stretches[-1][0] + reach // 2:
                stretches[-1][1] = high
            else:
                stretches.append([low, high])
        found = []
        for low, high in stretches:
            found += self._within(words, template, low, high)
        found.sort(key=lambda f: (-f[0], f[1]))
        out: list[tuple[int, int, int]] = []
        for f in found:
            if all(f[2] <= g[1] or f[1] >= g[2] for g in out):
                out.append(f)
        return sorted(out, key=lambda f: f[1])

    def _within(self, words: list[str], template: list[str], low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """Alignments in a stretch, from several beginnings: a template that is there twice has no unique words at first."""
        heads = {w for w in template[: len(template) - int(self.coverage * len(template)) + 1]}
        starts = [i for i in range(low, high) if words[i] in heads]
        until = low
        for start in starts:
            if start < until:
                continue
            pairs = patience(words[start : min(high, start + int(len(template) / self.density) + 1)], template)
            pairs = self._dense(pairs)
            if len(pairs) >= self.coverage * len(template):
                first, last = start + pairs[0][0], start + pairs[-1][0] + 1
                yield len(pairs), first, last
                until = last

    def _dense(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Without stray pairs at the ends, until the aligned words are dense enough."""
        while len(pairs) > 1 and len(pairs) < self.density * (pairs[-1][0] - pairs[0][0] + 1):
            front, back = pairs[1][0] - pairs[0][0], pairs[-1][0] - pairs[-2][0]
            pairs = pairs[1:] if front >= back else pairs[:-1]
        return pairs


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = MIN_COVERAGE, density: float = MIN_DENSITY
) -> DataFrame:
    """A row for each document and license notice in it.

    ``coverage`` is the share of the template's words that are aligned in its best occurrence,
    which runs from ``start_word`` to before ``end_word``; ``n_aligned`` counts them and
    ``occurrences`` says how often the notice is there without overlap. Words are runs of letters
    and digits, with single points, hyphens and apostrophes inside, in lower case.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text holds
    nothing. Of equal coverage the first occurrence counts. A null ``doc_id`` stays null; repeated
    rows repeat their findings. An empty table, or no templates, gives no rows.
    """
    given = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(given, coverage, density)
        for b in batches:
            rows = [(i, *found) for i, t in zip(b["doc_id"], b["text"]) if t for found in scanner.scan(t)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    # ids travel as text: in pandas numbers beside a null are floats
    found = docs.select(F.col("doc_id").cast("long").cast("string"), "text").mapInPandas(run, SCHEMA.replace("doc_id long", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
