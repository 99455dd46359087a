"""License scan by patience alignment.

Each template is aligned with the text: words that occur once in both anchor
the alignment, the longest increasing run of anchors is kept, and the gaps
between anchors are aligned the same way. Coverage is the share of the
template's words that are aligned. A text is aligned only where enough of a
template's words lie close together, and not at all if too many are absent; both
are bounds that a match cannot beat.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")

# Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                  "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                  "language governing permissions and limitations under the License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
                    "binary form must reproduce the above copyright notice, this list of conditions and the following "
                    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment of two word lists: matched places, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al >= ah or bl >= bh:
            continue
        once_a = {w for w, n in Counter(a[al:ah]).items() if n == 1}
        once = {w for w, n in Counter(b[bl:bh]).items() if n == 1 and w in once_a}
        if not once:
            continue
        at = {a[i]: i for i in range(al, ah) if a[i] in once}
        anchors = _longest([(at[b[j]], j) for j in range(bl, bh) if b[j] in once])
        out += anchors
        edges = [(al - 1, bl - 1), *anchors, (ah, bh)]
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:])]
    return sorted(out)


def _longest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (ascending in the second) that ascends in the first (patience sorting)."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for i, (x, _) in enumerate(pairs):
        k = bisect_left(tops, x)
        back[i] = ends[k - 1] if k else -1
        if k == len(tops):
            tops.append(x)
            ends.append(i)
        else:
            tops[k], ends[k] = x, i
    out = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _settle(words: list[str], hits: list[int], i: int, got: list[tuple[int, int]], template: list[str],
            span: int) -> tuple[int, int, int]:
    """First word, last word and number of aligned words of the notice that ``got``, aligned from ``hits[i]``, is part of.

    A window that starts at a template word before the notice can end inside
    it. So whole windows from later starts are aligned too; of those that share
    half of ``got`` the one with the most words stands, then the shortest.
    """
    seen = {(hits[i] + x, y) for x, y in got}
    half = -(-len(got) // 2)
    best = (len(got), got[0][0] - got[-1][0], hits[i] + got[0][0])
    for at in hits[i + 1:]:
        if best[0] == len(template) == 1 - best[1] or at > hits[i] + got[-half][0]:
            break
        here = [(at + x, y) for x, y in align(words[at:at + span], template)]
        if len(seen.intersection(here)) >= half:
            best = max(best, (len(here), here[0][0] - here[-1][0], here[0][0]), key=lambda b: b[:2])
    return best[2], best[2] - best[1], best[0]


def find(words: list[str], template: list[str], least: float, stretch: float) -> list[tuple[int, int, float]]:
    """``(first word, last word, coverage)`` of each place that covers ``least`` of the template, in order."""
    need = max(1, -(-int(round(least * len(template) * 1000)) // 1000))
    span = max(need, int(stretch * len(template)))
    known = set(template)
    hits = [i for i, w in enumerate(words) if w in known]
    out, i = [], 0
    while i + need <= len(hits):
        if hits[i + need - 1] - hits[i] >= span:
            i += 1
            continue
        got = align(words[hits[i]:hits[i] + span], template)
        if len(got) >= need:
            first, last, n = _settle(words, hits, i, got, template, span)
            out.append((first, last, n / len(template)))
            i = bisect_left(hits, last + 1)
        else:
            i += 1
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, stretch: float = 1.5,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per license notice found: ``doc_id, license, coverage, first_word, last_word, start, end``.

    Words are compared in lower case; ``start`` and ``end`` are characters of
    the text. ``least`` of the template's words must align within ``stretch``
    times its length. Where places of several templates overlap, the one with
    the most aligned words stands (ties: higher coverage, then name). Whole
    texts are read; null and empty texts and texts without a notice give no
    rows; rows that repeat an id give rows of their own. No shuffle.
    """
    cut = {k: WORD.findall(v.lower()) for k, v in sorted((templates or TEMPLATES).items())}
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                words = None
                there = set(WORD.findall(text.lower()))
                found = []
                for name, t in cut.items():
                    if sum(w in there for w in t) < least * len(t):  # absent words cannot align
                        continue
                    words = WORD.findall(text.lower()) if words is None else words
                    found += [(-round(c * len(t)), -c, name, a, b) for a, b, c in find(words, t, least, stretch)]
                taken: list[tuple[int, int]] = []
                for _, c, name, a, b in sorted(found):
                    if all(b < x or a > y for x, y in taken):
                        taken.append((a, b))
                        rows.append((at, name, -c, a, b))
                if taken:
                    marks = list(WORD.finditer(text))
                    low = len(marks) == len(words)  # lower-casing can split a word in rare scripts
                    rows[-len(taken):] = [(*r, marks[r[3]].start() if low else None, marks[r[4]].end() if low else None)
                                          for r in sorted(rows[-len(taken):], key=lambda r: r[3])]
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.float64()), *[pa.array(c, pa.int32()) for c in cols[3:]]],
                names=["doc_id", "license", "coverage", "first_word", "last_word", "start", "end"])

    return base.mapInArrow(run, f"doc_id {kind}, license string, coverage double, first_word int, last_word int, "
                                "start int, end int")
