"""License scans by patience alignment.

A text and a template are word sequences (runs of letters and digits, lower case). Anchors are words that occur once in
both; the longest increasing subsequence of their places is kept, and the gaps between anchors are aligned the same way,
after equal words at a gap's ends are matched. Coverage is the share of the template's words matched.

A text is read in overlapping windows, so that a notice that stands there twice is found each time: windows of 1.5
template sizes, a third apart, and of 4 sizes, half apart. A notice whose words spread over at most 2 template sizes lies
whole in a window, however long a gap inside it is; one spread wider, by what was put between its lines, is by definition
none. Templates and windows whose words cannot reach the threshold, whatever their order, are passed over; these bounds
are exact.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
}

_WORD = re.compile(rb"[a-z0-9]+")


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in both numbers; pairs come sorted by the first."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        if k == len(tops):
            tops.append(y)
            ends.append(i)
        else:
            tops[k], ends[k] = y, i
        back[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (in a, in b) by patience alignment."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        left, right = Counter(a[i:j]), Counter(b[k:m])
        where = {w: y for y, w in enumerate(b[k:m], k) if right[w] == 1}
        anchors = increasing([(x, where[w]) for x, w in enumerate(a[i:j], i) if left[w] == 1 and w in where])
        if not anchors:
            continue
        out += anchors
        for (x, y), (x2, y2) in zip([(i - 1, k - 1), *anchors], [*anchors, (j, m)], strict=True):
            todo.append((x + 1, x2, y + 1, y2))
    return sorted(out)


def needed(size: int, least: float) -> int:
    """Words of a template of this size that a notice matches at least."""
    return max(1, math.ceil(least * size - 1e-9))


def windows(n: int, size: int) -> list[tuple[int, int]]:
    """(first word, last word + 1) of the windows over a text of n words for a template of this size."""
    out = []
    for span, step in ((size + (size + 1) // 2, max(1, size // 2)), (4 * size, 2 * size)):
        out += [(at, min(n, at + span)) for at in range(0, max(1, n - span + step), step)]
    return out


def scan(text: list[bytes], template: list[bytes], least: float) -> list[tuple[float, int, int]]:
    """(coverage, first word, last word + 1) of each window that covers the template enough; of windows whose notices
    overlap, the one that covers most, then the first."""
    have, size = Counter(template), len(template)
    need = needed(size, least)
    hits = [i for i, w in enumerate(text) if w in have]
    found = []
    for begin, stop in windows(len(text), size):
        i, j = bisect_left(hits, begin), bisect_left(hits, stop)
        if j - i < need or sum((Counter(text[x] for x in hits[i:j]) & have).values()) < need:
            continue
        match = align(text[begin:stop], template)
        if len(match) >= need:
            found.append((len(match) / size, begin + match[0][0], begin + match[-1][0] + 1))
    found.sort(key=lambda x: (-x[0], x[1]))
    kept: list[tuple[float, int, int]] = []
    for f in found:
        if not any(s < f[2] and f[1] < e for _, s, e in kept):
            kept.append(f)
    return kept


def _scan_batches(templates: dict[str, str], least: float):
    def run(batches):
        import pyarrow as pa

        known = {name: words(t.encode()) for name, t in templates.items()}
        # matching so many words takes this many different ones at least
        needs = {name: (frozenset(t), max(1, len(set(t)) - (len(t) - needed(len(t), least)))) for name, t in known.items()}
        every = frozenset(w for t in known.values() for w in t)
        for b in batches:
            for i in range(0, len(b), 512):
                part, rows = b.slice(i, 512), []
                for text in column_bytes(part.column("text")):
                    w = words(text) if text else []
                    have = every.intersection(w)
                    found = []
                    for name, (vocabulary, need) in needs.items():
                        if len(have & vocabulary) >= need:
                            found += [(-c, s, name, e) for c, s, e in scan(w, known[name], least)]
                    # of notices that overlap, the one with more words matched stands
                    found.sort(key=lambda x: (x[0] * len(known[x[2]]), x[1], x[2]))
                    kept: list = []
                    for f in found:
                        if not any(k[1] < f[3] and f[1] < k[3] for k in kept):
                            kept.append(f)
                    kept.sort(key=lambda x: x[1])
                    best = max(kept, key=lambda x: (-x[0] * len(known[x[2]]), -x[1]), default=None)
                    rows.append((len(w), len(kept), best and best[2], round(-best[0], 6) if best else 0.0, ",".join(f"{n}:{s}:{e}" for _, s, n, e in kept)))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()), strict=True)]], ["doc_id", "n_words", "n_notices", "license", "coverage", "notices"])

    return run


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row for each document: doc_id, n_words, n_notices, license (of the notice with most words; null if none), coverage, notices.

    notices lists name:first word:end word of each notice found; of notices that overlap, the one with more words matched
    stands, then the earlier one, then the first name. A coverage of exactly `least` counts. Null and empty texts hold none;
    very long texts are read whole, a window at a time. Repeated documents and null ids give a row each. Empty tables give
    no rows; further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_scan_batches(templates or TEMPLATES, least), "doc_id long, n_words long, n_notices long, license string, coverage double, notices string")
