"""Licence scans: passages of a text held against licence templates by their Dice coefficient over word bigrams.

A text's passages are its lines, its paragraphs (lines without a blank one between) of several lines, all of it
if it has several paragraphs, and windows of words, across lines or inside one, where a template lies and no
passage of the other kinds has told it at least as well. Passages and templates are normalised to lower-case words of ASCII letters
and digits; their bigrams are counted with repeats. The coefficient is twice the shared bigrams over all
bigrams of both. A passage of n bigrams can reach the threshold t only with templates of between
n t / (2 - t) and n (2 - t) / t bigrams: only these are candidates, and passages outside all bounds are not looked at. A window shares at least t / (2 - t) of a
template's bigrams, so it holds one of any larger set of the others: only around these anchors are windows tried.

Scale: a text never leaves its task; the templates are a fixed list. There is no shuffle and no group.

Defined cases: null and empty texts, and passages of fewer than two words, match nothing. Of equally similar
templates the first name counts. Every row is judged by itself, repeated or not.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import as_bytes, map_arrow, slices

THRESHOLD = 0.8
#: Templates of so few bigrams have to be found at their full length: a part of them may belong to several licences.
SHORT = 20
WORD = re.compile(rb"[a-z0-9]+")

#: Notices and short texts of well-known licences.
TEMPLATES = {
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0-1.0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain under CC0 1.0."],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ],
    "lgpl-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "lgpl-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Templates:
    """The templates in order of their number of bigrams, and which of them hold a bigram."""

    def __init__(self, templates: dict[str, list[str]], threshold: float = THRESHOLD):
        rows = [(name, words(t.encode())) for name, texts in templates.items() for t in texts]
        rows = sorted(((len(w) - 1, name, Counter(zip(w, w[1:]))) for name, w in rows), key=lambda r: r[:2])
        self.sizes, self.names = [r[0] for r in rows], [r[1] for r in rows]
        self.holders: dict[tuple[bytes, bytes], dict[int, int]] = {}
        for i, (_, _, bigrams) in enumerate(rows):
            for bigram, n in bigrams.items():
                self.holders.setdefault(bigram, {})[i] = n
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)
        self.bigrams = [r[2] for r in rows]
        self.anchors: dict[tuple[bytes, bytes], list[int]] = {}
        for i, (n, _, bigrams) in enumerate(rows):
            left = n * (1 - self.ratio)
            for bigram in sorted(bigrams, key=lambda b: (-min(map(len, b)), b)):  # of long words first: these are rare
                self.anchors.setdefault(bigram, []).append(i)
                left -= bigrams[bigram]
                if left < -1e-9:
                    break

    def match(self, found: list[bytes]) -> tuple[str, float] | None:
        """The most similar template of a passage (its words), if it reaches the threshold."""
        n = len(found) - 1
        # one bigram of slack: the exact comparison below decides
        first, last = bisect_left(self.sizes, n * self.ratio - 1), bisect_right(self.sizes, n / self.ratio + 1)
        if n < 1 or first == last:
            return None
        held = Counter(b for b in zip(found, found[1:]) if b in self.holders)
        shared: Counter = Counter()
        if 2 * sum(held.values()) < self.threshold * n:
            return None  # even all of them shared with one template aren't enough
        for bigram, times in held.items():
            for i, own in self.holders[bigram].items():
                if first <= i < last:
                    shared[i] += min(times, own)
        best = min(((-2 * s / (n + self.sizes[i]), self.names[i]) for i, s in shared.items()), default=(0.0, ""))
        return (best[1], -best[0]) if -best[0] >= self.threshold else None


    def windows(self, found: list[bytes]) -> list[tuple[int, int, str, float]]:
        """First word, end, licence and coefficient of the best windows of a text (its words) that do not overlap."""
        pairs = list(zip(found, found[1:]))
        near: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs):
            if pair in self.anchors:
                for i in self.anchors[pair]:
                    near.setdefault(i, []).append(at)
        rows = []
        for i, places in near.items():
            most, regions = int(self.sizes[i] / self.ratio + 1e-9), []
            for at in places:
                first, last = max(0, at - most + 1), min(len(pairs), at + most)
                if regions and first <= regions[-1][1]:
                    regions[-1][1] = last
                else:
                    regions.append([first, last])
            for first, last in regions:
                rows += [(first + a, first + b + 1, self.names[i], dice) for a, b, dice in self.inside(i, most, pairs[first:last])]
        kept: list[tuple[int, int, str, float]] = []
        for row in sorted(rows, key=lambda r: (-r[3], r[2], r[0])):
            at = bisect_left(kept, row)
            if (not at or kept[at - 1][1] <= row[0]) and (at == len(kept) or row[1] <= kept[at][0]):
                kept.insert(at, row)
        return kept

    def inside(self, i: int, most: int, pairs: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, float]]:
        """Places (first and end bigram) and coefficients of the windows of one template, from the left."""
        own, size = self.bigrams[i], self.sizes[i]
        least, enough = size if size <= SHORT else 1, size * self.ratio - 1e-9
        sums = [0]
        for pair in pairs:
            sums.append(sums[-1] + (pair in own))
        best, a = (0.0, 0, 0), 0
        while a < len(pairs):
            if best[0] and (a >= best[2] or a > best[1] + most // 2):
                yield best[1], best[2], best[0]
                a, best = max(a, best[2]), (0.0, 0, 0)
                continue
            end = min(a + most, len(pairs))
            if pairs[a] in own and sums[end] - sums[a] >= enough:
                left, shared = dict(own), 0
                for b in range(a, end):
                    if left.get(pairs[b], 0):
                        left[pairs[b]] -= 1
                        shared += 1
                        dice = 2 * shared / (b + 1 - a + size)
                        if b + 1 - a >= least and dice >= self.threshold and dice > best[0]:
                            best = dice, a, b + 1
            a += 1
        if best[0]:
            yield best[1], best[2], best[0]


@cache
def fixed_templates() -> Templates:
    return Templates(TEMPLATES)


def passages(text: bytes, known: Templates | None = None) -> Iterator[tuple[int, int, list[bytes]]]:
    """First line (from 0), number of lines and words of every passage; windows last."""
    known = known or fixed_templates()
    lines = [words(line) for line in text.split(b"\n")]
    blocks: list[list[int]] = [[]]
    for i, line in enumerate(lines):
        yield i, 1, line
        if line:
            blocks[-1].append(i)
        elif blocks[-1]:
            blocks.append([])
    blocks = [b for b in blocks if b]
    for block in blocks:
        if len(block) > 1:
            yield block[0], block[-1] - block[0] + 1, [w for i in block for w in lines[i]]
    flat = [w for line in lines for w in line]
    if len(blocks) > 1:
        yield 0, len(lines), flat
    if not (found := known.windows(flat)):
        return
    ends = list(accumulate(map(len, lines)))
    kinds = [(i, 1) for i in range(len(lines))], [(b[0], b[-1] - b[0] + 1) for b in blocks], [(0, len(lines))]
    told: list[list[tuple]] = [[], [], []]
    for spans, hits in zip(kinds, told, strict=True):  # each in order, without overlap
        for first, n in spans:
            start, stop = ends[first] - len(lines[first]), ends[first + n - 1]
            if hit := known.match(flat[start:stop]):
                hits.append((start, stop, *hit))

    def as_well(hits: list[tuple], start: int, stop: int, name: str, dice: float) -> bool:
        near = hits[max(0, bisect_left(hits, (start,)) - 1) : bisect_left(hits, (stop,))]
        return any(start < end and (other == name or better >= dice) for _, end, other, better in near)

    for start, stop, name, dice in found:
        if not any(as_well(hits, start, stop, name, dice) for hits in told):
            first, last = bisect_right(ends, start), bisect_right(ends, stop - 1)
            yield first, last - first + 1, flat[start:stop]


FOUND = "array<struct<license: string, dice: double, line: int, lines: int>>"


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and the passages that match a template, in order of place, with their coefficient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("line", pa.int32()), ("lines", pa.int32())]))
        for batch in slices(batches):
            rows = [
                [
                    {"license": hit[0], "dice": hit[1], "line": line, "lines": lines}
                    for line, lines, found in passages(text, known)
                    if (hit := known.match(found))
                ]
                for text in as_bytes(batch)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "found"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, found {FOUND}")


def summary(found: DataFrame) -> DataFrame:
    """Per document the number of matching passages, all licences found, and the best match (ties: the first name)."""
    best = F.array_min(F.transform("found", lambda f: F.struct((-f.dice).alias("minus"), f.license.alias("license"))))
    return found.select(
        "doc_id",
        F.size("found").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f.license))), ",").alias("licenses"),
        best.license.alias("license"),
        (-best.minus).alias("dice"),
    )
