"""License scans by patience alignment of a text with license templates.

Words that occur once in both sequences are anchors; the longest increasing subsequence of their positions is kept, and the
gaps between its members, and before and behind, are aligned in the same way until a gap has no anchor. Equal words at the
ends of a gap match as well. Coverage is the share of a template's words that are matched.

A text is searched in regions: runs of the template's telling words (no stop words) with less than a template's length
between neighbours. A run is tried whole and, as a notice may come twice in it, in pieces that end where a telling word comes
more often than in the template; a piece reaches no further than the next one begins. Of overlapping finds the best covered stays.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts and headers of public licenses.
TEMPLATES = {
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GFDL-1.3": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "This project is licensed under the MIT License - see the LICENSE file for details.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
}
#: License identifiers that a tag may name.
TAGGED = "AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only MIT MPL-2.0 Unlicense Zlib".split()
TEMPLATES |= {f"SPDX:{name}": f"SPDX-License-Identifier: {name}" for name in TAGGED}
STOP = frozenset("a an and any are as at be by for from in is it no of on or that the this to under with without".split())

_words = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
        ends[k : k + 1] = [i]
        back[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched (position in a, position in b), in order."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, l = stack.pop()
        while i < j and k < l and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < l and a[j - 1] == b[l - 1]:
            j, l = j - 1, l - 1
            out.append((j, l))
        if i == j or k == l:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:l])
        place = {w: x for x, w in enumerate(b[k:l], k) if in_b[w] == 1}
        anchors = [(x, place[w]) for x, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in place]
        if not anchors:
            continue
        kept = [anchors[x] for x in increasing([y for _, y in anchors])]
        out += kept
        edges = [(i - 1, k - 1), *kept, (j, l)]
        stack += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
    return sorted(out)


def regions(words: list[str], telling: Counter, length: int) -> set[tuple[int, int]]:
    """Runs of telling words, and their pieces in which none comes more often than ``telling`` says, widened by the length."""
    runs: list[list[int]] = []
    pieces: list[list[int]] = []
    seen: Counter = Counter()
    for i, w in enumerate(words):
        if w not in telling:
            continue
        fresh = not runs or i - runs[-1][1] > length
        if fresh:
            runs.append([i, i])
        runs[-1][1] = i
        if fresh or seen[w] >= telling[w]:
            pieces.append([i, i])
            seen = Counter()
        pieces[-1][1] = i
        seen[w] += 1
    widen = lambda lo, hi, least, most: (max(least, lo - length), min(most, hi + length + 1))
    out = {widen(lo, hi, 0, len(words)) for lo, hi in runs}
    if len(pieces) > len(runs):
        ends = [(0, -1), *map(tuple, pieces), (len(words), len(words))]
        out |= {widen(lo, hi, before + 1, after) for (_, before), (lo, hi), (after, _) in zip(ends, ends[1:], ends[2:])}
    return out


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.templates = [(name, words, Counter(w for w in words if w not in STOP) or Counter(words)) for name, t in sorted(templates.items()) if (words := words_of(t))]
        self.any = frozenset(w for _, words, _ in self.templates for w in words)
        self.telling = frozenset(w for _, _, telling in self.templates for w in telling)
        self.least = least

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, last word) of each region covered to ``least``, by place; of overlapping finds the
        best covered, then that of most words, then the shortest."""
        words = words_of(text)
        have = self.any.intersection(words)
        found = set()
        for name, template, telling in self.templates if not have.isdisjoint(self.telling) else ():
            # no alignment matches more of a template than the words of it that the text has
            if sum(w in have for w in template) < self.least * len(template):
                continue
            for lo, hi in regions(words, telling, len(template)):
                matched = align(words[lo:hi], template)
                if len(matched) >= self.least * len(template):
                    found.add((-len(matched) / len(template), -len(matched), matched[-1][0] - matched[0][0], lo + matched[0][0], name))
        kept: list[tuple[str, float, int, int]] = []
        for coverage, _, span, first, name in sorted(found):
            if all(first + span < y[2] or y[3] < first for y in kept):
                kept.append((name, -coverage, first, first + span))
        return sorted(kept, key=lambda x: x[2])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_notices, licenses (names in order, comma-joined, null if none), coverage (the
    best, 0 if none), first_word, last_word of the first notice.

    Whole texts are searched. Null and empty texts have no notice; repeated rows give repeated results; other columns are
    ignored.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, least)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                found = [scanner.scan(t) for t in part.column(1).to_pylist()]
                columns = [[len(x) for x in found], [",".join(y[0] for y in x) or None for x in found], [max((y[1] for y in x), default=0.0) for x in found], [x[0][2] if x else None for x in found], [x[0][3] if x else None for x in found]]
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_notices", "licenses", "coverage", "first_word", "last_word"])

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, "doc_id bigint, n_notices bigint, licenses string, coverage double, first_word bigint, last_word bigint")
