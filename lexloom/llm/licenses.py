"""License scans by conditional compression.

1. Candidate blocks: lines that speak of licensing, with the lines around them that use
   license wording; lines without a letter or digit don't part them. Only words around what
   speaks of licensing in a block go on, as far to each side as the longest license may
   reach, so a long line is cut and wording over line ends isn't.
2. Ranking: where a template can stand (around its rarest word for a window of its length,
   and wherever enough of its words are for a changed long one) the words are compressed
   with zstandard once alone and once with the template as a raw dictionary. Windows that
   get no smaller go; the others are taken in order of the bytes saved. A window has the
   template's size, so a long line around it hides nothing, and their number isn't limited.
3. Confirmation by exact wording differences, over line ends and any number of times: a
   short notice if all of its words stand there one after another, a long text if nearly all
   of its words do in order, within WITHIN times its length, with no number of it changed.
   What is missing or added is reported. Where confirmed wordings share words, the one that
   saves most stands, less the bytes of its words that are missing.

Every text is scanned alone and whole; there is no shuffle.

Defined cases: null is the empty text, of no blocks. A very long text is scanned whole, in
time that grows with its words and with what it finds. Wording is compared without case and
without punctuation around words. Repeated rows give repeated results. Columns other than
key and text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from lexloom.llm import shared as S

SCHEMA = "doc_id long, n_blocks long, licenses string, spans string, exact boolean, differences string, best_gain double"

#: Words up to which a template is a notice, all of whose words must be there; and the share of a longer one's.
NOTICE_WORDS, LEAST_COVER = 24, 0.9
#: A long text with what is added to it has at most so many times its words.
WITHIN = 8
LEVEL = 3

# What speaks of licensing, in lower case.
TRIGGERS = ["licens", "licenc", "copyright", "permission is hereby", "permission to use", "redistribution", "warrant", "spdx", "creative commons", "public domain", "cc by", "cc-by", "cc0", "unencumbered"]

# Every template has a word with one of these in it.
HINTS = ["licens", "spdx", "permission", "redistribution", "unencumbered", "cc0"]

# The public wording of common licenses and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "BSD-2-Clause": [
        "SPDX-License-Identifier: BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "BSD-3-Clause": [
        "SPDX-License-Identifier: BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version.""",
    ],
    "LGPL-2.1": [
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version.""",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["SPDX-License-Identifier: CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ],
    "Zlib": [
        "SPDX-License-Identifier: Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
        transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
        is furnished to do so""",
    ],
    "EPL-2.0": [
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "0BSD": ["SPDX-License-Identifier: 0BSD"],
}

_WORD = re.compile(r"\S+")
_TRIGGER = re.compile("|".join(map(re.escape, TRIGGERS)), re.IGNORECASE)
_AROUND = "\"'`.,;:()[]{}<>*#!?$%&|/\\-"


def wording(text: str) -> list[str]:
    words = (w.strip(_AROUND).lower() for w in _WORD.findall(text))
    return [w for w in words if w]


class Template:
    """A wording with its dictionary, and the places of its words as bits."""

    def __init__(self, name: str, text: str):
        self.name, self.words = name, wording(text)
        self.n, self.long = len(self.words), len(self.words) > NOTICE_WORDS
        shared = zstandard.ZstdCompressionDict(" ".join(self.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False)
        self.least = next(k for k in range(self.n + 1) if k / self.n >= LEAST_COVER)
        self.counts, self.bits, self.back = Counter(self.words), {}, {}
        self.offsets = {w: [i for i, x in enumerate(self.words) if x == w] for w in self.counts}
        for i, w in enumerate(self.words):
            self.bits[w] = self.bits.get(w, 0) | 1 << i
            self.back[w] = self.back.get(w, 0) | 1 << (self.n - 1 - i)


def in_order(words: list[str], at: Iterator[int], bits: dict[str, int], n: int) -> Iterator[tuple[int, int]]:
    """(place, how many of the n words of a template stand in order up to it) for each of the places ``at``."""
    rows = mask = (1 << n) - 1
    for i in at:
        same = rows & bits[words[i]]
        rows = (rows + same | rows - same) & mask
        yield i, n - rows.bit_count()


def aligned(wanted: list[str], words: list[str]) -> list[tuple[int, int]]:
    """The longest list of pairs of equal words in order, with as many numbers as it can have."""
    worth = [len(wanted) + 1 + any(c.isdigit() for c in w) for w in wanted]
    best = [[0] * (len(words) + 1)]
    for w, v in zip(wanted, worth):
        above, row = best[-1], [0]
        for j, x in enumerate(words):
            row.append(above[j] + v if w == x else max(above[j + 1], row[-1]))
        best.append(row)
    out, i, j = [], len(wanted), len(words)
    while i and j:
        if wanted[i - 1] == words[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i - 1][j] >= best[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


class Scanner:
    """Templates with what finds them."""

    def __init__(self):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.templates = [Template(name, text) for name, texts in TEMPLATES.items() for text in texts]
        self.vocabulary = {w for t in self.templates if t.long for w in t.words}
        self.said = {w for t in self.templates for w in t.words}
        self.reach = WITHIN * max(t.n for t in self.templates)

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Spans of the candidate blocks: lines with a trigger, and license wording next to them or past lines without words."""
        lower = text.lower()
        if not any(t in lower for t in TRIGGERS):
            return
        lines, at = [], 0
        for line in text.split("\n"):
            small = line.lower()
            # blank lines and bare comment marks go on with what is around them
            kind = None if not any(c.isalnum() for c in line) else 2 if any(t in small for t in TRIGGERS) else 1 if self._license_like(small) else 0
            lines.append((at, at + len(line), kind))
            at += len(line) + 1
        i = 0
        while i < len(lines):
            j = end = i
            while lines[i][2] and j < len(lines) and lines[j][2] != 0:
                j += 1
                if lines[j - 1][2]:
                    end = j
            if any(kind == 2 for _, _, kind in lines[i:end]):
                yield lines[i][0], lines[end - 1][1]
            i = max(j, i + 1)

    def _license_like(self, line: str) -> bool:
        words = wording(line)
        return bool(words) and sum(w in self.vocabulary for w in words) >= 0.8 * len(words)

    def candidates(self, text: str, blocks: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[list[int]]:
        """[first word, end] of what a license of a block can lie in, from left to right, no two with common words; spans: of the words in the text."""
        starts, out = [a for a, _ in spans], []
        for begin, end in blocks:
            for m in _TRIGGER.finditer(text, begin, end):
                first, last = bisect_right(starts, m.start()) - 1, bisect_right(starts, m.end() - 1)
                first, last = max(0, first - self.reach), min(len(spans), last + self.reach)
                if out and first <= out[-1][1]:
                    out[-1][1] = max(last, out[-1][1])
                else:
                    out.append([first, last])
        return out

    def ranked(self, words: list[str], template: Template, where: dict[str, list[int]]) -> list[tuple[tuple[int, float], int]]:
        """((bytes, share) saved, first word) of the windows that can be a template, the one that saves most first; where: places of the words."""
        rare = min(template.offsets, key=lambda w: len(where.get(w, ())))
        known: dict[tuple[str, ...], tuple[int, float]] = {}
        out = []
        for start in sorted({i - k for i in where.get(rare, ()) for k in template.offsets[rare]}):
            if 0 <= start <= len(words) - template.n:
                window = tuple(words[start : start + template.n])
                if window not in known:
                    known[window] = self.saved(window, template)
                if known[window][0] > 0:
                    out.append((known[window], start))
        return sorted(out, key=lambda x: (-x[0][0], x[1]))

    def saved(self, words: Sequence[str], template: Template) -> tuple[int, float]:
        """Bytes, and the share, by which the words get smaller with the template."""
        data = " ".join(words).encode()
        alone, shared = len(self.plain.compress(data)), len(template.compressor.compress(data))
        return alone - shared, 1 - shared / alone

    def confirm(self, words: list[str], first: int, end: int, template: Template) -> tuple[list[int], list[str], list[str]] | None:
        """(places of the words that say the template, missing, added words) of words[first:end], or None."""
        some = words[first:end]
        greedy = [(m.a + k, m.b + k) for m in SequenceMatcher(None, template.words, some, autojunk=False).get_matching_blocks() for k in range(m.size)]
        for pairs in (lambda: greedy, lambda: aligned(template.words, some)):
            said, kept = ({p[k] for p in pairs()} for k in (0, 1))
            missing = [w for i, w in enumerate(template.words) if i not in said]
            if len(said) >= template.least and not any(c.isdigit() for w in missing for c in w):
                added = [some[j] for j in range(min(kept), max(kept)) if j not in kept and some[j]]
                return sorted(first + j for j in kept), missing, added
        return None

    def nearly(self, words: list[str], template: Template) -> Iterator[tuple[list[int], list[str], list[str]]]:
        """What confirms a long template, from left to right, no two with common words."""
        width, done = WITHIN * template.n, 0
        known = [i for i, w in enumerate(words) if w in template.bits]
        if (Counter(words[i] for i in known) & template.counts).total() < template.least:
            return
        # whatever is at most as long as width lies inside one of these
        for left in range(0, len(words), width):
            right = left + 2 * width
            at = known[bisect_left(known, max(left, done)) : bisect_left(known, right)]
            if (Counter(words[i] for i in at) & template.counts).total() < template.least or self.saved([words[i] for i in at], template)[0] <= 0:
                continue
            while (Counter(words[i] for i in at) & template.counts).total() >= template.least:
                stop = next((i for i, k in in_order(words, at, template.bits, template.n) if k >= template.least), None)
                if stop is None:
                    break
                before = [i for i in reversed(at) if i <= stop]
                start = next(i for i, k in in_order(words, before, template.back, template.n) if k >= template.least)
                found = self.fitted(words, start, stop, max(left, done), template) if stop - start < width else None
                if found is not None:
                    done = found[0][-1] + 1
                    yield found
                at = at[bisect_left(at, start + 1 if found is None else done) :]

    def fitted(self, words: list[str], start: int, stop: int, least: int, template: Template) -> tuple[list[int], list[str], list[str]] | None:
        """What confirms a template around the shortest span with enough of its words, with the words at both ends that go with it."""
        further = 2 * (template.n - template.least) + 8
        at = [i for i in range(start, min(len(words), stop + 1 + further)) if words[i] in template.bits]
        end = max((4 * k - (i - start), -i) for i, k in in_order(words, at, template.bits, template.n) if i >= stop)[1] * -1
        at = [i for i in range(end, max(least, start - further) - 1, -1) if words[i] in template.bits]
        first = max((4 * k - (end - i), i) for i, k in in_order(words, at, template.back, template.n))[1]
        return self.confirm(words, first, end + 1, template) or self.confirm(words, start, end + 1, template)

    def scan_words(self, words: list[str]) -> list[tuple[str, float, int, int, list[str], list[str]]]:
        """(license, gain, first word, end, missing words, added words) of every license the words state."""
        where: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.said:
                where.setdefault(w, []).append(i)
        claims = []
        for number, template in enumerate(self.templates):
            places, rest = [], words
            for size, start in self.ranked(words, template, where):
                # windows of the same words save the same, so they come from left to right
                if words[start : start + template.n] == template.words and (not places or start >= places[-1] + template.n):
                    places.append(start)
                    claims.append((size, number, list(range(start, start + template.n)), [], []))
            if template.long:
                if places:
                    rest = list(words)
                    for p in places:
                        rest[p : p + template.n] = [""] * template.n
                claims += [(self.saved(words[f[0][0] : f[0][-1] + 1], template), number, *f) for f in self.nearly(rest, template)]
        found, taken = [], set()
        # what a template says and the words don't counts against it: else a text that lacks a telling word could rank first
        for (_, gain), number, said, missing, added in sorted(claims, key=lambda c: (len(" ".join(c[3])) - c[0][0], c[2][0], c[1])):
            if taken.isdisjoint(said):
                taken.update(said)
                found.append((self.templates[number].name, gain, said[0], said[-1] + 1, missing, added))
        return found

    def scan(self, text: str) -> tuple[int, list]:
        lower = text.lower()
        if not any(h in lower for h in HINTS):
            return sum(1 for _ in self.blocks(text)), []
        blocks = list(self.blocks(text))
        spans = [m.span() for m in _WORD.finditer(text) if m.group().strip(_AROUND)] if blocks else []
        words = [text[a:b].strip(_AROUND).lower() for a, b in spans]
        found = []
        for first, end in self.candidates(text, blocks, spans):
            for name, gain, s, e, missing, added in self.scan_words(words[first:end]):
                found.append((name, gain, spans[first + s][0], spans[first + e - 1][1], missing, added))
        return len(blocks), found


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its candidate blocks, and the licenses confirmed in them.

    licenses: distinct names, sorted; spans: license:start:end in code points, by place;
    exact: some license is stated without any difference; differences: -missing +added words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                n, found = scanner.scan(value.as_py() or "")
                found.sort(key=lambda f: (f[2], f[3]))
                differences = [" ".join(["-" + w for w in f[4]] + ["+" + w for w in f[5]]) for f in found]
                rows.append((n, ",".join(sorted({f[0] for f in found})), ",".join(f"{f[0]}:{f[2]}:{f[3]}" for f in found), any(not d for d in differences), "; ".join(d for d in differences if d), round(max((f[1] for f in found), default=0.0), 4)))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], [f.split()[0] for f in SCHEMA.split(", ")])

    return S.keyed(docs, key, text).mapInArrow(S.trimmed(run), SCHEMA)
