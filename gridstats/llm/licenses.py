"""Licence notices and texts in documents: Dice coefficient over word bigrams against templates.

A text is compared as a whole, by paragraphs and by lines, after normalising: lower case, runs of letters and digits as
words. Dice is twice the number of shared distinct bigrams over the sum of both numbers. A segment can only reach a
threshold t with a template of a bigrams if it has between a t / (2 - t) and a (2 - t) / t of them; these bounds leave
most segments without any candidate, and an index of the templates' bigrams counts the shared ones of the rest.
A licence that none of these segments reaches is looked for in windows of words: along the text a bigram of the template
gains 2 - t and any other new one costs t, so the stretch of the largest sum is the one that can reach the threshold.
Rows are mapped where they are; templates are a parameter of fixed size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from gridstats.llm.text import column_bytes, slices

MIN_DICE = 0.8
WORD = re.compile(r"[^\W_]+")
KINDS = ("line", "paragraph", "text", "words")
TEXTS = Path(__file__).parent / "license_texts"  # whole licences

# Notices and texts of public licences.
WHOLE = (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"))
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
    "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
    "that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
    "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
    "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
    '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, "
    "please refer to https://unlicense.org"
)
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", ISC),
    ("BSD-2-Clause", f"{BSD_HEAD} {BSD_TAIL}"),
    ("BSD-3-Clause", f"{BSD_HEAD} {BSD_NAMES} {BSD_TAIL}"),
    ("Unlicense", UNLICENSE),
    *[(name, (TEXTS / f"{file}.txt").read_text(encoding="utf-8")) for name, file in WHOLE],
)


def bigrams(text: str) -> set[tuple[str, str]]:
    words = WORD.findall(text.lower())
    return set(zip(words, words[1:], strict=False))


class Templates:
    def __init__(self, templates: Sequence[tuple[str, str]], least: float) -> None:
        self.least = least
        self.names = [name for name, _ in templates]
        self.own = own = [bigrams(text) for _, text in templates]
        self.sizes = [len(g) for g in own]
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, found in enumerate(own):
            for g in found:
                self.index.setdefault(g, []).append(k)
        usable = [n for n in self.sizes if n]
        self.low, self.high = (min(usable) * least / (2 - least), max(usable) * (2 - least) / least) if usable else (1, 0)

    def match(self, segment: str) -> list[tuple[int, float]]:
        """(template, Dice) of all templates that a segment reaches."""
        # each bigram takes a blank or a mark between two words, so a shorter segment has too few
        if len(segment) < 3 * self.low:
            return []
        found = bigrams(segment)
        size = len(found)
        if not self.low <= size <= self.high or self.index.keys().isdisjoint(found):
            return []
        shared = Counter(k for g in found if g in self.index for k in self.index[g])
        dice = ((k, 2 * n / (size + self.sizes[k])) for k, n in shared.items())
        return [(k, d) for k, d in dice if d >= self.least]


    def windows(self, text: str, passed: set[str]) -> Iterator[tuple[int, float, int]]:
        """(template, Dice, number of its first word) of the best window for each template not ``passed`` that one reaches."""
        words = WORD.findall(text.lower())
        found = list(zip(words, words[1:], strict=False))
        shared = Counter(k for g in self.index.keys() & set(found) for k in self.index[g])
        for k, n in shared.items():
            # a window that reaches the threshold holds this share of the template
            if self.names[k] in passed or n < self.sizes[k] * self.least / (2 - self.least) - 1e-9:
                continue
            low, high = self.stretch(found, k)
            last, first = self.stretch(found[::-1], k)
            best = max((self.dice(set(found[a:b]), k), -a) for a, b in ((low, high), (len(found) - first, len(found) - last)))
            if best[0] >= self.least:
                yield k, best[0], -best[1]

    def dice(self, found: set[tuple[str, str]], k: int) -> float:
        return 2 * len(found & self.own[k]) / (len(found) + self.sizes[k])

    def stretch(self, found: list[tuple[str, str]], k: int) -> tuple[int, int]:
        """The stretch of the largest sum; a bigram that it has already gains and costs nothing."""
        own, start, total, best = self.own[k], 0, 0.0, (0.0, 0, 0)
        last: dict[tuple[str, str], int] = {}
        for place, g in enumerate(found):
            if total <= 0:
                start, total = place, 0.0
            if last.get(g, -1) < start:
                total += 2 - self.least if g in own else -self.least
            last[g] = place
            if total > best[0]:
                best = total, start, place + 1
        return best[1:]


def best_matches(text: str, templates: Templates) -> list[tuple[str, float, str, int]]:
    """(licence, Dice, kind of segment, its number) for each licence of a text: the best segment, the first of several.

    Windows of words are used for licences that no line, paragraph or whole text reaches.
    """
    lines = text.split("\n")
    paragraphs = re.split(r"\n[ \t]*\n", text) if "\n" in text else lines
    best: dict[str, tuple[float, int, int]] = {}
    for kind, segments in enumerate((lines, paragraphs if len(lines) > 1 else [], [text] if len(paragraphs) > 1 else [])):
        for place, segment in enumerate(segments):
            for k, dice in templates.match(segment):
                name = templates.names[k]
                if name not in best or dice > best[name][0]:
                    best[name] = dice, kind, place
    passed = set(best)
    for k, dice, place in templates.windows(text, passed):
        name = templates.names[k]
        if name not in best or dice > best[name][0]:
            best[name] = dice, len(KINDS) - 1, place
    return [(name, dice, KINDS[kind], place) for name, (dice, kind, place) in sorted(best.items())]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = MIN_DICE) -> DataFrame:
    """doc_id, license, dice, kind, place for each row of ``docs(doc_id, text)`` and licence that it names.

    A text that is null, empty or names no licence gives no row. Repeated rows and null doc_ids are rows like others.
    """
    shared = [tuple(t) for t in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(shared, least)
        for batch in batches:
            offsets, _ = column_bytes(batch.column(1))
            for low, high in slices(offsets):
                part = batch.slice(low, high - low)
                rows = [(i, *m) for i, text in enumerate(part.column(1).to_pylist()) if text for m in best_matches(text, known)]
                at, names, dice, kinds, places = zip(*rows, strict=True) if rows else ((), (), (), (), ())
                yield pa.record_batch(
                    {
                        "doc_id": part.column(0).take(pa.array(at, pa.int64())),
                        "license": pa.array(names, pa.string()),
                        "dice": pa.array(dice, pa.float64()),
                        "kind": pa.array(kinds, pa.string()),
                        "place": pa.array(places, pa.int64()),
                    }
                )

    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, "doc_id long, license string, dice double, kind string, place long")
