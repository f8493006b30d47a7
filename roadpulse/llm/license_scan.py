"""Operator 2: licence texts and notices, by winnowed fingerprints and banded alignment.

Templates are cut into words. Of every WINDOW runs of GRAM words in a row the one with the least
hash is a fingerprint, so any GRAM + WINDOW - 1 words that a text shares with a template hold one.
An inverted index from fingerprint to places in templates finds candidates in a text: a template
and a diagonal (place in the text minus place in the template). Around each diagonal a band of
the text is aligned with the whole template; the alignment tells how much of the template is
matched, and from where to where. Of matches that overlap the one with most matched words stays.

The templates are a fixed list, so the index is small and goes along with the code. The scan
is a map over whole texts: no shuffle, and a text is read once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import ship_code, table

GRAM, WINDOW = 3, 2
#: Words inserted or left out by which an alignment may leave its diagonal.
BAND = 8
#: Least share of a template's words that must match.
COVERAGE = 0.75
#: Words that tell no licence from another. All other words of a notice must match: they are what
#: it says. Of longer texts any words may be left out.
FILLERS = frozenset(b"released under the licensed this project work is license version spdx identifier".split())
NOTICE_WORDS = 24

_WORD = re.compile(rb"[a-z0-9]+")

# Public licence notices and the usual headers and bodies of licences, as
# (licence, text). Words alone count; case and punctuation do not.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Released under MIT License."),
    ("MIT", "Licensed under MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
)
TEXTS = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
)
#: The identifier line that files of each of these licences may carry instead.
IDENTIFIERS = tuple(
    (name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in (*NOTICES, *TEXTS)})
)
TEMPLATES = (*NOTICES, *TEXTS, *IDENTIFIERS)

Match = tuple[str, int, float, int, int, int]  # licence, template, coverage, matched, first, last


def _mix(x: np.ndarray) -> np.ndarray:
    """A spread order for fingerprints (the public splitmix64 finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Index:
    """Templates as word numbers, and the places of their fingerprints."""

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        words = [_WORD.findall(text.encode().lower()) for _, text in templates]
        self.names = [name for name, _ in templates]
        self.numbers = {word: n for n, word in enumerate(sorted({w for t in words for w in t}))}
        self.templates = [[self.numbers[w] for w in t] for t in words]
        fillers = {self.numbers[word] for word in FILLERS if word in self.numbers}
        self.told = [
            [w for w in t if w not in fillers] if len(t) < NOTICE_WORDS else [] for t in self.templates
        ]
        places = defaultdict(list)
        for number, template in enumerate(self.templates):
            grams = self.grams(np.array(template, np.int64))
            for place in self.winnowed(grams):
                places[int(grams[place])].append((number, int(place)))
        self.keys = np.array(sorted(places), np.int64)
        self.places = [places[int(key)] for key in self.keys]

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """One number for each run of GRAM words; -1 where one is in no template."""
        n = max(len(numbers) - GRAM + 1, 0)
        total, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            part = numbers[k : k + n]
            total = total * len(self.numbers) + part
            known &= part >= 0
        return np.where(known, total, -1)

    @staticmethod
    def winnowed(grams: np.ndarray) -> list[int]:
        """Places of the least hash (the last of equals) of every WINDOW in a row."""
        order = _mix(grams.astype(np.uint64))
        windows = range(max(len(order) - WINDOW + 1, min(len(order), 1)))
        chosen = set()
        for at in windows:
            part = order[at : at + WINDOW]
            chosen.add(at + len(part) - 1 - int(np.argmin(part[::-1])))
        return sorted(chosen)

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) of the fingerprints in a text; one for diagonals that are near."""
        grams = self.grams(numbers)
        found = np.searchsorted(self.keys, grams)
        found[found == len(self.keys)] = 0
        hits = np.flatnonzero(self.keys[found] == grams)
        diagonals = sorted(
            {(t, int(at) - place) for at in hits for t, place in self.places[found[at]]}
        )
        kept: list[tuple[int, int]] = []
        for template, diagonal in diagonals:
            if not kept or kept[-1][0] != template or diagonal - kept[-1][1] > BAND // 2:
                kept.append((template, diagonal))
        return kept

    def align(self, numbers: list[int], template: int, diagonal: int) -> tuple[int, int, int]:
        """Matched words of the template in the band, and the first and last one's place.

        Longest common subsequence of the template and the text, at most BAND off the diagonal;
        of equally long ones the one that starts last, and of these the one that ends first.
        """
        words = self.templates[template]
        width = 2 * BAND + 1
        # Per place in the band: (matched, first, -last) of the best alignment so far.
        row = [(0, -1, 0)] * (width + 1)
        for i, word in enumerate(words):
            new = [(0, -1, 0)] * (width + 1)
            for b in range(width):
                j = i + diagonal - BAND + b
                best = row[b + 1]  # the word of the template is left out
                if b and new[b - 1] > best:  # the word of the text is left out
                    best = new[b - 1]
                if 0 <= j < len(numbers) and numbers[j] == word:
                    matched, first, _ = row[b]
                    one_more = (matched + 1, first if matched else j, -j)
                    if one_more > best:
                        best = one_more
                new[b] = best
            row = new
        matched, first, last = max(row)
        return matched, first, -last

    def says(self, numbers: list[int], template: int) -> bool:
        """Whether the words that tell the licence of a notice stand there in their order."""
        words = iter(numbers)
        return all(word in words for word in self.told[template])

    def scan(self, text: str | None) -> list[Match]:
        """Matches in a whole text, in order; places in code points, the end exclusive."""
        data = (text or "").encode().lower().replace(b"licence", b"license")
        words = _WORD.findall(data)
        if len(words) < GRAM:
            return []
        numbers = list(map(self.numbers.get, words, repeat(-1)))
        found = []
        for template, diagonal in self.candidates(np.array(numbers, np.int64)):
            size = len(self.templates[template])
            matched, first, last = self.align(numbers, template, diagonal)
            if matched >= COVERAGE * size and self.says(numbers[first : last + 1], template):
                found.append((matched, matched / size, -template, first, last))
        # Most matched words first, then the better covered, then the first template and place.
        taken: list[tuple[int, int]] = []
        kept = []
        for matched, coverage, template, first, last in sorted(
            found, key=lambda x: (-x[0], -x[1], -x[2], x[3])
        ):
            if all(last < a or b < first for a, b in taken):
                taken.append((first, last))
                kept.append((first, last, -template, coverage, matched))
        if not kept:
            return []
        spans = [x.span() for x in _WORD.finditer(data)]
        whole = len(data) == len(text)  # only ASCII: bytes are code points

        def place(at: int) -> int:
            return at if whole else len(data[:at].decode())

        return [
            (self.names[t], t, coverage, matched, place(spans[a][0]), place(spans[b][1]))
            for a, b, t, coverage, matched in sorted(kept)
        ]


@lru_cache(2)
def _index(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(templates)


def find_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """A row for each match in a text: doc_id, license, template, coverage, matched, first, last.

    ``template`` counts along ``templates``; ``coverage`` is the share of its words that match,
    ``first`` and ``last`` the span in code points (end exclusive). Null and empty texts have no
    match; repeated rows have theirs each; other columns are ignored. ``licence`` reads as ``license``.
    """
    ship_code(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index(templates)
        columns = ["doc_id", "license", "template", "coverage", "matched", "first", "last"]
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"])
                for match in index.scan(text)
            ]
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        scan,
        "doc_id long, license string, template int, coverage double, matched int, "
        "first long, last long",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and texts in every whole document."""
    return find_licenses(table(spark, sf_dir, "documents"))
