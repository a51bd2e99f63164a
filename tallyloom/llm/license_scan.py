"""License scans: stretches of a text against licence templates by the Dice coefficient of their word bigrams.

Texts and templates are normalised alike: A-Z in lower case, ASCII punctuation taken out, runs of white space as one, digits as 0
(so a template covers all versions). The score of a stretch of words and a template is 2 * common / (a + b) over their sets of bigrams,
and a template is found where the best stretch of a text scores SCORE or more.

Size bounds prune first: of a template of b bigrams, only stretches of at most b * (2 - SCORE) / SCORE bigrams can score enough,
and only if at least b * SCORE / (2 - SCORE) of them are the template's. Those bounds are checked for all texts of a batch at
once; the few places that pass are scored exactly. A best stretch begins and ends with a common bigram, so only those are tried.

Licences share words, so of all stretches that score enough the best is taken first, then the best that overlaps with none taken, and so on; a licence named inside another's notice is
found where it also stands apart from it. Templates are notices, SPDX lines, and whole texts: whole short licences, and of long ones what their notices say. The version is the first number in a stretch
that is written as it is, or null (a template stands for all versions, since digits count as 0). Each text gives one row for each licence found, for the best of its stretches taken (of equals the longest template's, and its first). Null, empty and one-word texts have no
bigram and give none. Rows with the same doc_id give rows each for itself, a text of any length is scanned as a whole, columns of other names are left out.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import table, text_slices
from tallyloom.llm.wordhash import find_words, grams

SCORE = 0.8

# Names of licences as notices give them, by SPDX-like id without version.
NAMES = {
    "MIT": ["MIT License", "MIT Licence"],
    "Apache": ["Apache License, Version 2.0", "Apache License 2.0"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License"],
    "LGPL": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License"],
    "AGPL": ["GNU Affero General Public License, version 3", "GNU Affero General Public License"],
    "MPL": ["Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License"],
    "ISC": ["ISC License"],
    "EPL": ["Eclipse Public License, Version 2.0"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
}
# How notices begin, and whole notices.
BEGINNINGS = ["Licensed under {}", "Licensed under the {}", "Released under the {}", "This work is licensed under the {}", "Distributed under the terms of the {}"]
WHOLE = {
    "All-rights-reserved": ["All rights reserved."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "Apache": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "BSL": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"],
}
# SPDX identifiers by licence.
SPDX = {
    "MIT": ["MIT"], "Apache": ["Apache-2.0"], "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0", "GPL-3.0"], "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "MPL": ["MPL-2.0"], "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "ISC": ["ISC"], "EPL": ["EPL-2.0"], "CC0": ["CC0-1.0"], "CC-BY": ["CC-BY-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"], "Unlicense": ["Unlicense"], "Zlib": ["Zlib"], "BSL": ["BSL-1.0"],
}


def default_templates() -> list[tuple[str, str]]:
    return [(k, b.format(n)) for k, names in NAMES.items() for n in names for b in BEGINNINGS] + [(k, t) for k, texts in WHOLE.items() for t in texts] + [(k, f"SPDX-License-Identifier: {x}") for k, ids in SPDX.items() for x in ids]


@dataclass
class Templates:
    """For each template its licence and sorted bigrams; present marks the low bits of all of them."""

    names: list[str]
    bigrams: list[np.ndarray]
    all: np.ndarray
    present: np.ndarray


_LOW = np.uint64((1 << 20) - 1)


def _bigrams(texts: pa.Array):
    plain = pc.replace_substring_regex(texts.cast(pa.string()), "[0-9]", "0")
    words = find_words(plain, lower=True, bare=True)
    hashes, begin = grams(words.hash, words.first, 2)
    return words, hashes, begin


def prepare(templates: list[tuple[str, str]]) -> Templates:
    words, hashes, begin = _bigrams(pa.array([t for _, t in templates], pa.string()))
    owner = words.text[begin]
    sets = [np.unique(hashes[owner == i]) for i in range(len(templates))]
    kept = {tuple(s.tolist()): i for i, s in reversed(list(enumerate(sets))) if len(s)}
    order = sorted(kept.values())
    every = np.unique(np.concatenate([sets[i] for i in order])) if order else np.zeros(0, np.uint64)
    present = np.zeros(int(_LOW) + 1, bool)
    present[every & _LOW] = True
    return Templates([templates[i][0] for i in order], [sets[i] for i in order], every, present)


def best_stretch(hashes: np.ndarray, at: np.ndarray, size: int, most: int, score: float) -> tuple[float, int, int] | None:
    """The best (score, first bigram, bigrams) of the stretches that begin and end with one of the hits at, whose hashes are given; size: the template's bigrams."""
    best = None
    for i in range(len(at)):
        common: set[int] = set()
        for j in range(i, len(at)):
            length = int(at[j] - at[i]) + 1
            if length > most:
                break
            common.add(int(hashes[j]))
            dice = 2 * len(common) / (size + length)
            if best is None or dice > best[0] + 1e-12:
                best = (dice, int(at[i]), length)
    return best if best and best[0] >= score - 1e-9 else None


def longest_from(hashes: np.ndarray, at: np.ndarray, i: int, size: int, most: int, score: float, end: int | None = None) -> tuple[float, int] | None:
    """The best (score, bigrams) of the stretches from hit i to a later hit before the place end; the shortest on ties."""
    best = None
    common: set[int] = set()
    for j in range(i, len(at)):
        length = int(at[j] - at[i]) + 1
        if length > most or (end is not None and at[j] >= end):
            break
        common.add(int(hashes[j]))
        dice = 2 * len(common) / (size + length)
        if best is None or dice > best[0] + 1e-12:
            best = (dice, length)
    return best if best and best[0] >= score - 1e-9 else None


def settled(spots: list[tuple[str, int, int, np.ndarray, np.ndarray]], score: float) -> dict[str, tuple[float, int, int]]:
    """Score, first word and number of words of each licence's best stretch, for the spots (licence, template's bigrams, most, hashes, places) of one text.

    Of all stretches of all templates that score enough, the best is taken, then the best that overlaps with none taken, and so on, until every
    licence that can have one has its first. A place's best stretch is looked for again, before the next one taken, when its end is taken.
    """
    heap: list[tuple] = []

    def offer(k: int, i: int, end: int | None) -> None:
        name, size, most, hashes, at = spots[k]
        got = longest_from(hashes, at, i, size, most, score, end)
        if got:
            heapq.heappush(heap, (-round(got[0], 9), -size, name, int(at[i]), k, i, got[1], got[0]))

    for k, (_, _, _, _, at) in enumerate(spots):
        for i in range(len(at)):
            offer(k, i, None)
    out: dict[str, tuple[float, int, int]] = {}
    wanted = {x[2] for x in heap}
    begins: list[int] = []
    ends: list[int] = []  # of the words taken, in order
    while heap and len(out) < len(wanted):
        _, _, name, a, k, i, n, dice = heapq.heappop(heap)
        spot = bisect.bisect_right(begins, a)
        if spot and ends[spot - 1] > a:
            continue
        if spot < len(begins) and begins[spot] <= a + n:
            offer(k, i, begins[spot] - 1)  # bigram p covers the words p and p + 1
            continue
        begins.insert(spot, a)
        ends.insert(spot, a + n + 1)
        out.setdefault(name, (dice, a, n + 1))
    return out


def scan_texts(texts: pa.Array, templates: Templates, score: float = SCORE) -> list[tuple[int, str, float, int, int]]:
    """As best_stretches(), but of the stretches that overlap with no better one of another licence."""
    spots: dict[int, list[tuple]] = {}
    for t, *spot in dense_spots(texts, templates, score):
        spots.setdefault(t, []).append(tuple(spot))
    return [(t, name, *x) for t in sorted(spots) for name, x in sorted(settled(spots[t], score).items())]


def best_stretches(texts: pa.Array, templates: Templates, score: float) -> list[tuple[int, str, float, int, int]]:
    """text, licence, score, first word and number of words of each licence's best stretch."""
    found: dict[tuple[int, str], tuple] = {}
    for t, name, size, most, hashes, at in dense_spots(texts, templates, score):
        got = best_stretch(hashes, at, size, most, score)
        if got:
            told, (dice, _, n) = (got[0], got[1], got[2] + 1), found.get((t, name), (0.0, 0, 0))
            if told[0] > dice + 1e-12 or (told[0] > dice - 1e-12 and told[2] > n):
                found[t, name] = told
    return [(t, name, *x) for (t, name), x in sorted(found.items())]


def dense_spots(texts: pa.Array, templates: Templates, score: float) -> Iterator[tuple[int, str, int, int, np.ndarray, np.ndarray]]:
    """text, licence, the template's bigrams, the most a stretch can have, and hashes and places in the text of the hits that a good stretch can hold."""
    words, hashes, begin = _bigrams(texts)
    likely = np.flatnonzero(templates.present[hashes & _LOW])
    slot = np.minimum(np.searchsorted(templates.all, hashes[likely]), max(len(templates.all) - 1, 0))
    likely = likely[templates.all[slot] == hashes[likely]] if len(templates.all) else likely[:0]
    owner = np.searchsorted(words.first, begin[likely], side="right") - 1
    for name, own in zip(templates.names, templates.bigrams, strict=True):
        size = len(own)
        most, need = int(size * (2 - score) / score + 1e-9), max(1, int(np.ceil(size * score / (2 - score) - 1e-9)))
        slot = np.minimum(np.searchsorted(own, hashes[likely]), size - 1)
        hit = np.flatnonzero(own[slot] == hashes[likely])
        place, text = begin[likely[hit]], owner[hit]
        ends = hit[need - 1 :]
        dense = np.flatnonzero((place[need - 1 :] - place[: len(ends)] < most) & (text[need - 1 :] == text[: len(ends)]))
        for t in np.unique(text[dense]):
            mine = hit[text == t]
            near = dense[text[dense] == t]
            # hits in reach of a dense run; others can't be part of a stretch that scores enough
            low, high = place[near] - most, place[near + need - 1] + most
            spot = begin[likely[mine]]
            k = np.searchsorted(low, spot, side="right")
            mine = mine[(k > 0) & (np.maximum.accumulate(high)[np.maximum(k - 1, 0)] >= spot)]
            yield int(t), name, size, most, hashes[likely[mine]], begin[likely[mine]] - int(words.first[t])


_MARKS = re.compile(r"[!-/:-@\[-`{-~]")
_NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)*")


def version_in(text: str, first: int, n: int) -> str | None:
    """The first number in the n words from word first on, words being counted as for bigrams."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if _MARKS.sub("", w)]
    got = _NUMBER.search(" ".join(words[first : first + n]))
    return got.group() if got else None


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, score: float = SCORE) -> DataFrame:
    """doc_id, license_id, version, dice, first_word and n_words of each licence found in each row of docs (doc_id, text)."""
    ready = prepare(default_templates() if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            rows = scan_texts(batch.column("text"), ready, score)
            t, name, dice, at, n = zip(*rows, strict=True) if rows else ([],) * 5
            said = batch.column("text").take(pa.array(t, pa.int64())).to_pylist()
            version = [version_in(*x) for x in zip(said, at, n, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(t, pa.int64())), pa.array(name, pa.string()), pa.array(version, pa.string()), pa.array(dice, pa.float64()), pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "license_id", "version", "dice", "first_word", "n_words"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, license_id string, version string, dice double, first_word bigint, n_words bigint")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
