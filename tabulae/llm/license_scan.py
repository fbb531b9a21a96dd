"""License scans: an index of winnowed fingerprints of the templates, then banded sequence alignment.

Templates and texts are compared as words (runs of ASCII letters and digits, lower case, and of
non-ASCII characters).  Templates are winnowed: of the hashes of all runs of ``GRAM`` words, every
window keeps the least; an inverted index leads from these fingerprints to templates and places.
A text looks up all its runs.  If a share ``COVERAGE`` of a template's words is left and the others
are changed or dropped, some ``kept`` words are left in a row wherever the changes are: the window is
as wide as still gives a fingerprint in any such row, and shorter runs of ``SHORT_GRAM`` words serve
templates that guarantee less.  Words put in between count against this: with more changes, dropped
and inserted places than a share 1 - ``COVERAGE`` of the words, or an insertion longer than the band
beside what lies in it, a notice may stay unreported.  Hits of a template on neighbouring diagonals
form a candidate; a local alignment in a band around them counts the template words that the
text has and gives the span.  Candidates that cover at least ``COVERAGE`` of a template are reported.
"""
from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import WORD_BYTES, blobs, built, ship, utf8
from tabulae.llm.near_dup import mixed

#: Words of a run, and of a run of templates whose kept rows may be shorter than that.
GRAM, SHORT_GRAM = 3, 2
#: Half the width of the band, in words (half a shorter template); diagonals closer than this are one candidate.
BAND = 8
COVERAGE = 0.8
#: Bytes that all templates together may have: they are broadcast.
MOST_TEMPLATES = 32 << 20
CACHED_WORDS = 200_000
#: Notices of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_MATCH = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def align(template: list[int], text: list[int], diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment with (text place - template place) within ``band`` of ``diagonal``:
    number of equal words, first text place and the place after the last.

    Equal words count 2, other pairs and gaps -1; of equal values the one with more equal words
    counts, then a pair before a gap in the text, then the first end.
    """
    width = 2 * band + 1
    # value, equal words and first text place of the best alignment that ends at each diagonal
    before = [(0, 0, -1)] * width
    best, found = (0, 0), (0, 0, 0)
    for i, word in enumerate(template):
        now: list[tuple[int, int, int]] = []
        for d in range(width):
            j = i + diagonal - band + d
            cell = (0, 0, -1)
            if 0 <= j < len(text):
                same = text[j] == word
                v, n, s = before[d]
                if v + (2 if same else -1) > 0:
                    cell = (v + 2, n + 1, j if s < 0 else s) if same else (v - 1, n, s)
                if d + 1 < width and (gap := (before[d + 1][0] - 1, *before[d + 1][1:]))[:2] > cell[:2]:
                    cell = gap
                if d and (gap := (now[-1][0] - 1, *now[-1][1:]))[:2] > cell[:2]:
                    cell = gap
                if cell[:2] > best:
                    best, found = cell[:2], (cell[1], cell[2], j + 1)
            now.append(cell)
        before = now
    return found


def kept_row(size: int, coverage: float) -> int:
    """Words that are left in a row at least if a share ``coverage`` of ``size`` words is left."""
    left = math.ceil(coverage * size - 1e-9)
    return -(-left // (size - left + 1))


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of every ``window`` neighbouring ones (the last of equal ones); all of fewer hashes."""
    if len(hashes) < window:
        return np.arange(len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


class Index:
    """Fingerprints of the templates, and how to find them in texts."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.names = sorted(templates)
        self.hashes: dict[bytes, int] = {}
        self.templates = [self.numbers(words(templates[n].encode())) for n in self.names]
        #: by the length of a run: hashes in order, and their templates and places
        self.runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        rows = [kept_row(len(n), coverage) if len(n) else 0 for n in self.templates]
        for size in (SHORT_GRAM, GRAM):
            mine = [(t, g, winnowed(g, max(1, rows[t] - size + 1))) for t, n in enumerate(self.templates)
                    if len(n) >= GRAM and (GRAM if rows[t] >= GRAM else SHORT_GRAM) == size and len(g := self.grams(n, size))]
            if mine:
                keys = np.concatenate([g[p] for _, g, p in mine])
                owner = np.repeat([t for t, _, _ in mine], [len(p) for _, _, p in mine])
                place = np.concatenate([p for _, _, p in mine])
                order = np.argsort(keys, kind="stable")
                self.runs[size] = keys[order], owner[order], place[order]

    def numbers(self, found: list[bytes]) -> np.ndarray:
        get = self.hashes.get
        return np.array([get(w) or self._number(w) for w in found], dtype=np.uint64)

    def _number(self, word: bytes) -> int:
        if len(self.hashes) >= CACHED_WORDS:
            self.hashes.clear()
        n = self.hashes[word] = xxhash.xxh3_64_intdigest(word) or 1
        return n

    @staticmethod
    def grams(numbers: np.ndarray, run: int = GRAM) -> np.ndarray:
        size = len(numbers) - run + 1
        if size <= 0:
            return np.empty(0, dtype=np.uint64)
        total = np.zeros(size, dtype=np.uint64)
        for k in range(run):
            total = mixed(total ^ numbers[k:k + size])
        return total

    def scan(self, text: bytes, coverage: float | None = None) -> list[dict]:
        """Matches (license, coverage, start, end) with code point offsets, by start, then name.

        ``coverage``: the index's own or more.
        """
        coverage = max(self.coverage, coverage or 0.0)
        numbers = self.numbers(words(text))
        anchors = []
        for run, (keys, owner, place) in self.runs.items():
            grams = self.grams(numbers, run)
            first = np.searchsorted(keys, grams, side="left")
            for j in np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == grams).tolist():
                e = int(first[j])
                while e < len(keys) and keys[e] == grams[j]:
                    anchors.append((int(owner[e]), j - int(place[e])))
                    e += 1
        if not anchors:
            return []
        anchors.sort()
        plain, found, last = numbers.tolist(), {}, None
        for t, diagonal in anchors:
            template = self.templates[t].tolist()
            band = max(1, min(BAND, len(template) // 2))  # short notices may follow each other closely
            if last and last[0] == t and diagonal - last[1] <= band:
                continue  # in the band of the candidate before
            last = (t, diagonal)
            # the band reaches from this first diagonal over the others that belong to the candidate
            n, start, end = align(template, plain, diagonal + band // 2, band)
            if n >= coverage * len(template):
                key = (t, end)
                if key not in found or found[key][0] < n:
                    found[key] = (n, start)
        if not found:
            return []
        at = [m.span() for m in _WORD.finditer(text)]
        out = [{"license": self.names[t], "coverage": n / len(self.templates[t]),
                "start": len(text[:at[start][0]].decode("utf-8", "replace")),
                "end": len(text[:at[end - 1][1]].decode("utf-8", "replace"))} for (t, end), (n, start) in found.items()]
        return sorted(out, key=lambda m: (m["start"], m["license"], m["end"]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_matches``, ``licenses`` (distinct names, sorted) and ``matches`` (license,
    coverage, code point span of every match).

    Null and empty texts match nothing, nor do templates without a run of ``GRAM`` words; repeated
    rows match alike; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    templates = TEMPLATES if templates is None else templates
    if sum(len(t) for t in templates.values()) > MOST_TEMPLATES:
        raise ValueError(f"the templates have more than {MOST_TEMPLATES} characters")
    block = spark.sparkContext.broadcast((templates, coverage))

    def index_of(given: tuple[dict[str, str], float]) -> Index:
        return Index(*given)

    @F.arrow_udf("array<struct<license string, coverage double, start long, end long>>")
    def run(texts: pa.Array) -> pa.Array:
        index = built(block, index_of)
        return pa.array([index.scan(t) for t in blobs(texts)], pa.list_(_MATCH))

    found = docs.select(F.col(f"`{id_col}`").alias("id"), run(utf8(text_col)).alias("matches"))
    return found.select(F.col("id").alias(id_col), F.size("matches").cast("long").alias("n_matches"),
                        F.array_sort(F.array_distinct("matches.license")).alias("licenses"), "matches")
