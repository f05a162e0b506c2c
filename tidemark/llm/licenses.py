"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

The templates' word shingles are winnowed into an inverted index (fingerprint to template and
position). Shingles of a document that are in the index are seeds; seeds of one template near one
diagonal are a candidate, which is aligned with the template inside a band around that diagonal.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Public license notices that are looked for.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
}

SHINGLE = 3
WINDOW = 2
BAND = 8
COVERAGE = 0.7
# Letters become small, other ASCII characters but digits become spaces; all else stays.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


class Templates:
    """Words of the templates as numbers from 1, and the inverted index of their winnowed shingles."""

    def __init__(self, templates: dict[str, str], shingle: int = SHINGLE, window: int = WINDOW):
        self.names = list(templates)
        self.shingle = shingle
        self.numbers: dict[bytes, int] = {}
        self.words = [
            np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in plain_words(text)]) for text in templates.values()
        ]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for template, words in enumerate(self.words):
            hashes = self.hashes(words)
            chosen = set()
            for begin in range(max(1, len(hashes) - window + 1)):
                part = hashes[begin : begin + window]
                if len(part):  # the rightmost least of each window
                    chosen.add(begin + len(part) - 1 - int(np.argmin(part[::-1])))
            for position in sorted(chosen):
                self.index[int(hashes[position])].append((template, position))
        self.keys = np.array(sorted(self.index), dtype=np.uint64)

    def hashes(self, words: np.ndarray) -> np.ndarray:
        """Mixed hash of every shingle."""
        size = len(words) - self.shingle + 1
        if size <= 0:
            return np.zeros(0, np.uint64)
        found = np.zeros(size, np.uint64)
        for i in range(self.shingle):
            found = (found ^ words[i : i + size].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return found

    def seeds(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, position in the document, position in the template) of shared winnowed shingles."""
        if len(words) < self.shingle:
            return []
        # Only where all words of a shingle are words of templates.
        inside = np.convolve(words > 0, np.ones(self.shingle, int), "valid") == self.shingle
        places = np.flatnonzero(inside)
        if not len(places):
            return []
        hashes = self.hashes(words)[places]
        hit = places[np.isin(hashes, self.keys)]
        every = self.hashes(words)[hit]
        return [(t, int(place), at) for place, h in zip(hit, every) for t, at in self.index[int(h)]]


def aligned(document: np.ndarray, template: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Most words of the template matched in order, inside the band around one diagonal; first and last match.

    Longest common subsequence of the template and the document from ``shift``, with cells no more than
    ``band`` off the diagonal. Of equal lengths the shorter stretch of the document counts.
    """
    width = 2 * band + 1
    best = [(0, 0, 0)] * width  # matched, -length of the stretch, last; by offset from the diagonal
    begin = [-1] * width
    for i, word in enumerate(template):
        row: list[tuple[int, int, int]] = []
        starts: list[int] = []
        for o in range(width):
            j = shift + i + o - band
            options = [(best[o], begin[o])] if 0 <= j < len(document) and document[j] == word else []
            if options:
                (n, _, _), b = options[0]
                first = j if b < 0 else b
                options = [((n + 1, -(j - first), j), first)]
            if o + 1 < width:
                options.append((best[o + 1], begin[o + 1]))
            if row:
                options.append((row[-1], starts[-1]))
            options.append((best[o], begin[o])) if not options else None
            value, start = max(options)
            row.append(value)
            starts.append(start)
        best, begin = row, starts
    (matched, _, last), first = max(zip(best, begin))
    return matched, first, last


def candidates(seeds: list[tuple[int, int, int]], bands: list[int]) -> list[tuple[int, int]]:
    """(template, diagonal) of the seeds, one for all seeds within half the template's band."""
    found: list[tuple[int, int]] = []
    for template, shift in sorted({(t, place - at) for t, place, at in seeds}):
        if not found or found[-1][0] != template or shift - found[-1][1] > bands[template] // 2:
            found.append((template, shift))
    return found


def hits_of(text: str, index: Templates, band: int, coverage: float) -> list[tuple[str, int, int, float, int, int]]:
    """(template, matched words, words, coverage, start, end) in code points, end exclusive."""
    encoded = text.encode("utf-8", "surrogatepass")
    flat = encoded.translate(_PLAIN)
    words = np.array([index.numbers.get(w, 0) for w in flat.split()], dtype=np.int64)
    seeds = index.seeds(words)
    if not seeds:
        return []
    spans = [m.span() for m in re.finditer(rb"[^ ]+", flat)]
    found = []
    # Narrow enough that a repeat of the template right behind it lies outside.
    bands = [min(band, (len(pattern) - 1) // 2) for pattern in index.words]
    for template, shift in candidates(seeds, bands):
        pattern = index.words[template]
        matched, first, last = aligned(words, pattern, shift, bands[template])
        if matched >= coverage * len(pattern):
            found.append((template, matched, first, last))
    kept: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for hit in sorted(found, key=lambda h: -h[1]):  # the same place found over two diagonals is one hit
        if all(hit[0] != t or hit[3] < f or hit[2] > e for t, _, f, e in kept.values()):
            kept[hit[0], hit[2]] = hit
    rows = []
    for template, matched, first, last in sorted(kept.values(), key=lambda h: (h[2], h[0])):
        start = len(encoded[: spans[first][0]].decode("utf-8", "surrogatepass"))
        end = len(encoded[: spans[last][1]].decode("utf-8", "surrogatepass"))
        size = len(index.words[template])
        rows.append((index.names[template], matched, size, matched / size, start, end))
    return rows


def license_hits(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    band: int = BAND,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Rows (doc_id, template, matched, words, coverage, start, end), one per place that a template covers.

    A place counts if at least ``coverage`` of the template's words are matched in order. Places of one
    template do not overlap; those of different templates may. Words are compared without case and
    punctuation. Null, empty and other texts without a match give no row; rows with null ids and
    repeated rows give theirs; texts are scanned whole. An empty table gives no rows. Other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Templates(templates)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(key, *hit) for hit in hits_of(text or "", index, band, coverage)]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "template", "matched", "words", "coverage", "start", "end"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, template string, matched int, words int, coverage double, start long, end long")
