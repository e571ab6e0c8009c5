"""License scans: winnowed fingerprints of templates pick candidates, banded alignment reports coverage and spans."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import members, ngrams, small_slices, words

#: Words of a fingerprinted n-gram, and n-grams of a winnowing window: a run of GRAM + WINDOW - 1 words
#: that a text shares with a template has a fingerprint in common with it.
GRAM, WINDOW = 3, 2
#: Half width of the alignment band: words that may be missing or added on the way.
BAND = 8
MIN_COVERAGE = 0.8
#: Templates must stay small: they travel with the tasks.
MAX_TEMPLATE_WORDS = 200_000

# Notices and headers of public licences, by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met:",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
               "to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-short": "Released under the MIT License.",
    "all-rights-reserved": "All rights reserved.",
}

WORD = re.compile(r"[^ \t-\r]+")
_TRIM = re.compile(r"^[^\w]+|[^\w]+$")
MATCHES = ("doc_id long, license string, coverage double, matched_words long, template_words long, word_start long, "
           "word_end long, char_start long, char_end long")


def normal(word: str) -> str:
    """A word without outer punctuation, in lower case; what the alignment compares."""
    return _TRIM.sub("", word).lower() or word


def winnow(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Places of the smallest n-gram hash of each window, the rightmost of equal ones."""
    if len(hashes) <= window:
        return [int(len(hashes) - 1 - np.argmin(hashes[::-1]))] if len(hashes) else []
    picked = []
    for i in range(len(hashes) - window + 1):
        part = hashes[i: i + window]
        at = i + window - 1 - int(np.argmin(part[::-1]))
        if not picked or picked[-1] != at:
            picked.append(at)
    return picked


class TemplateIndex:
    """Inverted index from fingerprint to the (template, place) pairs that have it."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        texts = [templates[n] for n in self.names]
        if sum(len(t.split()) for t in texts) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
        self.words = [[normal(w) for w in WORD.findall(t)] for t in texts]
        hashes, _, _, bounds = words(pa.array(texts), lower=True, letters=True)
        self.places = defaultdict(list)
        for t in range(len(texts)):
            grams = ngrams(hashes[bounds[t]: bounds[t + 1]], GRAM)
            for at in winnow(grams):
                self.places[int(grams[at])].append((t, at))
        self.fingerprints = np.array(sorted(self.places), np.uint64)


def banded_alignment(template: list[str], text: list[str | None], shift: int, band: int) -> tuple[int, int, int]:
    """Most template words matched in order within a band: ``(matches, first, end)`` of the aligned text words.

    ``text[j]`` may stand for ``template[i]`` if ``|j - i - shift| <= band``; a word of either side may be
    left over. Of equally good alignments the one that starts latest, so the shortest, is reported.
    """
    width = 2 * band + 1
    none = (0, 0, 0)  # matches, minus words of the text left over between, first word
    row: list[tuple[int, int, int]] = [none] * width
    best, end = none, 0
    for i, word in enumerate(template):
        new = [none] * width
        for c in range(width):
            j = i + shift + c - band
            if j < 0 or j >= len(text):
                continue
            choice = row[c + 1] if c + 1 < width else none  # the template's word is left over
            left = new[c - 1] if c else none  # the text's word is left over
            if left[0] and (left[0], left[1] - 1, left[2]) > choice:
                choice = (left[0], left[1] - 1, left[2])
            if word == text[j]:
                old = row[c]
                hit = (old[0] + 1, old[1], old[2]) if old[0] else (1, 0, j)
                if hit > choice:
                    choice = hit
                if choice is hit and (hit[0], hit[1]) > (best[0], best[1]):
                    best, end = hit, j + 1
            new[c] = choice
        row = new
    return best[0], best[2], end


def scan_text(index: TemplateIndex, text_words: list[str], hits: list[tuple[int, int, int]], band: int,
              min_coverage: float) -> list[tuple[int, int, int, int]]:
    """``(template, matches, first, end)`` of the matches that hits ``(template, place, place in the template)`` lead to.

    A word counts for one match of a template; a shift between both places is tried once. Of matches of
    several templates over the same words the one with more matched words stays, then the better covered.
    """
    found = []
    by_template = defaultdict(list)
    for template, place, at in sorted(set(hits)):
        by_template[template].append((place, place - at))
    for template, tries in by_template.items():
        needed, left, tried = index.words[template], list(text_words), set()
        for place, shift in tries:
            if left[place] is None or shift in tried:
                continue
            low = max(0, shift - band)
            part = left[low: shift + len(needed) + band + 1]
            matches, first, end = banded_alignment(needed, part, shift - low, band)
            if matches >= min_coverage * len(needed):
                found.append((template, matches, low + first, low + end))
                left[low + first: low + end] = [None] * (end - first)
            else:
                tried.add(shift)
    # those kept do not overlap, so only the neighbours of a match can touch it
    kept: list[tuple[int, int, int, int]] = []
    for m in sorted(found, key=lambda m: (-m[1], -m[1] / len(index.words[m[0]]), m[2], m[0])):
        at = bisect_left(kept, m[2], key=lambda k: k[2])
        if (at == 0 or kept[at - 1][3] <= m[2]) and (at == len(kept) or m[3] <= kept[at][2]):
            kept.insert(at, m)
    return kept


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, band: int = BAND,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """License texts found in documents, one row per match: ``doc_id, license, coverage, matched_words,
    template_words, word_start, word_end, char_start, char_end`` (the last two in code points).

    ``coverage`` is the share of the template's words that the alignment matched. Words are runs between
    ASCII white space, compared in lower case without outer punctuation. A template with fewer words than an
    n-gram cannot be found. Null or empty texts and documents without a license give no row; repeated rows
    give their matches each; a null ``doc_id`` stays null; other columns are not read. Nothing is shuffled:
    the index of templates (bounded, checked) travels with the tasks.
    """
    index = TemplateIndex(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            texts = batch.column("text")
            hashes, _, _, bounds = words(texts, lower=True, letters=True)  # candidates go by letters and digits alone
            grams = ngrams(hashes, GRAM)
            places = np.flatnonzero(members(grams, index.fingerprints))
            rows = np.searchsorted(bounds, places, "right") - 1
            # the n-gram must end in its row
            whole = places + GRAM <= bounds[rows + 1]
            by_row = defaultdict(list)
            for place, row in zip(places[whole].tolist(), rows[whole].tolist()):
                for template, at in index.places[int(grams[place])]:
                    by_row[row].append((template, place - int(bounds[row]), at))
            out = []
            for row, hits in by_row.items():
                text, doc_id = texts[row].as_py(), batch.column("doc_id")[row].as_py()
                spans = [m.span() for m in WORD.finditer(text)]
                text_words = [normal(text[a:b]) for a, b in spans]
                for template, matches, first, end in scan_text(index, text_words, hits, band, min_coverage):
                    size = len(index.words[template])
                    out.append((doc_id, index.names[template], matches / size, matches, size, first, end,
                                spans[first][0], spans[end - 1][1]))
            if out:
                types = [pa.int64(), pa.string(), pa.float64()] + [pa.int64()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=[c.split()[0] for c in MATCHES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, MATCHES)
