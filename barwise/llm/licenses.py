"""License scans: normalised text against licence templates by Dice over word bigrams.

Texts and templates become lower-case alphanumeric words. Segments of a text
are its lines, its paragraphs (runs of lines that have words) and the whole
text. A segment matches a template when twice the shared distinct bigrams over
the sum of both bigram counts reaches the threshold. That needs bigram counts
within a factor of (2 - t) / t of each other and enough shared bigrams, so
segments outside these bounds never meet a template.

Documents are scanned where they lie, without a shuffle; the templates are a
parameter of a few kB.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm.words import ALNUM, mix, text_parts, word_hashes

THRESHOLD = 0.8
PART_BYTES = 1 << 20

# Public licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
     "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
     "governing permissions and limitations under the License."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
     "notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


def _bigrams(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])


class Templates:
    """Distinct bigrams of each template; templates of fewer than two words never match."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float) -> None:
        self.names, self.sets, self.widths = [], [], []
        for name, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            words, _ = word_hashes(data, np.array([0, len(data)]), ALNUM)
            if len(words) > 1:
                self.names.append(name)
                self.sets.append(np.unique(_bigrams(words)))
                self.widths.append(len(words) - 1)
        self.threshold = threshold
        self.vocab = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)
        self.least = min((len(s) for s in self.sets), default=0)
        self.need = threshold * self.least / (2 - threshold)  # shared bigrams of any match
        self.most = (2 - threshold) / threshold * max((len(s) for s in self.sets), default=0)

    def windows(self, grams: np.ndarray, found: dict[str, float], parts: list[tuple[int, int, str]]) -> Iterator[tuple[float, str]]:
        """(best Dice, name) of the templates outside ``found`` that a window of the text matches.

        Widest first; what a template matched (``parts``: segments and their
        templates, windows) from its first to its last bigram is no other one's window.
        """
        taken = np.zeros(len(grams) + 1, bool)
        wants = dict(zip(self.names, self.sets))
        for a, b, name in parts:
            at = a + np.flatnonzero(np.isin(grams[a:b], wants[name]))
            taken[at[0]:at[-1] + 1] = True
        for k in sorted(range(len(self.names)), key=lambda k: -self.widths[k]):
            name, want, width = self.names[k], self.sets[k], self.widths[k]
            if name in found:
                continue
            slot = np.minimum(np.searchsorted(want, grams), len(want) - 1)
            mine = (want[slot] == grams) & ~taken[:-1]
            count = np.concatenate(([0], np.cumsum(mine)))
            start = np.flatnonzero(mine)
            stop = np.minimum(start + width, len(grams))
            # Twice the shared over the sum: a window has at least as many distinct bigrams as it shares.
            start, stop = (x[(2 - self.threshold) * (count[stop] - count[start]) >= self.threshold * len(want)] for x in (start, stop))
            best = 0.0
            for a, b in zip(start.tolist(), stop.tolist()):
                have = np.unique(grams[a:b])
                both = len(np.intersect1d(have, want, assume_unique=True))
                dice = 2 * both / (len(have) + len(want))
                if dice >= self.threshold:
                    taken[a:b] = True
                best = max(best, dice)
            if best >= self.threshold:
                yield best, name

    def matches(self, segment: np.ndarray) -> list[tuple[float, str]]:
        """(Dice, name) of the templates that the segment (all its bigrams) matches."""
        have = np.unique(segment)
        out = []
        for name, want in zip(self.names, self.sets):
            if 2 * min(len(have), len(want)) >= self.threshold * (len(have) + len(want)):
                both = len(np.intersect1d(have, want, assume_unique=True))
                dice = 2 * both / (len(have) + len(want))
                if dice >= self.threshold:
                    out.append((dice, name))
        return out


def _scan(data: np.ndarray, offs: np.ndarray, t: Templates) -> list[dict[str, float]]:
    """Per text the best Dice of each matching template."""
    found: list[dict[str, float]] = [{} for _ in offs[:-1]]
    parts: dict[int, list[tuple[int, int, str]]] = {}
    breaks = np.flatnonzero(data == 10) + 1
    bounds = np.unique(np.concatenate([offs, breaks]))
    words, first = word_hashes(data, bounds, ALNUM)
    if len(words) < 2 or not len(t.vocab):
        return found
    grams = _bigrams(words)
    slot = np.minimum(np.searchsorted(t.vocab, grams), len(t.vocab) - 1)
    hits = np.concatenate(([0], np.cumsum(t.vocab[slot] == grams)))
    doc_word = first[np.searchsorted(bounds, offs)]  # an empty text shares the next one's bound
    line_doc = np.searchsorted(offs, bounds[:-1], side="right") - 1
    n_line = np.diff(first)
    # Paragraphs: neighbouring lines of one text that have words.
    has = n_line > 0
    start = has & ~np.concatenate(([False], has[:-1] & (line_doc[1:] == line_doc[:-1])))
    stop = has & ~np.concatenate((has[1:] & (line_doc[1:] == line_doc[:-1]), [False]))
    pieces = np.concatenate([
        np.column_stack([first[:-1], first[1:], line_doc]),
        np.column_stack([first[:-1][start], first[1:][stop], line_doc[start]]),
        np.column_stack([doc_word[:-1], doc_word[1:], np.arange(len(offs) - 1)])])
    pieces = pieces[pieces[:, 1] - pieces[:, 0] > 1]
    shared = hits[pieces[:, 1] - 1] - hits[pieces[:, 0]]
    for a, b, d in np.unique(pieces[shared >= t.need], axis=0).tolist():
        for dice, name in t.matches(grams[a:b - 1]):
            found[d][name] = max(dice, found[d].get(name, 0))
            parts.setdefault(d, []).append((a - doc_word[d], b - 1 - doc_word[d], name))
    last = np.maximum(doc_word[1:] - 1, doc_word[:-1])
    for d in np.flatnonzero(hits[last] - hits[doc_word[:-1]] >= t.need).tolist():
        for dice, name in list(t.windows(grams[doc_word[d]:last[d]], found[d], parts.get(d, []))):
            found[d][name] = dice
    return found


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_licenses, licenses (names, sorted, comma-joined), best_license,
    best_dice (ties: the first name).

    Null texts, and texts of fewer than two words, match nothing: 0, empty,
    null, null. Repeated rows give a row each; an empty table gives none.
    """
    schema = "doc_id long, n_licenses long, licenses string, best_license string, best_dice double"
    index = Templates(templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_parts(b.column(1), PART_BYTES):
                found = _scan(data, offs, index)
                best = [min(((-v, k) for k, v in f.items()), default=(None, None)) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([",".join(sorted(f)) for f in found], pa.string()), pa.array([k for _, k in best], pa.string()),
                     pa.array([None if v is None else -v for v, _ in best], pa.float64())],
                    names=["doc_id", "n_licenses", "licenses", "best_license", "best_dice"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
