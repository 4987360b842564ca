"""License scans: winnowed fingerprints of templates, then banded alignment.

Templates are cut into 3-word grams; of every ``WINNOW`` consecutive grams the
one with the smallest hash is a fingerprint, kept in an inverted index (hash to
template and position).  Every 3-word gram of a whole text is looked up; hits of
one template on nearby diagonals (text position minus template position) are
one candidate, whose region is aligned with the template inside a band around
those diagonals (match 2, mismatch or gap -1).  Grams cannot find an edited short
template (an edit of the third of five words breaks every gram), so templates of
fewer than ``SHORT`` words are no part of that index: their candidates are places
where enough of their words stand on nearby diagonals to cover ``MIN_COVERAGE``,
whatever lies between them; each is aligned likewise.  A candidate is reported if its
matched words cover at least ``MIN_COVERAGE`` of the template.  The band is
narrower for short templates, so that copies in a row stay apart.

The index is broadcast.  Templates are a parameter: their words are counted and
dealt to blocks of at most ``MAX_TEMPLATE_WORDS`` (one block for any usual list),
each with its own index and scan, so a broadcast has a known bound.

Defined results: a NULL or wordless text has no match; equal matches from
repeated rows each get their row; templates of fewer than 3 words are refused;
columns other than the id and the text are ignored; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.tokens import scan, window_hashes, words

GRAM = 3
WINNOW = 4
BAND = 6
SHORT = 2 * (GRAM + WINNOW)
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 500_000

# Short notices and headers of public licenses.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-2-Clause-intro": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense-intro": "This is free and unencumbered software released into the public domain.",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")      # the words of tokens.words, with positions


def _band(template: list[int]) -> int:
    return min(BAND, max(1, len(template) // 2 - 1))


def _need(template: list[int], min_coverage: float) -> int:
    return max(1, math.ceil(min_coverage * len(template) - 1e-9))


def winnow(hashes: np.ndarray, window: int = WINNOW) -> list[int]:
    """Positions of the fingerprints: the last smallest hash of every ``window`` consecutive ones."""
    size = min(window, len(hashes))
    picked = {i + size - 1 - int(np.argmin(hashes[i:i + size][::-1])) for i in range(len(hashes) - size + 1)} if size else set()
    return sorted(picked)


class TemplateIndex:
    """Inverted index of the templates' fingerprints, and the words of short templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.vocabulary: dict[bytes, int] = {}
        self.words: list[list[int]] = []
        entries = []
        for t, name in enumerate(self.names):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(templates[name])]
            if len(ids) < GRAM:
                raise ValueError(f"template {name} has fewer than {GRAM} words")
            self.words.append(ids)
            if len(ids) < SHORT:
                continue
            at, hashes = window_hashes(np.array(ids), GRAM)
            entries += [(hashes[i], t, int(at[i])) for i in winnow(hashes)]
        entries.sort()
        self.hashes = np.array([e[0] for e in entries], dtype=np.uint64)
        self.template = np.array([e[1] for e in entries], dtype=np.int64)
        self.position = np.array([e[2] for e in entries], dtype=np.int64)
        self.short = {t: sorted(set(ids)) for t, ids in enumerate(self.words) if len(ids) < SHORT}

    @staticmethod
    def postings(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Known words in order, and their positions."""
        known = np.flatnonzero(ids >= 0)
        at = known[np.argsort(ids[known], kind="stable")]
        return ids[at], at

    def dense(self, t: int, postings: tuple[np.ndarray, np.ndarray], need: int) -> np.ndarray:
        """Positions of words of short template t that have ``need`` of them within the reach of an alignment."""
        found, where = postings
        left, right = np.searchsorted(found, self.short[t], side="left"), np.searchsorted(found, self.short[t], side="right")
        at = np.sort(np.concatenate([where[a:z] for a, z in zip(left, right)]))
        ok = np.flatnonzero(at[need - 1:] - at[:max(at.size - need + 1, 0)] < 3 * len(self.words[t]))
        return at[np.unique((ok[:, None] + np.arange(need)).ravel())]

    def short_matches(self, t: int, ids: np.ndarray, postings: tuple[np.ndarray, np.ndarray], min_coverage: float):
        """Alignments of short template t that cover enough of it, none over another."""
        template = self.words[t]
        need, n, apart = _need(template, min_coverage), len(template), _band(template)
        hits = sorted((int(p) - i, int(p)) for p in self.dense(t, postings, need) for i, w in enumerate(template) if w == ids[p])
        free, begin = ids.copy(), 0
        while begin < len(hits):
            end = begin + 1
            # an alignment of positive score drifts by less than 2n diagonals: pieces of 4n that overlap by half hold it
            while end < len(hits) and hits[end][0] - hits[end - 1][0] <= apart and hits[end][0] - hits[begin][0] <= 4 * n:
                end += 1
            while True:
                live = [(d, p) for d, p in hits[begin:end] if free[p] >= 0]
                if len({p - d for d, p in live}) < need:
                    break
                pairs = align(template, free, live[0][0], live[-1][0])
                if len(pairs) < need:
                    break
                yield pairs
                free[pairs[0][1]:pairs[-1][1] + 1] = -2
            if end < len(hits) and hits[end][0] - hits[end - 1][0] <= apart:
                begin = next(k for k in range(begin + 1, end + 1) if k == end or hits[k][0] - hits[begin][0] > 2 * n)
            else:
                begin = end

    def candidates(self, ids: np.ndarray):
        """Hits of each template on nearby diagonals: (template, first and last diagonal)."""
        at, h = window_hashes(ids, GRAM)
        left, right = np.searchsorted(self.hashes, h, side="left"), np.searchsorted(self.hashes, h, side="right")
        by_template = defaultdict(list)
        for k in np.flatnonzero(right > left):
            for e in range(left[k], right[k]):
                by_template[int(self.template[e])].append(int(at[k] - self.position[e]))
        for t, found in by_template.items():
            found.sort()
            apart = _band(self.words[t])
            low = high = found[0]
            for diagonal in found[1:]:
                if diagonal - high > apart:
                    yield t, low, high
                    low = diagonal
                high = diagonal
            yield t, low, high


def align(template: list[int], text: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Best local alignment with diagonals from low to high and a band on either side: matched (template, text) positions."""
    base, width = low - _band(template), high - low + 2 * _band(template) + 1
    score, back, best = [[0] * (width + 1)], [], (0, 0, 0)
    for i, want in enumerate(template):
        row, step, above = [0] * (width + 1), [0] * width, score[-1]
        for k in range(width):                        # text position i + base + k
            j = i + base + k
            if not 0 <= j < len(text):
                continue
            same = text[j] == want
            options = (0, above[k] + (2 if same else -1), above[k + 1] - 1, (row[k - 1] if k else 0) - 1)
            row[k] = max(options)
            step[k] = options.index(row[k]) if row[k] else 0
            if row[k] > best[0]:
                best = (row[k], i, k)
        score.append(row)
        back.append(step)
    _, i, k = best
    pairs = []
    while i >= 0 and 0 <= k < width and back[i][k]:
        move = back[i][k]
        if move == 1:
            j = i + base + k
            if text[j] == template[i]:
                pairs.append((i, j))
            i -= 1
        elif move == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return pairs[::-1]


def matches(index: TemplateIndex, ids: np.ndarray, min_coverage: float):
    """Reported candidates of one text: (template, coverage, first and last matched word), each span once."""
    seen = set()
    for t, low, high in index.candidates(ids):
        template = index.words[t]
        pairs = align(template, ids, low, high)
        coverage = len(pairs) / len(template)
        if coverage >= min_coverage and (t, pairs[0][1], pairs[-1][1]) not in seen:
            seen.add((t, pairs[0][1], pairs[-1][1]))
            yield t, coverage, pairs[0][1], pairs[-1][1]
    postings = index.postings(ids)
    for t in index.short:
        for pairs in index.short_matches(t, ids, postings, min_coverage):
            yield t, len(pairs) / len(index.words[t]), pairs[0][1], pairs[-1][1]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document and license found: ``doc_id, license, coverage`` (best), ``n_spans``, ``spans``
    (``start:end`` code points of the text, comma-joined, end exclusive)."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return reduce(DataFrame.unionByName, (_scan_block(slim, block, min_coverage) for block in _blocks(templates or TEMPLATES)))


def _blocks(templates: dict[str, str], max_words: int | None = None) -> list[dict[str, str]]:
    limit, out, held = max_words or MAX_TEMPLATE_WORDS, [{}], 0
    for name in sorted(templates):
        size = len(words(templates[name]))
        if out[-1] and held + size > limit:
            out.append({})
            held = 0
        out[-1][name] = templates[name]
        held += size
    return out


def _scan_block(slim: DataFrame, templates: dict[str, str], min_coverage: float) -> DataFrame:
    index = slim.sparkSession.sparkContext.broadcast(TemplateIndex(templates))

    def run(batches):
        known = index.value
        for b in batches:
            texts, doc_ids, out = b.column("text").to_pylist(), [], []
            for first, counts, ids in scan(texts, known.vocabulary, GRAM):
                begin = np.r_[0, np.cumsum(counts + GRAM)]
                at, h = window_hashes(ids, GRAM)
                postings = known.postings(ids)
                hit = [at[np.isin(h, known.hashes)], *(known.dense(t, postings, _need(known.words[t], min_coverage)) for t in known.short)]
                touched = np.unique(np.searchsorted(begin, np.concatenate(hit), side="right") - 1)
                for d in touched:
                    mine = ids[begin[d]:begin[d] + counts[d]]
                    found = defaultdict(list)
                    for t, coverage, a, z in matches(known, mine, min_coverage):
                        found[t].append((a, z, coverage))
                    if found:
                        spans = [m.span() for m in _WORD.finditer(texts[first + d])]
                    for t, hits in sorted(found.items()):
                        hits.sort()
                        doc_ids.append(first + d)
                        out.append((known.names[t], max(c for *_, c in hits), len(hits),
                                    ",".join(f"{spans[a][0]}:{spans[z][1]}" for a, z, _ in hits)))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc_ids, pa.int64())), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                names=["doc_id", "license", "coverage", "n_spans", "spans"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, license string, coverage double, n_spans bigint, spans string")
