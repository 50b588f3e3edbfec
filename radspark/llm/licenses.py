"""License scans: winnowed fingerprints pick candidates, banded alignment reports spans.

Templates become words (a-z and 0-9 runs, lower case); the least hash of every
``WINDOW`` neighbouring ``GRAM``-word runs goes into an inverted index. Any
``WINDOW + GRAM - 1`` words in a row that a text shares with a template hit it.
Hits of a template that lie near one another and advance in both make a
candidate region (one that falls back in the template begins another, so
repeats of a notice are regions of their own), which is aligned with the
template inside a band around the hits' diagonals, at most half the template
wide (local alignment: match +2, other -1). A region's row tells how many template words
it matched, their share (coverage) and the span in the text.

The index holds the templates only (their size is checked), so it travels
inside the task; documents are never moved.

Defined results: null, empty and unlicensed texts give no rows; every region
whose coverage reaches ``least`` gives one, so a text may have several, also of
one template; of overlapping regions the one that matches most words stays
(then the larger coverage, then the template's name); texts of any length are
scanned whole, in time linear in their words and regions; repeated rows are
scanned alike, a null doc_id is kept as null; extra columns, whatever their
names, are ignored; an empty table gives none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import mix

GRAM, WINDOW, BAND, LEAST = 3, 2, 12, 0.75
#: Characters of all templates together; more would not be a small index.
MOST_TEMPLATE_CHARS = 20_000_000
WORD = re.compile(r"[a-z0-9]+")

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit-line": "Licensed under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "bsd-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc0-line": "This work is dedicated to the public domain under CC0 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
}


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]  # each template's word numbers
    vocab: dict[str, int]
    keys: np.ndarray  # sorted fingerprints
    posts: list[list[tuple[int, int]]]  # (template, position) of each


def _runs(ids: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` words in a row; 0 where one is not in the vocabulary."""
    n = len(ids) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, inside = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(gram):
        part = ids[k : k + n]
        inside &= part >= 0
        h = mix(h * np.uint64(31) + part.astype(np.uint64) + np.uint64(k + 1))
    return np.where(inside, h | np.uint64(1), np.uint64(0))


def winnow(h: np.ndarray, window: int) -> list[int]:
    """Positions of the least hash (the last of equals) of every window."""
    if not len(h):
        return []
    picked = {lo + int(len(w) - 1 - w[::-1].argmin()) for lo in range(max(1, len(h) - window + 1)) for w in [h[lo : lo + window]]}
    return sorted(picked)


def build_index(templates: dict[str, str], gram: int = GRAM, window: int = WINDOW) -> Index:
    if sum(map(len, templates.values())) > MOST_TEMPLATE_CHARS:
        raise ValueError("too many templates for an index that every task holds")
    vocab: dict[str, int] = {}
    names, words = list(templates), []
    table: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for t, name in enumerate(names):
        ids = np.array([vocab.setdefault(w, len(vocab)) for w in WORD.findall(templates[name].lower())], dtype=np.int64)
        words.append(ids)
        h = _runs(ids, min(gram, max(1, len(ids))))
        for p in winnow(h, window):
            table[int(h[p])].append((t, p))
    keys = np.array(sorted(table), dtype=np.uint64)
    return Index(names, words, vocab, keys, [table[int(k)] for k in keys])


def align(text: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int, int]:
    """Local alignment on diagonals (text - template position) low..high.

    Returns (template words matched, first and last matched text position, score)
    of the best path; ties go to the one that ends first.
    """
    best = (0, -1, -1, 0)
    prev: dict[int, tuple[int, int, int]] = {}  # diagonal -> score, matched, start
    for j in range(len(template)):
        now: dict[int, tuple[int, int, int]] = {}
        w = template[j]
        for d in range(low, high + 1):
            i = j + d
            if not 0 <= i < len(text):
                continue
            s, m, st = prev.get(d, (0, 0, -1))
            if text[i] == w:
                cell = (s + 2, m + 1, st if s > 0 else i)
            else:
                cell = (s - 1, m, st)
            up = prev.get(d + 1)  # template word left out
            if up and up[0] - 1 > cell[0]:
                cell = (up[0] - 1, up[1], up[2])
            left = now.get(d - 1)  # text word left out
            if left and left[0] - 1 > cell[0]:
                cell = (left[0] - 1, left[1], left[2])
            if cell[0] <= 0:
                continue
            now[d] = cell
            if text[i] == w and cell[0] > best[3]:
                best = (cell[1], cell[2], i, cell[0])
        prev = now
    return best


FOUND = "doc_id long, template string, matched long, template_words long, coverage double, start long, end long"


def scan_text(text: str, index: Index, gram: int = GRAM, band: int = BAND, least: float = LEAST) -> list[tuple]:
    """(template, matched, template words, coverage, start, end) of each region, in text order."""
    low = text.lower()
    if len(low) != len(text):  # a letter that lowers to two would shift the offsets
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    get = index.vocab.get
    ids = np.fromiter((get(w, -1) for w in WORD.findall(low)), np.int64)
    h = _runs(ids, gram)
    at = np.flatnonzero(h)
    if not len(at) or not len(index.keys):
        return []
    spot = np.searchsorted(index.keys, h[at])
    hit = index.keys[np.minimum(spot, len(index.keys) - 1)] == h[at]
    if not hit.any():
        return []
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, k in zip(at[hit].tolist(), spot[hit].tolist()):
        for t, q in index.posts[k]:
            by[t].append((p - q, p))
    places = [m.span() for m in WORD.finditer(low)]
    out = set()
    for t, hits in by.items():
        words = index.words[t]
        wide = min(band, max(1, len(words) // 2))  # less than from one repeat to the next
        for low_d, high_d in chains(sorted(hits, key=lambda x: (x[1], x[0])), len(words), wide):
            first, last = max(0, low_d - wide), min(len(ids), high_d + len(words) + wide)
            m, a, z, _ = align(ids[first:last], words, low_d - wide - first, high_d + wide - first)
            if m and m / len(words) >= least:
                out.add((index.names[t], m, len(words), m / len(words), places[first + a][0], places[first + z][1]))
    starts: list[int] = []
    best: list[tuple] = []
    for r in sorted(out, key=lambda r: (-r[1], -r[3], r[0], r[4])):
        k = bisect_right(starts, r[4])
        if (k == 0 or best[k - 1][5] <= r[4]) and (k == len(best) or r[5] <= best[k][4]):
            starts.insert(k, r[4])
            best.insert(k, r)
    return best


def chains(hits: list[tuple[int, int]], words: int, wide: int) -> list[tuple[int, int]]:
    """Least and greatest diagonal of each run of hits (diagonal, text position; in text order) that advance in text and template."""
    done: list[tuple[int, int]] = []
    live: list[list[int]] = []  # least, greatest and last diagonal, last position
    for d, p in hits:
        stale = [c for c in live if p - c[3] > words + wide]
        if stale:
            done += [(c[0], c[1]) for c in stale]
            live = [c for c in live if p - c[3] <= words + wide]
        fit = [c for c in live if p - d > c[3] - c[2] and max(c[1], d) - min(c[0], d) <= wide]
        if fit:
            c = min(fit, key=lambda c: (abs(c[2] - d), -c[3]))
            c[0], c[1], c[2], c[3] = min(c[0], d), max(c[1], d), d, p
        else:
            live.append([d, d, d, p])
    return done + [(c[0], c[1]) for c in live]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """Every region of every text that covers ``least`` of a template: ``FOUND``."""
    index = build_index(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo in range(0, len(ids), 512):
                rows = [(i, *r) for i, t in zip(ids[lo : lo + 512], b.column(1).slice(lo, 512).to_pylist()) if t for r in scan_text(t, index, least=least)]
                cols = list(zip(*rows)) or [[]] * 7
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND)
