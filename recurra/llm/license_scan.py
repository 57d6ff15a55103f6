"""License scans: MinHash bands over overlapping text windows retrieve templates, exact
shingle containment verifies them and gives the spans.

A text is cut into windows of words that overlap by half, at each of a few widths that
double. A template is looked for in the windows of the least width that holds it whatever
its place (at least twice its length), so some window contains all of it and its words
make up a known share of that window's.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import (_U, PrefixHash, _flags, mix64, raw_bytes, seeded, slices, small_batches,
                                text_of, words)

SHINGLE = 3
#: A window of four template lengths holds a template's shingles with a Jaccard share of about
#: a quarter or more; 96 bands of one row miss a share of 0.2 with probability 5e-10.
BANDS = 96
MAX_TEMPLATES = 2_000
#: Words of a text whose windows are compared at a time (a power of two, as all widths are).
TILE = 1 << 15
LOW_BITS = _U(0xFFFF)
_SEEDS = seeded(BANDS, 77)
_STEP = seeded(SHINGLE, 41) | _U(1)

# Templates of license notices (fixed values): one-line notices, and the notices that files
# commonly carry, as a whole. Full license texts are not among them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are "
                    "permitted provided that the following conditions are met",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy "
                        "of the License at",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
                 "without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                      "the GNU General Public License as published by the Free Software Foundation, either version 3 "
                      "of the License, or (at your option) any later version. This program is distributed in the hope "
                      "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                      "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
                      "more details.",
    "LGPL-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of "
                       "the GNU Lesser General Public License as published by the Free Software Foundation, either "
                       "version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                       "the GNU Affero General Public License as published by the Free Software Foundation, either "
                       "version 3 of the License, or (at your option) any later version.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                      "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD-clauses": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
                   "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
                   "this list of conditions and the following disclaimer in the documentation and/or other materials "
                   "provided with the distribution.",
}

#: Words are runs of ASCII letters and digits and of any byte above 127, in lower case.
_BREAK = ~_flags(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, first byte, end byte) of every word; bytes count from the text's start."""
    data, off = raw_bytes(texts)
    data = _LOWER[data]
    doc, start, end = words(data, off, _BREAK)
    return doc, PrefixHash(data).of(start, end), start - off[doc], end - off[doc]


def runs(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE words from every word on, 0 where they leave the text."""
    out = np.zeros(len(h), _U)
    m = len(h) - SHINGLE + 1
    if m > 0:
        with np.errstate(over="ignore"):
            acc = sum((h[i:i + m] * _STEP[i] for i in range(1, SHINGLE)), h[:m] * _STEP[0])
        out[:m] = np.where(doc[:m] == doc[SHINGLE - 1:], mix64(acc) | _U(1), _U(0))
    return out


def signatures(sh: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """len(begin) x BANDS matrix: least seeded hash of the shingles in [begin, end)."""
    out = np.empty((len(begin), BANDS), _U)
    edges = np.stack([begin, end], axis=1).ravel() - begin[0]
    sh = np.r_[sh[begin[0]:end[-1]], _U(0)]
    leaves = np.where(sh == 0, ~_U(0), _U(0))       # words without a shingle never give the least
    x, high = np.empty_like(sh), np.empty_like(sh)
    for b in range(BANDS):
        np.bitwise_xor(sh, _SEEDS[b], out=x)
        np.multiply(x, _U(0x9E3779B97F4A7C15), out=x)
        np.right_shift(x, _U(32), out=high)
        np.bitwise_xor(x, high, out=x)
        np.bitwise_or(x, leaves, out=x)
        out[:, b] = np.minimum.reduceat(x, edges)[::2]
    return out


def ordinals(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, nth from 0) of the members of groups of ``many`` each."""
    which = np.repeat(np.arange(len(many)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)


class Matcher:
    """The templates' bands and shingles; small, sent to every task."""

    def __init__(self, templates: Mapping[str, str], containment: float):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        self.names = sorted(templates)
        self.containment = containment
        doc, h, _, _ = word_hashes(pa.array([templates[n] for n in self.names], pa.string()))
        sh = runs(doc, h)
        self.shingles = [np.unique(sh[(doc == i) & (sh != 0)]) for i in range(len(self.names))]
        self.length = np.bincount(doc, minlength=len(self.names))
        if any(len(s) == 0 for s in self.shingles):
            raise ValueError(f"a template needs at least {SHINGLE} words")
        flat = np.concatenate(self.shingles) if self.shingles else np.empty(0, _U)
        size = np.array([len(s) for s in self.shingles], np.int64)
        self.known = np.unique(flat)
        end = np.cumsum(size)
        self.signature = signatures(flat, end - size, end) if len(flat) else np.empty((0, BANDS), _U)
        # the width of window in which a template is looked for
        self.width = 2 ** np.ceil(np.log2(np.maximum(2 * self.length, 16))).astype(np.int64)
        # per width, the band keys of its templates as one sorted array
        # and by their low bits which keys cannot be there; the same shingle has another value in every band
        self.keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in np.unique(self.width).tolist():
            group = np.flatnonzero(self.width == width)
            key = self.signature[group].ravel()
            order = np.argsort(key, kind="stable")
            maybe = np.zeros(int(LOW_BITS) + 1, bool)
            maybe[key & LOW_BITS] = True
            self.keys[width] = key[order], np.repeat(group, BANDS)[order], maybe

    def retrieve(self, width: int, sig: np.ndarray) -> list[tuple[int, int]]:
        """(window, template) of all windows and templates that share a band."""
        known, owner, maybe = self.keys[width]
        key = sig.ravel()
        hit = np.flatnonzero(maybe[key & LOW_BITS])
        lo = np.searchsorted(known, key[hit])
        many = np.searchsorted(known, key[hit], side="right") - lo
        hit, lo, many = hit[many > 0], lo[many > 0], many[many > 0]
        which, nth = ordinals(many)
        found = np.stack([hit[which] // BANDS, owner[lo[which] + nth]], axis=1)
        return list(map(tuple, np.unique(found, axis=0).tolist()))

    def tiles(self, begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first, end) words of stretches that hold every window of every text, a few tiles
        at a time, so that the signatures of a very long text are never all in memory."""
        over = int(self.width.max()) // 2
        tile = max(TILE, over)
        text, nth = ordinals(np.maximum(1, -(-(count - over) // tile)))
        at = begin[text] + tile * nth
        to = np.minimum(at + tile + over, (begin + count)[text])
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(to, at[lo] + 4 * tile, side="right")))
            yield at[lo:hi], to[lo:hi]
            lo = hi

    def windows(self, sh: np.ndarray, at: np.ndarray, to: np.ndarray
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(width, first words, end words, signatures) of the windows of the stretches [at, to).

        A window is two neighbouring halves, and two halves of one width make one of the next,
        so the shingles are hashed once for all widths.
        """
        step, most = min(self.keys) // 2, max(self.keys)
        many = -(-(to - at) // step)
        text, nth = ordinals(many)
        first = at[text] + step * nth
        halves = signatures(sh, first, np.minimum(first + step, to[text]))
        while True:
            row = np.cumsum(many) - many                              # first half of every stretch
            if 2 * step in self.keys:
                text, nth = ordinals(np.maximum(1, many - 1))
                one = row[text] + nth
                two = row[text] + np.minimum(nth + 1, many[text] - 1)
                first = at[text] + step * nth
                yield (2 * step, first, np.minimum(first + 2 * step, to[text]),
                       np.minimum(halves[one], halves[two]))
            if 2 * step == most:
                return
            text, nth = ordinals(-(-many // 2))
            one = row[text] + 2 * nth
            two = row[text] + np.minimum(2 * nth + 1, many[text] - 1)
            halves, many, step = np.minimum(halves[one], halves[two]), -(-many // 2), 2 * step

    def scan(self, texts: pa.Array) -> list[tuple[int, str, float, int, int]]:
        """(row, template, containment, first byte, end byte) of every verified notice."""
        doc, h, start, end = word_hashes(texts)
        if len(doc) == 0 or not self.names:
            return []
        sh = runs(doc, h)
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        count = np.diff(np.r_[begin, len(doc)])
        found: dict[tuple[int, int], set[tuple[float, int, int]]] = {}
        for at, to in self.tiles(begin, count):
            for width, first, last, sig in self.windows(sh, at, to):
                for w, t in self.retrieve(width, sig):
                    which = np.searchsorted(self.shingles[t], sh[first[w]:last[w]])
                    which[which == len(self.shingles[t])] = 0
                    place = np.flatnonzero(self.shingles[t][which] == sh[first[w]:last[w]])
                    spans = dense_spans((place + first[w]).tolist(), which[place].tolist(),
                                        len(self.shingles[t]) * self.containment)
                    if spans:
                        found.setdefault((int(doc[first[w]]), t), set()).update(
                            (n / len(self.shingles[t]), a, z) for n, a, z in spans)
        out = []
        for (row, t), spans in found.items():
            taken: list[tuple[int, int]] = []
            for share, first, last in sorted(spans, key=lambda x: (-x[0], x[2] - x[1], x[1])):
                stop = min(last + SHINGLE, int(begin[np.searchsorted(begin, first, side="right") - 1]
                                               + count[np.searchsorted(begin, first, side="right") - 1])) - 1
                if all(stop < a or b < first for a, b in taken):      # windows see one notice twice
                    taken.append((first, stop))
                    out.append((row, self.names[t], share, int(start[first]), int(end[stop])))
        return sorted(out, key=lambda x: (x[0], x[1], x[3]))


def dense_spans(place: list[int], which: list[int], least: float) -> list[tuple[int, int, int]]:
    """(distinct shingles, first place, last place) of the notices among a template's shingles
    found at ``place`` (ascending; ``which`` shingle each is).

    The shortest run that holds as many distinct shingles as there are is a notice, if they
    are enough; then the places before it and after it are looked through in the same way.
    Shingles that stray around a notice are therefore outside its span.
    """
    need = len(set(which))
    if need == 0 or need < least:
        return []
    seen: dict[int, int] = {}
    best, lo = None, 0
    for hi, x in enumerate(which):
        seen[x] = seen.get(x, 0) + 1
        while seen[which[lo]] > 1:
            seen[which[lo]] -= 1
            lo += 1
        if len(seen) == need and (best is None or place[hi] - place[lo] < place[best[1]] - place[best[0]]):
            best = lo, hi
    lo, hi = best
    return [*dense_spans(place[:lo], which[:lo], least), (need, place[lo], place[hi]),
            *dense_spans(place[hi + 1:], which[hi + 1:], least)]


def scan_licenses(docs: DataFrame, *, templates: Mapping[str, str] = TEMPLATES, containment: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, containment, first_byte, end_byte): every notice found in each row.

    Found means: a window holds at least ``containment`` of the template's distinct 3-word
    shingles (exact check). The span is the shortest run of shingles that holds them, without
    stray shingles around it; notices that repeat in one text are reported each, and of
    overlapping spans of one template the fullest, then the shortest, then the first. A template
    is looked for in windows that hold it whole with room for as many words again.
    Rows without a match, NULL and empty texts among them, give no rows; repeated rows are
    reported each. Windows of any text are made in the task that reads it: no shuffle.
    """
    small_batches(docs.sparkSession)
    matcher = docs.sparkSession.sparkContext.broadcast(Matcher(templates, containment))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text"), 1 << 19):
                found = matcher.value.scan(texts)
                ids = batch.column("id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[at + f[0]].as_py() for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()),
                     pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                    names=["id", "template", "containment", "first_byte", "end_byte"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"))
    made = rows.mapInArrow(run, "id string, template string, containment double, first_byte long, end_byte long")
    return made.select(F.col("id").cast(id_type).alias("doc_id"), "template", "containment", "first_byte", "end_byte")
