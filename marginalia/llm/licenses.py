"""License scans by MinHash bands over overlapping text windows.

Texts and templates are sequences of three-word shingles.  A template of m
shingles is looked for in windows of four blocks of B shingles, B being the
least power of two with m <= 3 B + 1; windows start at every block, so any run
of m shingles lies whole in one of them.  A window and a template share a band
when their minima under a permutation agree.  With :data:`BANDS` bands of one
row, a window that holds a share c of a template meets it with probability
1 - (1 - s)^BANDS at s = k / (W + m - k), k = ceil(c m); for c = 0.8 that is over
0.9999 for every template length (:func:`collision_probability`).  Exact
containment of shingles, word by word, then decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.storage import small_batches

BANDS = 40
SHINGLE = 3
#: Least share of a template's shingles that a match holds.
CONTAINMENT = 0.8
#: Identifier and wording of the notices.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain worldwide."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MIX = np.random.Generator(np.random.Philox(key=11)).integers(1, 1 << 63, BANDS + SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_CACHE_WORDS = 500_000
#: Words scanned at a time; longer texts are cut and the cuts overlap by the
#: widest window.
SEGMENT_WORDS = 1 << 16


def words(text: str | None) -> list[bytes]:
    """Runs of letters and digits, A-Z lower-cased; other scripts as they are."""
    return _WORD.findall((text or "").encode().lower())


def collision_probability(shingles: int, containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """The least chance that a window holding ``containment`` of a template
    of so many shingles shares a band with it."""
    width = 4 * block_size(shingles)
    held = math.ceil(containment * shingles - 1e-9)
    s = held / (width + shingles - held)
    return 1 - (1 - s) ** bands


def block_size(shingles: int) -> int:
    """B for a template of so many shingles."""
    size = 1
    while 3 * size + 1 < shingles:
        size *= 2
    return size


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """A number for each run of :data:`SHINGLE` words; the last ones of the
    array have none."""
    n = max(len(hashes) - SHINGLE + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        out += (hashes[i : i + n] ^ hashes[i : i + n] >> np.uint64(29)) * _MIX[BANDS + i]
    return out ^ out >> np.uint64(32)


def _minima(shingles: np.ndarray) -> np.ndarray:
    """Values of each shingle under each permutation, bands first."""
    out = np.empty((BANDS, len(shingles)), np.uint32)
    for at in range(0, len(shingles), 8192):
        out[:, at : at + 8192] = (shingles[None, at : at + 8192] * _MIX[:BANDS, None]) >> np.uint64(32)
    return out


@dataclass
class Index:
    """Templates by band: what a window's minimum under a permutation fetches."""

    templates: list[tuple[str, str]]
    grams: list[set[tuple[bytes, ...]]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    blocks: dict[int, list[dict[int, list[int]]]] = field(default_factory=dict)
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    hashes: _Hashes = field(default_factory=_Hashes)

    def __post_init__(self) -> None:
        for name, text in self.templates:
            found = words(text)
            if len(found) < SHINGLE:
                raise ValueError(f"a template needs {SHINGLE} words: {text!r}")
            self.names.append(name)
            self.grams.append(set(zip(*(found[i:] for i in range(SHINGLE)), strict=False)))
            least = _minima(_shingles(self.hashed(found))).min(axis=1)
            size = block_size(len(found) - SHINGLE + 1)
            bands = self.blocks.setdefault(size, [{} for _ in range(BANDS)])
            for band, value in zip(bands, least.tolist(), strict=True):
                band.setdefault(value, []).append(len(self.names) - 1)
        for size, bands in self.blocks.items():
            self.filters[size] = np.zeros((BANDS, 1 << 16), bool)
            for i, band in enumerate(bands):
                self.filters[size][i, [v & 0xFFFF for v in band]] = True

    def hashed(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))

    def candidates(self, shingles: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first shingle, window width, template) that share a band."""
        values, size = _minima(shingles), 1
        while self.blocks and size <= max(self.blocks):
            if size in self.blocks:
                count = values.shape[1]
                wide = np.full((BANDS, count + 3), np.uint32(0xFFFFFFFF))
                wide[:, :count] = values
                two = np.minimum(wide[:, :-1], wide[:, 1:])
                four = np.minimum(two[:, :count], two[:, 2 : count + 2])
                seen = set()
                for i in range(BANDS):
                    row = four[i]
                    for at in np.flatnonzero(self.filters[size][i][row & np.uint32(0xFFFF)]).tolist():
                        for template in self.blocks[size][i].get(int(row[at]), ()):
                            seen.add((at * size, 4 * size, template))
                yield from seen
            if values.shape[1] % 2:
                values = np.concatenate([values, np.full((BANDS, 1), np.uint32(0xFFFFFFFF))], axis=1)
            values = np.minimum(values[:, ::2], values[:, 1::2])
            size *= 2

    def scan(self, texts: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        """Per text the matches (name, first word, words, containment), the
        best one of each run of overlapping windows and name."""
        overlap = 4 * max(self.blocks, default=0) + SHINGLE
        found: dict[tuple[int, str], set[tuple[int, int, float]]] = {}
        pieces: list[tuple[int, int, list[bytes]]] = []  # text, first word, words
        held = 0
        for i, text in enumerate(texts):
            for at in range(0, max(len(text), 1), SEGMENT_WORDS):
                piece = text[at : at + SEGMENT_WORDS + overlap]
                if held + len(piece) > 2 * SEGMENT_WORDS:
                    self._scan(pieces, found)
                    pieces, held = [], 0
                pieces.append((i, at, piece))
                held += len(piece)
        self._scan(pieces, found)
        out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        for (text, name), spans in found.items():
            best, upto = None, -1
            for a, n, share in sorted(spans):
                if best is not None and a >= upto:
                    out[text].append((name, *best))
                    best = None
                if best is None or share > best[2]:
                    best = (a, n, share)
                upto = max(upto, a + n)
            out[text].append((name, *best))
        return [sorted(x, key=lambda m: (m[1], m[0])) for x in out]

    def _scan(self, pieces: list[tuple[int, int, list[bytes]]], found: dict[tuple[int, str], set[tuple[int, int, float]]]) -> None:
        """Adds the matching windows of pieces of texts."""
        texts = [words for _, _, words in pieces]
        starts = np.cumsum([0, *map(len, texts)])
        every = [w for t in texts for w in t]
        if len(every) < SHINGLE:
            return
        # windows may reach over the end of a piece; what counts is cut to it
        for first, width, template in self.candidates(_shingles(self.hashed(every))):
            owner = int(np.searchsorted(starts, first, "right")) - 1
            for text in range(owner, len(texts)):
                a, z = max(first - int(starts[text]), 0), first + width + SHINGLE - 1 - int(starts[text])
                if z <= 0:
                    break
                part = texts[text][a:z]
                share = len(self.grams[template].intersection(zip(*(part[i:] for i in range(SHINGLE)), strict=False))) / len(self.grams[template])
                if share >= CONTAINMENT:
                    owner_, first_word, _ = pieces[text]
                    found.setdefault((owner_, self.names[template]), set()).add((first_word + a, len(part), share))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_words, matches`` per row; a match has license, start_word,
    n_words (of the window that holds it) and containment.

    Null and empty texts and texts of fewer than three words have no match;
    null keys and repeated rows are scanned as they come; of overlapping windows
    of one license the first of highest containment is the match; very long
    texts are scanned whole, in overlapping pieces; other columns are never read;
    an empty table gives no rows, no templates no matches.
    """
    small_batches(docs)
    templates = TEMPLATES if templates is None else templates
    match = pa.struct([("license", pa.string()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                texts = [words(t) for t in batch.column(1).to_pylist()]
                rows = [[dict(zip(("license", "start_word", "n_words", "containment"), m, strict=True)) for m in x] for x in index.scan(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, pa.list_(match))], [key, "n_words", "matches"]
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_words bigint, matches array<struct<license: string, start_word: int, n_words: int, containment: double>>"
    )


def licensed(docs: DataFrame, templates: list[tuple[str, str]] | None = None, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_words, n_matches, n_licenses, licenses, containment`` per row:
    the distinct licenses in order, comma-joined, and the best containment (0
    without a match)."""
    found = scan(docs, templates, text=text, key=key)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        key,
        "n_words",
        F.size("matches").cast("long").alias("n_matches"),
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("containment"),
    )
