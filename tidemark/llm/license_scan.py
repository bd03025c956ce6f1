"""Licence scan: MinHash bands over overlapping text windows, then exact containment.

Texts and templates are sets of hashed five-word shingles, of words ``[a-z0-9]+`` in lower case.
Templates are ordered by length; for templates of up to ``2^j`` shingles a text is cut into
windows of ``2^(j+1)`` shingles that overlap by half, so any run of that length lies within one.
A window and a template that share a band of minhashes are compared: the template is found if
the window contains 0.8 of its shingles or more.  The bands are chosen so that a window with
just that containment shares one with a probability of at least ``1 - 1e-6``.

The built-in templates are notices of a sentence and whole licence texts (``licenses/*.txt``).
Versions of a licence hold most of each other's text, so both may be found at one place.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Words
from tidemark.llm.common import pick, rows_of

#: Words in a shingle, and the share of a template's shingles that must be found.
WIDTH, CONTAINED = 5, 0.8
#: Minhashes in a band, and the chance to miss a window at the limit.
ROWS, MISS = 1, 1e-6
#: Templates at most: they are sent to every task.
MAX_TEMPLATES = 20_000
CACHE_BYTES = 40 << 20

#: Notices of common licences (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "gpl-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

def built_in() -> dict[str, str]:
    """The notices, and the whole licence texts under the names of their files in small letters."""
    texts = sorted(Path(__file__).with_name("licenses").glob("*.txt"))
    return TEMPLATES | {f"{path.stem.lower()}-text": path.read_text("utf-8") for path in texts}


_WORD = re.compile(rb"[a-z0-9]+")
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def template_class(n: int) -> int:
    """Class of a template of ``n`` shingles: the least ``j`` with ``n <= 2^j``, 2 at least."""
    return max(2, math.ceil(math.log2(max(n, 1))))


def bands_for(n: int, contained: float = CONTAINED, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that find a window holding ``contained`` of a template of ``n`` shingles."""
    window, common = 2 << template_class(n), math.ceil(contained * n)
    jaccard = common / (window + n - common)
    return math.ceil(math.log(miss) / math.log(1 - jaccard**rows))


class Scanner:
    """Templates prepared for the scan of texts."""

    def __init__(self, templates: dict[str, str], width: int = WIDTH, contained: float = CONTAINED, rows: int = ROWS):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.width, self.contained, self.rows = width, contained, rows
        self._hash = Words(xxhash.xxh64_intdigest, CACHE_BYTES)
        self.names, self.sets = list(templates), []
        for name in self.names:
            tokens = np.unique(self.shingles(templates[name])[0])
            if not len(tokens):
                raise ValueError(f"template {name!r} has fewer than {width} words")
            self.sets.append(tokens)
        self.classes = sorted({template_class(len(s)) for s in self.sets})
        self.bands = {
            j: max(bands_for(len(s), contained, rows) for s in self.sets if template_class(len(s)) == j)
            for j in self.classes
        }
        #: Shingles that a text must have at least to hold a template of the class.
        self.least = {
            j: min(math.ceil(contained * len(s)) for s in self.sets if template_class(len(s)) == j) for j in self.classes
        }
        most = max(self.bands.values(), default=0) * rows
        rng = np.random.default_rng(5)
        self._mul = rng.integers(1, 1 << 63, most, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._add = rng.integers(0, 1 << 63, most, dtype=np.uint64)
        # (class, band) -> band key -> templates
        self.index: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, tokens in enumerate(self.sets):
            j = template_class(len(tokens))
            for band in range(self.bands[j]):
                self.index[j, band][int(self._key([self._minhash(tokens, h).min() for h in self._hashes(band)]))].append(k)
        self._keys = {at: np.array(sorted(keys), np.uint64) for at, keys in self.index.items()}
        self.index = {at: dict(keys) for at, keys in self.index.items()}

    def _hashes(self, band: int) -> range:
        return range(band * self.rows, (band + 1) * self.rows)

    def _minhash(self, tokens: np.ndarray, h: int) -> np.ndarray:
        return ((tokens ^ self._add[h]) * self._mul[h]) >> np.uint64(20)

    @staticmethod
    def _key(values):
        total = values[0]
        for v in values[1:]:
            total = total * _K1 + v
        return total

    def shingles(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        words = _WORD.findall(text.encode().lower())
        if len(words) < self.width:
            return np.empty(0, np.uint64), words
        codes = np.fromiter(map(self._hash.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.width + 1
        total = np.zeros(n, np.uint64)
        for k in range(self.width):
            total = (total ^ codes[k : k + n]) * _K2
            total ^= total >> np.uint64(29)
        return total, words

    def candidates(self, tokens: list[np.ndarray]) -> list[set[tuple[int, int]]]:
        """``(template, first shingle of the window)`` of the windows of each text that share a band.

        The texts lie one after another, the longest first, so that those long enough for a class
        are a prefix and a hash is computed once for all texts and classes.
        """
        out: list[set[tuple[int, int]]] = [set() for _ in tokens]
        some = sorted((k for k, t in enumerate(tokens) if len(t)), key=lambda k: -len(tokens[k]))
        if not some or not self.classes:
            return out
        lengths = np.array([len(tokens[k]) for k in some])
        flat = np.concatenate([tokens[k] for k in some])
        # half windows of each text that is long enough for the class; class 0 is single shingles
        counts = {0: lengths}
        for j in self.classes:
            enough = np.searchsorted(-lengths, -self.least[j], side="right")
            counts[j] = -(-lengths[:enough] >> j)
        ends = {j: np.cumsum(c) for j, c in counts.items()}
        starts: dict[tuple[int, int], np.ndarray] = {}
        for band in range(max(self.bands.values())):
            wanted = [j for j in self.classes if band < self.bands[j] and len(counts[j])]
            if not wanted:
                continue
            shingles = flat[: ends[0][len(counts[wanted[0]]) - 1]]
            lows = [self._minhash(shingles, h) for h in self._hashes(band)]
            for below, j in zip([0, *wanted], wanted):
                if (below, j) not in starts:
                    first = np.repeat((ends[below] - counts[below])[: len(counts[j])], counts[j])
                    nth = np.arange(len(first)) - np.repeat(ends[j] - counts[j], counts[j])
                    starts[below, j] = first + (nth << (j - below))
                last = ends[below][len(counts[j]) - 1]
                lows = [np.minimum.reduceat(low[:last], starts[below, j]) for low in lows]
                mins = []
                for low in lows:
                    after = np.append(low[1:], _TOP)
                    after[ends[j] - 1] = _TOP  # the next half window is another text's
                    mins.append(np.minimum(low, after))
                keys, known = self._key(mins), self._keys[j, band]
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                for w in np.flatnonzero(known[at] == keys):
                    text = int(np.searchsorted(ends[j], w, side="right"))
                    # a last half window lies within the one before it
                    nth = min(int(w - ends[j][text] + counts[j][text]), max(0, int(counts[j][text]) - 2))
                    out[some[text]].update((k, nth << j) for k in self.index[j, band][int(keys[w])])
        return out

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, float, int, int]]]:
        """``template, share found, first word, words`` of the best window of each template found."""
        tokens = [self.shingles(t)[0] if t else np.empty(0, np.uint64) for t in texts]
        return [self._verified(t, c) for t, c in zip(tokens, self.candidates(tokens), strict=True)]

    def _verified(self, tokens: np.ndarray, candidates: set[tuple[int, int]]) -> list[tuple[str, float, int, int]]:
        best: dict[int, tuple[float, int]] = {}
        for k, start in sorted(candidates):
            template = self.sets[k]
            window = tokens[start : start + (2 << template_class(len(template)))]
            found = np.isin(template, window).sum() / len(template)
            if found >= self.contained and (k not in best or found > best[k][0]):
                best[k] = (float(found), start)
        return [
            (self.names[k], found, start, 2 << template_class(len(self.sets[k]))) for k, (found, start) in sorted(best.items())
        ]


def license_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """One row per document and template found: ``doc_id, license, contained, first_word, n_words``.

    The window is the best one, the earliest of equal ones.  Null and empty texts and texts of
    fewer than five words give no row; repeated rows give their matches once each; an empty table
    gives an empty result; further columns of the input are ignored.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(dict(built_in() if templates is None else templates))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in rows_of(batches, 256):
            hits = scanner.scan(batch.column("text").to_pylist())
            rows_hit = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
            flat = [h for hit in hits for h in hit]
            columns = list(zip(*flat, strict=True)) if flat else [(), (), (), ()]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows_hit, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "license", "contained", "first_word", "n_words"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(work, f"doc_id {kind}, license string, contained double, first_word bigint, n_words bigint")
