"""License scan: MinHash bands over overlapping text windows retrieve templates,
exact shingle containment verifies them.

A template of W words is looked for in every window of W words; a text with fewer
words is one window. Both are sets of ``width``-word shingles (a shorter template is
one shingle). Containment of at least ``percent`` in a window no longer than the
template means a similarity of at least c / (2 - c), 2/3 at 80 %; with ``BANDS`` bands
of one coordinate each, a window is missed with a chance of at most (1/3)^16 < 3e-8.

One table per shingle width holds the band values of all templates. Each place of a
text is looked up in it once per band, whatever the number of templates: a window has
a template's band value exactly if it holds a place with that value and none with a
smaller one, so each place found gives an interval of window starts. Only templates
retrieved this way are compared, by a running count of the distinct shingles that
each of their windows shares.

Templates are a dictionary or a table ``(license, text)`` of at most
``MAX_TEMPLATE_BYTES`` (more is an error) and are broadcast with the function. Defined
results: null or wordless texts match nothing, nor do texts with fewer words than a
shingle; each matching row gives one row per template; repeated rows are reported
alike; an empty table or no templates give an empty result; templates that are null or
wordless are left out, of templates with one name the least text counts. Input columns
named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import blocks as B
from settlekit.llm.decontaminate import words_of

WIDTH, PERCENT, BANDS = 5, 80, 16
MAX_TEMPLATE_BYTES = 16 << 20
_CELLS = 1 << 20        # of a numpy block
OUTPUTS = ("license", "n_windows", "containment", "first_word")
#: Short notices of common licenses (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "All rights reserved": "All rights reserved.",
}
_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(word: np.ndarray, width: int) -> np.ndarray:
    """Hash of the shingle that starts at each word (the caller checks row ends)."""
    n = max(0, len(word) - width + 1)
    h = np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64)
    for d in range(width):
        h = B.mix(h + word[d:d + n])
    return h


def coordinate(shingle: np.ndarray, band: int) -> np.ndarray:
    """Value of each shingle in a band; a set's band value is the least of its shingles."""
    return (shingle ^ _XOR[band]) * _MUL[band]


class Template:
    def __init__(self, name: str, text: str, width: int = WIDTH):
        word, *_ = words_of(*B.text_bytes(pa.array([text], pa.string())))
        self.name, self.width = name, min(width, len(word))
        h = _shingles(word, self.width) if len(word) else np.zeros(0, np.uint64)
        self.size = len(h)                      # shingle places of a window
        self.shingles = np.unique(h)


@dataclass
class Places:
    """Shingles of some rows by place, with the first and last place of each one's row."""

    shingle: np.ndarray
    first: np.ndarray
    last: np.ndarray        # before ``first`` where the row holds no shingle

    @classmethod
    def of(cls, word: np.ndarray, row: np.ndarray, width: int) -> Places:
        shingle = _shingles(word, width)
        starts = B.group_starts(row)
        per = np.diff(np.append(starts, len(row)))
        first, end = np.repeat(starts, per)[:len(shingle)], np.repeat(starts + per, per)[:len(shingle)]
        return cls(shingle, first, end - width)


def _clear(value: np.ndarray, at: np.ndarray, least: np.ndarray, reach: np.ndarray, step: int) -> np.ndarray:
    """How many places next to each of ``at``, in direction ``step``, hold nothing below ``least``; at most ``reach``."""
    free = np.zeros(len(at), np.int64)
    going = np.flatnonzero(reach > 0)
    width = 16
    while len(going):
        kept = []
        for part in np.array_split(going, -(-len(going) * width // _CELLS)):
            ahead = free[part, None] + np.arange(1, width + 1)
            inside = ahead <= reach[part, None]
            place = at[part, None] + step * np.where(inside, ahead, 0)
            stop = ~inside | (value[place] < least[part, None])
            run = np.where(stop.any(axis=1), stop.argmax(axis=1), width)
            free[part] += run
            kept.append(part[run == width])
        going, width = np.concatenate(kept), min(2 * width, 4096)
    return free


class BandTable:
    """Band values of all templates of one width."""

    def __init__(self, templates: list[Template]):
        self.templates, self.width = templates, templates[0].width
        self.size = np.array([t.size for t in templates])
        self.bands = []
        for b in range(BANDS):
            value = np.array([coordinate(t.shingles, b).min() for t in templates], dtype=np.uint64)
            order = np.argsort(value, kind="stable")
            self.bands.append((value[order], order))

    def windows(self, places: Places) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """(first start, last start) of the windows that share a band value, by template."""
        found: dict[int, list] = {}
        for b, (known, owner) in enumerate(self.bands):
            value = coordinate(places.shingle, b)
            lo = np.searchsorted(known, value)
            at = np.flatnonzero((known[np.minimum(lo, len(known) - 1)] == value) & (np.arange(len(value)) <= places.last))
            n = np.searchsorted(known, value[at], side="right") - lo[at]
            who, at = owner[B.ranges(lo[at], n)], np.repeat(at, n)
            if not len(at):
                continue
            first, last = places.first[at], places.last[at]
            size = np.minimum(self.size[who], last - first + 1)
            left = _clear(value, at, value[at], np.minimum(size - 1, at - first), -1)
            right = _clear(value, at, value[at], np.minimum(size - 1, last - at), 1)
            low, high = at - left, np.minimum(at, at + right - size + 1)
            for t, x in _by(who, low <= high):
                found.setdefault(t, []).append((low[x], high[x]))
        return {t: tuple(np.concatenate(c) for c in zip(*got, strict=True)) for t, got in found.items()}


def _by(who: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(template, positions) of the chosen rows."""
    x = np.flatnonzero(chosen)
    x = x[np.argsort(who[x], kind="stable")]
    for part in np.split(x, B.group_starts(who[x])[1:]) if len(x) else ():
        yield int(who[part[0]]), part


def verified(template: Template, places: Places, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, shared shingles) of the windows between ``low`` and ``high`` that hold ``percent`` of the template."""
    n, size = len(places.shingle), template.size
    rank = np.minimum(np.searchsorted(template.shingles, places.shingle), len(template.shingles) - 1)
    near = np.flatnonzero((template.shingles[rank] == places.shingle) & (np.arange(n) <= places.last))
    order = near[np.lexsort((near, rank[near]))]
    before = np.full(len(order), -1)
    same = rank[order[1:]] == rank[order[:-1]]
    before[1:][same] = order[:-1][same]
    # A place counts in the windows that hold it and not the one before with the same shingle.
    from_start = np.maximum(np.maximum(before + 1, order - size + 1), places.first[order])
    steps = np.bincount(from_start, minlength=n + 1) - np.bincount(order + 1, minlength=n + 1)
    shared = np.cumsum(steps)[:n]
    edges = np.bincount(low, minlength=n + 1) - np.bincount(high + 1, minlength=n + 1)
    start = np.flatnonzero((np.cumsum(edges)[:n] > 0) & (100 * shared >= percent * len(template.shingles)))
    return start, shared[start]


def _known(templates: dict[str, str] | DataFrame, width: int) -> list[Template]:
    if isinstance(templates, DataFrame):
        rows = templates.where("license IS NOT NULL AND text IS NOT NULL")
        size = rows.agg(F.sum(F.octet_length("license") + F.octet_length("text"))).first()[0] or 0
        if size > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates of {size} bytes; at most {MAX_TEMPLATE_BYTES} are broadcast")
        templates = {r[0]: r[1] for r in rows.groupBy("license").agg(F.min("text")).collect()}
    return [t for t in (Template(n, x, width) for n, x in sorted(templates.items())) if t.size]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES, width: int = WIDTH, percent: int = PERCENT,
                  text_col: str = "text") -> DataFrame:
    """For each row and matching template: ``docs`` without its text, ``license,
    n_windows`` (matching windows), ``containment`` (of the best) and ``first_word`` (place of the first)."""
    known = _known(templates, width)
    tables = [BandTable([t for t in known if t.width == w]) for w in sorted({t.width for t in known})]
    rest = [c for c in docs.columns if c != text_col and c not in OUTPUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for lo, hi, data, offsets in B.pieces(batch.column(0)):
                word, row, _, _ = words_of(data, offsets)
                first = np.searchsorted(row, np.arange(hi - lo))
                for table in tables:
                    places = Places.of(word, row, table.width)
                    if not len(places.shingle):
                        continue
                    for which, (low, high) in sorted(table.windows(places).items()):
                        t = table.templates[which]
                        s, both = verified(t, places, low, high, percent)
                        if len(s):
                            cut = B.group_starts(row[s])
                            n = np.diff(np.append(cut, len(s)))
                            best = np.maximum.reduceat(both, cut)
                            for a, k, m in zip(s[cut].tolist(), n.tolist(), best.tolist(), strict=True):
                                r = int(row[a])
                                out.append((lo + r, t.name, k, m / len(t.shingles), a - int(first[r])))
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in batch.columns[1:]), pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.float64()),
                 pa.array([o[4] for o in out], pa.int64())], names=[*rest, *OUTPUTS])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes),
                        "license string, n_windows bigint, containment double, first_word bigint"])
    return docs.select(F.col(text_col).cast("string"), *rest).mapInArrow(run, schema)
