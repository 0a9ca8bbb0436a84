"""Licence scan by MinHash bands over overlapping text windows.

Each template of s shingles is looked for with windows of s shingles that
start every eighth of s (templates of like length share a window size). A
window that holds a copy of containment 0.8 or more is at most a sixteenth of
s off its best place and has similarity 0.58 or more to the template; with 24
bands of one MinHash value it misses all of them with a probability under
1e-8. Retrieved templates are verified by the exact containment of their
shingles in the text around the window.

Words are compared in lower case without marks at their edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import U64, arrow_settings, mix, stage, text_bytes, word_hashes

SHINGLE = 5
BANDS = 24
CONTAINMENT = 80  # percent
MAX_TEMPLATES = 20_000  # they are sent to every task: about 10 kB each

# Wording of public licence notices.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

_EDGE = np.arange(256, dtype=np.uint8)
_EDGE[[i for i in range(128) if not chr(i).isalnum() and chr(i) not in ".-+"]] = 32


def plain(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Marks become blanks; a full stop or dash only at a word's end."""
    out = _EDGE[data]
    soft = (out == 46) | (out == 45) | (out == 43)
    last = np.zeros(len(out), bool)
    if len(out):
        last[:-1] = out[1:] == 32
        last[off[1:][off[1:] > 0] - 1] = True
    out[soft & last] = 32
    return out


def shingles(data: np.ndarray, off: np.ndarray):
    """Shingle hashes of all texts in order, their text numbers and first bytes."""
    h, row, start, _ = word_hashes(plain(data, off), off)
    n = max(0, len(h) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        s = np.zeros(n, U64)
        for i in range(SHINGLE):
            s += mix(h[i : n + i] + U64(i + 1)) * U64(2 * i + 1)
        s = mix(s)
    ok = row[:n] == row[SHINGLE - 1 :] if n else np.zeros(0, bool)
    return s[ok], row[:n][ok], start[:n][ok]


def band_values(s: np.ndarray, band: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(s ^ U64((0x9E3779B97F4A7C15 * (band + 1)) % (1 << 64)))


def window_size(n: int) -> int:
    """Window lengths grow by a quarter: templates of like length share one."""
    size = 1
    while size < n:
        size = max(size + 1, size * 5 // 4)
    return size


class Templates:
    def __init__(self, rows: list[tuple[str, str]]):
        if len(rows) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        raw = [t.encode() for _, t in rows]
        off = np.append(0, np.cumsum([len(x) for x in raw]))
        s, row, _ = shingles(np.frombuffer(b"".join(raw), np.uint8), off)
        self.names = [n for n, _ in rows]
        self.sets = [np.unique(s[row == i]) for i in range(len(rows))]
        for name, x in zip(self.names, self.sets):
            if not len(x):
                raise ValueError(f"the template of {name} has fewer than {SHINGLE} words")
        self.keys: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size in sorted({window_size(len(x)) for x in self.sets}):
            own = np.array([i for i, x in enumerate(self.sets) if window_size(len(x)) == size])
            table = []
            for band in range(BANDS):
                low = np.array([band_values(self.sets[i], band).min() for i in own], U64)
                order = np.argsort(low, kind="stable")
                table.append((low[order], own[order]))
            self.keys[size] = table
        # a window has a template's band value only if it holds the shingle it comes from
        self.marks = np.unique(np.concatenate([x[[band_values(x, b).argmin() for b in range(BANDS)]] for x in self.sets]))

    def near(self, s: np.ndarray, row: np.ndarray) -> np.ndarray:
        """True for the shingles of texts that can share a band value at all."""
        at = np.searchsorted(self.marks, s)
        at[at == len(self.marks)] = 0
        return np.isin(row, np.unique(row[self.marks[at] == s]))

    def retrieve(self, s: np.ndarray, row: np.ndarray):
        """(template, first shingle, window) of windows that share a band value."""
        found = set()
        for size, table in self.keys.items():
            step = max(1, size // 8)
            bounds = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
            ends = np.append(bounds[1:], len(row))
            # windows at every step, and one at the end of each text
            n = np.maximum(0, (ends - bounds - size) // step + 1)
            first = np.repeat(bounds, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step
            first = np.unique(np.concatenate([first, np.maximum(bounds, ends - size)]))
            stop = np.minimum(first + size, ends[np.searchsorted(bounds, first, "right") - 1])
            for band, (keys, own) in enumerate(table if len(first) else ()):
                value = band_values(s, band)
                low = sliding_min(value, first, stop, size)
                a, b = np.searchsorted(keys, low), np.searchsorted(keys, low, "right")
                for i in np.flatnonzero(a < b):
                    found.update((int(t), int(first[i]), int(stop[i])) for t in own[a[i] : b[i]])
        return found


def sliding_min(value: np.ndarray, first: np.ndarray, stop: np.ndarray, size: int) -> np.ndarray:
    """Minimum of value[first:stop], with stop - first <= size, by doubling."""
    level, have, out = value, 1, np.empty(len(first), U64)
    length = stop - first
    while True:
        own = (length >= have) & (length < 2 * have)
        out[own] = np.minimum(level[first[own]], level[stop[own] - have])
        if 2 * have > size or len(level) <= have:
            return out
        level = np.minimum(level[:-have], level[have:])
        have *= 2


def hits(templates: Templates, percent: int):
    """mapInArrow: documents -> verified regions, one row a document and licence."""

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            s, row, start = shingles(data, off)
            some = templates.near(s, row)
            s, row, start = s[some], row[some], start[some]
            best: dict[tuple[int, str], list] = {}
            for t, a, b in sorted(templates.retrieve(s, row)):
                own, doc = templates.sets[t], row[a]
                wide = b - a
                lo, hi = max(0, a - wide), min(len(s), b + wide)
                near = np.arange(lo, hi)[row[lo:hi] == doc]
                inside = near[np.isin(s[near], own)]
                common = len(np.unique(s[inside]))
                if 100 * common >= percent * len(own):
                    at = best.setdefault((int(doc), templates.names[t]), [0, 1, int(inside[0]), set()])
                    if common * at[1] > at[0] * len(own) or at[0] == 0:
                        at[0], at[1] = common, len(own)
                    at[2] = min(at[2], int(inside[0]))
                    at[3].add(int(inside[0]))
            rows = [(docs[d], name, c, n, c / n, len(places), int(start[first] - off[d])) for (d, name), (c, n, first, places) in sorted(best.items())]
            if rows:
                cols = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "license", "common", "total", "containment", "regions", "first_byte"])

    return run


HITS = "doc_id long, license string, common long, total long, containment double, regions long, first_byte long"


def scan_licenses(docs: DataFrame, rows: list[tuple[str, str]], percent: int = CONTAINMENT) -> DataFrame:
    """A row for each document and licence of which a region holds ``percent`` or
    more of a template's shingles: the best template's common and total
    shingles, the number of distinct regions and the first one's byte offset.
    Null or empty texts and documents without a licence give no row; repeated
    rows give one each; other columns are not read."""
    docs = docs.filter("length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(hits(Templates(rows), percent), HITS)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        return stage(scan_licenses(docs, [(k, t) for k, v in NOTICES.items() for t in v]), "op9")
