"""License scans: winnowed template fingerprints, then banded alignment.

Templates (a fixed list of public license notices) are cut into words; the
hashes of their word 3-grams are put into an inverted index hash ->
(template, position): all of them for templates of at most 32 words, winnowed
ones (the smallest of each window of 4) for longer ones.  Templates of at most
5 words are indexed by their 2-grams, since one changed word can break every
3-gram.  Every word 2-gram and 3-gram of a document is looked up; hits on nearly the same diagonal make a candidate,
which is aligned with the template in a band around that diagonal.  Reported:
the matched words' share of the template or, if that is longer, of the matched
span (so a word put into a notice lowers its coverage), and the character span.

Nulls and edge cases: null or empty texts report nothing; words are runs of
letters and digits of the lower-cased text; notices repeated in a text are
reported once per place; null doc_ids are kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: fixed values: public notices by SPDX id
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MIT": "Released under the MIT License",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
}
K, WINDOW, BAND = 3, 4, 4
SHORT, WHOLE = 5, 32  # words: indexed by 2-grams, by every 3-gram
_WORD = re.compile(r"[^\W_]+")


def winnow(words: list[str]) -> list[tuple[int, int]]:
    h = [zlib.crc32(" ".join(words[i:i + K]).encode()) for i in range(len(words) - K + 1)]
    return sorted({min((x, -i) for i, x in enumerate(h[s:s + WINDOW], s)) for s in range(max(1, len(h) - WINDOW + 1))}) if h else []


def fingerprints(words: list[str]) -> list[tuple[int, int]]:
    """(hash, position) of the word runs by which a template is found."""
    if len(words) > WHOLE:
        return [(h, -i) for h, i in winnow(words)]
    k = K - (len(words) <= SHORT)
    return [(zlib.crc32(" ".join(words[i:i + k]).encode()), i) for i in range(len(words) - k + 1)]


def index(templates: dict[str, str]) -> tuple[dict, dict]:
    words = {n: _WORD.findall(t.lower()) for n, t in templates.items()}
    at: dict[int, list] = defaultdict(list)
    for n, w in words.items():
        for h, i in fingerprints(w):
            at[h].append((n, i))
    return words, dict(at)


def align(need: list[str], have: list[str], shift: int) -> tuple[int, int, int]:
    """(matched words, first, last + 1 in have): longest common subsequence within BAND of the diagonal."""
    best: dict[int, tuple[int, int, int]] = {}
    top = (0, 0, 0)
    for i, w in enumerate(need):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + shift - BAND), min(len(have), i + shift + BAND + 1)):
            here = max(best.get(j, (0, 0, 0)), row.get(j - 1, (0, 0, 0)))
            if have[j] == w:
                n, a, _ = best.get(j - 1, (0, j, j))
                here = max(here, (n + 1, a if n else j, j + 1))
            row[j] = here
            top = max(top, here)
        best = row
    return top


def scan_text(text: str, words: dict, at: dict, vocabulary: frozenset, least: float) -> list[tuple[str, float, int, int]]:
    low = text.lower()
    have = _WORD.findall(low)
    ok = [w in vocabulary for w in have]
    found: dict[tuple, None] = {}
    for j in range(len(have) - 1):
        if ok[j] and ok[j + 1]:
            for k in (K - 1, K) if j + 2 < len(have) and ok[j + 2] else (K - 1,):
                for n, i in at.get(zlib.crc32(" ".join(have[j:j + k]).encode()), ()):
                    found[(n, j - i)] = None
    if not found:
        return []
    spans = [m.span() for m in _WORD.finditer(low)]
    out, last = [], {}
    for n, shift in sorted(found):
        if n in last and shift - last[n] <= BAND:
            continue
        m, a, b = align(words[n], have, shift)
        # words of the text between matched ones count against the notice like words it lacks
        share = m / max(len(words[n]), b - a)
        if share >= least:
            out.append((n, share, spans[a][0], spans[b - 1][1]))
            last[n] = shift
    # of overlapping notices the one with more matched text stays, on a tie the one with more matched words
    starts: list[int] = []  # kept notices do not overlap, so their neighbours decide
    keep: list = []
    for x in sorted(out, key=lambda r: (-(r[3] - r[2]) * r[1], -r[1] * len(words[r[0]]), r[0])):
        at = bisect.bisect_left(starts, x[2])
        if (at == 0 or keep[at - 1][3] <= x[2]) and (at == len(keep) or x[3] <= keep[at][2]):
            starts.insert(at, x[2])
            keep.insert(at, x)
    return keep


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, license, coverage, span_start, span_end (characters of the lower-cased text)."""
    common.prepare(docs.sparkSession)
    words, at = index(templates or TEMPLATES)
    vocabulary = frozenset(x for w in words.values() for x in w)

    def run(batches):
        for b in batches:
            rows = [(d, *r) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for r in scan_text(t, words, at, vocabulary, least)]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()),
                                              pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                             ["doc_id", "license", "coverage", "span_start", "span_end"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, license string, coverage double, span_start long, span_end long")
