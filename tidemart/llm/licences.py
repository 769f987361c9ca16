"""Licence notices in documents, by winnowed fingerprints and banded alignment.

Templates and documents are read as lower-case words. Hashes of GRAM words are winnowed: of every
WINDOW neighbouring hashes the least one is kept (the last of equal ones), so a common run of
GRAM + WINDOW - 1 words always shares a kept hash. The templates' kept hashes form an inverted
index; a document's hits on one template that lie near one diagonal make a candidate, whose words
are aligned with the template inside a band around that diagonal. Reported are the share of the
template's words that matched and the place of the match, in words and in characters.

Rows: NULL or empty text has no match. Repeated rows and equal ids are each reported. A match
inside a better one of the same document is left out. Columns are carried in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt

GRAM, WINDOW = 3, 3
BAND = 0.2           # half width of the band, as a share of the template's words; 4 words at least
COVERAGE = 0.7       # least share of a template's words that a reported match has
GAP = -0.5

# Public licence notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}
FOUND = ("struct<licence:string,coverage:double,matched:bigint,begin_word:bigint,end_word:bigint,begin_char:bigint,end_char:bigint>")


def winnowed(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of all rows, and the word each begins at. Rows of fewer than GRAM words have none."""
    hashes, gram_rows = bt.windows(codes, rows, GRAM)
    long = np.repeat(np.diff(rows) >= GRAM, np.diff(gram_rows))
    home = bt.row_of(gram_rows)
    at = np.arange(len(hashes)) - gram_rows[home] + rows[home]
    kept = np.zeros(len(hashes), dtype=bool)
    window, window_rows = np.arange(len(hashes)), gram_rows
    count = np.diff(window_rows)
    per = np.where(count >= WINDOW, count - WINDOW + 1, np.minimum(count, 1))
    out_rows = np.concatenate([[0], np.cumsum(per)])
    first = np.arange(out_rows[-1]) + np.repeat(window_rows[:-1] - out_rows[:-1], per)
    last = np.repeat(window_rows[1:] - 1, per)
    best = first.copy()
    for k in range(1, WINDOW):
        other = np.minimum(first + k, last)
        best = np.where(hashes[other] <= hashes[best], other, best)
    kept[best] = True
    kept &= long
    return hashes[kept], at[kept]


def _text_words(data: np.ndarray, offsets: np.ndarray):
    lower = bt.LOWER[data]
    starts, ends, rows = bt.words(lower, offsets, bt.WORD_BYTES)
    return starts, ends, rows, bt.hashes(lower, starts, ends)


class Index:
    """Templates' words and the inverted index of their kept hashes."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        data, offsets = bt.flat(pa.array(templates.values(), pa.string()))
        _, _, self.rows, self.code = _text_words(data, offsets)
        hashes, at = winnowed(self.code, self.rows)
        order = np.argsort(hashes, kind="stable")
        self.hashes, at = hashes[order], at[order]
        self.template = np.searchsorted(self.rows, at, side="right") - 1
        self.at = at - self.rows[self.template]

    def words(self, k: int) -> list[int]:
        return self.code[self.rows[k]:self.rows[k + 1]].tolist()


def align(template: list[int], words: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, end) of the best local alignment with |place in words - place in template - shift| <= band."""
    width = 2 * band + 1
    score = [0.0] * (width + 2)
    trace = [(0, -1, -1)] * (width + 2)       # matched, first, end of the alignment that ends here
    best, best_trace = 0.0, (0, 0, 0)
    for i, want in enumerate(template):
        new_score, new_trace = [0.0] * (width + 2), [(0, -1, -1)] * (width + 2)
        for b in range(1, width + 1):
            j = i + shift + b - 1 - band
            if not 0 <= j < len(words):
                continue
            same = words[j] == want
            value, source = score[b] + (1.0 if same else GAP), trace[b]
            if score[b + 1] + GAP > value:     # a template word is missing
                value, source, hit = score[b + 1] + GAP, trace[b + 1], False
            else:
                hit = same
            if new_score[b - 1] + GAP > value:  # a word was inserted
                value, source, hit = new_score[b - 1] + GAP, new_trace[b - 1], False
            if value <= 0:
                continue
            matched, begin, _ = source
            if hit:
                source = (matched + 1, j if begin < 0 else begin, j + 1)
            new_score[b], new_trace[b] = value, source
            if value > best:
                best, best_trace = value, source
        score, trace = new_score, new_trace
    return best_trace


def _found(index: Index, code: np.ndarray, rows: np.ndarray) -> dict[int, list[tuple]]:
    """Per row: (template, matched, first word, end word)."""
    hashes, at = winnowed(code, rows)
    low = np.searchsorted(index.hashes, hashes, side="left")
    hit = np.flatnonzero((low < len(index.hashes)) & (index.hashes[np.minimum(low, len(index.hashes) - 1)] == hashes))
    tries: dict[tuple[int, int], list[int]] = {}
    for k in hit.tolist():
        row = int(np.searchsorted(rows, at[k], side="right")) - 1
        j = int(low[k])
        while j < len(index.hashes) and index.hashes[j] == hashes[k]:
            tries.setdefault((row, int(index.template[j])), []).append(int(at[k] - rows[row] - index.at[j]))
            j += 1
    out: dict[int, list[tuple]] = {}
    for (row, k), shifts in tries.items():
        template = index.words(k)
        words = code[rows[row]:rows[row + 1]]
        band = max(4, int(BAND * len(template)))
        shifts.sort()
        begin = 0
        for end in range(1, len(shifts) + 1):
            if end < len(shifts) and shifts[end] - shifts[begin] <= band:
                continue
            middle = shifts[(begin + end) // 2]
            base = max(0, middle - band)
            part = words[base:middle + len(template) + band + 1].tolist()
            matched, first, stop = align(template, part, middle - base, band)
            if matched >= COVERAGE * len(template):
                out.setdefault(row, []).append((k, matched, base + first, base + stop))
            begin = end
    for row, got in out.items():
        got.sort(key=lambda x: (-x[1], -x[1] / len(index.words(x[0])), x[2], x[0]))
        kept: list[tuple] = []
        for one in got:
            if not any(other[2] <= one[2] and one[3] <= other[3] for other in kept):
                kept.append(one)
        out[row] = sorted(kept, key=lambda x: (x[2], x[0]))
    return out


def scanned(docs: DataFrame, carry: list[str], templates: dict[str, str] | None = None) -> DataFrame:
    """`row` (the columns to carry), n_words and found: an array of matches, in text order."""
    index = Index(templates or TEMPLATES)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "text")
    schema = given.select("row", F.lit(0).cast("bigint").alias("n_words"), F.array().cast(f"array<{FOUND}>").alias("found")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("licence", pa.string()), ("coverage", pa.float64()), *[(c, pa.int64()) for c in (
            "matched", "begin_word", "end_word", "begin_char", "end_char")]]))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                starts, ends, rows, code = _text_words(data, offsets)
                out: list[list[dict]] = [[] for _ in range(end - row)]
                for r, got in _found(index, code, rows).items():
                    text = data[offsets[r]:offsets[r + 1]]
                    lead = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                    for k, matched, first, stop in got:
                        a, b = starts[rows[r] + first] - offsets[r], ends[rows[r] + stop - 1] - offsets[r]
                        out[r].append({"licence": index.names[k], "coverage": matched / len(index.words(k)), "matched": matched,
                                       "begin_word": first, "end_word": stop, "begin_char": int(lead[a]), "end_char": int(lead[b])})
                yield pa.record_batch([batch.column(0).slice(row, end - row), pa.array(np.diff(rows), pa.int64()), pa.array(out, kind)],
                                      names=["row", "n_words", "found"])

    return given.mapInArrow(scan, schema)
