"""License scan: winnowed fingerprints pick templates, banded alignment measures them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalstats.llm.common import NON_ALPHANUMERIC, Words, leftmost_smallest, ngrams, pieces, spans

# The usual notices of public licenses.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_SCHEMA = "doc_id bigint, template string, start_word bigint, end_word bigint, n_matched bigint, coverage double"
_MATCH, _MISMATCH, _GAP = 2, -1, -1
#: Cells of a row of the alignments that are made together.
_CELLS = 1 << 20


def banded_alignments(
    template: np.ndarray, words: np.ndarray, first: np.ndarray, size: np.ndarray, diagonal: np.ndarray, band: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of ``template`` with each of several texts, ``size[i]`` of the
    ``words`` from ``first[i]`` on, within ``band[i]`` of ``text position - template position =
    diagonal[i]``: matched words, first word and end in the text.

    All texts go through the template word by word together: a row per text, a column per
    diagonal of the widest band. Of equal scores a match or replacement goes before a gap.
    """
    n, width = len(first), 2 * int(band.max()) + 1
    low = diagonal - band.max()
    column = np.arange(width)
    reach = low[:, None] + np.arange(len(template) + width)
    inside = (reach >= 0) & (reach < size[:, None])
    text = words[np.where(inside, first[:, None] + reach, 0)]
    allowed = np.abs(column - int(band.max())) <= band[:, None]
    score, matched, start = (np.zeros((n, width), np.int64) for _ in range(3))
    best, best_matched, best_start, best_end = (np.zeros(n, np.int64) for _ in range(4))
    rows = np.arange(n)
    for i, word in enumerate(template):
        here, at = allowed & inside[:, i : i + width], reach[:, i : i + width]
        same = (text[:, i : i + width] == word) & here
        fresh = score == 0
        new = score + np.where(same, _MATCH, _MISMATCH)
        new_matched = np.where(fresh, 0, matched) + same
        new_start = np.where(fresh, at, start)
        # A word of the template left out: the same text position, one column further in the row before.
        up = new[:, :-1] < score[:, 1:] + _GAP
        new[:, :-1] = np.where(up, score[:, 1:] + _GAP, new[:, :-1])
        new_matched[:, :-1] = np.where(up, matched[:, 1:], new_matched[:, :-1])
        new_start[:, :-1] = np.where(up, start[:, 1:], new_start[:, :-1])
        new = np.where(here, np.maximum(new, 0), 0)
        # Words of the text left out cost one each, so the best of all cells to the left, the
        # nearest of equals, is a running maximum.
        ahead = np.maximum.accumulate((new - _GAP * column) * width + column, axis=1)
        source = ahead % width
        score = np.maximum(ahead // width + _GAP * column, 0) * here
        matched = np.take_along_axis(new_matched, source, axis=1)
        start = np.take_along_axis(new_start, source, axis=1)
        # Of equal scores the earliest start, then the first end.
        rank = np.where(same, score * (len(template) + 2 * width + 1) - (start - low[:, None]), -1)
        top = rank.argmax(axis=1)
        value, begin = score[rows, top], start[rows, top]
        better = same[rows, top] & ((value > best) | ((value == best) & (begin < best_start)))
        best = np.where(better, value, best)
        best_matched = np.where(better, matched[rows, top], best_matched)
        best_start = np.where(better, begin, best_start)
        best_end = np.where(better, at[rows, top] + 1, best_end)
    return best_matched, best_start, best_end


class _Templates:
    """Words and inverted index of fingerprints: hash to template and position."""

    def __init__(self, templates: Mapping[str, str], gram: int, window: int) -> None:
        self.names = list(templates)
        words = Words(pa.array(list(templates.values()), pa.string()), NON_ALPHANUMERIC, lower=True)
        hashes = words.hashes()
        self.words = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        text, at, prints = fingerprints(words, hashes, gram, window)
        order = np.argsort(prints, kind="stable")
        self.prints, self.template = prints[order], text[order]
        self.position = (at - words.first[text])[order]
        self.sizes = words.counts


def fingerprints(
    words: Words, hashes: np.ndarray, gram: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: of each ``window`` consecutive ``gram``-word hashes the smallest; text,
    first word and hash. Texts with fewer hashes give their smallest."""
    grams = ngrams(hashes, gram)
    parts = []
    for size in range(1, window + 1):
        counts = words.counts - gram + 1
        fitting = counts >= window if size == window else counts == size
        first = np.where(fitting, words.first[:-1], 0)
        text, at = spans(np.where(fitting, counts - size + 1, 0), first)
        if len(at):
            parts.append(np.unique(np.stack([text, leftmost_smallest(grams, size)[at]], axis=1), axis=0))
    found = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
    return found[:, 0], found[:, 1], grams[found[:, 1]] if len(found) else np.zeros(0, np.uint64)


def _alike(template: np.ndarray, width: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Places to align together: one template, bands of about one width, a bounded number of cells."""
    order = np.lexsort((width, template))
    at = 0
    while at < len(order):
        t, w = template[order[at]], width[order[at]]
        most = max(_CELLS // int(sizes[t] + 4 * w + 1), 1)
        group = order[at : at + most]
        group = group[(template[group] == t) & (width[group] <= 2 * w + 1)]
        yield group
        at += len(group)


def _scanner(index, gram: int, window: int, band: int, min_percent: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"), NON_ALPHANUMERIC, lower=True)
            hashes = words.hashes()
            text, at, prints = fingerprints(words, hashes, gram, window)
            low, high = (np.searchsorted(known.prints, prints, side) for side in ("left", "right"))
            seed, place = spans(high - low, low)
            rows: list[tuple] = []
            if len(seed):
                own, position = text[seed], at[seed] - words.first[text[seed]]
                template = known.template[place]
                diagonal = position - known.position[place]
                order = np.lexsort((position, diagonal, template, own))
                own, template, diagonal = own[order], template[order], diagonal[order]
                apart = np.minimum(band, known.sizes[template] // 2)
                new = np.append(
                    True,
                    (own[1:] != own[:-1]) | (template[1:] != template[:-1]) | (np.diff(diagonal) > apart[1:]),
                )
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(new)) - 1
                centre = (diagonal[begin] + diagonal[end]) // 2
                width = apart[begin] + (diagonal[end] - diagonal[begin] + 1) // 2
                ids = piece.column("doc_id").to_pylist()
                for chosen in _alike(template[begin], width, known.sizes):
                    body, i = known.words[template[begin[chosen[0]]]], own[begin[chosen]]
                    found = banded_alignments(
                        body, hashes, words.first[i], words.counts[i], centre[chosen], width[chosen]
                    )
                    name = known.names[template[begin[chosen[0]]]]
                    for text_number, matched, start, stop in zip(i.tolist(), *(x.tolist() for x in found), strict=True):
                        if 100 * matched >= min_percent * len(body):
                            rows.append((ids[text_number], name, start, stop, matched, matched / len(body), text_number))
                # Each place once, whatever bands have led to it.
                rows = [r[:-1] for r in sorted(set(rows), key=lambda r: (r[-1], r[2:4], r[1]))]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "template", "start_word", "end_word", "n_matched", "coverage"],
            )

    return scan


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    gram: int = 3,
    window: int = 3,
    band: int = 64,
    min_percent: int = 80,
) -> DataFrame:
    """One row per place in ``docs`` (``doc_id, text``) that holds a template: ``doc_id,
    template, start_word, end_word, n_matched, coverage``.

    Words are as in :func:`signalstats.llm.decontaminate.find_benchmark`; positions
    count them. Of every ``window`` consecutive ``gram``-word hashes the smallest is a
    fingerprint, so a run of ``gram + window - 1`` common words is never missed. An
    inverted index of the templates' fingerprints names candidates; seeds on diagonals
    within ``band`` (half the template, if that is shorter) are one place, so words put into
    a notice, up to that many at a time, do not break it. Sequence alignment within as many
    words of those diagonals gives the matched words and their span; places with at least
    ``min_percent`` % of the template's words are reported, each once.

    Null or empty text: no rows. Templates without ``gram`` words are never found. A
    repeated row reports its places again; a null ``doc_id`` stays null. Short
    templates inside longer ones are reported beside them. Other columns are not used.

    The templates are a parameter of bounded size and are broadcast; documents are
    read once and nothing is shuffled.
    """
    index = docs.sparkSession.sparkContext.broadcast(_Templates(templates, gram, window))
    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return rows.mapInArrow(_scanner(index, gram, window, band, min_percent), _SCHEMA)
