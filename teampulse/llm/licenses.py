"""License scan (operator 3): winnowed template fingerprints, then banded alignment.

Templates and texts are read as lower-cased words of letters, digits and
non-ASCII bytes. Of a template's hashed runs of `GRAM` words, winnowing keeps
the smallest of every `WINDOW` neighbours; an inverted index maps each kept hash
to its places in the templates (its size is the templates', a parameter). All
runs of a text are looked up, so a copied passage of GRAM + WINDOW - 1 template
words is always hit. Hits of a template that lie near one diagonal form a
candidate, whose words are aligned with the template's inside a band of at most
`BAND` words around that diagonal (match +1, mismatch and gap -1, best local path).
A match is reported with its coverage and character span if it covers `COVERAGE`
of a template or, as a part of one, scores `PART` words; of a group of hits all
such matches are. Shorter runs that legal and everyday prose share with long
templates ("to the extent permitted by applicable law") are no licences. A match that is not an exact whole copy gives way to
one of another template that explains its span better.

Templates are the usual notices of public licenses and the full texts in
`license_texts/`. Copies of long templates that leave out or change more than
`GAP` words in a row are matched piece by piece.
"""

from __future__ import annotations

import heapq
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from teampulse.llm import vec

GRAM = 3
WINDOW = 3
BAND = 8
COVERAGE = 0.7
#: Aligned words, less mismatches and gaps, from which on a part of a template is reported. Prose shares up to twelve
#: ("is provided as is, without warranty of any kind, express or implied").
PART = 14
GAP = 256
REACH = 16

# Public license notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."),
    "mit-notice": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "bsd-3-clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

for _code, _name in {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial",
                     "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
                     "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}.items():
    for _version, _port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        TEMPLATES[f"cc-{_code}-{_version}-notice"] = f"This work is licensed under a Creative Commons {_name} {_version} {_port} License."
        TEMPLATES[f"cc-{_code}-{_version}-short-notice"] = f"Licensed under CC {_code.upper()} {_version}."
        TEMPLATES[f"cc-{_code}-{_version}-link"] = f"creativecommons.org/licenses/{_code}/{_version}"
TEMPLATES |= {
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc0-1.0-link": "creativecommons.org/publicdomain/zero/1.0",
    "mit-short-notice": "Licensed under the MIT License.",
    "apache-2.0-short-notice": "Released under the Apache License, Version 2.0.",
    "bsd-3-clause-notice": "Released under the 3-Clause BSD License.",
    "bsd-2-clause-notice": "Released under the 2-Clause BSD License.",
    "bsd-style-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "isc-notice": "Released under the ISC License.",
    "mpl-2.0-short-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
}
for _code, _name in (("gpl", "GNU General Public License"), ("lgpl", "GNU Lesser General Public License"),
                     ("agpl", "GNU Affero General Public License")):
    for _version in {"gpl": ("2", "3"), "lgpl": ("2.1", "3"), "agpl": ("3",)}[_code]:
        _key = f"{_code}-{_version if '.' in _version else _version + '.0'}"
        TEMPLATES.setdefault(f"{_key}-notice", f"This work is licensed under the {_name}, version {_version}.")
        TEMPLATES.setdefault(f"{_key}-header", (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {_name} as published "
            f"by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version."))
# Full texts; read here once, they travel to the workers by value.
TEMPLATES |= {f"{_file.stem}-text": _file.read_text("utf-8") for _file in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

_BETWEEN = np.ones(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _BETWEEN[_low:_high] = False


def word_hashes(data, offsets):
    """(hash, start, end) of the words, and the number of the first word of each row."""
    data = vec.LOWER[data]
    starts, ends, first = vec.words(data, offsets, _BETWEEN)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    return vec.span_hash(vec.prefix_hash(data), starts, ends), starts, ends, first


def grams(h, k: int = GRAM):
    """Hash of the run of k words from each word on (none for the last k - 1)."""
    out = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    code = vec.seeded(k, 17) | np.uint64(1)
    for j in range(k):
        out += vec.mix(h[j : j + len(out)] + code[j]) * code[j]
    return vec.mix(out)


def winnowed(g, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest (last of equals) hash of every `window` neighbours; all of them if there are fewer."""
    if len(g) <= window:
        return np.array([len(g) - 1 - int(np.argmin(g[::-1]))]) if len(g) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(g, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


class Index:
    """Inverted index of templates: sorted hashes with (template, place)."""

    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.names = list(templates)
        self.words, keys, places = [], [], []
        for t, text in enumerate(templates.values()):
            raw = np.frombuffer(text.encode(), np.uint8)
            h = word_hashes(raw, np.array([0, len(raw)]))[0]
            self.words.append(h)
            g = grams(h)
            at = winnowed(g)
            keys += g[at].tolist()
            places += [(t, int(p)) for p in at]
        order = sorted(range(len(keys)), key=lambda i: (keys[i], places[i]))
        self.keys = np.array([keys[i] for i in order], np.uint64)
        self.places = np.array([places[i] for i in order], np.int64).reshape(-1, 2)

    def hits(self, g):
        """(place in g, template, place in the template) of every look-up that succeeds."""
        low, high = np.searchsorted(self.keys, g, "left"), np.searchsorted(self.keys, g, "right")
        count = high - low
        at = np.repeat(np.arange(len(g)), count)
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return at, self.places[entry, 0], self.places[entry, 1]


def align(text, template, shift: int, band: int = BAND):
    """Best local alignment of word hashes inside |j - i - shift| <= band, where i is a template place, j a text place.

    Returns (matched words, first text word, one past the last).
    """
    return scored(text, template, shift, band)[1:]


def scored(text, template, shift: int, band: int):
    """align() with the score before it."""
    width = 2 * band + 1
    best = (0, 0, 0, 0)  # score, matches, begin, end
    prev = [(0, 0, -1)] * width  # score, matches, begin, for j = i - 1 + shift - band + c
    for i, word in enumerate(template.tolist()):
        row = []
        for c in range(width):
            j = i + shift - band + c
            cell = (0, 0, -1)
            if 0 <= j < len(text):
                score, matches, begin = prev[c]
                if text[j] == word:
                    cell = (score + 1, matches + 1, j if begin < 0 else begin)
                elif score > 1:
                    cell = (score - 1, matches, begin)
                up = prev[c + 1] if c + 1 < width else (0, 0, -1)
                left = row[c - 1] if c else (0, 0, -1)
                for score, matches, begin in (up, left):
                    if score - 1 > cell[0]:
                        cell = (score - 1, matches, begin)
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
            row.append(cell)
        prev = row
    return best


def scan(index: Index, h) -> list[tuple]:
    """(template, matched words, first word, one past the last) of the matches in a text of word hashes.

    Per template hits form groups along a diagonal: neighbours lie at most the band's diagonals, and a template's length
    (`GAP` for long ones), apart. Large groups come first; a group inside a match that is found is passed over. Hits of a
    group before and after its best match are groups again. Of overlapping matches of one template the one with more words stays.
    """
    at, template, place = index.hits(grams(h))
    out = []
    for t in np.unique(template).tolist():
        own = np.flatnonzero(template == t)
        order = own[np.lexsort((place[own], at[own]))]
        words = index.words[t]
        band = min(BAND, max(1, len(words) // 4))  # narrower than the words between two copies of a short template
        gap, reach = min(len(words), GAP), len(words) if len(words) <= GAP else REACH
        todo, found = [], []

        def add(hits, low, high):
            for group in _groups(hits, band, gap):
                heapq.heappush(todo, (-len(group), group, low, high))

        add([(int(at[i] - place[i]), int(at[i])) for i in order], 0, len(h))
        while todo:
            _, group, low, high = heapq.heappop(todo)
            if any(m[2] <= group[0][1] and group[-1][1] + GRAM <= m[3] for m in found):
                continue
            shift = sorted(d for d, _ in group)[len(group) // 2]
            first = max(0, group[0][1] - shift - reach)
            last = min(len(words), group[-1][1] - shift + GRAM + reach)
            start = max(low, shift + first - 2 * band)
            part = h[start : max(start, min(high, shift + last + 2 * band))]
            score, matched, begin, end = scored(part.tolist(), words[first:last], shift + first - start, band)
            begin, end = begin + start, end + start
            if matched >= COVERAGE * len(words) or score >= PART:
                found.append((t, matched, begin, end, score))
            before, after = [x for x in group if x[1] + GRAM <= begin], [x for x in group if x[1] >= end]
            if score and begin > low:
                add(before, low, begin)
            if score and end < high:
                add(after, end, high)
        for m in sorted(found, key=lambda m: (-m[1], m[2])):
            if all(m[3] <= o[2] or o[3] <= m[2] for o in out if o[0] == t):
                out.append(m)
    size = [len(w) for w in index.words]
    best = [m for m in out if m[4] == size[m[0]] or not any(
        o[0] != m[0] and o[2] <= m[2] and m[3] <= o[3] and (o[4], o[1] / size[o[0]]) > (m[4], m[1] / size[m[0]]) for o in out)]
    return sorted((m[:4] for m in best), key=lambda m: (m[2], m[3], m[0]))


def _groups(hits, band: int, gap: int) -> list[list[tuple]]:
    """(diagonal, place) hits in order of place, each put to the group whose last hit is near in both, of these the nearest."""
    groups, live = [], []
    for d, place in hits:
        live = [g for g in live if place - g[-1][1] <= gap]
        near = min(live, key=lambda g: abs(d - g[-1][0]), default=None)
        if near is None or abs(d - near[-1][0]) > band:
            near = []
            groups.append(near)
            live.append(near)
        near.append((d, place))
    return groups


def license_spans(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, coverage, char_start, char_end) of each match in docs; characters are code points.

    Null and empty texts have no match. Repeated rows report their matches each; an empty table gives none.
    """

    def run(batches):
        index = Index(templates)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            data, offsets = vec.buffers(batch.column(1))
            for i, j in vec.slices(offsets):
                piece, offs = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                h, starts, ends, first = word_hashes(piece, offs)
                g = grams(h)
                hit = np.flatnonzero(np.isin(g, index.keys))
                chars = None
                for r in np.unique(np.searchsorted(first, hit, "right") - 1).tolist():
                    for t, matched, begin, end in scan(index, h[first[r] : first[r + 1]]):
                        if chars is None:
                            chars = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
                        a, b = starts[first[r] + begin], ends[first[r] + end - 1]
                        rows.append((ids[i + r], index.names[t], matched / len(index.words[t]),
                                     int(chars[a] - chars[offs[r]]), int(chars[b] - chars[offs[r]])))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                ["doc_id", "license", "coverage", "char_start", "char_end"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, license string, coverage double, char_start long, char_end long")
