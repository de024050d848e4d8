"""License scans (operator 7): winnowed fingerprints of templates pick candidates, banded alignment reports coverage and spans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import between, lowered, mix, slices, span_hashes, text_buffer, text_column, words

_U = np.uint64
#: Everything but letters, digits and bytes of other scripts parts words, so punctuation and line breaks don't matter.
_SPACE = between(*(b for b in range(128) if not chr(b).isalnum()))

#: Public license notices (fixed values).
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
}


def winnow(hashes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the fingerprints of one sequence of word hashes: the smallest (of equal ones the last) hash of `gram` words in each run of `window` such hashes. Any `gram` + `window` - 1 words in a row have one."""
    n = len(hashes) - gram + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(gram):
        h = mix(h * _U(0x9FB21C651E98DF25) + hashes[i : i + n])
    best = np.arange(max(1, n - window + 1))
    for i in range(1, min(window, n)):
        other = np.arange(len(best)) + i
        best = np.where(h[other] <= h[best], other, best)
    place = np.unique(best)
    return h[place], place


@dataclass
class Index:
    """The templates' words, and inverted indexes from fingerprint and from anchor word to (template, place)."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray
    anchors: np.ndarray
    anchor_template: np.ndarray
    anchor_place: np.ndarray


#: Below so many words a match may share no fingerprint with its template, so some of the template's words are looked for by themselves.
SHORT = 16


def anchored(words: list[np.ndarray], coverage: float) -> list[tuple[int, int]]:
    """(template, place) of one word more than a match of `coverage` may miss, for each short template: every match has one of them. Words of the fewest templates come first."""
    often = Counter(x for w in words for x in set(w.tolist()))
    out = []
    for t, w in enumerate(words):
        if 0 < len(w) < SHORT:
            missed = len(w) - next(m for m in range(len(w) + 1) if m >= coverage * len(w))
            out += [(t, i) for i in sorted(range(len(w)), key=lambda i: (often[int(w[i])], i))[: missed + 1]]
    return out


def build_index(templates: dict[str, str], gram: int, window: int, coverage: float) -> Index:
    names, all_words, prints, owner, places = sorted(templates), [], [], [], []
    for t, name in enumerate(names):
        data = np.frombuffer(templates[name].encode(), np.uint8)
        start, end, _ = words(data, np.array([0, len(data)]), _SPACE)
        w = span_hashes(lowered(data), start, end)
        h, place = winnow(w, gram, window)
        all_words.append(w)
        prints.append(h)
        owner.append(np.full(len(h), t))
        places.append(place)
    prints, owner, places = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (prints, owner, places))
    order = np.argsort(prints, kind="stable")
    anchors = sorted((int(all_words[t][i]), t, i) for t, i in anchored(all_words, coverage))
    own = np.array([a for a, _, _ in anchors], np.uint64), np.array([t for _, t, _ in anchors], np.int64), np.array([i for _, _, i in anchors], np.int64)
    return Index(names, all_words, prints[order], owner[order], places[order], *own)


def banded(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """(matched words, from, to) of the best alignment of the template with a stretch of `text`, cells within `band` of the diagonal text = template + shift. An unequal word or a gap costs 1, a match gives 2; the template's ends may stay out."""
    wide = 2 * band + 1
    score, match, origin = [0] * wide, [0] * wide, [0] * wide
    for c in range(wide):
        origin[c] = max(0, shift - band + c)
    best = (0, 0, 0, 0)
    for i, word in enumerate(template.tolist()):
        now, nmatch, norigin = [0] * wide, [0] * wide, [0] * wide
        for c in range(wide):
            j = i + shift - band + c  # the text's word that meets the template's word i
            norigin[c] = max(0, j + 1)
            if 0 <= j < len(text):
                hit = text[j] == word
                s, m, o = score[c] + (2 if hit else -1), match[c] + hit, origin[c] if score[c] > 0 else j
                if c + 1 < wide and score[c + 1] - 1 > s:
                    s, m, o = score[c + 1] - 1, match[c + 1], origin[c + 1]
                if c and now[c - 1] - 1 > s:
                    s, m, o = now[c - 1] - 1, nmatch[c - 1], norigin[c - 1]
                if s > 0:
                    now[c], nmatch[c], norigin[c] = s, m, o
                    if s > best[0]:
                        best = (s, int(m), o, j + 1)
        score, match, origin = now, nmatch, norigin
    return best[1:]


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, gram: int = 3, window: int = 2, coverage: float = 0.8, band: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per match: key, template, n_words (of the template), matched_words, coverage (their ratio, at least `coverage`), start, end (code points in the text).

    A template is looked for wherever the text shares a fingerprint with it; hits within a band (at most a quarter of the template) of one diagonal are one candidate, aligned once. Of
    overlapping matches of one template the one with most matched words stays (then the first). Null and empty texts match nothing;
    repeated rows are each reported. Templates of fewer than SHORT words are also looked for at single words of theirs, one of which every match has;
    a longer one's match that misses words or holds others so close together that no gram + window - 1 words in a row are left may be missed. `templates` is a bounded
    parameter that goes to every task; an empty one, like an empty table, gives an empty result. Other columns are left out.
    """
    kind = docs.schema[key].dataType.simpleString()
    index = build_index(templates, gram, window, coverage)
    bands = [max(1, min(band, len(w) // 4)) for w in index.words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data, offsets = text_buffer(batch.column(1))
            start, end, before = words(data, offsets, _SPACE)
            w = span_hashes(lowered(data), start, end)
            out: list[tuple] = []
            h, place = winnow(w, gram, window)
            candidates: set[tuple[int, int, int]] = set()
            for known, template_of, place_of, hashes, places in ((index.prints, index.template, index.place, h, place), (index.anchors, index.anchor_template, index.anchor_place, w, np.arange(len(w)))):
                at = np.searchsorted(known, hashes)
                hit = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == hashes) if len(known) and len(hashes) else np.zeros(0, int)
                for i in hit:
                    r = int(np.searchsorted(before, places[i], "right")) - 1
                    a = at[i]
                    while a < len(known) and known[a] == hashes[i]:
                        t = int(template_of[a])
                        candidates.add((r, t, int(places[i] - before[r] - place_of[a]) // bands[t]))
                        a += 1
            found: dict[tuple[int, int], list] = {}
            for r, t, diagonal in sorted(candidates):
                own, template = w[before[r] : before[r + 1]], index.words[t]
                wide = bands[t]
                shift = diagonal * wide + wide // 2
                low = max(0, shift - 2 * wide)
                matched, a, b = banded(template, own[low : shift + len(template) + 2 * wide].tolist(), shift - low, 2 * wide)
                if matched >= coverage * len(template):
                    found.setdefault((r, t), []).append((-matched, a + low, b + low))
            for (r, t), spans in sorted(found.items()):
                taken: list[tuple[int, int]] = []
                for minus, a, b in sorted(set(spans)):
                    if all(b <= x or a >= y for x, y in taken):
                        taken.append((a, b))
                        from_, to = (int(((data[offsets[r] : x] & 0xC0) != 0x80).sum()) for x in (start[before[r] + a], end[before[r] + b - 1]))
                        out.append((r, index.names[t], len(index.words[t]), -minus, -minus / len(index.words[t]), from_, to))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in range(7)]
            kinds = (None, pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds[1:], strict=True))],
                ["key", "template", "n_words", "matched_words", "coverage", "start", "end"],
            )

    found = docs.select(F.col(key).alias("key"), text_column(text).alias("text")).mapInArrow(run, f"key {kind}, template string, n_words int, matched_words int, coverage double, start long, end long")
    return found.withColumnRenamed("key", key)
