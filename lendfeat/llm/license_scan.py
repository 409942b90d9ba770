"""License notices found by patience alignment with templates.

A notice's words are aligned with a stretch of the text: words that occur once in both are
anchors, the longest increasing subsequence of the anchors is kept, and the gaps between
them are aligned the same way after their common beginnings and ends.  Coverage is the
share of the template's words that are aligned; a stretch is a hit from ``COVERAGE`` on, if
the phrases that tell the licence from its neighbours (its name, number and conditions) are
aligned as well, each with successive words: "version 2" is no version 3, "BY-NC-ND" no "BY-NC".

Stretches worth aligning hold enough of the template's words within one and a half times
its length; they are found for all positions at once by running sums.  A text that repeats
a notice is searched on behind each hit, so repeats neither hide each other nor are lost.

Defined results: null and empty texts have no hits, null ids and repeated rows are scanned
like any other, an empty table gives no rows.  Of overlapping hits the one with more aligned words is
kept (then higher coverage, then the template's name).  Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T

COVERAGE = 0.8
STRETCH = 1.5


class Template(NamedTuple):
    text: str
    #: Phrases that must be aligned whole.
    telling: tuple[str, ...] = ()


#: Names that a short notice gives a licence, and the phrase that tells it (fixed values).
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "apache license version 2.0"),
    "Artistic-2.0": ("Artistic License 2.0", "artistic license 2.0"),
    "BSD": ("BSD License", "bsd license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "bsd 2 clause license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "bsd 3 clause license"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "boost software license version 1.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "cc0 1.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "eclipse public license version 2.0"),
    "ISC": ("ISC License", "isc license"),
    "MIT": ("MIT License", "mit license"),
    "MPL-2.0 short": ("Mozilla Public License, version 2.0", "mozilla public license version 2.0"),
    "Unlicense": ("Unlicense", "the unlicense"),
}
#: Conditions of the Creative Commons licences (fixed values).
CONDITIONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: The GNU licences and their versions (fixed values).
GNU = {"GPL": ("GNU General Public License", ("2", "3")), "LGPL": ("GNU Lesser General Public License", ("2.1", "3")), "AGPL": ("GNU Affero General Public License", ("3",))}
#: Longer texts (fixed values).
TEXTS = {
    "Apache-2.0 header": Template('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', ("apache license version 2.0",)),
    "GPL header": Template("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("gnu general public license", "version 3")),
    "GPL-2.0 header": Template("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("gnu general public license", "version 2")),
    "MIT text": Template('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software', ("without restriction", "sublicense and or sell copies")),
    "MIT whole": Template(
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        ("without restriction", "sublicense and or sell copies"),
    ),
    "ISC text": Template("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("with or without fee",)),
    "BSD text": Template("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("source and binary forms",)),
    "BSD-3-Clause text": Template(
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        ("source and binary forms", "neither the name of"),
    ),
    "MPL-2.0": Template("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license v 2.0",)),
}


def notices() -> dict[str, Template]:
    """The templates: short notices by rule, then the longer texts.

    A short notice has one lead-in word of slack: "Released under", "Licensed under" and "This work is licensed under" all reach it."""
    out = {name: Template(f"Licensed under the {title}", (telling,)) for name, (title, telling) in NAMES.items()}
    for short, words in CONDITIONS.items():
        out[f"CC-{short}-4.0"] = Template(f"Licensed under CC {short} 4.0", (f"CC {short} 4.0",))
        out[f"CC-{short}-4.0 long"] = Template(f"This work is licensed under a Creative Commons {words} 4.0 International License", (f"Commons {words} 4.0",))
    for short, (title, versions) in GNU.items():
        for v in versions:
            out[f"{short}-{v if '.' in v else v + '.0'}"] = Template(f"This work is licensed under the {title}, version {v}", (title, f"license version {v}"))
    return out | TEXTS


TEMPLATES = notices()
_b = np.arange(256)
_LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs rising on both sides; pairs come by their first part."""
    tails, ends, back = [], [], []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tails, b)
        back.append(ends[at - 1] if at else -1)
        tails[at : at + 1], ends[at : at + 1] = [b], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(template: list, text: list) -> list[tuple[int, int]]:
    """Aligned positions (template, text), rising."""
    found, todo = [], [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        left, right = Counter(template[a:b]), Counter(text[c:d])
        at = {w: j for j, w in enumerate(text[c:d], c) if right[w] == 1}
        anchors = _increasing([(i, at[w]) for i, w in enumerate(template[a:b], a) if left[w] == 1 and w in at])
        found += anchors
        if anchors:
            stops = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(stops, stops[1:])]
    return sorted(found)


def _hashes(text: str) -> np.ndarray:
    data = _LOWER[np.frombuffer(text.encode() + b"\n", np.uint8)]
    return T.words(data, np.array([len(data)]))[0]


def _spans(template: list, telling: list[list]) -> list[list[tuple[int, int]]]:
    """Where each telling phrase stands in the template."""
    return [[(i, i + len(p)) for i in range(len(template) - len(p) + 1) if template[i : i + len(p)] == p] for p in telling]


def _tells(pairs: list[tuple[int, int]], spans: list[list[tuple[int, int]]]) -> bool:
    """Whether every telling phrase is aligned with successive words."""
    at = dict(pairs)
    return all(any(all(i in at and at[i] == at.get(a, -1) + i - a for i in range(a, b)) for a, b in places) for places in spans)


def _hits(words: np.ndarray, places: np.ndarray, template: list, spans: list, coverage: float):
    """(first word, last word, aligned words) of every hit in one text; places: where a template word is."""
    m = len(template)
    need, wide = int(np.ceil(coverage * m)), int(STRETCH * m) + 1
    inside = np.searchsorted(places, places + wide) - np.arange(len(places))
    behind = -1
    for p in places[inside >= need].tolist():
        if p <= behind:
            continue
        pairs = align(template, words[p : p + wide].tolist())
        if len(pairs) >= need and pairs[0][1] == 0 and _tells(pairs, spans):  # else a later stretch begins with it
            behind = p + pairs[-1][1]
            yield p, behind, len(pairs)


def _best(hits: list[tuple]) -> list[tuple]:
    """Of (doc, name, coverage, first, last, aligned) hits those that no better one of their text overlaps, in order."""
    kept, of = [], {}
    for h in sorted(hits, key=lambda h: (-h[5], -h[2], h[1], h[3])):
        taken = of.setdefault(h[0], [])  # (first, last) of the kept hits, rising and apart
        i = bisect_left(taken, (h[3],))
        if (i == len(taken) or taken[i][0] > h[4]) and (i == 0 or taken[i - 1][1] < h[3]):
            taken.insert(i, (h[3], h[4]))
            kept.append(h)
    return sorted(kept, key=lambda h: (h[0], h[3]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, Template] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """A row per hit: doc_id, license, coverage, start and end (code points, end exclusive)."""
    hashed = {name: h for name, t in templates.items() if len(h := _hashes(t.text))}
    spans = {name: _spans(h.tolist(), [_hashes(p).tolist() for p in templates[name].telling]) for name, h in hashed.items()}

    def run(batches):
        sorted_words = {name: np.unique(h) for name, h in hashed.items()}
        every = np.unique(np.concatenate(list(sorted_words.values()))) if hashed else np.zeros(0, np.uint64)
        for batch in batches:
            rows = []
            for at, data, ends in T.chunks(batch["text"], lower=False):
                if not len(every):
                    continue
                h, start, end, stop = T.words(_LOWER[data], ends)
                slot = np.searchsorted(every, h).clip(0, len(every) - 1)
                seen = np.flatnonzero(every[slot] == h)
                hits, points = [], None
                for name, template in hashed.items():
                    own = seen[np.isin(h[seen], sorted_words[name])]
                    wide, need = int(STRETCH * len(template)) + 1, int(np.ceil(coverage * len(template)))
                    dense = own[np.searchsorted(own, own + wide) - np.arange(len(own)) >= need]
                    for doc in np.unique(np.searchsorted(stop, dense, "right")).tolist():
                        a, b = (stop[doc - 1] if doc else 0), stop[doc]
                        places = own[np.searchsorted(own, a) : np.searchsorted(own, b)] - a
                        hits += [(doc, name, n / len(template), first, last, n) for first, last, n in _hits(h[a:b], places, template.tolist(), spans[name], coverage)]
                for doc, name, share, first, last, _ in _best(hits):
                    if points is None:
                        points = np.cumsum((data & 0xC0) != 0x80)
                    a, base = (stop[doc - 1] if doc else 0), points[ends[doc - 1] - 1] if doc else 0
                    rows.append((batch["doc_id"][at + doc].as_py(), name, share, int(points[start[a + first]] - base) - 1, int(points[end[a + last] - 1] - base)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "license", "coverage", "start", "end"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, license string, coverage double, start long, end long")
