"""License scans by patience alignment.

A text is aligned with a license template word by word. Words that are unique in both
are anchors; the longest increasing run of anchors is kept, and the gaps between them
are aligned in the same way. Coverage is the share of the template's words that found
a partner. Alignment is done in windows that the template's rare words vote for, so a
license that occurs several times in a text is found each time.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")
#: Words too common to point to a license.
COMMON = frozenset(
    "a all and any are as at be but by can do for from get if in is it its may must no not of on or shall such "
    "that the them these they this to under use used was were which who will with without you your".split()
)
# Wordings of the licenses themselves.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ],
}
for _id, _kind, _version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")):
    TEMPLATES[_id].append(
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {_kind}General Public "
        f"License as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later "
        "version."
    )
# Titles of the full texts.
for _id, _title in {
    "GPL-2.0": "GNU General Public License Version 2, June 1991",
    "GPL-3.0": "GNU General Public License Version 3, 29 June 2007",
    "LGPL-2.1": "GNU Lesser General Public License Version 2.1, February 1999",
    "LGPL-3.0": "GNU Lesser General Public License Version 3, 29 June 2007",
    "AGPL-3.0": "GNU Affero General Public License Version 3, 19 November 2007",
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "MPL-2.0": "Mozilla Public License Version 2.0",
}.items():
    TEMPLATES[_id].append(_title)
for _kind, _words in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives")):
    for _version, _where in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES[f"CC-BY{_kind}-{_version}"] = [
            f"Licensed under CC BY{_kind} {_version}.",
            f"This work is licensed under a Creative Commons Attribution{_words} {_version} {_where} License.",
        ]
#: Words that tell relatives apart: none may be missing, and in these families none may be added.
TELLING = frozenset("lesser affero nd nc sa noncommercial commercial sharealike alike noderivatives noderivs derivatives derivs".split())
NAMES = frozenset("mit bsd apache mozilla gnu cc creative".split())
FAMILIES = frozenset("gnu cc creative".split())
#: A word close behind a find that makes it a part of a longer license.
UNLESS = {"BSD-2-Clause": "endorse"}


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.words = [w.lower() for w in WORD.findall(text)]
        count = Counter(self.words)
        #: Rare words and their places; enough of them that a match cannot do without.
        self.keys = {w: i for i, w in enumerate(self.words) if count[w] == 1 and w not in COMMON and not w.isdigit()}
        # a version counts where it is first said; numbers of a list do not count
        listed = " 1. " in text
        self.must = {self.words.index(w) for w in count if w in NAMES or w in TELLING or (w.isdigit() and not listed)}
        self.must_words = {self.words[i] for i in self.must}
        self.family = not FAMILIES.isdisjoint(self.words)
        self.slack = max(3, len(self.words) // 3)
        if len(self.keys) <= (1 - COVERAGE) * len(self.words):
            raise ValueError(f"too few rare words in a template of {name}")


ALL = [Template(name, text) for name, texts in TEMPLATES.items() for text in texts]
KEYS: dict[str, list[tuple[int, int]]] = {}
for _t, _template in enumerate(ALL):
    for _w, _i in _template.keys.items():
        KEYS.setdefault(_w, []).append((_t, _i))


def increasing(values: list[int]) -> list[int]:
    """Places of the longest increasing run (patience sorting)."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = ends[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[pile], ends[pile] = v, i
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, increasing in both lists."""
    pairs, open_ = [], [(0, len(a), 0, len(b))]
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            pairs.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            pairs.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        in_a, in_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        place = {w: i for i, w in enumerate(b[blo:bhi], blo) if in_b[w] == 1}
        unique = [(i, place[w]) for i, w in enumerate(a[alo:ahi], alo) if in_a[w] == 1 and w in place]
        anchors = [unique[k] for k in increasing([j for _, j in unique])]
        if not anchors:
            continue
        pairs += anchors
        for (i, j), (k, m) in zip([(alo - 1, blo - 1), *anchors], [*anchors, (ahi, bhi)], strict=True):
            open_.append((i + 1, k, j + 1, m))
    return sorted(pairs)


def found(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, license, coverage) in code points; of overlapping finds the best one."""
    words, spans = [], []
    for m in WORD.finditer(text):
        words.append(m[0].lower())
        spans.append(m.span())
    votes: dict[int, list[tuple[int, str]]] = {}
    for p, w in enumerate(words):
        for t, i in KEYS.get(w, ()):
            votes.setdefault(t, []).append((p - i, w))
    hits = []
    have = set(words)
    for t, starts in votes.items():
        template = ALL[t]
        if not template.must_words <= have:
            continue
        n, starts = len(template.words), sorted(starts)
        need = max(1, len(template.keys) - int((1 - COVERAGE) * n + 1e-9))
        group: list[tuple[int, str]] = []
        for start, w in [*starts, (len(words) + 10 * n + 99, "")]:
            if group and start - group[-1][0] > template.slack:
                if len({x for _, x in group}) >= need:
                    hits += _windows(words, template, group)
                group = []
            group.append((start, w))
    best: list[tuple[float, int, int, int, str]] = sorted(((-c, -k, a, b, name) for a, b, name, c, k in hits))
    out: list[tuple[int, int, str, float]] = []
    taken: list[tuple[int, int]] = []
    for c, _, a, b, name in best:
        if all(b < x or y < a for x, y in taken):
            taken.append((a, b))
            out.append((spans[a][0], spans[b][1], name, round(-c, 4)))
    return sorted(out)


def _told_apart(words: list[str], template: Template, pairs: list[tuple[int, int]]) -> bool:
    """Whether the telling words of the template found partners and the text adds none of another license."""
    first, last = pairs[0][0], pairs[-1][0]
    if not template.must <= {j for _, j in pairs}:
        return False
    if (word := UNLESS.get(template.name)) and word in words[first : last + 40]:
        return False
    own = {i for i, _ in pairs}
    return not template.family or not any(
        i not in own and (words[i] in TELLING or words[i : i + 2] == ["library", "general"]) for i in range(first, last + 1)
    )


def _windows(words: list[str], template: Template, group: list[tuple[int, str]]) -> Iterator[tuple[int, int, str, float, int]]:
    """Alignments around each likely start of a group, one per copy of the license."""
    n = len(template.words)
    tried, last = Counter(s for s, _ in group), None
    starts, reach = sorted(tried), template.slack // 2
    for start in starts:
        # of starts close to each other, the one with the most votes stands for all
        near = starts[bisect_left(starts, start - reach) : bisect_right(starts, start + reach)]
        if start != max(near, key=lambda s: (tried[s], -s)) or last is not None and start - last < 2:
            continue
        last = start
        low, high = max(0, start - template.slack), min(len(words), start + n + template.slack)
        for a, b in ((low, high), (max(0, start), min(len(words), start + n))):
            pairs = align(words[a:b], template.words)
            if pairs and len(pairs) >= COVERAGE * n and _told_apart(words, template, [(a + i, j) for i, j in pairs]):
                yield a + pairs[0][0], a + pairs[-1][0], template.name, len(pairs) / n, len(pairs)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licenses (array of start, end, license, coverage): one row per row of ``docs``.

    Null text counts as empty; a text without a license has an empty array. Repeated rows
    stay repeated; other columns are not looked at.
    """
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                some = found(t) if not KEYS.keys().isdisjoint(WORD.findall(t.lower())) else []
                out.append([dict(zip(("start", "end", "license", "coverage"), x, strict=True)) for x in some])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(item))], ["doc_id", "licenses"])

    common.small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, f"doc_id {kind}, licenses array<struct<start:bigint,end:bigint,license:string,coverage:double>>")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found_rows = scan(common.table(spark, sf_dir, "documents"))
    said = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"), F.format_number(x["coverage"], 4)))
    return found_rows.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(said, ",").alias("licenses"))
