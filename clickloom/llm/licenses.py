"""License scans with a generalised suffix automaton over the words of license templates.

The templates are the four base phrases and a few public license notices. Their words are numbered, and one
automaton is built that accepts every run of words of any template. A text is streamed through it: after each word
the automaton knows the longest run ending there that some template contains (the matching statistics). A base
phrase stands wherever its state lies on the suffix links of the current one. Runs of at least ``MIN_WORDS`` words
that cannot be extended are anchors; anchors that follow each other in a template and lie near each other in the text
are chained into spans, and a span that covers at least ``MIN_COVERAGE`` of a notice adds the notice's label.

The score is the largest share of a template that a span covers; a base phrase is a template and counts as 1.

Edge cases: null counts as empty; texts without words give zeros, nulls and empty labels; texts of any length are
streamed with the words of the text in memory and, per template, only chains that can still grow; repeated rows
get equal answers; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, register

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licenses and their labels.
NOTICES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of
    the Software."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
    Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
    on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
    the specific language governing permissions and limitations under the License."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
    General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
    option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
    General Public License for more details."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
    list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
    MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("cc-by", """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy
    of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box
    1866, Mountain View, CA 94042, USA."""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
    modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
    binary, for any purpose, commercial or non-commercial, and by any means."""),
]

MIN_WORDS = 4
MAX_GAP = 12  # words of the text between two anchors of one span
MIN_COVERAGE = 0.6

_GAPS = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased: runs of digits, a-z and characters beyond ASCII."""
    return text.encode().lower().translate(_GAPS).split() if text else []


class Automaton:
    """Suffix automaton of several word lists."""

    def __init__(self, templates: list[tuple[str, str, bool]]):
        """``templates``: label, text, and whether it is a base phrase."""
        self.labels = [label for label, _, _ in templates]
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        lists = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(t)] for _, t, _ in templates]
        self.sizes = [len(x) for x in lists]
        for ids in lists:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        own: list[list[tuple[int, int]]] = [[] for _ in self.next]  # (template, end) of the runs of a state
        for template, ids in enumerate(lists):
            state = 0
            for end, word in enumerate(ids, 1):
                state = self.next[state][word]
                own[state].append((template, end))
        self.ends = own
        self.phrases: list[list[int]] = [[] for _ in self.next]
        by_length = sorted(range(1, len(self.next)), key=lambda s: self.length[s])
        for state in reversed(by_length):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        at: dict[int, list[int]] = {}
        for template, (ids, (_, _, base)) in enumerate(zip(lists, templates, strict=True)):
            if base:
                state = 0
                for word in ids:
                    state = self.next[state][word]
                at.setdefault(state, []).append(template)
        for state in by_length:
            self.phrases[state] = at.get(state, []) + (self.phrases[self.link[state]] if self.link[state] > 0 else [])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: int) -> int:
        """The state for ``at`` plus ``word`` with exactly one word more, parted from longer runs if need be."""
        there = self.next[at][word]
        if self.length[there] == self.length[at] + 1:
            return there
        copy = self._state(self.length[at] + 1, self.link[there], dict(self.next[there]))
        self.link[there] = copy
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        made = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self._split(at, word)
        return made


@lru_cache(maxsize=1)
def _automaton() -> Automaton:
    base = [(label, phrase, True) for phrase, label in PHRASES.items()]
    return Automaton(base + [(label, notice, False) for label, notice in NOTICES])


def statistics(ids: list[int], automaton: Automaton):
    """Yield (index, state, length) of the longest match that ends at each word of ``ids``."""
    state, length = 0, 0
    edges, link, longest = automaton.next, automaton.link, automaton.length
    for i, word in enumerate(ids):
        while state and word not in edges[state]:
            state = link[state]
            length = longest[state]
        if word in edges[state]:
            state = edges[state][word]
            length += 1
        yield i, state, length


def _known_runs(ids: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the runs of at least two words that some template has."""
    known = np.concatenate([[0], (ids > 0).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    keep = ends - starts >= 2
    return list(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True))


def _chain(anchors, sizes: list[int]) -> list[tuple[int, int, int, float]]:
    """Chain anchors (template, start in text, start in template, words) into spans (template, start, end, coverage)."""
    spans, growing = [], {}
    for template, at, place, n in anchors:
        chains = growing.setdefault(template, [])
        live = [c for c in chains if at - c[1] <= MAX_GAP]
        spans += [(template, c[0], c[1], c[3] / sizes[template]) for c in chains if at - c[1] > MAX_GAP]
        best = None
        for c in live:
            overlap = max(0, c[1] - at, c[2] - place)
            if place + n > c[2] and at + n > c[1] and n > overlap and (best is None or c[3] - overlap > best[0][3] - best[1]):
                best = (c, overlap)
        # The chain that is extended stays as it was, too: a better continuation may follow.
        live.append([best[0][0], at + n, place + n, best[0][3] + n - best[1]] if best else [at, at + n, place + n, n])
        latest: dict[int, list] = {}
        for c in live:
            if c[2] not in latest or c[3] > latest[c[2]][3]:
                latest[c[2]] = c
        growing[template] = list(latest.values())
    for template, chains in growing.items():
        spans += [(template, c[0], c[1], c[3] / sizes[template]) for c in chains]
    return spans


def scan_text(text: str | None, automaton: Automaton | None = None) -> dict:
    automaton = automaton or _automaton()
    found = words(text)
    ids = np.fromiter(map(automaton.vocabulary.get, found, repeat(0)), np.int32, len(found))
    hits: list[tuple[int, int]] = []  # (start, template) of base phrases
    anchors: list[tuple[int, int, int, int]] = []
    for start, end in _known_runs(ids):
        before = None
        for i, state, length in statistics(ids[start:end].tolist(), automaton):
            if automaton.phrases[state]:
                for p in automaton.phrases[state]:
                    if length >= automaton.sizes[p]:
                        hits.append((start + i + 1 - automaton.sizes[p], p))
            if before and length <= before[2] and before[2] >= MIN_WORDS:
                anchors += _anchors(automaton, start, before)
            before = (i, state, length)
        if before and before[2] >= MIN_WORDS:
            anchors += _anchors(automaton, start, before)
    spans = [
        {"label": automaton.labels[t], "start": a, "end": b, "coverage": min(1.0, c)}
        for t, a, b, c in _chain(anchors, automaton.sizes)
        if c >= MIN_COVERAGE
    ]
    base = {automaton.labels[p] for _, p in hits}
    starts = [s for s, _ in hits]
    return {
        "n_words": len(found),
        "n_base": len(hits),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s["label"] for s in spans})),
        "score": 1.0 if hits else max((s["coverage"] for s in spans), default=0.0),
        "spans": spans,
    }


def _anchors(automaton: Automaton, start: int, match: tuple[int, int, int]) -> list[tuple[int, int, int, int]]:
    i, state, length = match
    at = start + i + 1 - length
    return [(t, at, end - length, length) for t, end in automaton.ends[state] if automaton.sizes[t] >= MIN_WORDS]


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
_SCAN = pa.struct(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))]
)


def scanned(text: Column) -> Column:
    """Struct of counts, labels, score and spans of a text."""

    @F.arrow_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, start: long, end: long, coverage: double>>"
    )
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([scan_text(t.as_py()) for t in texts], _SCAN)

    return scan(text)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts, labels, score and the spans themselves."""
    return docs.select("doc_id", scanned(F.col("text")).alias("found")).select("doc_id", "found.*")


@register("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).drop("spans")
