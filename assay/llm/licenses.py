"""Operator 2: licence scans with a generalised suffix automaton of licence tokens.

Every template (and every base phrase) is a string of words in one automaton. A text is
streamed through it word by word, which gives at each place the longest run of words that some
template contains (matching statistics). Maximal runs of enough words are chained, in the order
of the template and with small gaps in the text, into spans that cover the template; a span
that covers enough of it gives the template's label.

The automaton is as large as the templates, which are a parameter; each text is one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_texts
from assay.llm.decontaminate import words_of

# Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Paragraphs of well-known licences and of the notices that name them, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied. See the License for the specific language governing permissions and "
        "limitations under the License",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at",
    ),
    "boost": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license to use, reproduce, "
        "display, distribute, execute, and transmit the Software",
        "Distributed under the Boost Software License, Version 1.0",
    ),
    "zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
        "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
        "by any means",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License",),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
}

# Words of the shortest run that enters a chain, words of text a chain may leap over, the words of
# a template and the share of it that a chain must cover, and the words of a run in it that
# templates of no other label hold.
MIN_RUN = 3
MAX_GAP = 8
MIN_WORDS = 8
MIN_COVER = 0.5
TELLING_RUN = 4


class SuffixAutomaton:
    """All runs of words of several strings; each state knows where its runs end."""

    def __init__(self, strings: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[list[tuple[int, int]]] = [[]]
        for which, words in enumerate(strings):
            last = 0
            for at, word in enumerate(words, 1):
                last = self._extend(last, word, places)
                places[last].append((which, at))
        # A run of a state ends wherever a run of the states that link to it ends.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                places[self.link[state]] += places[state]
        self.places = [sorted(set(p)) for p in places]

    def _clone(self, state: int, word: bytes, target: int, places) -> int:
        copy = len(self.link)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        places.append([])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes, places) -> int:
        target = self.next[last].get(word)
        if target is not None:  # another string has this run
            if self.length[target] == self.length[last] + 1:
                return target
            return self._clone(last, word, target, places)
        new = len(self.link)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        places.append([])
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            if self.length[target] == self.length[state] + 1:
                self.link[new] = target
            else:
                self.link[new] = self._clone(state, word, target, places)
        return new


def chain(runs: list[tuple[int, int, int]], max_gap: int) -> tuple[int, int, int]:
    """(covered words, start, end) of the best chain of (start, end, template end) runs.

    Runs come in order of their end. One follows another if it starts at most ``max_gap`` words
    after it and goes on later in the template; overlapping words of the template count once.
    """
    best: list[tuple[int, int]] = []  # covered words and start of the best chain that ends here
    top = (0, 0, 0)
    first = 0
    for i, (start, end, at) in enumerate(runs):
        while runs[first][1] + max_gap < start:
            first += 1
        covered, begin = end - start, start
        for j in range(first, i):
            _, other_end, other_at = runs[j]
            if other_end < end and other_at < at:
                more = best[j][0] + min(end - max(start, other_end), at - other_at)
                if more > covered:
                    covered, begin = more, best[j][1]
        best.append((covered, begin))
        top = max(top, (covered, -begin, end))
    return top[0], -top[1], top[2]


class LicenceScanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, tuple[str, ...]]):
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.labels = [label for label, texts in templates.items() for _ in texts]
        strings = [words_of(t.encode()) for texts in templates.values() for t in texts]
        self.sizes = [len(words) for words in strings]
        self.automaton = SuffixAutomaton(strings + [words for words, _ in self.phrases])
        # States whose run stands in templates of one label only.
        self.telling = [
            len({self.labels[which] for which, _ in held if which < len(self.sizes)}) == 1
            for held in self.automaton.places
        ]
        # Which phrases end where a state ends.
        auto = self.automaton
        self.marks: list[tuple[tuple[int, str], ...]] = [()] * len(auto.link)
        held: dict[int, list[tuple[int, str]]] = {}
        for words, label in self.phrases:
            state = 0
            for word in words:
                state = auto.next[state][word]
            held.setdefault(state, []).append((len(words), label))
        for state in sorted(range(1, len(auto.link)), key=auto.length.__getitem__):
            self.marks[state] = self.marks[auto.link[state]] + tuple(held.get(state, ()))

    def __call__(self, words: list[bytes]):
        """(base places as (start, label), spans as (start, end, label, cover), best cover).

        A chain speaks for its template's label only with a run that no other label's templates
        have: the words that licences share with each other, and with plain prose, tell nothing.
        """
        auto, marks = self.automaton, self.marks
        nexts, link, length = auto.next, auto.link, auto.length
        root = nexts[0]
        base: list[tuple[int, str]] = []
        runs: dict[int, list[tuple[int, int, int]]] = {}
        telling: dict[int, list[int]] = {}  # by template, where telling runs start
        state = size = 0
        words = [*words, b""]  # ends the last run: no word is empty
        for i, word in enumerate(words):
            if not state:
                state = root.get(word, 0)
                size = 1 if state else 0
                continue
            follow = nexts[state].get(word)
            if follow is None:
                if size >= MIN_RUN:
                    for which, at in auto.places[state]:
                        if which < len(self.sizes):
                            runs.setdefault(which, []).append((i - size, i, at))
                            if size >= TELLING_RUN and self.telling[state]:
                                telling.setdefault(which, []).append(i - size)
                while state > 0 and word not in nexts[state]:
                    state = link[state]
                    size = length[state]
                state = nexts[state].get(word, 0)
                size = size + 1 if state else 0
            else:
                state, size = follow, size + 1
            if marks[state]:
                base += [(i - n + 1, label) for n, label in marks[state] if n <= size]
        spans, best = [], 1.0 if base else 0.0
        for which, found in runs.items():
            covered, start, end = chain(found, MAX_GAP)
            if not any(start <= place < end for place in telling.get(which, ())):
                continue
            cover = min(1.0, covered / self.sizes[which])
            best = max(best, cover)
            if cover >= MIN_COVER and covered >= MIN_WORDS:
                spans.append((start, end, self.labels[which], cover))
        return base, sorted(spans), best


def _make(phrases, templates):
    def make():
        scan = LicenceScanner(phrases, templates)

        def call(texts):
            out = {name: [] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for text in texts:
                words = words_of(text)
                base, spans, best = scan(words)
                starts = [start for start, _ in base]
                base_labels = {label for _, label in base}
                out["n_words"].append(len(words))
                out["n_base"].append(len(base))
                out["first_word"].append(min(starts, default=None))
                out["last_word"].append(max(starts, default=None))
                out["base_labels"].append(sorted(base_labels))
                out["labels"].append(sorted(base_labels | {label for _, _, label, _ in spans}))
                out["score"].append(best)
                out["spans"].append(
                    [{"start": a, "end": b, "label": c, "cover": d} for a, b, c, d in spans]
                )
            return out

        return call

    return make


def scan_licences(
    documents: DataFrame,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
) -> DataFrame:
    """The columns ``keep`` of each row and a struct column ``licence``.

    ``licence``: n_words; n_base, first_word, last_word (number, smallest and largest start of
    the places where a base phrase stands; starts are null without one); base_labels and labels
    (distinct, sorted; labels adds those of covered templates); score (1 where a base phrase
    stands, else the best share of a template that a chain covers with a telling run); spans (one for each template
    covered enough: words start to end, label, cover). A null or empty text has no words, no
    labels and score 0. Rows are independent, so repeated rows or ids and further columns
    change nothing.
    """
    names = tuple(f"c{i}" for i in range(len(keep)))
    source = documents.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("body")
    )
    fields = (
        "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, "
        "spans array<struct<start: long, end: long, label: string, cover: double>>"
    )
    scanned = map_texts(source, _make(phrases, templates), fields, text="body", keep=names)
    return scanned.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        F.struct(*[F.col(c) for c in scanned.columns if c not in names]).alias("licence"),
    )
