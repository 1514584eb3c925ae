"""License scans with a generalised suffix automaton of license words.

The automaton holds the words of all templates and all base phrases. A text is streamed through it: after each word the
automaton knows, for each template, the longest run of words that ends there and occurs in the template (the matching
statistics). Matches of MIN_MATCH words and more that can't be continued are chained, template by template, at each of their
places in it, where they follow each other closely and in the template's order. The best chains are found by dynamic
programming. One gives a label and a span if it covers COVERAGE of its template, LEAST words of it (all, if it has fewer), and
in one match the template's own phrase, which tells it from its relatives. Base phrases are ends of matches, read off the
automaton's suffix links, so they are found in the same pass.

The automaton is fixed and small, and goes to the workers as a whole; nothing is shuffled. Words outside its vocabulary
reset it, so only runs of known words are stepped through.

Null and empty texts have no words, no labels and score 0. Repeated rows get equal results; long texts are read whole.
Other columns of the input are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import map_batches, table
from linkmill.llm._words import split_words

#: The base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Templates: label, passage of a public license text or notice, and the phrase without which it is another license's.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache license version 2 0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ""),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions", "permission is hereby granted free of charge"),
    ("mit", "Released under the MIT License.", ""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ""),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "the gnu general public license"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "redistributions of source code must retain"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "permission to use copy modify"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mozilla public license v 2 0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ""),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ""),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ""),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ""),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "waived all copyright"),
    ("unlicense", "This is free and unencumbered software released into the public domain.", ""),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means", "no part of this publication"),
)

MIN_MATCH = 3
#: Words that may lie between two matches of a chain, in the text and in the template.
MAX_GAP = 8
#: Part of a template, and words of it (or all, if it has fewer), that a chain must cover for its label.
COVERAGE, LEAST = 0.6, 12


class Automaton:
    """Generalised suffix automaton over word numbers; state 0 is the start."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.number: dict[bytes, int] = {}
        number = lambda t: [self.number.setdefault(w, len(self.number) + 1) for w in split_words(t)]
        self.base = [(number(p), label) for p, label in base]
        self.templates = [(label, number(t)) for label, t, _ in templates]
        self.key = [self._place(number(t), number(k)) for _, t, k in templates]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[dict[int, list]] = [{}]  # template: ends of the state's words in it
        for t, (_, words) in enumerate(self.templates):
            self._add(words, t)
        for words, _ in self.base:
            self._add(words, None)
        by_length = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for s in reversed(by_length):
            for t, ends in self.places[s].items():
                self.places[self.link[s]].setdefault(t, []).extend(ends)
        #: For each state, (template, state, length) of the longest end of its words that occurs in each template.
        self.within: list[dict[int, tuple[int, int]]] = [{}] * len(self.next)
        for s in by_length:
            up = {t: x for t, x in self.within[self.link[s]].items()}
            if self.length[s] >= MIN_MATCH:
                up.update({t: (s, self.length[s]) for t in self.places[s]})
            self.within[s] = up
        self.phrases: list[tuple] = [()] * len(self.next)  # (base phrase, least length of the match) at each state
        own: dict[int, list] = {}
        for k, (words, _) in enumerate(self.base):
            s = 0
            for w in words:
                s = self.next[s][w]
            own.setdefault(s, []).append((k, len(words)))
        for s in by_length:
            self.phrases[s] = (*own.get(s, ()), *self.phrases[self.link[s]])

    def _add(self, words: list[int], template: int | None) -> None:
        last = 0
        for i, w in enumerate(words):
            last = self._extend(last, w)
            if template is not None:
                self.places[last].setdefault(template, []).append(i + 1)

    @staticmethod
    def _place(words: list[int], phrase: list[int]) -> tuple[int, int]:
        """Where the phrase stands first."""
        n = len(phrase)
        return next(((i, i + n) for i in range(len(words) - n + 1) if n and words[i : i + n] == phrase), (0, 0))

    def _new(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt), self.length.append(length), self.link.append(link), self.places.append({})  # noqa: B018
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state for the string of p followed by w, made on its own if its state also holds longer ones."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        state, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, w)
        return state

    def scan(self, text: str | None) -> dict:
        """n_words, base: (phrase, start) in order, labels, spans: (label, first word, end, coverage), score."""
        words = split_words(text)
        get = self.number.get
        ids = np.array([get(w, 0) for w in words], np.int32)
        known = ids > 0
        base: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int, int]] = []  # template, first word, end, state
        starts = np.flatnonzero(known & ~np.concatenate(([False], known[:-1]))) if len(ids) else ids
        ends = np.flatnonzero(known & ~np.concatenate((known[1:], [False]))) + 1 if len(ids) else ids
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a < 2:
                continue
            state, size, now = 0, 0, {}
            for i, w in enumerate(ids[a:b].tolist(), a):
                before = now
                while state and w not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                if w in self.next[state]:
                    state = self.next[state][w]
                    size += 1
                now = {t: (own, min(size, n)) for t, (own, n) in self.within[state].items()} if size >= MIN_MATCH else {}
                for t, (own, n) in before.items():
                    if t not in now or now[t][1] <= n:
                        matches.append((t, i - n, i, own))
                for k, least in self.phrases[state]:
                    if size >= least:
                        base.append((i + 1 - least, k))
            matches += [(t, b - n, b, own) for t, (own, n) in now.items()]
        spans = self._chains(matches)
        labels = sorted({self.base[k][1] for _, k in base} | {s[0] for s in spans})
        return {"n_words": len(words), "base": sorted(base), "labels": labels, "spans": spans, "score": max((s[3] for s in spans), default=0.0)}

    def _chains(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Spans of templates that chains of matches cover, by first word."""
        by_template: dict[int, list] = {}
        for t, a, b, state in matches:
            by_template.setdefault(t, []).extend((a, b, end - (b - a), end) for end in self.places[state][t])
        found = []
        for t, pieces in by_template.items():
            label, words = self.templates[t]
            first, end = self.key[t]
            least = max(COVERAGE * len(words), min(LEAST, len(words)))
            if sum(p[1] - p[0] for p in pieces) < least:
                continue
            for a, b, covered in best_chains(pieces, lambda p, first=first, end=end: p[2] <= first and end <= p[3]):
                if covered >= least:
                    found.append((label, a, b, min(1.0, covered / len(words))))
        return sorted(set(found), key=lambda s: (s[1], s[2], s[0]))


def gain(p: tuple, q: tuple) -> int:
    """Words that piece q (first word and end in the text, first word and end in the template) adds to a chain that ends with
    p; 0 if it can't follow."""
    if q[0] - p[1] > MAX_GAP or q[2] - p[3] > MAX_GAP or q[0] < p[0] or q[2] < p[2]:
        return 0
    return max(0, min(q[1] - max(q[0], p[1]), q[3] - max(q[2], p[3])))


def best_chains(pieces: list[tuple], holds) -> list[tuple[int, int, int]]:
    """(first word, end, words covered) of chains through a piece that `holds`: the best ones, no two over the same words.

    The best chain that ends with each piece, and the best that goes on from it, by dynamic programming in order of ends;
    pieces further back than MAX_GAP words can't be the one before."""
    pieces = sorted(set(pieces), key=lambda p: (p[1], p[0], p[2]))
    n = len(pieces)
    before, back, low = [p[1] - p[0] for p in pieces], [-1] * n, 0
    after, on = [0] * n, [-1] * n
    near: list[range] = []
    longest = max((p[1] - p[0] for p in pieces), default=0)
    for j, q in enumerate(pieces):
        while pieces[low][1] < q[1] - longest - MAX_GAP:
            low += 1
        near.append(range(low, j))
        for i in near[j]:
            if (g := gain(pieces[i], q)) and before[i] + g > before[j]:
                before[j], back[j] = before[i] + g, i
    for j in range(n - 1, -1, -1):
        for i in near[j]:
            if (g := gain(pieces[i], pieces[j])) and after[j] + g > after[i]:
                after[i], on[i] = after[j] + g, j
    taken: list[tuple[int, int, int]] = []  # in order of the text, no two overlap
    for k in sorted((k for k in range(n) if holds(pieces[k])), key=lambda k: (-before[k] - after[k], k)):
        first, last = k, k
        while back[first] >= 0:
            first = back[first]
        while on[last] >= 0:
            last = on[last]
        a, b = pieces[first][0], pieces[last][1]
        at = bisect_left(taken, (a, b))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b, before[k] + after[k]))
    return taken


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (start and label of each base phrase), labels, spans and score of every row."""

    def make():
        automaton = Automaton()

        def work(batch):
            found = [automaton.scan(t) for t in batch.column(1).to_pylist()]
            yield [
                batch.column(0), [f["n_words"] for f in found],
                [[{"start": a, "label": automaton.base[k][1]} for a, k in f["base"]] for f in found], [f["labels"] for f in found],
                [[{"label": s[0], "first": s[1], "end": s[2], "coverage": s[3]} for s in f["spans"]] for f in found], [f["score"] for f in found],
            ]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_words long, base array<struct<start: long, label: string>>, labels array<string>, spans array<struct<label: string, first: long, end: long, coverage: double>>, score double"
    return map_batches(docs, ["doc_id", "text"], ddl, make)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.col("base.start")
    return license_scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
