"""Licence scans with a generalised suffix automaton of the templates' words."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.common import id_and_text, pieces, with_id

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Public licence notices and the labels they give when most of their words are found in place.
TEMPLATES = (
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-grant", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version."),
    ("apache-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-grant", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                     "compliance with the License. You may obtain a copy of the License at"),
    ("mit-notice", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                  "the Software"),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                  "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                   "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("boost-notice", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy "
                     "at https://www.boost.org/LICENSE_1_0.txt)"),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
                   "to alter it and redistribute it freely, subject to the following restrictions"),
    ("unlicense-grant", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                        "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("apache-disclaimer", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                          "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                          "implied. See the License for the specific language governing permissions and limitations under the "
                          "License."),
)

_LOWER = bytes(range(65, 91))
#: ASCII letters in lower case and digits stay, other ASCII becomes a blank; bytes of other characters stay.
_WORDS = bytes(
    b + 32 if b in _LOWER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_WORDS).split()


@dataclass(frozen=True)
class Settings:
    """``least``: words of the shortest match that counts for a template (or all of a shorter one's). ``gap``: words that may
    stand between two words of a chain, in the text and in the template. ``covered``: share of a template's words that its best
    chain must cover to give its label."""

    least: int = 3
    gap: int = 8
    covered: float = 0.7


class Automaton:
    """Suffix automaton of several word sequences; each state knows where its strings end."""

    def __init__(self, sequences: list[list[int]], least: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set] = [set()]
        for t, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].add((t, place))
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        self.ends, self.least = ends, least
        self.known: dict = {}

    def _state(self, length, link, arcs, ends) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(arcs)
        ends.append(set())
        return len(self.len) - 1

    def _split(self, p: int, word: int, q: int, ends) -> int:
        """A copy of q for its strings that are as short as those through p."""
        copy = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]), ends)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int, ends) -> int:
        q = self.next[last].get(word)
        if q is not None:  # the string is there already, from another sequence
            return q if self.len[q] == self.len[last] + 1 else self._split(last, word, q, ends)
        state, p = self._state(self.len[last] + 1, 0, {}, ends), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.len[q] == self.len[p] + 1 else self._split(p, word, q, ends)
        return state

    def matches(self, state: int, length: int) -> tuple:
        """(template, place, longest) of every template word at which the matched words end, if long enough."""
        key = (state, length)
        if key not in self.known:
            found: dict = {}
            while state > 0:
                for end in self.ends[state]:
                    found.setdefault(end, length)
                state = self.link[state]
                length = self.len[state]
            self.known[key] = tuple((t, place, n) for (t, place), n in sorted(found.items()) if n >= self.least[t])
        return self.known[key]


class Scanner:
    def __init__(self, phrases: dict[str, str], templates, settings: Settings):
        self.settings = settings
        sequences = [words_of(text.encode()) for text in [*phrases, *(text for _, text in templates)]]
        self.labels = [*phrases.values(), *(label for label, _ in templates)]
        self.phrases = len(phrases)
        self.sizes = [*map(len, sequences)]
        vocabulary = sorted({word for sequence in sequences for word in sequence})
        self.number = {word: i + 1 for i, word in enumerate(vocabulary)}  # 0: no word of a template
        numbered = [[self.number[word] for word in sequence] for sequence in sequences]
        least = [size if i < self.phrases else min(size, settings.least) for i, size in enumerate(self.sizes)]
        self.automaton = Automaton(numbered, least)
        self.single = min(least, default=2) < 2
        width = len(vocabulary) + 1
        self.pairs = np.zeros((width, width), bool)
        for sequence in numbered:
            self.pairs[sequence[:-1], sequence[1:]] = True

    def runs(self, ids: np.ndarray):
        """Stretches (start, end) outside of which no two words in a row stand so in a template."""
        if self.single:
            return [(0, len(ids))]
        if len(ids) < 2:
            return []
        pair = np.concatenate(([False], self.pairs[ids[:-1], ids[1:]], [False]))
        edges = np.flatnonzero(pair[1:] != pair[:-1])
        return list(zip(edges[0::2].tolist(), (edges[1::2] + 1).tolist()))

    def scan(self, data: bytes):
        """Number of words, places (start, phrase), and spans (template, first, last, covered words) of a text."""
        words = words_of(data)
        get = self.number.get
        ids = np.fromiter((get(word, 0) for word in words), np.int32, len(words))
        places, found = [], []
        step, link, lengths = self.automaton.next, self.automaton.link, self.automaton.len
        for start, end in self.runs(ids):
            state = length = 0
            open_runs: dict = {}
            for at, word in enumerate(ids[start:end].tolist(), start):
                while state and word not in step[state]:
                    state = link[state]
                    length = lengths[state]
                state = step[state].get(word, 0)
                length = length + 1 if state else 0
                current = {}
                for t, place, n in self.automaton.matches(state, length):
                    if t < self.phrases and place == self.sizes[t] - 1:
                        places.append((at - n + 1, t))
                    current[t, place - at] = (at - n + 1, at)
                for run, span in open_runs.items():
                    if run not in current:
                        found.append((run, span))
                open_runs = current
            found.extend(open_runs.items())
        return len(words), places, self._chains(found)

    def _chains(self, found):
        """Best chains of matched words: (template, first, last, covered words), none of a template overlapping another in the text.

        A chain's words go forward in the text and in the template, and leave out at most ``gap`` words at a time in either. For
        every matched word the longest chain that ends there is kept, all of them at once, so a stray match never closes a
        chain that goes on later. Of the chains with the same beginning the longest counts, then longest chains first.
        """
        by_template: dict = {}
        for (t, shift), (first, last) in found:
            words = by_template.setdefault(t, {})
            for at in range(first, last + 1):
                words.setdefault(at, []).append(at + shift)
        return [(t, *span) for t, words in sorted(by_template.items()) for span in self._longest(words)]

    def _longest(self, words: dict[int, list[int]]):
        reach = self.settings.gap + 1
        ends: dict = {}  # text place: (template place, words of the longest chain that ends here, its beginning)
        best: dict = {}  # beginning: words and last text place of its longest chain
        for at in sorted(words):
            near = [one for before in range(at - reach, at) for one in ends.get(before, ())]
            ends.pop(at - reach, None)
            here = []
            for place in sorted(words[at]):
                covered, begin = 0, (at, place)
                for other, size, start in near:
                    if size > covered and place - reach <= other < place:
                        covered, begin = size, start
                here.append((place, covered + 1, begin))
                if covered + 1 > best.get(begin, (0,))[0]:
                    best[begin] = covered + 1, at
            ends[at] = here
        kept: list = []  # disjoint, in text order
        for (first, _), (covered, last) in sorted(best.items(), key=lambda one: (-one[1][0], one[0])):
            k = bisect_left(kept, (first,))
            if (k == len(kept) or kept[k][0] > last) and (not k or kept[k - 1][1] < first):
                kept.insert(k, (first, last, covered))
        return kept

    def row(self, data: bytes) -> tuple:
        n_words, places, spans = self.scan(data)
        starts = [start for start, _ in places]
        base = {self.labels[t] for _, t in places}
        share = [(self.labels[t], first, last, covered / self.sizes[t], t) for t, first, last, covered in spans]
        own = {label for label, _, _, part, t in share if t >= self.phrases and part >= self.settings.covered}
        return (n_words, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | own)), max((part for *_, part, _ in share), default=0.0),
                [{"label": label, "first": first, "last": last, "covered": part} for label, first, last, part, _ in share])


SPANS = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
    T.StructField("covered", T.DoubleType())]))


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every document.

    Words are runs of ASCII letters (in lower case), digits and other characters. ``n_base`` counts all places at
    which a phrase's words stand, ``first_word`` and ``last_word`` are the smallest and largest start of them (null if there
    are none). Templates are found through long matches in the same automaton, whose words are
    chained by dynamic programming: longest chains that go forward in text and template with small gaps. A chain is a span, and its
    ``covered`` share of the template's words decides about the template's label. ``score`` is the largest share covered. ``labels`` has both kinds.

    Null and empty texts have no words, empty labels and score 0. Rows are kept as they are, with null or
    repeated ids too; other columns don't matter. An empty table gives an empty result.
    """
    result = with_id(
        docs, ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
        ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("spans", SPANS))
    templates = tuple(templates)

    def scan(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(result)
        scanner = Scanner(phrases, templates, settings)
        for piece in pieces(batches):
            data = pc.fill_null(piece.column("text").cast(pa.binary()), b"").to_pylist()
            columns = zip(*map(scanner.row, data))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, kind) for c, kind in zip(columns, arrow.types[1:]))], arrow.names)

    return id_and_text(docs).mapInArrow(scan, result)
