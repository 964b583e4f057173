"""Licence scan: matching statistics of texts against a generalised suffix automaton of licence templates.

The templates' words make one suffix automaton, which is small and goes along
with the code.  A text streams through it in pieces of ``PIECE`` characters: after each word the
automaton holds the longest suffix that occurs in a template (the matching
statistics).  Words and pairs of words that no template has are found by array
operations, so that only runs of known pairs are walked.  Matches that can't be
extended are chained, forward in both the text and the template with small
gaps, into spans; a span that covers enough of its template gives the text its
label.  Naming phrases ("mit license") are templates of their own: they are read off the
same states.

A span: template, first and last word in the text, words covered, share of the
template.  Of spans that overlap in a text the one that covers more words stays
(of equals the larger share, then the first by name).  The score is
1 - (1 - share of the best span) * (1/2 if a phrase is named).

Edge cases: a null or empty text has no words, no labels and score 0; repeated
rows are scanned each for itself; texts of any length are taken whole, in
pieces, a word beyond a piece in one; an empty table gives an empty result;
other columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, text_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
#: The rest of a word, in either case.
_REST = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*")

#: Characters of a text that are cut into words at a time.
PIECE = 1 << 20
#: Words of a match at least; between two matches of a chain at most, in the text and in the template.
MATCH_WORDS, GAP_WORDS = 4, 16
#: A span is one of so large a share of its template, or of so many of its words.
LEAST_SHARE, LEAST_WORDS = 0.8, 25

#: Phrases that name a licence, and its label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of public licences and notices (label, text).
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
     files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
     following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
     Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
     MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
     DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
     USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache", "licensed under the Apache License, Version 2.0"),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You
     may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
     distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
     License for the specific language governing permissions and limitations under the License."""),
    ("gpl", "this work is licensed under the GNU General Public License, version 3"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
     the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that
     it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
     General Public License for more details. You should have received a copy of the GNU General Public License along with this program."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
     met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in
     binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
     materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
     above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
     file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
     distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower() if text.isascii() else text.translate(_LOWER))


def pieces(text: str, size: int = PIECE) -> Iterator[list[str]]:
    """The words of a text, so many characters at a time and on to the end of a word."""
    low = 0
    while low < len(text):
        high = _REST.match(text, min(low + size, len(text))).end()
        yield words_of(text[low:high])
        low = high


class Automaton:
    """Suffix automaton of several sequences of words: states by ``longest`` string, suffix ``link`` and ``step``s.

    ``ends`` has of each state the (template, words before its end) where its strings end; ``named`` the phrases (number, words) that are
    suffixes of its longest string.
    """

    def __init__(self, sequences: list[list[str]], phrases: list[list[str]]):
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for s in (*sequences, *phrases) for w in s}))}
        self.longest, self.link, self.step = [0], [-1], [{}]
        ends: list[set[tuple[int, int]]] = [set()]
        coded = [[self.vocabulary[w] for w in s] for s in (*sequences, *phrases)]
        for number, s in enumerate(coded):
            last = 0
            for i, word in enumerate(s):
                last = self._extend(last, word)
                ends += [set() for _ in range(len(self.longest) - len(ends))]
                if number < len(sequences):
                    ends[last].add((number, i + 1))
        for state in sorted(range(1, len(self.longest)), key=self.longest.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]  # a suffix ends wherever a longer string does
        # Only states of long enough strings are ever asked.
        self.ends = [tuple(sorted(e)) if n >= MATCH_WORDS else () for e, n in zip(ends, self.longest)]
        own = defaultdict(list)
        for number, phrase in enumerate(coded[len(sequences):]):
            state = 0
            for word in phrase:
                state = self.step[state][word]
            own[state].append((number, len(phrase)))
        self.named: list[tuple[tuple[int, int], ...]] = [()] * len(self.longest)
        for state in sorted(range(1, len(self.longest)), key=self.longest.__getitem__):
            self.named[state] = self.named[self.link[state]] + tuple(own[state])
        known = np.zeros((len(self.vocabulary), len(self.vocabulary)), bool)
        for s in coded:
            known[s[:-1], s[1:]] = True
        #: Whether two words stand together in a template; the last row and column are of unknown words.
        self.pairs = np.pad(known, (0, 1))

    def _new(self, longest: int, link: int, step: dict[int, int]) -> int:
        self.longest.append(longest), self.link.append(link), self.step.append(step)
        return len(self.longest) - 1

    def _split(self, at: int, word: int) -> int:
        """The state after ``word`` from ``at``, so that its longest string is just ``at``'s and the word."""
        there = self.step[at][word]
        if self.longest[there] == self.longest[at] + 1:
            return there
        twin = self._new(self.longest[at] + 1, self.link[there], dict(self.step[there]))
        self.link[there] = twin
        while at >= 0 and self.step[at].get(word) == there:
            self.step[at][word] = twin
            at = self.link[at]
        return twin

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new = self._new(self.longest[last] + 1, 0, {})
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new


@cache
def automaton() -> Automaton:
    return Automaton([words_of(t) for _, t in TEMPLATES], [p.split() for p in PHRASES])


@cache
def sizes() -> list[int]:
    return [len(words_of(t)) for _, t in TEMPLATES]


class Chains:
    """Chains of the matches of one text, each template's own: matches come by their ends, chains that can't grow are settled."""

    def __init__(self):
        self.sizes = sizes()
        self.open: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # end in text, end in template, covered, first word
        self.spans: list[tuple[int, int, int, int]] = []  # first, end, covered, template

    def add(self, template: int, low: int, high: int, at: int) -> None:
        """Words ``low`` to ``high`` of the text are those up to ``at`` of the template."""
        kept, best = [], (high - low, low)
        for end, place, covered, first in self.open[template]:
            if low - end > GAP_WORDS:
                self._settle(template, end, covered, first)
                continue
            kept.append((end, place, covered, first))
            fresh = min(high - max(low, end), at - max(at - (high - low), place))  # words that neither has
            gap = at - (high - low) - place
            if fresh > 0 and place < at and gap <= GAP_WORDS and (covered + fresh, first) > best:
                best = covered + fresh, first
        kept.append((high, at, *best))
        self.open[template] = kept

    def _settle(self, template: int, end: int, covered: int, first: int) -> None:
        if covered >= LEAST_SHARE * self.sizes[template] or covered >= LEAST_WORDS:
            # Ends of one chain follow each other: the one that covers more takes the other's place.
            if self.spans and self.spans[-1][3] == template and first < self.spans[-1][1]:
                self.spans[-1] = max(self.spans[-1], (first, end, covered, template), key=lambda s: (s[2], -s[0]))
            else:
                self.spans.append((first, end, covered, template))

    def done(self) -> list[tuple[int, int, int, float, str]]:
        """Spans without overlaps: template, first, last word, words covered, share, label."""
        for template, ends in self.open.items():
            for end, _, covered, first in sorted(ends):
                self._settle(template, end, covered, first)
        best = sorted(self.spans, key=lambda s: (-s[2], -s[2] / self.sizes[s[3]], TEMPLATES[s[3]][0], s))
        starts: list[int] = []
        taken: list[tuple[int, int, int, int]] = []
        for span in best:
            i = bisect_left(starts, span[0])
            if (i == 0 or taken[i - 1][1] <= span[0]) and (i == len(starts) or span[1] <= starts[i]):
                starts.insert(i, span[0])
                taken.insert(i, span)
        return [(t, first, end - 1, covered, min(1.0, covered / self.sizes[t]), TEMPLATES[t][0]) for first, end, covered, t in taken]


def walk(text: str, piece: int = PIECE) -> Iterator[tuple[str, int, int, int]]:
    """("match", first word, end, state) of matches of ``MATCH_WORDS`` or more that no word extends, ("place", first word, end, phrase) and at last
    ("end", 0, words, 0)."""
    auto = automaton()
    longest, link, step, named = auto.longest, auto.link, auto.step, auto.named
    unknown = len(auto.vocabulary)
    base, before, state, length = 0, unknown, 0, 0  # state and length: of the run that is still open

    for words in pieces(text, piece):
        codes = np.fromiter(map(auto.vocabulary.get, words, repeat(unknown)), np.int32, len(words))
        if not len(codes):
            continue
        ahead = np.concatenate([[before], codes[:-1]])
        at = np.flatnonzero(auto.pairs[ahead, codes])
        last = -1
        for i, one, word in zip(at.tolist(), ahead[at].tolist(), codes[at].tolist()):
            if i != last + 1 or not length:  # a run begins with the word before its first pair
                if length >= MATCH_WORDS:
                    yield "match", base + last + 1 - length, base + last + 1, state
                state, length = step[0][one], 1
            elif word not in step[state]:
                if length >= MATCH_WORDS:
                    yield "match", base + i - length, base + i, state
            while word not in step[state]:
                state = link[state]
                length = longest[state]
            state = step[state][word]
            length += 1
            last = i
            for number, size in named[state]:
                if length >= size:
                    yield "place", base + i + 1 - size, base + i + 1, number
        if last != len(codes) - 1:
            if length >= MATCH_WORDS:
                yield "match", base + last + 1 - length, base + last + 1, state
            state = length = 0
        before = int(codes[-1])
        base += len(codes)
    if length >= MATCH_WORDS:
        yield "match", base - length, base, state
    yield "end", 0, base, 0


def scan(text: str, piece: int = PIECE) -> dict:
    """n_words, n_base, first and last place of a phrase, the phrases' labels, spans."""
    ends, labels = automaton().ends, list(PHRASES.values())
    chains = Chains()
    places, first, last, named, words = 0, None, None, set(), 0
    for what, low, high, x in walk(text, piece):
        if what == "match":
            for template, at in ends[x]:
                chains.add(template, low, high, at)
        elif what == "place":
            places, first, last = places + 1, low if first is None else min(first, low), low if last is None else max(last, low)
            named.add(labels[x])
        else:
            words = high
    return {"n_words": words, "n_base": places, "first_word": first, "last_word": last, "named": named, "spans": chains.done()}


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " spans array<struct<template: int, first: long, last: long, covered: long, share: double, label: string>>"
)
_SPAN = pa.list_(pa.struct([("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.int64()), ("share", pa.float64()), ("label", pa.string())]))


def _row(doc_id: int | None, text: str) -> tuple:
    found = scan(text)
    named, spans = found["named"], found["spans"]
    share = max((s[4] for s in spans), default=0.0)
    return (doc_id, found["n_words"], found["n_base"], found["first_word"], found["last_word"], ",".join(sorted(named)),
            ",".join(sorted(named | {s[5] for s in spans})), 1 - (1 - share) * (0.5 if named else 1.0),
            [dict(zip(("template", "first", "last", "covered", "share", "label"), s)) for s in spans])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), _SPAN]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    for batch in batches:
        rows = [_row(doc_id, text.as_py()) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, places of phrases, labels, score, and the covered spans of templates."""
    text_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).mapInArrow(_scanned, SCHEMA)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
