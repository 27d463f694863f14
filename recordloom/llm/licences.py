"""Licence spans, by matching statistics over a suffix automaton of licence templates.

The templates, and short phrases that name a licence, are turned into words and put into one suffix automaton:
each of its states stands for the stretches of template words that end in the same places. Texts are read word by
word: the automaton keeps the longest stretch that ends at the word and stands in some template. A phrase ends where
its state lies on the chain of suffix links of the state reached, so phrases are found by the same pass. Where the
stretch cannot go on, it is a match if it has at least `least` words. Matches that follow each other, in the text and in
the template, with at most `gap` words between them, make a chain; a chain that covers at least `share` of the words of
its template is a span with the template's label. Of overlapping spans of one label the one that covers more stays.

Words are told apart by their bytes. Words that stand in no template, or next to each other in none, end a
stretch, so only the remaining stretches enter the automaton. The automaton is broadcast; it has at most two
states a word of the templates, which are a parameter and not data. Nothing is shuffled.

The labels of a document are those of its phrases and of its spans; the score is the largest share of a template
covered by one span, 1 where a phrase stands. Null and empty texts have no words, no labels and score 0. Equal texts
get equal results. A text of any length is read whole. Ties between chains go to the earlier one. Other columns are
not read, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.wordids import number
from recordloom.llm.words import ALPHANUMERIC, LOWER, slices

#: Phrase -> label. Every place counts.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, text): notices that files carry.
TEMPLATES = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    ),
    (
        "lgpl",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
        your option) any later version.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]


@dataclass
class _State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)


def _words(text: str) -> list[str]:
    w = number(pa.array([text]), ALPHANUMERIC, LOWER)
    return w.distinct.take(pa.array(w.ids)).to_pylist()


class Automaton:
    """The suffix automaton of all templates and phrases, with the places at which each of its states ends."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.vocabulary: dict[str, int] = {}
        self.labels: list[str] = []
        self.sizes: list[int] = []
        self.states = [_State(0)]
        ends: list[list[tuple[int, int]]] = [[]]
        pairs = set()
        texts = [(label, _words(text), False) for label, text in templates]
        texts += [(label, _words(text), True) for text, label in phrases.items()]
        texts = [t for t in texts if t[1]]
        finals = {}
        for n, (label, words, is_phrase) in enumerate(texts):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            pairs.update(zip(ids, ids[1:], strict=False))
            self.labels.append(label)
            self.sizes.append(len(ids))
            last = 0
            for i, w in enumerate(ids):
                last = self._extend(last, w, ends)
                ends[last].append((n, i + 1))
            if is_phrase:
                finals[n] = last
        # A state also ends wherever the states that link to it end.
        for s in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            if self.states[s].link > 0:
                ends[self.states[s].link] += ends[s]
        self.ends = [sorted(set(e)) for e in ends]
        self.phrase_ends: list[list[int]] = [[] for _ in self.states]
        for n in finals:
            # The state that the words of the phrase lead to: splits may have moved them.
            state = 0
            for w in (self.vocabulary[x] for x in texts[n][1]):
                state = self.states[state].next[w]
            self.phrase_ends[state].append(n)
        self.is_phrase = [p for _, _, p in texts]
        self.pairs = np.array(sorted(a * len(self.vocabulary) + b for a, b in pairs), dtype=np.int64)
        self.words = pa.array(list(self.vocabulary), type=pa.string())
        self.shortest = min([2, *(len(w) for _, w, p in texts if p)])

    def _extend(self, last: int, word: int, ends: list[list[tuple[int, int]]]) -> int:
        """The state for the stretch of `last` and one word more; copies of earlier texts share states."""
        states = self.states

        def split(p: int, q: int) -> int:
            """A state for the stretches of q that are suffixes of p and the word."""
            copy = len(states)
            states.append(_State(states[p].length + 1, states[q].link, dict(states[q].next)))
            ends.append([])
            states[q].link = copy
            while p >= 0 and states[p].next.get(word) == q:
                states[p].next[word] = copy
                p = states[p].link
            return copy

        if word in states[last].next:
            q = states[last].next[word]
            return q if states[q].length == states[last].length + 1 else split(last, q)
        new = len(states)
        states.append(_State(states[last].length + 1))
        ends.append([])
        p = last
        while p >= 0 and word not in states[p].next:
            states[p].next[word] = new
            p = states[p].link
        if p < 0:
            states[new].link = 0
        else:
            q = states[p].next[word]
            states[new].link = q if states[q].length == states[p].length + 1 else split(p, q)
        return new

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
        """Stretches that cannot go on, as (end, length, state), and phrases, as (first word, phrase)."""
        states, state, length = self.states, 0, 0
        matches, phrases = [], []
        for i, w in enumerate(words):
            before = (i, length, state)
            while state and w not in states[state].next:
                state = states[state].link
                length = states[state].length
            if w in states[state].next:
                state, length = states[state].next[w], length + 1
            if length <= before[1]:
                matches.append(before)
            s, whole = state, length
            while s > 0:
                for n in self.phrase_ends[s]:
                    if self.sizes[n] <= whole:
                        phrases.append((i + 1 - self.sizes[n], n))
                s = states[s].link
                whole = states[s].length
        matches.append((len(words), length, state))
        return matches, phrases


@dataclass
class Span:
    label: str
    first: int
    last: int
    share: float


def chain(automaton: Automaton, matches: list[tuple[int, int, int]], gap: int, share: float) -> list[Span]:
    """Spans of templates that matches, given by (end, length, state) in order of their ends, cover in order."""
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for end, length, state in matches:
        for n, at in automaton.ends[state]:
            if not automaton.is_phrase[n]:
                by_template.setdefault(n, []).append((end, length, at))
    spans = []
    for n, found in by_template.items():
        size = automaton.sizes[n]
        # Chains end to end: (end in text, end in template, words covered, first word).
        chains: list[tuple[int, int, int, int]] = []
        live = 0
        for end, length, at in found:
            while live < len(chains) and chains[live][0] + gap + size < end:
                live += 1
            best = (length, end - length)
            for e, t, covered, first in chains[live:]:
                new = min(end - e, at - t, length)
                if new > 0 and end - new - e <= gap and at - new - t <= gap and covered + new > best[0]:
                    best = (covered + new, first)
            chains.append((end, at, *best))
        for end, _, covered, first in chains:
            if covered >= share * size:
                spans.append(Span(automaton.labels[n], first, end - 1, min(1.0, covered / size)))
    # Of overlapping spans of a label, the one that covers more.
    spans.sort(key=lambda s: (s.label, -s.share, s.first, s.last))
    kept: dict[str, list[Span]] = {}
    taken: dict[str, set[int]] = {}
    for s in spans:
        places = taken.setdefault(s.label, set())
        if places.isdisjoint(range(s.first, s.last + 1)):
            places.update(range(s.first, s.last + 1))
            kept.setdefault(s.label, []).append(s)
    return sorted((s for held in kept.values() for s in held), key=lambda s: (s.first, s.last, s.label))


_SPAN = [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())]
_PLACE = [("label", pa.string()), ("first_word", pa.int64())]
_FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("phrases", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType())]))),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("first_word", T.LongType()),
                        T.StructField("last_word", T.LongType()),
                        T.StructField("share", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def _scanned(part: pa.RecordBatch, automaton: Automaton, least: int, gap: int, share: float) -> pa.RecordBatch:
    w = number(part.column(1), ALPHANUMERIC, LOWER)
    # Numbers of words in the templates, -1 for all others.
    known = pa.compute.fill_null(pa.compute.index_in(w.distinct, automaton.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = known[w.ids] if len(w.ids) else w.ids
    keys = ids[:-1] * len(automaton.words) + ids[1:]
    at = np.searchsorted(automaton.pairs, keys)
    joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
    joined &= automaton.pairs[np.minimum(at, len(automaton.pairs) - 1)] == keys if len(automaton.pairs) else False
    joined[w.first[1:-1][(w.first[1:-1] > 0) & (w.first[1:-1] < len(ids))] - 1] = False
    inside = ids >= 0
    begins = np.flatnonzero(inside & ~np.append(False, joined)[: len(ids)])
    ends = np.flatnonzero(inside & ~np.append(joined, False)[: len(ids)]) + 1
    long = ends - begins >= automaton.shortest
    begins, ends = begins[long], ends[long]
    matches: dict[int, list] = {}
    phrases: dict[int, list] = {}
    owners = np.searchsorted(w.first, begins, "right") - 1
    for b, e, t in zip(begins.tolist(), ends.tolist(), owners.tolist(), strict=True):
        base = b - int(w.first[t])
        stretches, places = automaton.scan(ids[b:e].tolist())
        for end, length, state in stretches:
            if length >= least:
                matches.setdefault(t, []).append((base + end, length, state))
        for first, n in places:
            phrases.setdefault(t, []).append({"label": automaton.labels[n], "first_word": base + first})
    spans = [
        [{"label": s.label, "first_word": s.first, "last_word": s.last, "share": s.share} for s in chain(automaton, matches[t], gap, share)]
        if t in matches
        else []
        for t in range(len(part))
    ]
    named = [sorted(phrases.get(t, []), key=lambda p: (p["first_word"], p["label"])) for t in range(len(part))]
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(w.first)), pa.array(named, type=pa.list_(pa.struct(_PLACE))), pa.array(spans, type=pa.list_(pa.struct(_SPAN)))],
        names=_FOUND.names,
    )


def scan(
    documents: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    least: int = 4,
    gap: int = 8,
    share: float = 0.8,
) -> DataFrame:
    """(doc_id, n_words, phrases, spans): every place of a phrase, and the spans of templates, by first word."""
    automaton = Automaton(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    sent = documents.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _scanned(part, sent.value, least, gap, share)

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, _FOUND)


def summary(found: DataFrame) -> DataFrame:
    """Per document: counts, first and last place of a phrase, labels and score."""
    of_phrases, of_spans = F.col("phrases.label"), F.col("spans.label")
    covered = F.coalesce(F.array_max("spans.share"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.first_word").alias("first_word"),
        F.array_max("phrases.first_word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(of_phrases)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(of_phrases, of_spans)), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(covered).alias("score"),
        "spans",
    )
