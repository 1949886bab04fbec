"""License texts in documents: a generalised suffix automaton of all templates, matching statistics, chains of matches.

Every text is streamed through the automaton of the templates' words. At each word its state is the longest run of words
ending there that stands in some template; a run of at least ``least`` words that cannot be extended is a match, with all
its places in the templates. Matches of one template in increasing order, at most ``gap`` words apart, form a chain: a
span of the document and the share of the template's words it covers. From ``cover`` on the span bears the template's
label. Stretches of words that no template holds only reset the automaton, so they are skipped array-wise.

Beside the method, a phrase's words standing one after another give its label (the base).

The automaton is built once from the templates, is as small as they are, and is sent to the executors; documents are
neither shuffled nor cut. Time grows with the words of a text, memory with the longest text.

Defined results. Words are runs of letters, digits and non-ASCII characters, A-Z in lower case; null counts as empty. A
text without words has no spans and score 0. A document may hold several templates, or one several times; equal
documents are scanned one by one.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoptide.llm.common import annotate, bare_words, texts

# Phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Opening grants and notices of public licences, by label.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
        " Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]


class Automaton:
    """Generalised suffix automaton over word numbers: transitions, suffix links, lengths, and all end places by state."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, template in enumerate(templates):
            last = 0
            for place, word in enumerate(template):
                last = self._extend(last, word)
                self.ends[last].append((number, place + 1))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]].extend(self.ends[state])
        self.ends[0] = []

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        """The state of just p's runs followed by word, cut out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another template, or the same, has this run already
            return self._clone(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._clone(p, word, self.next[p][word])
        return new

    def matches(self, words: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end in words, length, state) of each longest match of at least ``least`` words that the next word breaks."""
        out, state, length = [], 0, 0
        for at, word in enumerate(words):
            before = (at, length, state)
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            if before[1] >= least and length <= before[1]:
                out.append(before)
        if length >= least:
            out.append((len(words), length, state))
        return out


def chains(found: list[tuple[int, int, int]], automaton: Automaton, sizes: list[int], gap: int) -> list[tuple[int, int, int, float]]:
    """(template, first word, end, share of the template) of the chains of matches."""
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for end, length, state in found:
        for template, place in set(automaton.ends[state]):
            by_template.setdefault(template, []).append((end - length, place - length, length))
    out = []
    for template, parts in by_template.items():
        open_: list[list[int]] = []  # first word, end, place in the template, covered words
        for start, place, length in sorted(parts):
            best = None
            for chain in open_:
                skip = max(0, chain[1] - start, chain[2] - place)  # what the chain has already
                if start - chain[1] <= gap and skip < length and place + length > chain[2] and (best is None or chain[3] > best[0][3]):
                    best = chain, skip
            if best is None:
                open_.append([start, start + length, place + length, length])
            else:
                chain, skip = best
                chain[1:] = [max(chain[1], start + length), place + length, chain[3] + length - skip]
            done = [c for c in open_ if start - c[1] > gap]
            if done:
                out += [(template, c[0], c[1], c[3] / sizes[template]) for c in done]
                open_ = [c for c in open_ if start - c[1] <= gap]
        out += [(template, c[0], c[1], c[3] / sizes[template]) for c in open_]
    return sorted(out, key=lambda c: (c[1], c[2], c[0]))


SPANS = "array<struct<label: string, first_word: bigint, end_word: bigint, share: double>>"
FIELDS = f"n_words long, places array<struct<label: string, word: bigint>>, spans {SPANS}"


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    least: int = 4,
    gap: int = 8,
    cover: float = 0.6,
) -> DataFrame:
    """``row`` (all columns of docs), ``n_words``, ``places`` of phrases and ``spans`` of templates, in order of words."""
    vocabulary: dict[bytes, int] = {}
    tokens = [[vocabulary.setdefault(w, len(vocabulary)) for w in bare_words(t.encode())] for _, t in templates]
    automaton, sizes = Automaton(tokens), [len(t) for t in tokens]
    sought = [(bare_words(p.encode()), label) for p, label in phrases]
    shared = docs.sparkSession.sparkContext.broadcast((automaton.__dict__, vocabulary))

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        parts, numbers = shared.value
        machine = object.__new__(Automaton)
        machine.__dict__.update(parts)
        counts, places, spans = [], [], []
        for text in texts(batch.column("text")):
            found = bare_words(text)
            counts.append(len(found))
            places.append(phrase_places(found, sought))
            spans.append(template_spans(found, numbers, machine))
        kinds = [pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))]
        kinds.append(pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("share", pa.float64())])))
        return [pa.array(v, k) for v, k in zip((counts, places, spans), kinds)]

    def template_spans(found: list[bytes], numbers: dict[bytes, int], machine: Automaton) -> list[dict]:
        known = np.fromiter(map(numbers.get, found, repeat(-1)), np.int64, len(found))
        inside = np.concatenate(([0], (known >= 0).view(np.int8), [0]))
        starts, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
        long = ends - starts >= least
        hits = []
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            hits += [(start + at, n, s) for at, n, s in machine.matches(known[start:end].tolist(), least)]
        covered = [c for c in chains(hits, machine, sizes, gap) if c[3] >= cover]
        return [{"label": templates[t][0], "first_word": a, "end_word": b, "share": min(1.0, s)} for t, a, b, s in covered]

    return annotate(docs, values, FIELDS)


def phrase_places(found: list[bytes], sought: list[tuple[list[bytes], str]]) -> list[dict]:
    out = []
    times = {last: found.count(last) for last in {phrase[-1] for phrase, _ in sought}}
    for phrase, label in sought:
        at = -1
        for _ in range(times[phrase[-1]]):
            at = found.index(phrase[-1], at + 1)
            start = at - len(phrase) + 1
            if start >= 0 and found[start : at + 1] == phrase:
                out.append({"label": label, "word": start})
    return sorted(out, key=lambda p: (p["word"], p["label"]))
