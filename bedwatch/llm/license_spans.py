"""Licence scan by a generalised suffix automaton of licence words.

The automaton holds every run of words of every template. A text is streamed through it word by word; after each word
it knows the longest run ending there that occurs in some template (the matching statistics). Maximal long runs are
chained per template, in order in text and template and with bounded gaps, into spans; a template whose chained runs
cover enough of it is reported. Short phrases are templates that have to match whole.
"""

from __future__ import annotations

from collections import deque
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from bedwatch.llm.common import per_text

# ---- Fixed values: phrases and labels of the contract. ----
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# ---- Fixed values: characteristic passages of public licence texts. ----
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions""",
    "mit-notice": "Released under the MIT License",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version""",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}

#: lower-cases A-Z and turns every byte outside words into a space; bytes of other scripts belong to words
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences. States are numbers; state 0 is the empty run."""

    def __init__(self, sequences: list[list]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, end) of the runs of a state, filled below
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].append((number, at + 1))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:  # what ends a longer run ends its suffixes
                self.ends[self.link[state]] = sorted({*self.ends[self.link[state]], *self.ends[state]})

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _extend(self, last: int, token) -> int:
        if token in self.next[last]:  # the run is there from an earlier sequence
            known = self.next[last][token]
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, token, known)
        made, at = self._state(self.length[last] + 1), last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = made
            at = self.link[at]
        if at >= 0:
            known = self.next[at][token]
            self.link[made] = known if self.length[known] == self.length[at] + 1 else self._clone(at, token, known)
        return made

    def _clone(self, at: int, token, known: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[known])
        self.link[copy], self.link[known] = self.link[known], copy
        while at >= 0 and self.next[at].get(token) == known:
            self.next[at][token] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, length: int, token) -> tuple[int, int]:
        """The longest run ending with ``token``: its state and length."""
        while state and token not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if token in self.next[state]:
            return self.next[state][token], length + 1
        return 0, 0


class Span(NamedTuple):
    label: str
    start: int  # first word
    end: int  # behind the last word
    covered: float  # share of the template's words


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = BASE, least_run: int = 4,
                 least_cover: float = 0.6, gap: int = 12):
        texts = [(label, words(t)) for label, t in templates.items()]
        self.first_phrase = len(texts)
        texts += [(label, words(t)) for t, label in phrases.items()]
        self.labels, self.sizes = [x[0] for x in texts], [len(x[1]) for x in texts]
        self.automaton = Automaton([x[1] for x in texts])
        self.known = {w for _, t in texts for w in t}
        self.least_run = min([least_run, *self.sizes[:self.first_phrase]])
        self.least_cover, self.gap = least_cover, gap
        # per state: the whole phrases that are a suffix of its longest run, as (length, phrase)
        automaton = self.automaton
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in automaton.ends]
        for state in sorted(range(1, len(automaton.ends)), key=automaton.length.__getitem__):
            whole = [(self.sizes[s], s) for s, end in automaton.ends[state]
                     if s >= self.first_phrase and end == self.sizes[s] == automaton.length[state]]
            self.phrases[state] = whole + self.phrases[automaton.link[state]]

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, str]], list[Span]]:
        """Starts and labels of all whole phrases, and the spans of covered templates, by start."""
        automaton, known = self.automaton, self.known
        places: list[tuple[int, str]] = []
        runs: dict[int, list[tuple[int, int, int]]] = {}  # template -> (start in text, start in template, words)
        state = length = 0

        def maximal(end: int):
            if length >= self.least_run:
                for template, at in automaton.ends[state]:
                    if template < self.first_phrase and at >= length:
                        runs.setdefault(template, []).append((end - length, at - length, length))

        previous = -1
        for at in [i for i, w in enumerate(tokens) if w in known]:
            if at != previous + 1 and length:
                maximal(previous + 1)
                state = length = 0
            before = (state, length)
            following = automaton.step(state, length, tokens[at])
            if following[1] <= before[1]:  # the run could not grow
                maximal(at)
            state, length = following
            for size, phrase in self.phrases[state]:
                if size <= length:
                    places.append((at + 1 - size, self.labels[phrase]))
            previous = at
        if length:
            maximal(previous + 1)
        spans = [s for t, found in runs.items() for s in self._chained(t, found)]
        return sorted(places), sorted(spans, key=lambda s: (s.start, s.end, s.label))

    def _chained(self, template: int, runs: list[tuple[int, int, int]]) -> list[Span]:
        """Best chains of runs that follow each other in text and template with at most ``gap`` words between."""
        runs = sorted(runs)
        best: list[tuple[int, int]] = []  # words covered by the best chain that ends with this run, its first word
        recent: deque[int] = deque()
        spans: list[Span] = []
        for k, (start, at, size) in enumerate(runs):
            while recent and runs[recent[0]][0] + self.sizes[template] + self.gap < start:
                recent.popleft()
            chain = (size, start)
            for j in recent:
                s, a, n = runs[j]
                lost = max(0, s + n - start, a + n - at)  # overlap counts once
                if s < start and a < at and lost < size and start - s - n <= self.gap and at - a - n <= self.gap:
                    chain = max(chain, (best[j][0] + size - lost, best[j][1]), key=lambda c: c[0])
            best.append(chain)
            recent.append(k)
        # chains by cover; a chain inside a better one is no span of its own
        for k in sorted(range(len(runs)), key=lambda k: (-best[k][0], runs[k][0])):
            covered, first = best[k]
            end = runs[k][0] + runs[k][2]
            if covered / self.sizes[template] < self.least_cover:
                break
            spans.append(Span(self.labels[template], first, end, min(1.0, covered / self.sizes[template])))
        out: list[Span] = []
        for s in sorted(spans, key=lambda s: (s.start, -s.covered, s.end)):
            if not out or s.start >= out[-1].end:
                out.append(s)
            elif s.covered > out[-1].covered:
                out[-1] = s
        return out


def scan_licenses(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    n_base counts the places of whole phrases (overlapping ones each); first_word and last_word are their smallest and
    largest start, null without any. labels adds the templates covered; score is the largest share of a template or
    phrase found. spans lists template:start:end:cover by start. Null texts count as empty: no words, score 0.
    """
    scanner = scanner or Scanner()

    def make():
        def work(ids, texts):
            rows = []
            for text in texts:
                tokens = words(text)
                places, spans = scanner.scan(tokens)
                base = {label for _, label in places}
                rows.append((
                    len(tokens), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(sorted(base)), ",".join(sorted(base | {s.label for s in spans})),
                    max([float(bool(places)), *(s.covered for s in spans)]),
                    ",".join(f"{s.label}:{s.start}:{s.end}:{s.covered:.3f}" for s in spans)))
            return list(zip(*rows))
        return work

    return per_text(docs, make, [
        ("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()), ("first_word", "long", pa.int64()),
        ("last_word", "long", pa.int64()), ("base_labels", "string", pa.string()), ("labels", "string", pa.string()),
        ("score", "double", pa.float64()), ("spans", "string", pa.string())], id_col, text_col)
