"""Licence scan: a generalised suffix automaton of licence tokens gives matching statistics, chained to spans.

The automaton holds every run of tokens of every template. A document is streamed through it once: after
each token it knows the longest run that ends there and occurs in some template. Maximal runs of at least
``MIN_RUN`` tokens are chained per template (rising in document and template, heaviest chain) and the
share of the template that a chain covers is the score of its span. Documents without a token that every
run of ``MIN_RUN`` template tokens must contain cannot hold one and are not streamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import texts

# Phrases and labels of the contract.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Public licence notices, long and short.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     'agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
     "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit-text", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
]
MIN_RUN = 4
#: Tokens between two runs of one span at most, and the share of a template that makes a span.
MAX_GAP, MIN_COVER = 40, 0.75
_COMMON = b"a an and any are as at be by copy for free from in is it of on or released software that the this to under use version was with work 0 2 3 4".split()
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case ASCII letters, ASCII digits and every other non-ASCII character make words."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class SuffixAutomaton:
    """Of several token sequences; each state knows where its runs end in which sequence."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token, ends)
                ends[last].add((k, i))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]

    def _state(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, token: bytes, q: int, ends: list) -> int:
        clone = self._state(self.length[p] + 1, ends)
        self.next[clone], self.link[clone] = dict(self.next[q]), self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: bytes, ends: list) -> int:
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q, ends)
        new, p = self._state(self.length[last] + 1, ends), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q, ends)
        return new

    def runs(self, tokens: list[bytes], least: int) -> list[tuple[int, int, int]]:
        """Maximal matches (end position, length, state) of ``least`` tokens or more, from the matching statistics."""
        found, state, size = [], 0, 0
        follow, link, length = self.next, self.link, self.length
        for i, token in enumerate(tokens):
            before, state_before = size, state
            while state and token not in follow[state]:
                state = link[state]
                size = length[state]
            state = follow[state].get(token, 0)
            size = size + 1 if state else 0
            if before >= least and size <= before:
                found.append((i - 1, before, state_before))
        if size >= least:
            found.append((len(tokens) - 1, size, state))
        return found


class _Best:
    """Prefix maxima over template positions."""

    def __init__(self, n: int):
        self.best: list[tuple[int, int]] = [(0, -1)] * (n + 1)

    def put(self, at: int, value: tuple[int, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def before(self, at: int) -> tuple[int, int]:
        top = (0, -1)
        while at > 0:
            top = max(top, self.best[at])
            at -= at & -at
        return top


def heaviest_chain(matches: list[tuple[int, int, int]], n: int) -> list[int]:
    """Indices of the heaviest chain of (document start, template start, length) that rises in both without overlap."""
    order = sorted(range(len(matches)), key=lambda i: matches[i][0])
    by_end = sorted(order, key=lambda i: matches[i][0] + matches[i][2])
    best, score, back, done = _Best(n), {}, {}, 0
    for i in order:
        start, at, size = matches[i]
        while matches[by_end[done]][0] + matches[by_end[done]][2] <= start:
            j = by_end[done]
            best.put(matches[j][1] + matches[j][2] - 1, (score[j], j))
            done += 1
        top, back[i] = best.before(at)
        score[i] = top + size
    i = max(order, key=lambda k: (score[k], -k))
    chain = []
    while i >= 0:
        chain.append(i)
        i = back[i]
    return chain[::-1]


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 min_run: int = MIN_RUN, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER):
        self.labels = [label for label, _ in templates]
        self.sequences = [words(t) for _, t in templates]
        self.automaton = SuffixAutomaton(self.sequences)
        self.phrases = [(words(p), label) for p, label in phrases.items()]
        self.min_run, self.max_gap, self.min_cover = min_run, max_gap, min_cover
        common = set(_COMMON)
        # every run of min_run tokens and every phrase holds at least one of these
        self.telling = {w for s in self.sequences for w in s if w not in common} | {w for p, _ in self.phrases for w in p if w not in common}
        for s in self.sequences:
            for i in range(max(1, len(s) - min_run + 1)):
                if self.telling.isdisjoint(s[i:i + min_run]):
                    self.telling |= set(s[i:i + min_run])

    def places(self, tokens: list[bytes]) -> list[tuple[int, str]]:
        found = []
        for phrase, label in self.phrases:
            at, n = -1, len(phrase)
            try:
                while True:
                    at = tokens.index(phrase[0], at + 1)
                    if tokens[at:at + n] == phrase:
                        found.append((at, label))
            except ValueError:
                pass
        return sorted(found)

    def spans(self, tokens: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, word after the last, share of the template) of chains that cover enough of one."""
        near: dict[int, list[list[tuple[int, int, int]]]] = {}
        for end, size, state in self.automaton.runs(tokens, self.min_run):
            for k, at in self.automaton.ends[state]:
                groups = near.setdefault(k, [])
                match = (end - size + 1, at - size + 1, size)
                if groups and match[0] - sum(groups[-1][-1][::2]) <= self.max_gap:
                    groups[-1].append(match)
                else:
                    groups.append([match])
        found = []
        for k, groups in near.items():
            n = len(self.sequences[k])
            for matches in groups:
                chain = [matches[i] for i in heaviest_chain(matches, n)]
                cover = sum(m[2] for m in chain) / n
                if cover >= self.min_cover:
                    found.append((self.labels[k], chain[0][0], chain[-1][0] + chain[-1][2], cover))
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))

    def scan(self, text: str) -> dict:
        tokens = words(text)
        found = {"n_words": len(tokens), "places": [], "spans": []}
        if not self.telling.isdisjoint(tokens):
            found |= {"places": self.places(tokens), "spans": self.spans(tokens)}
        return found


SCAN = ("n_words long, places array<struct<word:long,label:string>>, "
        "spans array<struct<label:string,first_word:long,end_word:long,cover:double>>")
_TYPES = [pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
          pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())]))]


def _scan(scanner_args: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**scanner_args)
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch.column(1)]
            columns = [[f["n_words"] for f in found], [[{"word": w, "label": x} for w, x in f["places"]] for f in found],
                       [[dict(zip(("label", "first_word", "end_word", "cover"), s)) for s in f["spans"]] for f in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, _TYPES))],
                                             ["doc_id", "n_words", "places", "spans"])

    return run


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", **scanner_args) -> DataFrame:
    """Per row: n_words, the places of the base phrases, and the spans that cover a template.

    Null and empty texts have no words, places or spans. Repeated rows are scanned each; an empty table
    gives an empty result. One pass, no shuffle; memory is bounded by one document.
    """
    rows = texts(docs, key, text)
    return rows.mapInArrow(_scan(scanner_args), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCAN}")


def licence_report(scanned: DataFrame) -> DataFrame:
    """Digest of a scan: counts, first and last place, labels, and a score."""
    labels = lambda *arrays: F.array_join(F.array_sort(F.array_distinct(F.concat(*arrays))), ",")
    base, own = F.col("places.label"), F.col("spans.label")
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        labels(base).alias("base_labels"), labels(base, own).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max("spans.cover"), F.lit(0.0)))).alias("score"))
