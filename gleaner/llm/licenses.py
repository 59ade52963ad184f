"""License scans with a generalised suffix automaton of licence wording.

The automaton holds every run of words of every template and phrase.  Streaming
a file through it gives, at each word, the longest run ending there that occurs
in some template (matching statistics).  Maximal long matches are then chained,
in the order of the template and of the file, into spans, and a template whose
words are covered far enough labels the file.

Words that no template has, and pairs of words that no template has side by
side, end every match; so only the stretches between them that are long enough
to matter are streamed, which are found for whole batches with array code.

Nulls: a null or empty text has no words and no labels.  Whole texts are read
whatever their length (in pieces of bounded size, cut between documents).
Repeated rows are scanned alike; each input row gives one output row; extra
columns are not read.  Ties between chains go to the earlier start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import HashIndex, byte_class, byte_values, chunks, hash_bytes, hash_spans, utf8, word_spans

#: What separates words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
SEPARATOR = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: phrase -> label; every place where the words stand side by side counts.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label -> wordings of licence notices.
TEMPLATES = {
    "mit": ("released under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    "apache-2": ("licensed under the apache license version 2 0",
                 "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    "gpl-3": ("licensed under the gnu general public license version 3",
              "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    "lgpl": ("licensed under the gnu lesser general public license",),
    "agpl-3": ("licensed under the gnu affero general public license version 3",),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
            "released under the bsd license"),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "cc-by-nc": ("licensed under cc by nc 4 0", "licensed under a creative commons attribution noncommercial"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "licensed under a creative commons attribution sharealike"),
    "cc-by": ("licensed under cc by 4 0",),
    "cc0": ("released into the public domain under cc0",),
}


def words(text: str) -> list[str]:
    """Words of a text, A-Z lower-cased."""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


@dataclass
class SuffixAutomaton:
    """Generalised: ``add`` takes one sequence after the other; each state knows where its runs end."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.ends.append(set())
        return len(self.size) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, word, known)
        new = self._state(self.size[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            known = self.step[at][word]
            self.link[new] = known if self.size[known] == self.size[at] + 1 else self._split(at, word, known)
        return new

    def _split(self, at: int, word: int, known: int) -> int:
        clone = self._state(self.size[at] + 1, dict(self.step[known]), self.link[known])
        self.link[known] = clone
        while at >= 0 and self.step[at].get(word) == known:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def add(self, sequence: list[int], name: int) -> None:
        """``name``'s runs; afterwards call ``close`` once."""
        last = 0
        for i, word in enumerate(sequence):
            last = self._extend(last, word)
            self.ends[last].add((name, i + 1))

    def close(self) -> None:
        """Hand every end to the states of the shorter runs that end there too."""
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """At each word: (length of the longest known run ending here, its state)."""
        state, size = 0, 0
        for word in sequence:
            while state and word not in self.step[state]:
                state = self.link[state]
                size = self.size[state]
            if word in self.step[state]:
                state, size = self.step[state][word], size + 1
            yield size, state


class Scanner:
    """The automaton over templates and phrases, and the tables that find what to stream."""

    def __init__(self, templates=None, phrases=None, least_match: int = 3, least_cover: float = 0.8, most_gap: int = 8):
        templates = TEMPLATES if templates is None else templates
        phrases = PHRASES if phrases is None else phrases
        self.least_match, self.least_cover, self.most_gap = least_match, least_cover, most_gap
        self.names: list[tuple[str, bool]] = []
        self.sizes: list[int] = []
        vocabulary: dict[str, int] = {}
        self.automaton = SuffixAutomaton()
        pairs = set()
        entries = [(text, label, False) for label, texts in templates.items() for text in texts]
        entries += [(text, label, True) for text, label in phrases.items()]
        for text, label, exact in entries:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
            self.automaton.add(ids, len(self.names))
            self.names.append((label, exact))
            self.sizes.append(len(ids))
            pairs |= set(zip(ids, ids[1:]))
        self.automaton.close()
        self.least_run = min([least_match, *(s for s, (_, exact) in zip(self.sizes, self.names) if exact)])
        self.values = byte_values(fold_case=True)
        self.words = HashIndex(np.array([hash_bytes(w.encode(), self.values) for w in vocabulary], dtype=np.uint64))
        self.pairs = np.array(sorted(a * len(vocabulary) + b for a, b in pairs), dtype=np.int64)

    def stretches(self, ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
        """Longest stretches of words, within one document, in which each pair is known."""
        if len(ids) < 2:
            if len(ids) and self.least_run <= 1 and ids[0] >= 0:
                yield 0, 1
            return
        code = ids[:-1].astype(np.int64) * len(self.words.keys) + ids[1:]
        both = (ids[:-1] >= 0) & (ids[1:] >= 0)
        both[both] = np.isin(code[both], self.pairs)
        cut = first[(first > 0) & (first < len(ids))]
        both[cut - 1] = False
        edge = np.diff(np.concatenate([[0], both.astype(np.int8), [0]]))
        for lo, hi in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            if hi - lo + 1 >= self.least_run:
                yield int(lo), int(hi) + 1

    def matches(self, ids: list[int], at: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """(phrase places (name, start)), and maximal matches (name, file start, template start, length)."""
        places, long, before = [], [], (0, 0)
        stats = [*self.automaton.statistics(ids), (0, 0)]
        for i, (size, state) in enumerate(stats):
            if size != before[0] + 1 and before[0] >= self.least_match:
                n = before[0]
                long += [(name, at + i - n, end - n, n) for name, end in self.automaton.ends[before[1]] if not self.names[name][1] and end >= n]
            before = (size, state)
            if size:
                # phrases that end here: their last state is this one or one of its suffixes
                walk, room = state, size
                while walk > 0:
                    shorter = self.automaton.size[self.automaton.link[walk]]
                    for name, end in self.automaton.ends[walk]:
                        if self.names[name][1] and end == self.sizes[name] and shorter < end <= room:
                            places.append((name, at + i + 1 - end))
                    walk, room = self.automaton.link[walk], shorter
        return places, long

    def chain(self, long: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, end word, covered share) of every template covered far enough."""
        found = []
        for name in sorted({m[0] for m in long}):
            rows = sorted((s, t, n) for name2, s, t, n in long if name2 == name)
            best: list[tuple[int, int]] = []  # covered words of the best chain that ends here, its start
            for i, (s, t, n) in enumerate(rows):
                cover, start = n, s
                for j in range(i - 1, -1, -1):
                    s2, t2, n2 = rows[j]
                    if s - (s2 + n2) > self.most_gap + max(self.sizes):
                        break
                    if s2 + n2 <= s and t2 + n2 <= t and s - (s2 + n2) <= self.most_gap and best[j][0] + n > cover:
                        cover, start = best[j][0] + n, best[j][1]
                best.append((cover, start))
            kept: list[tuple[int, int, int]] = []  # (start, end, cover), apart from each other
            for start, end, cover in sorted((start, s + n, cover) for (s, _, n), (cover, start) in zip(rows, best)
                                            if cover >= self.least_cover * self.sizes[name]):
                if not kept or start >= kept[-1][1]:
                    kept.append((start, end, cover))
                elif cover > kept[-1][2]:
                    kept[-1] = (start, end, cover)
            found += [(self.names[name][0], start, end, cover / self.sizes[name]) for start, end, cover in kept]
        return found


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label:string,first:long,end:long,cover:double>>")


def scan(documents: DataFrame, templates=None, phrases=None) -> DataFrame:
    """One row per document: the phrase places, the labels, and the template spans (words counted from 0).

    ``score`` is the largest covered share of any template, 1 where a phrase
    stands, 0 where nothing was found.  Row-local: no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                          ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                          ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])))])
        for batch in chunks(batches, "text"):
            offsets, data = utf8(batch.column("text"))
            starts, ends, first = word_spans(offsets, data, SEPARATOR)
            ids = scanner.words.find(hash_spans(data, starts, ends, scanner.values))
            places: dict[int, list] = {}
            long: dict[int, list] = {}
            for lo, hi in scanner.stretches(ids, first):
                doc = int(np.searchsorted(first, lo, "right")) - 1
                p, m = scanner.matches(ids[lo:hi].tolist(), lo - int(first[doc]))
                places.setdefault(doc, []).extend(p)
                long.setdefault(doc, []).extend(m)
            rows = []
            for doc, (key, n) in enumerate(zip(batch.column("doc_id").to_pylist(), np.diff(first).tolist())):
                base = places.get(doc, [])
                spans = scanner.chain(long[doc]) if long.get(doc) else []
                at = [s for _, s in base]
                named = {scanner.names[name][0] for name, _ in base}
                rows.append((key, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(named)),
                             ",".join(sorted(named | {s[0] for s in spans})), 1.0 if base else max([0.0, *(min(1.0, s[3]) for s in spans)]),
                             [dict(zip(("label", "first", "end", "cover"), s)) for s in sorted(spans, key=lambda s: (s[1], s[0]))]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
