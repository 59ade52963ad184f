"""H15 for keyword lists of any size: one automaton, one pass over the text (Aho and Corasick 1975).

States are the keywords' prefixes, in UTF-8 bytes; every state has a next state for
every byte, its failure link being resolved when the table is built (bytes that no keyword has
share one column).  A batch of texts is read from the Arrow buffers byte by byte, all
texts at once, longest first, so that each step is a few array operations over the
texts that still go on.  Where a state ends keywords, it is noted per text; what
suffixes of it end, too, comes from its failure chain.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


class Automaton:
    """``step`` (state, byte class) -> state; ``first`` and ``ends``: the keywords that end at each state."""

    def __init__(self, keywords: tuple[str, ...]):
        words = [k.encode() for k in keywords]
        self.n_empty = sum(not w for w in words)
        used = sorted({b for w in words for b in w})
        self.byte_class = np.zeros(256, dtype=np.int64)
        self.byte_class[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        own: list[list[int]] = [[]]
        for number, word in enumerate(words):
            at = 0
            for b in word:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    own.append([])
                at = children[at][b]
            if word:
                own[at].append(number)
        self.step = np.zeros((len(children), len(used) + 1), dtype=np.int32)
        fail, queue = [0] * len(children), deque([0])
        while queue:
            at = queue.popleft()
            if at:
                self.step[at] = self.step[fail[at]]
                own[at] = own[at] + own[fail[at]]
            for b, to in children[at].items():
                c = self.byte_class[b]
                fail[to] = int(self.step[at, c]) if at else 0
                self.step[at, c] = to
                queue.append(to)
        self.step = self.step.ravel()
        self.width = len(used) + 1
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        self.ends = np.array([k for x in own for k in x], dtype=np.int64)
        self.n_keywords = len(words)

    def hits(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """How many keywords occur in each text (a keyword listed twice counts twice)."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts, live = offsets[:-1][order], sizes[order]
        classes = self.byte_class[data] if len(data) else np.zeros(0, np.int64)
        ending = np.diff(self.first) > 0
        state, found = np.zeros(len(order), dtype=np.int64), []
        size = int(np.searchsorted(-live, 0))
        at = 0
        while size:
            now = self.step[state[:size] * self.width + classes[starts[:size] + at]]
            state[:size] = now
            hit = np.flatnonzero(ending[now])
            if len(hit):
                found.append(order[hit] * len(ending) + now[hit])
            at += 1
            size = int(np.searchsorted(-live, -at, "left"))
            if len(found) > 4096:
                found = [np.unique(np.concatenate(found))]
        out = np.full(len(order), self.n_empty, dtype=np.int64)
        if found:
            text, at_state = np.divmod(np.unique(np.concatenate(found)), len(ending))
            count = self.first[at_state + 1] - self.first[at_state]
            owner = np.repeat(text, count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[at_state], count)
            distinct = np.unique(owner * self.n_keywords + self.ends[place])
            out += np.bincount(distinct // self.n_keywords, minlength=len(out))
        return out


@lru_cache(maxsize=4)
def automaton(keywords: tuple[str, ...]) -> Automaton:
    """Built once per worker and list."""
    return Automaton(keywords)


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur (as substrings) in the lower-cased text; 0 for null."""
    listed = tuple(keywords)

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        body = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = body.buffers()
        if not len(body):
            return pa.array([], pa.int64())
        at = np.frombuffer(offsets, dtype=np.int64)[body.offset:body.offset + len(body) + 1]
        hits = automaton(listed).hits(at, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8))
        return pa.array(np.where(np.asarray(texts.is_null().to_numpy(zero_copy_only=False)), 0, hits))

    return count(F.lower(text))
