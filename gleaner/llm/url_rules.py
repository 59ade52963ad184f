"""URL filters by a bit-parallel wildcard automaton.

All glob rules are laid side by side in one row of bits, several 64-bit words
long: the bit of (rule, k) is set while the rule's first k symbols match what
has been read.  One step over a character is a shift with carry between the
words, an AND with the character's mask, and the self-loops of the wildcards;
every rule advances in that one step, for every URL of the batch at once.

Globs match the whole canonical URL (lower-cased host, then path):

* ``**`` any run of characters, ``*`` any run without ``/``, ``?`` one character
  other than ``/``; everything else stands for itself.

A rule without wildcards in the form ``host/path`` means the host and all its
subdomains and every path that starts with the given one.

Nulls: a null URL, or one without ``://``, has an empty host and path; only
rules that match the empty string fit it.  Empty and very long URLs are
ordinary input (time is linear in the length).  Repeated rows are judged
alike; ties between fitting rules of the same length go to the earlier rule.
Extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule): the listed host/path rules; the longest fitting one decides.
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: (verdict, glob): the library's own rules, for URLs that no site rule fits; the longest fitting one decides.
GLOB_RULES = (
    ("block", "**/login**"), ("block", "**/cgi-bin/**"), ("block", "**/wp-admin/**"), ("block", "**/cart/**"),
    ("block", "**.exe"), ("block", "**.zip"), ("block", "**.iso"), ("block", "ads.*/**"), ("block", "*.doubleclick.*/**"),
)


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``? #``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def site_globs(rule: str) -> list[str]:
    """The globs of a ``host/path`` rule: the host itself, and its subdomains."""
    return [f"{rule}**", f"*.{rule}**"]


@dataclass(frozen=True)
class Automaton:
    """``step[c]``: states that character c may enter; ``loop[c]``: states that keep themselves on c."""

    start: np.ndarray
    step: np.ndarray
    loop: np.ndarray
    accept: tuple[int, ...]

    def run(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Boolean (n, globs): which glob matches which string."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, sizes = offsets[:-1][order], lengths[order]
        state = np.repeat(self.start[None, :], len(sizes), axis=0)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -t, "left"))  # those longer than t
            c, now = data[begin[:live] + t], state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[c]) | (now & self.loop[c])
        out = np.empty((len(sizes), len(self.accept)), dtype=bool)
        for k, bit in enumerate(self.accept):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) != 0
        return out


def compile_globs(globs: list[str]) -> Automaton:
    """Lay the globs side by side; each takes one bit more than it has symbols."""
    parsed = []
    for glob in globs:
        symbols: list[np.ndarray] = []
        loops: dict[int, str] = {}
        raw, i = glob.encode(), 0
        while i < len(raw):
            if raw[i:i + 1] == b"*":
                kind = "**" if raw[i:i + 2] == b"**" else "*"
                if loops.get(len(symbols)) != "**":
                    loops[len(symbols)] = kind
                i += len(kind)
                continue
            fits = np.zeros(256, dtype=bool)
            if raw[i:i + 1] == b"?":
                fits[:] = True
                fits[ord("/")] = False
            else:
                fits[raw[i]] = True
            symbols.append(fits)
            i += 1
        parsed.append((symbols, loops))
    bits = sum(len(s) + 1 for s, _ in parsed)
    width = max(1, -(-bits // 64))
    start, step, loop = np.zeros(width, np.uint64), np.zeros((256, width), np.uint64), np.zeros((256, width), np.uint64)
    accept, at = [], 0
    for symbols, loops in parsed:
        word, one = lambda k: (at + k) // 64, lambda k: np.uint64(1) << np.uint64((at + k) % 64)  # noqa: B023
        start[word(0)] |= one(0)
        for k, fits in enumerate(symbols, 1):
            step[fits, word(k)] |= one(k)
        for k, kind in loops.items():
            keeps = np.ones(256, dtype=bool)
            keeps[ord("/")] = kind == "**"
            loop[keeps, word(k)] |= one(k)
        accept.append(at + len(symbols))
        at += len(symbols) + 1
    return Automaton(start, step, loop, tuple(accept))


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
          site_rules=SITE_RULES, glob_rules=GLOB_RULES, default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (the deciding site rule or null), verdict, and own_rule (the
    deciding glob where no site rule fits, else null).

    Row-local: no shuffle, and the automaton is the only thing sent to tasks.
    """
    globs, owner = [], []
    for n, (_, rule) in enumerate(site_rules):
        globs += site_globs(rule)
        owner += [n, n]
    globs += [g for _, g in glob_rules]
    automaton = compile_globs(globs)
    sites = [n for n in sorted(range(len(site_rules)), key=lambda n: (-len(site_rules[n][1]), n))]
    own = [n for n in sorted(range(len(glob_rules)), key=lambda n: (-len(glob_rules[n][1]), n))]
    base = len(owner)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([h + p for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())], pa.string())
            fits = automaton.run(*utf8(text))
            rule = np.full(batch.num_rows, None, dtype=object)
            verdict = np.full(batch.num_rows, default, dtype=object)
            glob = np.full(batch.num_rows, None, dtype=object)
            open_ = np.ones(batch.num_rows, dtype=bool)
            for n in sites:
                hit = open_ & (fits[:, 2 * n] | fits[:, 2 * n + 1])
                rule[hit], verdict[hit] = site_rules[n][1], site_rules[n][0]
                open_ &= ~hit
            for n in own:
                hit = open_ & fits[:, base + n]
                glob[hit], verdict[hit] = glob_rules[n][1], glob_rules[n][0]
                open_ &= ~hit
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string()), pa.array(glob, pa.string())],
                names=[id_column, "host", "path", "rule", "verdict", "own_rule"])

    slim = pages.select(id_column, host(F.col(url_column)).alias("host"), path(F.col(url_column)).alias("path"))
    kind = dict(slim.dtypes)[id_column]
    return slim.mapInArrow(decide, f"{id_column} {kind}, host string, path string, rule string, verdict string, own_rule string")
