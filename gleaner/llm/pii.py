"""Format-preserving pseudonyms for validated personal numbers, dates and addresses.

Each value found is validated (check digits, ranges, calendar), reduced to its
canonical form, and permuted by a keyed Feistel network over exactly the set of
values of its format; cycle walking keeps the result inside that set.  The
pseudonym is then written back in the shape of the original: separators, country
prefix and check digits stay right.  Being a keyed permutation, equal values get
equal pseudonyms in every document and in every notation, different values never
share one, and the key holder can invert it.

Kinds: ``card`` (13-19 digits, Luhn), ``phone`` (+country, then 10 digits),
``ssn`` (ddd-dd-dddd with valid groups), ``ipv4``, ``date`` (ISO or d.m.y / m/d/y,
1900-2099), ``email`` (the letters and digits of the local part).

Nulls: a null text stays null and has no finds.  Whole texts are read, whatever
their length.  Overlapping candidates: the earliest, then the longest, valid one
counts.  Repeated rows are treated alike; extra columns pass through
``pseudonymise`` untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_class, chunks, utf8

ROUNDS = 10
_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
_MARKS = byte_class([(0x30, 0x39), (0x40, 0x40)])


def feistel(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network on the next power of four, walked until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    while True:
        left, right = value >> half, value & mask
        for r in order:
            seen = left if inverse else right
            digest = hashlib.blake2b(f"{tweak}|{size}|{r}|{seen}".encode(), key=key, digest_size=16).digest()
            f = int.from_bytes(digest, "big") & mask
            left, right = (right ^ f, left) if inverse else (right, left ^ f)
        value = left << half | right
        if value < size:
            return value


def luhn_digit(body: str) -> str:
    """The check digit that makes body + digit valid."""
    total = sum(sum(divmod(int(d) * 2, 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(body)))
    return str(-total % 10)


def refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


Permute = Callable[[int, int, str], int]


def _card(m: re.Match, p: Permute) -> str | None:
    d = _digits(m[0])
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = f"{p(int(d[:-1]), 10 ** (len(d) - 1), f'card{len(d)}'):0{len(d) - 1}d}"
    return refill(m[0], body + luhn_digit(body))


def _phone(m: re.Match, p: Permute) -> str | None:
    d = _digits(m[2])
    return m[1] + refill(m[2], f"{p(int(d), 10 ** 10, 'phone'):010d}") if len(d) == 10 else None


def _ssn_index(a: int, g: int, s: int) -> int | None:
    if not (1 <= a <= 899 and a != 666 and 1 <= g <= 99 and 1 <= s <= 9999):
        return None
    return ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1


def _ssn(m: re.Match, p: Permute) -> str | None:
    at = _ssn_index(int(m[1]), int(m[2]), int(m[3]))
    if at is None:
        return None
    rest, s = divmod(p(at, 898 * 99 * 9999, "ssn"), 9999)
    a, g = divmod(rest, 99)
    return f"{a + 1 + (a + 1 >= 666):03d}-{g + 1:02d}-{s + 1:04d}"


def _ipv4(m: re.Match, p: Permute) -> str | None:
    parts = m[0].split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    return ".".join(map(str, p(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ipv4").to_bytes(4, "big")))


def _date(m: re.Match, p: Permute) -> str | None:
    g = m.groupdict()
    if g["y1"]:
        y, mo, d, write = g["y1"], g["m1"], g["d1"], lambda x: f"{x.year:04d}-{x.month:02d}-{x.day:02d}"
    elif g["y2"]:
        y, mo, d, write = g["y2"], g["m2"], g["d2"], lambda x: f"{x.day:02d}.{x.month:02d}.{x.year:04d}"
    else:
        y, mo, d, write = g["y3"], g["m3"], g["d3"], lambda x: f"{x.month:02d}/{x.day:02d}/{x.year:04d}"
    try:
        at = (date(int(y), int(mo), int(d)) - _FIRST_DAY).days
    except ValueError:
        return None
    return write(_FIRST_DAY + timedelta(days=p(at, _DAYS, "date"))) if 0 <= at < _DAYS else None


def _email(m: re.Match, p: Permute) -> str | None:
    local = m[1]
    value, size, place = 0, 1, []
    for c in local:
        base, n = (ord("a"), 26) if c.islower() else (ord("A"), 26) if c.isupper() else (ord("0"), 10) if c.isdigit() else (0, 0)
        place.append((c, base, n))
        if n:
            value, size = value * n + ord(c) - base, size * n
    if size == 1:
        return None
    shape = "".join("a" if b == 97 else "A" if b == 65 else "0" if n else c for c, b, n in place)
    value, out = p(value, size, f"email|{shape}@{m[2].lower()}"), []
    for c, base, n in reversed(place):
        if n:
            value, k = divmod(value, n)
            c = chr(base + k)
        out.append(c)
    return "".join(reversed(out)) + "@" + m[2]


_YEAR = "(?:19|20)[0-9][0-9]"
#: kind, pattern, rewriting of a match (None: not valid).  In order of preference where they begin at the same place.
KINDS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9][A-Za-z0-9._%+-]{0,63})@((?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24})(?![A-Za-z0-9-])"), _email),
    ("phone", re.compile(r"(?<![0-9+])(\+[0-9]{1,3}[ .-]?)(\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?![0-9])"), _phone),
    ("ipv4", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"), _ipv4),
    ("ssn", re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?!-?[0-9])"), _ssn),
    ("date", re.compile(rf"(?<![0-9./-])(?:(?P<y1>{_YEAR})-(?P<m1>[0-9]{{2}})-(?P<d1>[0-9]{{2}})|(?P<d2>[0-9]{{2}})\.(?P<m2>[0-9]{{2}})\.(?P<y2>{_YEAR})|(?P<m3>[0-9]{{2}})/(?P<d3>[0-9]{{2}})/(?P<y3>{_YEAR}))(?!-?[0-9])"), _date),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"), _card),
)


def finds(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every valid value, in order, not overlapping."""
    def permute(value: int, size: int, tweak: str) -> int:
        return feistel(value, size, key, tweak)

    found = []
    for rank, (kind, pattern, rewrite) in enumerate(KINDS):
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            new = rewrite(m, permute)
            if new is not None:
                found.append((m.start(), -m.end(), rank, kind, new))
    out, free = [], 0
    for start, end, _, kind, new in sorted(found):
        if start >= free:
            out.append((start, -end, kind, new))
            free = -end
    return out


def _each(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[str, list]]]]:
    """Per chunk the texts that have finds; texts without a digit or @ are not looked at in Python."""
    for batch in chunks(batches, "text"):
        offsets, data = utf8(batch.column("text"))
        at = np.flatnonzero(_MARKS[data])
        docs = np.unique(np.searchsorted(offsets, at, "right") - 1)
        texts = batch.column("text").take(pa.array(docs)).to_pylist()
        yield batch, {int(d): (t, f) for d, t in zip(docs, texts) if (f := finds(t, key))}


FINDS = "doc_id long, start long, end long, kind string, pseudonym string"


def find(documents: DataFrame, key: str) -> DataFrame:
    """One row per valid value: doc_id, start and end (characters), kind, pseudonym."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("pseudonym", pa.string())])
        for batch, hits in _each(batches, secret):
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[d], *f) for d, (_, fs) in sorted(hits.items()) for f in fs]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return documents.select("doc_id", "text").mapInArrow(run, FINDS)


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """The same rows and columns, with every valid value in ``text`` replaced."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hits in _each(batches, secret):
            texts = batch.column("text").to_pylist()
            for d, (text, fs) in hits.items():
                out, last = [], 0
                for start, end, _, new in fs:
                    out += [text[last:start], new]
                    last = end
                texts[d] = "".join([*out, text[last:]])
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))
