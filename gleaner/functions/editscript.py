"""Equal runs of an edit script of least cost (insert, delete, replace: 1 each).

The distances are kept as Hyyroe (2003) keeps them: one row per character of ``b``, and in
it one bit per character of ``a`` where the distance grows by one (``up``) or falls by
one (``down``) from that character on.  The script is read backwards from the
end: a character of ``a`` goes where the distance grew there; else one of ``b`` comes in where
the row above falls there; else the two stand for each other.

Rows are kept from ``STEP`` (or, for long texts, the square root of the length) to
the next only, and those between are computed again when the script gets
there; so two texts of n characters need about n * sqrt(n) bits, not n * n.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

#: Rows computed at once; shorter texts are done in one go.
STEP = 512
#: Rows after which a limit is looked at.
CHECKED = 64


def char_masks(a: str) -> dict[str, int]:
    """Per character the bits of its places."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _rows(masks: dict[str, int], full: int, b: str, up: int, down: int) -> list[tuple[int, int]]:
    """(up, down) after each character of ``b``, from the row before it."""
    out = []
    for ch in b:
        x = masks.get(ch, 0) | down
        kept = (((x & up) + up) ^ up) | x
        grows = (down | ~(kept | up)) & full
        falls = kept & up
        grows = ((grows << 1) | 1) & full
        falls = (falls << 1) & full
        up, down = (falls | ~(kept | grows)) & full, grows & kept
        out.append((up, down))
    return out


def _pairs(a: str, b: str) -> list[tuple[int, int]]:
    """Places (in a, in b) of equal characters that the script keeps, last first."""
    full = (1 << len(a)) - 1
    masks, step = char_masks(a), max(STEP, isqrt(len(b)) + 1)
    starts = [(full, 0)]  # the row before each stretch of ``step`` characters
    rows = _rows(masks, full, b[:step], full, 0)
    for at in range(step, len(b), step):
        starts.append(rows[-1])
        rows = _rows(masks, full, b[at:at + step], *rows[-1])
    begin = (len(starts) - 1) * step
    kept, i, j = [], len(a), len(b)
    while i and j:
        if j <= begin:
            begin -= step
            rows = _rows(masks, full, b[begin:begin + step], *starts[begin // step])
        if rows[j - 1 - begin][0] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        above = rows[j - 1 - begin][1] if j > begin else starts[begin // step][1]
        if j and above >> (i - 1) & 1:
            continue
        i -= 1
        if a[i] == b[j]:
            kept.append((i, j))
    return kept


def _least(n: int, rest: int, at: int, up: int, down: int) -> int:
    """A lower bound of the whole distance from the row after ``at`` characters, with ``rest`` to come."""
    bits = lambda x: np.unpackbits(np.frombuffer(x.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    row = at + np.concatenate(([0], np.cumsum(bits(up).astype(np.int32) - bits(down))))
    return int((row + np.abs(n - np.arange(n + 1) - rest)).min())  # what is left differs in length


def distance(a: str, b: str, limit: int | None = None) -> int | None:
    """The edit distance: a row at a time, the last one holds it.  None once it is sure to exceed ``limit``."""
    most = min(len(a), len(b))
    head = next((k for k in range(most) if a[k] != b[k]), most)
    most -= head
    tail = next((k for k in range(most) if a[-1 - k] != b[-1 - k]), most)
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    full = (1 << len(a)) - 1
    masks, up, down = char_masks(a), full, 0
    step = STEP if limit is None else CHECKED
    for at in range(0, len(b), step):
        up, down = _rows(masks, full, b[at:at + step], up, down)[-1]
        done = min(at + step, len(b))
        if limit is not None and _least(len(a), len(b) - done, done, up, down) > limit:
            return None
    found = len(b) + up.bit_count() - down.bit_count()
    return found if limit is None or found <= limit else None


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of the script's equal runs, then (len(a), len(b), 0).

    What the two begin and end with alike is kept before the rest is compared.
    """
    most = min(len(a), len(b))
    head = next((k for k in range(most) if a[k] != b[k]), most)
    most -= head
    tail = next((k for k in range(most) if a[-1 - k] != b[-1 - k]), most)
    inner = [(i + head, j + head) for i, j in reversed(_pairs(a[head:len(a) - tail], b[head:len(b) - tail]))]
    blocks: list[list[int]] = [[0, 0, head]] if head else []
    for i, j, n in [(i, j, 1) for i, j in inner] + [(len(a) - tail, len(b) - tail, tail)]:
        if n and blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += n
        elif n:
            blocks.append([i, j, n])
    return [(i, j, n) for i, j, n in blocks] + [(len(a), len(b), 0)]
