"""Matching blocks of two texts, as ``difflib`` finds them without junk, in near-linear time.

The longest common part of two stretches is looked for by its length: windows of one length
are compared by rolling hashes, all at once, and the length is halved in on.  Of the longest
parts the first in the one text, and then in the other, is taken, and what lies before and
after it is matched in turn.  Small stretches are left to ``difflib`` itself, as is one where two
windows of equal hash are not equal.
"""

from __future__ import annotations

import difflib

import numpy as np

SMALL = 1 << 14  # product of lengths
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hashed:
    """Letters of a text and hashes of all its windows."""

    def __init__(self, text: str, power: np.ndarray):
        self.text, self.letters = text, np.frombuffer(text.encode("utf-32-le"), np.uint32)
        x = (self.letters.astype(np.uint64) + np.uint64(1)) * MIX
        x ^= x >> np.uint64(29)
        n = len(x)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * power[:n], dtype=np.uint64)))
        self.lift = power[::-1][:n]  # brings a window's hash to one place

    def windows(self, lo: int, hi: int, size: int) -> np.ndarray:
        at = np.arange(lo, hi - size + 1)
        return (self.sums[at + size] - self.sums[at]) * self.lift[at]


def longest(a: Hashed, b: Hashed, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """(i, j, size) of the longest common part, the first of equals; size -1 where hashes say what is not so."""
    least, most, found = 0, min(ahi - alo, bhi - blo), (alo, blo, 0)
    size = most
    while least < most:
        x, y = a.windows(alo, ahi, size), b.windows(blo, bhi, size)
        ordered = np.sort(y)
        place = np.minimum(np.searchsorted(ordered, x), len(y) - 1)
        hits = np.flatnonzero(ordered[place] == x)
        if len(hits):
            i, least = int(hits[0]), size
            found = (alo + i, blo + int(np.flatnonzero(y == x[i])[0]), size)
        else:
            most = size - 1
        size = (least + most + 1) // 2
    i, j, size = found
    return found if np.array_equal(a.letters[i : i + size], b.letters[j : j + size]) else (i, j, -1)


def matching_blocks(old: str, new: str) -> list[tuple[int, int, int]]:
    """(i, j, size) of the parts of ``old`` that ``new`` has, in order; the last one is empty."""
    power = np.cumprod(np.full(max(len(old), len(new)) + 1, BASE), dtype=np.uint64)
    a, b = Hashed(old, power), Hashed(new, power)
    open_, out = [(0, len(old), 0, len(new))], []
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        n, m = ahi - alo, bhi - blo
        if not n or not m:
            continue
        size = -1
        if n * m > SMALL:
            i, j, size = longest(a, b, alo, ahi, blo, bhi)
        if size < 0:
            own = difflib.SequenceMatcher(None, old[alo:ahi], new[blo:bhi], autojunk=False).get_matching_blocks()
            out.extend((alo + i, blo + j, k) for i, j, k in own if k)
        elif size:
            out.append((i, j, size))
            open_.append((alo, i, blo, j))
            open_.append((i + size, ahi, j + size, bhi))
    return [*sorted(out), (len(old), len(new), 0)]
