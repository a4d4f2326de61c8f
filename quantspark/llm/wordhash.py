"""Words and word n-grams of many texts at once, as 64-bit hashes over byte buffers.

A word's hash is the difference of two prefix sums of byte * base^position
(mod 2^64), brought to position 0 by the base's inverse and then mixed, so a
whole window of texts costs a few passes over its bytes.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACE = bytes([0x20, *range(0x09, 0x0E)])
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 19)
        steps = np.full(size, _BASE if which == "base" else _INV, dtype=np.uint64)
        steps[0] = 1
        have = _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def separator_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(separators)] = True
    return table


IS_SPACE = separator_table(SPACE)


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_sep: np.ndarray = IS_SPACE,
                lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of the rows that ``offsets`` (n + 1) cut out of ``data``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    part, offs = data[lo:hi], offsets - lo
    if not len(part):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if lower:
        part = LOWER[part]
    word = ~is_sep[part]
    before = np.empty(len(part), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    first = offs[:-1][offs[:-1] < len(part)]
    before[first] = False
    after = np.empty(len(part), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    last = offs[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    sums = np.empty(len(part) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power("base", len(part)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("inverse", len(part))[starts]
    rows = np.searchsorted(offs, starts, "right") - 1
    return mix(h ^ (ends - starts).astype(np.uint64)), rows


def shingles(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the n-word shingles; a row of fewer words has one of all its words."""
    if not len(words):
        return words, rows
    scale = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    k = len(words) - n + 1
    out_h, out_r = [], []
    if k > 0:
        full = rows[:k] == rows[n - 1:]
        h = np.zeros(k, np.uint64)
        for i in range(n):
            h += words[i:i + k] * scale[i]
        out_h.append(h[full])
        out_r.append(rows[:k][full])
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[first, len(rows)])
    short = first[size < n]
    if len(short):
        size = size[size < n]
        h = size.astype(np.uint64)
        for i in range(n - 1):
            at = np.minimum(short + i, len(words) - 1)
            h = h + np.where(size > i, words[at] * scale[i], np.uint64(0))
        out_h.append(h)
        out_r.append(rows[short])
    return mix(np.concatenate(out_h)), np.concatenate(out_r)
