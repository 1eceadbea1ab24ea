"""Hashes of words and word shingles, vectorised over the bytes of many texts.

Words are maximal runs of bytes other than white space (0x09-0x0D, 0x20), if not told
otherwise, with A-Z in lower case. A word's hash is a polynomial over its bytes modulo 2^64,
mixed; a shingle's is a polynomial over its words' hashes, mixed again.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All of ASCII but letters and digits.
NO_LETTER = np.arange(256) < 0x80
NO_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_LOWER = np.arange(256, dtype=np.uint64) + _U(1)
_LOWER[ord("A") : ord("Z") + 1] += _U(32)


#: Bytes whose powers are held at a time; one longer word makes a run of its own.
_RUN = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[:1] = _U(1)
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Where all words begin and end; ``between``: the bytes that are in no word."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[firsts[1:] - 1] = inside[firsts[1:] - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    start, stop = word_bounds(data, offsets, between)
    hashes = np.empty(len(start), np.uint64)
    at, size, up, down = 0, 0, None, None
    while at < len(start):
        low = start[at]
        to = max(at + 1, int(np.searchsorted(stop, low + _RUN, "right")))
        run = data[low : stop[to - 1]]
        if len(run) > size:
            size = min(max(len(run), _RUN), len(data))
            up = _powers(_BYTE_BASE, size)
            down = _powers(pow(_BYTE_BASE, -1, 1 << 64), size)
        total = np.zeros(len(run) + 1, np.uint64)
        np.cumsum(_LOWER[run] * up[: len(run)], out=total[1:])
        first, last = start[at:to] - low, stop[at:to] - low
        # Dividing by the power at a word's start frees its hash of its place.
        hashes[at:to] = mix((total[last] - total[first]) * down[first])
        at = to
    counts = np.searchsorted(start, offsets[1:]) - np.searchsorted(start, offsets[:-1])
    return hashes, counts


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and how many each text has.

    A text with fewer words than a shingle has one, of all its words; a text
    without words has none.
    """
    hashes, counts = word_hashes(data, offsets)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(len(hashes), np.uint64)
    row_end = np.repeat(bounds[1:], counts)
    at = np.arange(len(hashes))
    length = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        here = at + k < row_end
        total[here] = total[here] * _U(_WORD_BASE) + hashes[at[here] + k]
        length += here
    row = np.repeat(np.arange(len(counts)), counts)
    keep = (length == words) | (at == np.repeat(bounds[:-1], counts))
    keys, row = mix(total[keep] + length[keep]), row[keep]
    ends = np.cumsum(np.bincount(row, minlength=len(counts)))
    for low, high in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        keys[low:high].sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return keys[fresh], np.bincount(row[fresh], minlength=len(counts))
