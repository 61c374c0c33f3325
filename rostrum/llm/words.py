"""Words and word shingles of whole texts as 64-bit hashes, by array operations over UTF-8 bytes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; A-Z count as a-z. The hash of a word is a polynomial
over random values of its bytes, then mixed; the hash of a shingle is mixed from
those of its words and their number.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, ascending: by sorting, which is several times as fast here as the library's hashing."""
    if len(x) < 2:
        return x
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse, grown on demand and kept by a worker."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 18)
            up, down = _powers(_BASE, size), _powers(_INVERSE, size)
            if size > 1 << 20:  # a very long text: not kept
                return up, down
            cls.up, cls.down = up, down
        return cls.up, cls.down


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word, and the number of words before each row (one more than rows)."""
    n = len(data)
    space = np.ones(n + 2, bool)
    space[1 : n + 1] = _SPACE[data]
    solid = ~space[1 : n + 1]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(solid & (space[:n] | edge[:n]))
    end = np.flatnonzero(solid & (space[2 : n + 2] | edge[1 : n + 1])) + 1
    up, down = Powers.of(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return mix((total[end] - total[first]) * down[first]), first, end, np.searchsorted(first, offsets)


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, row by row, and the number before each row.

    A row with fewer words gives its whole sequence as one; without words none.
    """
    count = np.diff(rows)
    per = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(int(at[-1]), np.uint64)
    if not len(out):
        return out, at
    start = np.repeat(rows[:-1] - at[:-1], per) + np.arange(len(out))
    full = np.repeat(count >= size, per)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        out += padded[start + k] * _PLACE[k]
    for i in np.flatnonzero(~full):
        row = int(np.searchsorted(at, i, side="right")) - 1
        own = hashes[rows[row] : rows[row + 1]]
        out[i] = np.append(own * _PLACE[: len(own)], _PLACE[63 - len(own)]).sum(dtype=np.uint64)
    return mix(out), at
