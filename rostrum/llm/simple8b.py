"""Word-aligned coding of unsigned integers: a 64-bit word has a selector of 4 bits and 60 bits of payload.

A selector says how many values a word holds and of how many bits. Values of
60 bits and more are escapes: their word is :data:`ESCAPE` and the value itself
stands in a list after the words. Values are coded in blocks, so that any block
decodes on its own and with array operations only.
"""

from __future__ import annotations

import numpy as np

#: Values in a word and bits of each, by selector.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([c for c, _ in SELECTORS])
#: The payload of 60 ones under the last selector: the value is the block's next escape.
ESCAPE = np.uint64(15 << 60 | (1 << 60) - 1)
#: Values in a block.
BLOCK = 4096


def _kinds(v: np.ndarray) -> np.ndarray:
    """For each value the selector of a word that starts with it: the first whose number of values all fit, or all that its block has left."""
    n = len(v)
    widths = sorted({bits for _, bits in SELECTORS})
    #: how many of the widths are too narrow; a row for each block, and what would follow its end fits everywhere
    need = np.zeros((-(-n // BLOCK), BLOCK + int(COUNTS[0])), np.uint8)
    flat = np.zeros(need.shape[0] * BLOCK, np.uint8)
    for bits in widths:
        wide = v >= np.uint64(1 << bits)
        if not wide.any():
            break
        flat[:n] += wide
    need[:, :BLOCK] = flat.reshape(-1, BLOCK)
    most, size = {1: need}, 1  # the greatest need among so many values from each place on
    while 2 * size <= COUNTS[0]:
        most[2 * size] = np.maximum(most[size][:, :-size], most[size][:, size:])
        size *= 2
    kind = np.full((need.shape[0], BLOCK), len(SELECTORS) - 1, np.uint8)
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[s]
        half = 1 << count.bit_length() - 1
        window = np.maximum(most[half][:, :BLOCK], most[half][:, count - half : count - half + BLOCK])
        np.putmask(kind, window <= widths.index(bits), np.uint8(s))
    return kind.ravel()[:n]


def encode(values: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of ``values`` as (number of values, words, escapes)."""
    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    if not n:
        return []
    kind = _kinds(v)
    at = np.arange(n)
    jump = np.minimum(at + COUNTS[kind], np.minimum(at - at % BLOCK + BLOCK, n))
    #: all blocks walk side by side from word to word
    starts = np.arange(0, n, BLOCK)
    block_end = np.minimum(starts + BLOCK, n)
    pos, steps = starts, []
    while True:
        steps.append(pos)
        pos = jump[np.minimum(pos, block_end - 1)]  # the last place of a block leads to its end
        if (pos >= block_end).all():
            break
    grid = np.array(steps).T  # a row for each block
    held = grid < block_end[:, None]
    first = grid[held]
    words = np.zeros(len(first), np.uint64)
    sel = kind[first]
    padded = np.append(v, np.zeros(64, np.uint64))
    big = v >= np.uint64((1 << 60) - 1)
    for s in np.unique(sel):
        count, bits = SELECTORS[s]
        these = np.flatnonzero(sel == s)
        word = np.full(len(these), int(s) << 60, np.uint64)
        if bits == 60:
            one = v[first[these]]
            word |= np.minimum(one, np.uint64((1 << 60) - 1))
        elif bits:
            p, mask = first[these], np.uint64((1 << bits) - 1)
            for i in range(count):  # what lies beyond the block's end is cut when it is read
                word |= (padded[p + i] & mask) << np.uint64(i * bits)
        words[these] = word
    cuts = np.cumsum(held.sum(axis=1))[:-1]
    return [(int(e - s), w, v[s:e][big[s:e]]) for s, e, w in zip(starts, block_end, np.split(words, cuts), strict=True)]


def decode(n: int, words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ``n`` values of a block."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[sel]
    at = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(sel):
        c, bits = SELECTORS[s]
        if not bits:
            continue
        these = np.flatnonzero(sel == s)
        mask, p, w = np.uint64((1 << bits) - 1), at[these], words[these]
        for i in range(c):
            out[p + i] = w >> np.uint64(i * bits) & mask
    out[at[words == ESCAPE]] = escapes
    return out[:n]
