"""Passages of many words that stand in more than one text, by a sparse suffix array.

Suffixes are kept only where the content says so: at the positions of minimisers,
the least hash of :data:`GRAM` words among :data:`WINDOW` in a row. Two texts that
share a passage of ``min_words`` words share such a position in it and at least
:data:`HEAD` words from there on.

1. Suffixes whose first :data:`HEAD` words no other text has at such a position are
   dropped (a minimum and a maximum of ids per hash, combined before the shuffle).
2. The others are sorted by these words, those after and those before, in ranges
   that may split equal suffixes. Each run of ``min_words`` words belongs to one kept
   position; a suffix is compared with its neighbours on either side, one step after
   the other, and what it shares with a neighbour of another text, extended to the
   right and to the left, covers some of its runs. A suffix is settled once all its
   runs are covered, or once its neighbours on both sides share too few words to the
   right for any run that is left: those further away share no more.
3. Runs of suffixes that :data:`STEPS` neighbours on either side don't settle, or that
   stand beside the end of a range, are counted by hashes: an exact check of what is
   left.
4. The marked words of a text join to passages.

Words are those of :mod:`words`; positions count words from 0, ends are exclusive.
Texts of fewer words, null ones and rows of null id have no passage. Rows that
share an id are one text's and don't make each other repeats. Texts may be of any
length; repeated passages within one text alone don't count. Empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.runtime import bit_table, bounded_batches, chunks, discard, has_bit, materialise, raw_bytes
from rostrum.llm.words import Powers, distinct, mix, words

MIN_WORDS, GRAM, WINDOW = 50, 8, 24
#: Words from a kept position on that every shared passage has.
HEAD = MIN_WORDS - WINDOW
#: Neighbours on either side that a suffix is compared with.
STEPS = 32
#: Words compared on either side beyond these.
SIDE = MIN_WORDS - HEAD
#: Bits of the table that marks shared heads (a power of two), and the share of set bits from which a join follows.
BITS, FULL = 1 << 24, 0.25


def anchors(hashes: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Kept positions: ``p`` (place in ``hashes``), ``row``, ``head`` (hash), ``first`` and ``last`` start of the runs that belong to each."""
    n = len(hashes)
    up, down = Powers.of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=total[1:])
    start = np.zeros(0, np.int64)
    if n >= MIN_WORDS:
        start = np.arange(n - MIN_WORDS + 1)
        start = start[start + MIN_WORDS <= rows[np.searchsorted(rows, start, side="right")]]
    if not len(start):
        return {k: np.zeros(0, np.int64) for k in ("p", "row", "first", "last")} | {"head": np.zeros(0, np.uint64), "total": total, "down": down}
    padded = np.append(hashes, np.zeros(GRAM, np.uint64))
    gram = np.zeros(n, np.uint64)
    for i in range(GRAM):
        gram = mix(gram + padded[i : i + n])
    least = start + np.lib.stride_tricks.sliding_window_view(gram, WINDOW).argmin(axis=1)[start]
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1  # the least of a later run is never further left
    begin, end = np.append(0, cut), np.append(cut, len(start))
    p = least[begin]
    return {"p": p, "row": np.searchsorted(rows, p, side="right") - 1, "first": start[begin], "last": start[end - 1], "head": _hash(total, down, p, HEAD), "total": total, "down": down}


def _hash(total: np.ndarray, down: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return mix((total[at + size] - total[at]) * down[at])


def _positions(batches: Iterator[pa.RecordBatch], marks: bytes | None = None) -> Iterator[tuple]:
    """Ids, word hashes, rows and the kept positions (of marked heads only, if marks are given)."""
    for b in chunks(batches, "text"):
        data, at = raw_bytes(b.column(1))
        hashes, _, _, rows = words(data, at)
        a = anchors(hashes, rows)
        if marks is not None:
            kept = has_bit(marks, a["head"] % np.uint64(BITS))
            a = {k: v if k in ("total", "down") else v[kept] for k, v in a.items()}
        if len(a["p"]):
            yield b.column(0), hashes, rows, a


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, _, _, a in _positions(batches):
        yield pa.RecordBatch.from_arrays([pa.array(a["head"].view(np.int64)), ids.take(pa.array(a["row"]))], ["head", "id"])


def suffixes(marks: bytes):
    """Makes rows of kept suffixes: ``head``, ``key`` (head, words after, words before backwards), ``id``, ``pos``, ``least`` and ``most`` words from the starts of its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, rows, a in _positions(batches, marks):
            p, row, head = a["p"], a["row"], a["head"]
            short = np.append(np.maximum(hashes >> np.uint64(32), 1), np.uint64(0)).astype(">u4")
            side, last = np.arange(SIDE), len(hashes)
            right, left = p[:, None] + HEAD + side, p[:, None] - 1 - side
            right = np.where(right < rows[row + 1][:, None], right, last)
            left = np.where(left >= rows[row][:, None], left, last)
            key = np.concatenate([head.astype(">u8")[:, None].view(np.uint8), short[right].view(np.uint8), short[left].view(np.uint8)], axis=1)
            size = key.shape[1]
            column = pa.Array.from_buffers(pa.binary(), len(p), [None, pa.py_buffer(np.arange(len(p) + 1, dtype=np.int32) * size), pa.py_buffer(np.ascontiguousarray(key))])
            yield pa.RecordBatch.from_arrays([pa.array(head.view(np.int64)), column, ids.take(pa.array(row)), *(pa.array(x) for x in (p - rows[row], p - a["last"], p - a["first"]))], ["head", "key", "id", "pos", "least", "most"])

    return run


def runs(marks: bytes):
    """Makes rows of all runs of marked heads: ``hash``, ``id`` and ``begin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, rows, a in _positions(batches, marks):
            n = a["last"] - a["first"] + 1
            begin = np.repeat(a["first"] - np.cumsum(n) + n, n) + np.arange(n.sum())
            row = np.repeat(a["row"], n)
            yield pa.RecordBatch.from_arrays([pa.array(_hash(a["total"], a["down"], begin, MIN_WORDS).view(np.int64)), ids.take(pa.array(row)), pa.array(begin - rows[row])], ["hash", "id", "begin"])

    return run


def _reach(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words to the right and to the left of the position that suffixes share, row by row; 0 and 0 where heads differ."""
    same = (a[:, :8] == b[:, :8]).all(axis=1)
    x, y = (np.ascontiguousarray(k[:, 8:]).view(np.uint32).reshape(len(k), 2 * SIDE) for k in (a, b))
    eq = (x == y) & (x != 0)
    run = lambda e: np.logical_and.accumulate(e, axis=1).sum(axis=1)
    return np.where(same, HEAD + run(eq[:, :SIDE]), 0), np.where(same, run(eq[:, SIDE:]), 0)


def _bits(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers with the bits from ``low`` to ``high`` set, none where ``low`` is greater."""
    one = np.int64(1)
    return np.where(low <= high, (one << np.maximum(high + 1, 0)) - (one << np.minimum(low, 62)), 0)


def _match(key: np.ndarray, info: np.ndarray, start: int, stop: int, steps: int = STEPS) -> pa.RecordBatch:
    """Passages of the suffixes from ``start`` to ``stop`` in the sorted arrays, and the heads that neighbours don't settle.

    ``info``: id, position, least and most words from the starts of the suffix's
    runs. A run is told by the words of it that stand before the suffix's position.
    """
    n, doc = len(info), info[:, 0]
    need = _bits(info[start:stop, 2], info[start:stop, 3])
    covered, settled = np.zeros(stop - start, np.int64), np.zeros(stop - start, bool)
    ended = {-1: settled.copy(), 1: settled.copy()}
    for step in range(1, steps + 1):
        for side in (-1, 1):
            at = np.flatnonzero(~settled & ~ended[side])
            other = at + start + side * step
            inside = (other >= 0) & (other < n)
            at, other = at[inside], other[inside]
            right, left = _reach(key[at + start], key[other])
            other_text = doc[at + start] != doc[other]
            covered[at] |= np.where(other_text, _bits(MIN_WORDS - right, np.minimum(left, WINDOW)), 0)
            #: the run that needs the fewest words to the right is the one that starts furthest to the left
            missing = need[at] & ~covered[at]
            ended[side][at] = right < MIN_WORDS - np.frexp(missing.astype(np.float64))[1] + 1
            settled[at] |= missing == 0
        settled |= ended[-1] & ended[1]
        if settled.all():
            break
    covered &= need
    spans, rest = [], covered
    for _ in range(WINDOW):
        at = np.flatnonzero(rest)
        if not len(at):
            break
        low = np.frexp((rest[at] & -rest[at]).astype(np.float64))[1] - 1
        over = rest[at] + (np.int64(1) << low)  # clears the lowest row of ones
        high = np.frexp((over & -over).astype(np.float64))[1] - 2
        spans.append((doc[at + start], info[at + start, 1] - high, info[at + start, 1] - low + MIN_WORDS))
        rest = rest.copy()
        rest[at] &= ~_bits(low, high)
    head = distinct(np.ascontiguousarray(key[start:stop][~settled, :8]).view(">u8").ravel().astype(np.uint64).view(np.int64))
    ids, begin, end = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else (np.zeros(0, np.int64),) * 3
    k, m = len(ids), len(head)
    columns = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(m, pa.int64())]) for x in (ids, begin, end)]
    return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(head, pa.int64())])], ["id", "begin", "end", "head"])


def compared(steps: int):
    """Makes the passages within a sorted range; holds a batch and the neighbours around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, info, done = np.zeros((0, 8 + 8 * SIDE), np.uint8), np.zeros((0, 4), np.int64), 0
        for b in batches:
            data, _ = raw_bytes(b.column(0))
            key = np.concatenate([key, data.reshape(-1, key.shape[1])])
            info = np.concatenate([info, np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5)], axis=1)])
            stop = len(info) - steps
            if stop > done:
                yield _match(key, info, done, stop, steps)
                first = max(0, stop - steps)
                key, info, done = key[first:], info[first:], stop - first
        if len(info) > done:
            yield _match(key, info, done, len(info), steps)

    return run


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``begin`` and ``end`` (words) of each passage that another text has as well."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    heads = texts.mapInArrow(_heads, "head long, id long").groupBy("head").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    shared = materialise(heads.where("lo < hi").select("head"), "heads")
    marks, share = bit_table(shared, F.pmod("head", F.lit(BITS)), BITS)
    kept = texts.mapInArrow(suffixes(marks), "head long, key binary, id long, pos long, least long, most long")
    if share > FULL:
        kept = kept.join(shared, "head", "left_semi")
    order = ("key", "id", "pos")
    ranged = kept.select(*order, "least", "most").repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialise(ranged.mapInArrow(compared(STEPS), "id long, begin long, end long, head long"), "matches")
    left = materialise(found.where("head is not null").select("head").distinct(), "unsettled")
    marks, _ = bit_table(left, F.pmod("head", F.lit(BITS)), BITS)
    all_runs = materialise(texts.mapInArrow(runs(marks), "hash long, id long, begin long"), "runs")
    #: written, so that the join below has plain sides and a hash of very many runs can be split
    twice = materialise(all_runs.groupBy("hash").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("hash"), "twice")
    exact = all_runs.join(twice, "hash").select("id", "begin", (F.col("begin") + MIN_WORDS).alias("end"))
    spans = found.where("id is not null").select("id", "begin", "end").union(exact).distinct()
    w = Window.partitionBy("id").orderBy("begin", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(before >= F.col("begin"), 0).otherwise(1)).withColumn("k", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    passages = marked.groupBy("id", "k").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).select(F.col("id").alias(id_col), "begin", "end")
    out = materialise(passages, "passages")
    discard(shared, found, left, all_runs, twice)
    return out
