"""Toxicity score of whole texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is put in lower case, white space becomes a space, and one space is put at
either end. Its features are the distinct n-grams of :data:`LENGTHS` characters,
hashed to :data:`BITS` bits. From a bounded sample of labelled rows come, for each
feature, the smoothed log ratio of its frequency in rows of either label, and a
logistic regression on the features times these ratios; features that no more
than :data:`RARE` rows have, or whose ratio is within noise, are left out. The
score is the regression's probability. The sample is at most :data:`SAMPLE`
rows, the first by a hash of the label's id, and ends with the row that brings its
texts to :data:`SAMPLE_BYTES`; it trains in one task; counts and
weights have a fixed size. Nothing but the text enters a score.

Null texts count as empty and get the score of the bias alone, as do empty ones.
Rows of null id are scored and take no part in training, nor do labels other than
0 and 1. A text that stands in several rows gets the same score in each. With no
labelled row, or of one label only, every score is that label's share (0 without
any). An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import bounded_batches, chunks, raw_bytes, spare_names
from rostrum.llm.words import Powers, distinct

LENGTHS = (3, 4, 5, 6, 7)
BITS = 20
SAMPLE = 8_000
RARE = 4
#: Standard deviations that a log ratio must stand from 0, smoothing of counts, ridge of the regression and its steps.
NOISE, SMOOTH, RIDGE, STEPS = 3.0, 1.0, 1e-3, 300
#: Bytes of the sample's texts after which no further row joins it, and features that a step of the regression takes at a time.
SAMPLE_BYTES, AT_ONCE = 64 << 20, 1 << 20
#: Bytes of text taken at a time, so that the arrays stay in a processor's cache.
PIECE = 1 << 17

_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[[9, 10, 11, 12, 13]] = _BYTE[32]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct features of each text; with ``wanted`` (a mark for each feature) only those."""
    padded = pc.binary_join_element_wise(pa.scalar(" ", texts.type), pc.utf8_lower(texts.fill_null("")), pa.scalar(" ", texts.type), "")
    data, at = raw_bytes(padded)
    start = np.flatnonzero((data & 0xC0) != 0x80)  # a place for each character
    rows = np.searchsorted(start, at)
    up, down = Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    total = np.append(total[start], total[-1])
    down = down[start]
    found, whose = [], []
    for n in LENGTHS:
        if len(start) < n:
            continue
        h = ((total[n:] - total[:-n]) * down[: len(start) - n + 1] + np.uint64(n)) * _MIX
        idx = (h ^ (h >> np.uint64(32))) * _MIX >> np.uint64(64 - BITS)
        i = np.flatnonzero(wanted[idx]) if wanted is not None else np.arange(len(idx))
        row = np.searchsorted(rows, i, side="right") - 1
        inside = i + n <= rows[row + 1]
        found.append(idx[i[inside]].astype(np.int64))
        whose.append(row[inside])
    if not found:
        return [np.zeros(0, np.int64)] * len(texts)
    keys = distinct(np.concatenate(whose) << BITS | np.concatenate(found))
    cuts = np.searchsorted(keys >> BITS, np.arange(1, len(texts)))
    return np.split(keys & ((1 << BITS) - 1), cuts)


def fit(pieces: list[pa.Array], labels: np.ndarray) -> np.ndarray:
    """Weight of each feature, and last the bias."""
    out = np.zeros((1 << BITS) + 1, np.float32)
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.0
        out[-1] = 40.0 if share == 1 else -40.0
        return out
    count = np.zeros((2, 1 << BITS))
    row = 0
    for piece in pieces:
        for x in features(piece):
            count[int(y[row]), x] += 1
            row += 1
    rows = np.bincount(y.astype(int), minlength=2)
    p, q = count[1] + SMOOTH, count[0] + SMOOTH
    ratio = np.log(p / (rows[1] + 2 * SMOOTH)) - np.log(q / (rows[0] + 2 * SMOOTH))
    wanted = (count.sum(axis=0) > RARE) & (np.abs(ratio) > NOISE * np.sqrt(1 / p + 1 / q))
    del count
    number = (np.cumsum(wanted) - 1).astype(np.int32)
    kept = [number[x] for piece in pieces for x in features(piece, wanted)]
    col = np.concatenate(kept) if kept else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(y), dtype=np.int32), [len(x) for x in kept])
    del kept, number
    scale = ratio[wanted]

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(col), AT_ONCE):
            yield row[i : i + AT_ONCE], col[i : i + AT_ONCE]

    def by_row(weight: np.ndarray) -> np.ndarray:
        return sum((np.bincount(r, weight[c], len(y)) for r, c in blocks()), np.zeros(len(y)))

    def by_feature(error: np.ndarray) -> np.ndarray:
        return sum((np.bincount(c, error[r], len(scale)) for r, c in blocks()), np.zeros(len(scale)))

    w, bias = np.zeros(len(scale)), float(np.log(rows[1] / rows[0]))
    #: gradient descent with momentum; the step follows from the rows' mean norm
    step = 4 / (by_row(scale**2).mean() + 1)
    weight = np.where(y == 1, 0.5 / rows[1], 0.5 / rows[0])
    ahead, ahead_bias, v, vb = w.copy(), bias, w.copy(), bias
    for t in range(STEPS):
        score = by_row(scale * ahead) + ahead_bias
        error = weight * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y)
        w, bias = ahead - step * (scale * by_feature(error) + RIDGE * ahead), ahead_bias - step * error.sum()
        beta = t / (t + 3)
        ahead, ahead_bias, v, vb = w + beta * (w - v), bias + beta * (bias - vb), w, bias
    out[:-1][wanted] = w * scale
    out[-1] = bias
    return out


def probability(texts: pa.Array, weights: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    total = np.array([weights[x].sum(dtype=np.float64) for x in features(texts, wanted)]) + float(weights[-1])
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights from at most :data:`SAMPLE` labelled rows whose id isn't held out (see :func:`held_out`)."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    known = docs.select(F.col(id_col).alias("id")).where("id is not null")
    chosen = y.join(known, "id", "left_semi").orderBy(F.xxhash64("id"), "id", "y").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, y, held = [], [], 0
        for b in chunks(batches, "text", PIECE):
            b = b.slice(0, max(0, SAMPLE - len(y)) if held < SAMPLE_BYTES else 0)
            if b.num_rows:
                pieces.append(pa.array(b.column(0).to_pylist(), pa.string()))
                y += b.column(1).to_pylist()
                held += b.column(0).nbytes
        yield pa.RecordBatch.from_arrays([pa.array([fit(pieces, np.array(y)).tobytes()], pa.binary())], ["weights"])

    order = (F.xxhash64("id"), "id", "text", "y")
    row = texts.repartition(1).sortWithinPartitions(*order).select("text", "y").mapInArrow(run, "weights binary").first()
    return np.frombuffer(row.weights, np.float32) if row else fit([], np.zeros(0))


def held_out(col):
    """Whether an id is kept from training: its text's crc32 is a multiple of 5."""
    return F.crc32(col.cast("string")) % 5 == 0


def _scores(batches: Iterator[pa.RecordBatch], packed: bytes) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches, whose last column is the text, and the scores of their rows."""
    w = np.frombuffer(packed, np.float32)
    wanted = w[:-1] != 0
    for b in chunks(batches, -1, PIECE):
        yield b, probability(b.column(b.num_columns - 1), w, wanted)


def score(docs: DataFrame, weights: np.ndarray, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the score of the text."""
    bounded_batches(docs.sparkSession)
    packed, (text,) = weights.tobytes(), spare_names([*keep, name], "text")
    rows = docs.select(*keep, F.col(text_col).alias(text))
    schema = docs.select(*keep, F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, p in _scores(batches, packed):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p)], schema.names)

    return rows.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, weights: np.ndarray, limit: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns."""
    bounded_batches(docs.sparkSession)
    packed, (text,) = weights.tobytes(), spare_names(docs.columns, "text")
    rows, names = docs.select("*", F.col(text_col).alias(text)), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, p in _scores(batches, packed):
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names).filter(pa.array(p < limit))

    return rows.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` (1 from a score of 0.5) of every row."""
    scored = score(docs, train(docs, labels, id_col=id_col, text_col=text_col), text_col=text_col, keep=(id_col,))
    return scored.select(id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
