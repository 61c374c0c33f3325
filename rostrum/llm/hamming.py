"""Exact nearest codes by Hamming distance with an incremental multi-index.

Vectors become binary codes, a bit for each component (1 where it is above 0). Codes
are dealt into blocks by a hash of the id, and every block is searched for every
query: a query's result is the best of its blocks'. Within a block

1. a code is cut into segments of about as many bits as the number of codes has
   digits in base two; every segment has an index from its value to the codes that
   have it;
2. a query looks, in rounds, for values at a distance of 0, 1, 2, ... from its own in
   one segment after the other. Once that is done up to ``r`` in the first ``a``
   segments and up to ``r - 1`` in the others, every code within
   ``segments * r + a - 1`` bits has been met;
3. codes that are met are verified by their full distance. A query whose k-th verified
   distance is no more than what is covered is done; only the others go on.

Values at a distance are enumerated by flipping bits; where a segment has fewer values
in use than there are flips, these are gone through instead.

Equal codes of a block are searched as one and stand for their ``k + 1`` smallest ids.
Ties go to the smaller id; a query is no neighbour of itself (of its own id). Null
vectors, and ids that are null, are left out; vectors of another length than the
first's by id count as null, null or not-a-number components as not above 0.
Repeated rows of one id and code count once. A query of fewer than k other rows
gets all of them. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.runtime import bounded_batches, materialise

#: Codes of a block at most (on average), and at least where there is work for more tasks; queries that meet a copy of a block.
BLOCK, LEAST, QUERIES = 1 << 20, 1 << 13, 1 << 16
#: Widest segment, so that its values index a table.
WIDEST = 20
#: Looked-up values, and verified codes, that are held at once.
AT_ONCE = 1 << 18


def codes(vectors: DataFrame, queries: Column, bits: int, *, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``query`` (whether the condition holds) and ``code`` (bytes, in whole 64-bit words) of the vectors of ``bits`` components."""
    size = -(-bits // 64) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            values = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, bits)
            packed = np.zeros((b.num_rows, size), np.uint8)
            with np.errstate(invalid="ignore"):
                some = np.packbits(values > 0, axis=1, bitorder="little")
            packed[:, : some.shape[1]] = some
            code = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(np.arange(b.num_rows + 1, dtype=np.int32) * size), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), code], ["id", "query", "code"])

    real = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) == bits))
    known = real.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return known.select("id", F.coalesce(queries, F.lit(False)).alias("query"), "vector").mapInArrow(run, "id long, query boolean, code binary")


@cache
def flips(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits of which ``radius`` are set."""
    if not radius:
        return np.zeros(1, np.uint32)
    bits = np.fromiter((b for c in combinations(range(width), radius) for b in c), np.uint32, math.comb(width, radius) * radius)
    return (np.uint32(1) << bits.reshape(-1, radius)).sum(axis=1, dtype=np.uint32)


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and of which range each is."""
    width = stop - start
    owner = np.repeat(np.arange(len(start)), width)
    return np.arange(len(owner)) + np.repeat(start - np.cumsum(width) + width, width), owner


class Block:
    """An index over the codes of a block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, bits: int, k: int):
        """``rows``: the words of each id's code."""
        self.k = k
        order = np.lexsort((ids, *rows.T))
        ids, rows = ids[order], rows[order]
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
        fresh = new | np.append(True, ids[1:] != ids[:-1])
        ids, rows, new = ids[fresh], rows[fresh], new[fresh]
        first = np.flatnonzero(new)
        self.codes = rows[first]
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        self.ids = ids[place <= k]
        self.at = np.searchsorted(np.cumsum(new)[place <= k] - 1, np.arange(len(first) + 1))
        n = max(1, round(bits / max(4, min(WIDEST, math.log2(max(2, len(first)))))), -(-bits // WIDEST))
        self.cuts = [bits * i // n for i in range(n + 1)]
        self.order, self.table = [], []
        for i, value in enumerate(self.values(self.codes)):
            self.order.append(np.argsort(value, kind="stable").astype(np.int32))
            self.table.append(np.append(0, np.cumsum(np.bincount(value, minlength=1 << self.cuts[i + 1] - self.cuts[i]))))
        self.used = [np.flatnonzero(np.diff(t)).astype(np.uint32) for t in self.table]

    def values(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The value of each segment of the codes."""
        for low, high in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            word, at = divmod(low, 64)
            value = rows[:, word] >> np.uint64(at)
            if at + high - low > 64:
                value = value | rows[:, word + 1] << np.uint64(64 - at)
            yield (value & np.uint64((1 << high - low) - 1)).astype(np.uint32)

    def _probe(self, segment: int, radius: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query's value the codes whose value is ``radius`` bits away: places of queries and codes, piece by piece."""
        width, table, used = self.cuts[segment + 1] - self.cuts[segment], self.table[segment], self.used[segment]
        if radius > width:
            return
        listed = math.comb(width, radius) <= len(used)
        step = max(1, AT_ONCE // (math.comb(width, radius) if listed else len(used)))
        for i in range(0, len(own), step):
            some = own[i : i + step, None]
            if listed:
                value = (some ^ flips(width, radius)).ravel()
                query = np.repeat(np.arange(i, i + len(some)), len(value) // len(some))
            else:
                query, which = np.nonzero(np.bitwise_count(some ^ used) == radius)
                query, value = query + i, used[which]
            start, stop = table[value], table[value + 1]
            hit = np.flatnonzero(stop > start)
            query, start, stop = query[hit], start[hit], stop[hit]
            cut = np.searchsorted(np.cumsum(stop - start), np.arange(AT_ONCE, (stop - start).sum() + AT_ONCE, AT_ONCE), side="left") + 1
            for a, b in zip(np.append(0, cut[:-1]), cut, strict=True) if len(cut) else ():
                at, owner = _spread(start[a:b], stop[a:b])
                yield query[a:b][owner], self.order[segment][at]

    def search(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query up to ``k`` results, the nearest first: place of the query, id and distance."""
        none = np.zeros(0, np.int64)
        bound, done = np.full(len(ids), np.iinfo(np.int64).max), np.zeros(len(ids), bool)
        best = (none, none, none)
        values, n = list(self.values(rows)), len(self.cuts) - 1
        for radius in range(1 + max(b - a for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True))):
            for segment in range(n):
                open_ = np.flatnonzero(~done)
                if not len(open_):
                    return best
                for at, code in self._probe(segment, radius, values[segment][open_]):
                    query = open_[at]
                    distance = np.bitwise_count(rows[query] ^ self.codes[code]).sum(axis=1, dtype=np.int64)
                    near = distance <= bound[query]
                    query, code, distance = query[near], code[near], distance[near]
                    which, owner = _spread(self.at[code], self.at[code + 1])
                    query, distance, found = query[owner], distance[owner], self.ids[which]
                    other = found != ids[query]
                    best = self._best(*(np.concatenate([x, y[other]]) for x, y in zip(best, (query, found, distance), strict=True)), bound)
                done |= bound <= n * radius + segment
        return best

    def _best(self, query: np.ndarray, found: np.ndarray, distance: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct first ``k`` of each query; sets the bounds of those that have as many."""
        order = np.lexsort((found, distance, query))
        query, found, distance = query[order], found[order], distance[order]
        fresh = np.append(True, (query[1:] != query[:-1]) | (found[1:] != found[:-1]) | (distance[1:] != distance[:-1]))[: len(query)]
        query, found, distance = query[fresh], found[fresh], distance[fresh]
        start = np.flatnonzero(np.append(True, query[1:] != query[:-1]))[: len(query)]
        place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
        kept = place < self.k
        last = place == self.k - 1
        bound[query[last]] = distance[last]
        return query[kept], found[kept], distance[kept]


def _search(bits: int, k: int):
    """Makes results from rows in the order of block, part of the queries and role: a block's codes stand before its queries."""
    words = -(-bits // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([c.to_numpy() for c in b.columns[:3]], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
            ids = b.column(3).to_numpy()
            rows = np.array([np.frombuffer(x, np.uint64) for x in b.column(4).to_pylist()]).reshape(-1, words)
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                *own, role = key[start].tolist()
                if own != now:
                    now, held, block = own, [], None
                if role == 0:
                    held.append((ids[start:stop], rows[start:stop]))
                    continue
                if block is None and held:
                    block, held = Block(*(np.concatenate(x) for x in zip(*held, strict=True)), bits, k), []
                if block is not None:
                    query, found, distance = block.search(ids[start:stop], rows[start:stop])
                    at = pa.array(query + start)
                    yield pa.RecordBatch.from_arrays([b.column(3).take(at), b.column(4).take(at), pa.array(found), pa.array(distance)], ["query_id", "query_code", "id", "distance"])

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``neighbour_id`` and ``distance`` of the k nearest of each row where ``queries`` holds.

    ``queries`` is a condition on ``id_col`` (named ``id`` in it).
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    first = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).agg(F.min_by(F.size(vector_col), id_col)).first()[0]
    bits = first or 1
    rows = materialise(codes(vectors, queries, bits, id_col=id_col, vector_col=vector_col), "codes")
    n, asked = rows.agg(F.count("*"), F.count_if("query")).first()
    blocks = max(1, -(-n // BLOCK), min(spark.sparkContext.defaultParallelism, n // LEAST))
    parts = max(1, -(-asked // QUERIES))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    base = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), every(parts).alias("part"), F.lit(0).alias("role"), "id", "code")
    ask = rows.where("query").select(every(blocks).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("role"), "id", "code").distinct()
    ordered = base.union(ask).repartition(blocks * parts, "block", "part").sortWithinPartitions("block", "part", "role")
    met = ordered.mapInArrow(_search(bits, k), "query_id long, query_code binary, id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_code").orderBy("distance", "id"))
    best = met.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")


#: The same over ``embeddings`` in SQL, as query op3 returns it.
SQL = """
WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 100 = 0),
d AS (
  SELECT query_id, vec_id AS neighbour_id,
         list_sum(list_transform(range(1, 1 + len(e)), lambda i: CASE WHEN (e[i] > 0) <> (embedding[i] > 0) THEN 1 ELSE 0 END))::BIGINT AS distance
  FROM q, embeddings WHERE vec_id <> query_id
)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank, neighbour_id, distance FROM d) WHERE rank <= 10
"""
