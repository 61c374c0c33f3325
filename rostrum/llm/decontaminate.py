"""Benchmark items inside texts, up to an edit budget: pigeonhole pieces and bit-parallel edit distance.

Texts and items are put in lower case, every run of characters other than
letters and digits becomes one space, and a space stands at either end. An item
of ``m`` characters may lie in a text with up to ``m * percent // 100`` edits; it
is cut into one piece more than that, so one piece at least occurs unchanged.
Pieces are found by rolling hashes of the text's bytes and compared byte by byte.
Around each hit the window that an alignment could reach is first held against
the distinct 4-grams that so many edits can destroy, then searched with Myers'
bit-parallel distance; overlapping windows of an item are searched as one.

Items are grouped so that a group has :data:`GROUP_BYTES` of text at most, and
each group is one pass over the texts: what is sent to the tasks is bounded.

Null or wordless texts and items match nothing. Repeated items and rows each
give their own rows. A text is searched as a whole, however long. Of the places
of an item in a text the one of least distance counts, of equals the first.
Empty tables give empty results; other columns play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import bounded_batches, chunks, raw_bytes
from rostrum.llm.words import Powers, mix

PERCENT = 8
GROUP_BYTES = 4 << 20
GRAM = 4
#: Bytes of a piece that are hashed: the largest of these that the piece has.
HASHED = (1, 2, 3, 4, 6, 8, 10, 12, 16, 24, 32, 48, 64)
#: Most bits of the tables that sort out most places.
TABLE = 22
PIECE = 1 << 18
_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normalise(texts: pa.Array) -> pa.Array:
    """Lower case, one space for each run of other characters than letters and digits, a space at either end."""
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts.fill_null("")), r"[^\p{L}\p{N}]+", " "), " ")
    return pc.if_else(pc.equal(plain, ""), plain, pc.binary_join_element_wise(pa.scalar(" ", plain.type), plain, pa.scalar(" ", plain.type), ""))


def distance(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edits that turn ``pattern`` into a part of ``text``, and where the first such part ends.

    ``anchored``: the part starts where ``text`` starts.
    """
    m = len(pattern)
    full, high, low = (1 << m) - 1, 1 << m - 1, int(anchored)
    equal: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        equal[c] |= 1 << i
    plus, minus, now, best, end = full, 0, m, m, 0
    get = equal.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | minus
        xh = ((eq & plus) + plus ^ plus) | eq
        ph = minus | ~(xh | plus)
        mh = plus & xh
        if ph & high:
            now += 1
        elif mh & high:
            now -= 1
            if now < best:
                best, end = now, j + 1
        ph = ph << 1 | low
        plus = (mh << 1 | ~(xv | ph)) & full
        minus = ph & xv & full
    return best, end


class Items:
    """The pieces of a group of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        texts = normalise(pa.array([t for _, t in items], pa.string())).to_pylist()
        self.ids: dict[str, list[int]] = defaultdict(list)
        for (i, _), t in zip(items, texts, strict=True):
            if t:
                self.ids[t].append(i)
        self.texts = list(self.ids)
        self.budget = [len(t) * percent // 100 for t in self.texts]
        self.grams = [{t[i : i + GRAM] for i in range(len(t) - GRAM + 1)} for t in self.texts]
        by_size: dict[int, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for j, t in enumerate(self.texts):
            n = self.budget[j] + 1
            for p in range(n):
                a, z = len(t) * p // n, len(t) * (p + 1) // n
                piece = t[a:z].encode()
                size = max(q for q in HASHED if q <= len(piece))
                by_size[size][piece[:size]].append((piece, j, a))
        self.tables = []
        for size, pieces in sorted(by_size.items()):
            keys = np.array([int(_hashes(np.frombuffer(x, np.uint8), size)[0]) for x in pieces], np.uint64)
            bits = np.uint64(64 - min(TABLE, max(12, len(keys).bit_length() + 7)))
            seen = np.zeros(1 << 64 - int(bits), bool)
            seen[keys >> bits] = True
            order = np.argsort(keys)
            self.tables.append((size, bits, seen, keys[order], [list(pieces.values())[i] for i in order.tolist()]))

    def places(self, data: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """By row and item: the byte where a piece was found, and the piece's first character in the item."""
        out = defaultdict(list)
        for size, bits, seen, keys, pieces in self.tables:
            if len(data) < size:
                continue
            h = _hashes(data, size)
            where = np.flatnonzero(seen[h >> bits])
            k = np.minimum(np.searchsorted(keys, h[where]), len(keys) - 1)
            good = keys[k] == h[where]
            where, k = where[good], k[good]
            rows = np.searchsorted(at, where, side="right") - 1
            for w, key, row in zip(where.tolist(), k.tolist(), rows.tolist(), strict=True):
                for piece, item, first in pieces[key]:
                    if w + len(piece) <= at[row + 1] and data[w : w + len(piece)].tobytes() == piece:
                        out[row, item].append((w, first))
        return out

    def search(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Row, item, distance, begin and end (characters of the normalised text) of each match."""
        texts: dict[int, tuple[str, np.ndarray]] = {}
        for (row, item), found in sorted(self.places(data, at).items()):
            if row not in texts:
                own = data[at[row] : at[row + 1]]
                texts = {row: (own.tobytes().decode(), np.cumsum((own & 0xC0) != 0x80) - 1)}
            text, char = texts[row]
            pattern, k = self.texts[item], self.budget[item]
            spans = sorted({max(0, int(char[w - at[row]]) - first - k) for w, first in found})
            width, best, i = len(pattern) + 2 * k, None, 0
            while i < len(spans):
                start = stop = spans[i]
                while i < len(spans) and spans[i] <= stop + k:
                    stop = spans[i]
                    i += 1
                window = text[start : stop + width]
                own = self.grams[item]
                if len(own) > k * GRAM and len(own.intersection(window[x : x + GRAM] for x in range(len(window) - GRAM + 1))) < len(own) - k * GRAM:
                    continue
                edits, end = distance(pattern, window)
                if edits <= k and (best is None or edits < best[0]):
                    back = distance(pattern[::-1], window[:end][::-1], anchored=True)[1]
                    best = (edits, start + end - back, start + end)
            if best:
                yield row, item, *best


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    up, down = Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[: len(data) - size + 1])


@lru_cache(maxsize=1)
def _loaded(items: tuple, percent: int) -> Items:
    return Items(list(items), percent)


def item_groups(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[tuple]:
    """The items in groups of bounded size (a lone larger item is a group by itself)."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * total // GROUP_BYTES) if total > GROUP_BYTES else 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [tuple((r.id, r.text) for r in rows.where(part == g).orderBy("id", "text").collect()) for g in range(n)]


def contaminations(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text and item that lies in it: ``id_col``, ``item_id``, ``distance``, ``begin``, ``end``.

    ``begin`` and ``end`` count characters of the normalised text.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "item_id", "distance", "begin", "end"]

    def finder(group: tuple):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _loaded(group, percent)
            for b in chunks(batches, "_text", PIECE):
                found = [(row, i, d, s, e) for row, item, d, s, e in items.search(*raw_bytes(normalise(b.column(1)))) for i in items.ids[items.texts[item]]]
                if found:
                    row, *rest = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in rest)], names)

        return run

    rows = docs.select(id_col, F.col(text_col).alias("_text"))
    out = None
    for group in item_groups(benchmark):
        one = rows.mapInArrow(finder(group), f"`{id_col}` {kind}, item_id long, distance long, begin long, end long")
        out = one if out is None else out.union(one)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    bounded_batches(docs.sparkSession)
    position = docs.columns.index(text_col)
    out = docs

    def keeper(group: tuple):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _loaded(group, percent)
            for b in chunks(batches, position, PIECE):
                clean = np.ones(b.num_rows, bool)
                clean[[row for row, *_ in items.search(*raw_bytes(normalise(b.column(position))))]] = False
                yield b.filter(pa.array(clean))

        return run

    for group in item_groups(benchmark):
        out = out.mapInArrow(keeper(group), docs.schema)
    return out
