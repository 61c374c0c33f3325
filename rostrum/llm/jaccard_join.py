"""Similarity self-join of texts on the Jaccard similarity of their word shingles, by adaptive prefixes.

All sets are put in one order, rare shingles first. A set of ``n`` shingles
whose partners must share at least ``a`` of them keeps its first ``n - a + l``
shingles, its *l-prefix*; two sets that are similar share at least ``l`` shingles
of their l-prefixes. Each set chooses its ``l`` by estimated cost: a longer
prefix is dearer to scan but asks for more shared shingles before a pair is
verified. A pair is held to the smaller ``l`` of the two.

* Order and cost rest on a table of :data:`BUCKETS` counts of hashed shingles over
  all texts (a fixed size, so it is broadcast): what a count has above the mean
  marks the shingles of common passages.
* Equal sets form a class from the start; only classes are compared.
* Shingles that one class alone has in its prefix are dropped by a minimum and a
  maximum per shingle, combined before the shuffle; a table of :data:`BITS` bits
  that marks the others keeps most entries from being shuffled a second time.
* Each class is first compared with one hub: of every shingle the class with most
  shared entries, of these the one it meets most often. Linked classes merge; classes
  whose hubs are in one component are a family. Pairs within one component are done.
* What is left between components is joined in full. Across families, pairs meet at
  the shingles of their prefixes. Within a family, which shares most of its shingles,
  the members outside its largest component are compared with all others: both sides
  are cut into blocks of bounded size, and in each pair of blocks the same
  prefix condition decides which pairs are verified.
* Verification is exact. Sets travel once for each block of partners, are compared in
  a stream, and only links leave a task. No link between components is lost.

Texts without words have empty sets and link with nothing, as do null texts; a
text of fewer words than a shingle gives its whole sequence. Rows of null id take
part in no link and keep a null component. Rows that share an id are
one node, whatever their texts.
Repeated rows stay rows. Ids are 64-bit integers. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.components import connected_components
from rostrum.llm.runtime import bit_table, bounded_batches, chunks, discard, has_bit, materialise, raw_bytes
from rostrum.llm.words import distinct, shingles, words

#: Counts in the table of shingle frequencies.
BUCKETS = 1 << 16
#: Longest extension of a prefix.
LONGEST = 8
#: Bits of the table that marks shared shingles, and most bits of that of the texts that a verification needs (powers of two).
BITS, TEXT_BITS = 1 << 22, 1 << 27
#: Shingles of the outsiders of a family that a task holds at most (on average), and of the members that it reads at least.
HELD, BLOCK = 1 << 21, 1 << 17
#: How far apart the marks of equal places in different partitions lie.
SPREAD, LOW = 1_000_003, (1 << 33) - 1
#: Partners that one copy of a set serves.
PARTNERS = 256


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and shingle sets (ascending hashes) of bounded pieces of the batches."""
    for b in chunks(batches, "text"):
        data, at = raw_bytes(b.column(1))
        hashes, _, _, rows = words(data, at)
        all_, cut = shingles(hashes, rows, size)
        yield b.column(0), [distinct(all_[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _class(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def signatures(docs: DataFrame, size: int, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """One pass over all rows.

    First ``id``, ``n`` (distinct shingles) and ``cls`` (equal for equal sets, null
    for empty ones) of every row; then how far the count of each bucket of shingles
    lies above what chance gives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for ids, sets in _sets(batches, size):
            total += np.bincount((np.concatenate(sets) >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(map(len, sets), pa.int64()), pa.array([_class(x) if len(x) else None for x in sets], pa.int64()), none], ["id", "n", "cls", "bucket"])
        at = np.flatnonzero(total)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(total[at]), none, pa.array(at, pa.int64())], ["id", "n", "cls", "bucket"])

    both = materialise(_texts(docs, id_col, text_col).mapInArrow(run, "id long, n long, cls long, bucket long"), "signatures")
    table = np.zeros(BUCKETS, np.int64)
    for bucket, n in both.where("bucket is not null").groupBy("bucket").agg(F.sum("n")).collect():  # BUCKETS rows at most
        table[bucket] = n
    middle = np.median(table)
    return both.where("bucket is null").drop("bucket"), np.maximum(table - middle - 4 * np.sqrt(middle), 0).astype(np.float64)


def required(n: np.ndarray | int, percent: int):
    """Shingles that a set of ``n`` must share with any similar one."""
    return -(-percent * n // 100)


def prefix(own: np.ndarray, excess: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a set: its shingles, the least ``l`` of which each is part, and the chosen ``l``."""
    n = len(own)
    need = int(required(n, percent))
    common = excess[(own >> np.uint64(48)).astype(np.int64)]
    order = np.lexsort((own, np.ceil(np.log2(1 + common))))
    cost = 1 + common[order]
    most = min(LONGEST, need)
    scan = np.cumsum(cost[: n - need + most])[n - need :]
    ell = 1 + np.arange(most)
    #: pairs that share l of these shingles, each verified by a pass over the set
    chosen = int(np.argmin(scan + scan / ell**2 * (1 + n / 64))) + 1
    keep = n - need + chosen
    return own[order[:keep]], np.maximum(1, np.arange(1, keep + 1) - (n - need)), chosen


def entries(docs: DataFrame, size: int, percent: int, excess: np.ndarray, marks: bytes | None = None, *, id_col: str, text_col: str) -> DataFrame:
    """Prefix entries, of marked shingles only if marks are given: ``token``, ``cls``, and in one number ``n``, level and ``l``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, size):
            known = ids.is_valid().to_pylist()
            token, cls, info = [], [], []
            for ok, own in zip(known, sets, strict=True):
                if ok and len(own):
                    t, level, ell = prefix(own, excess, percent)
                    info.append(len(own) * 256 + level * 16 + ell)
                    token.append(t)
                    cls.append(np.full(len(t), _class(own)))
            if token:
                token, cls, info = np.concatenate(token), np.concatenate(cls), np.concatenate(info)
                if marks is not None:
                    kept = has_bit(marks, token % np.uint64(BITS))
                    token, cls, info = token[kept], cls[kept], info[kept]
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(cls), pa.array(info)], ["token", "cls", "info"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "token long, cls long, info long")


def _wanted_sets(docs: DataFrame, wanted: DataFrame, size: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``items`` (the set's hashes, ascending, as bytes) of the wanted ids and of a few others: those that share a mark with one.

    The marks are about eight bits for each wanted id, up to :data:`TEXT_BITS`.
    """
    bits = min(TEXT_BITS, max(1 << 20, 1 << (8 * wanted.count()).bit_length()))
    #: ids may count on within partitions from multiples of 2^33: both parts enter the mark
    marks, _ = bit_table(wanted, F.pmod(F.col("id").bitwiseAND(F.lit(LOW)) + F.shiftright("id", 33) * SPREAD, F.lit(bits)), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def some() -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(b.column(0).is_valid())
                if b.num_rows:
                    b = b.filter(pa.array(has_bit(marks, _mark(b.column(0).to_numpy().astype(np.int64), bits))))
                    if b.num_rows:
                        yield b

        for ids, sets in _sets(some(), size):
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "items"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "id long, items binary")


def _mark(ids: np.ndarray, bits: int) -> np.ndarray:
    return ((ids & LOW) + (ids >> 33) * SPREAD & (bits - 1)).astype(np.uint64)


def common(own: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of an ascending set with others."""
    at = np.cumsum([0, *map(len, sets)])
    if not len(own) or not at[-1]:
        return np.zeros(len(sets), np.int64)
    items = np.concatenate(sets)
    total = np.append(0, np.cumsum(own[np.minimum(np.searchsorted(own, items), len(own) - 1)] == items))
    return total[at[1:]] - total[at[:-1]]


def to_verify(pairs: DataFrame) -> DataFrame:
    """The roles of nodes in the verification of ``pairs`` (``a``, ``b``): ``id`` is wanted in the block ``block`` of ``a``, as ``b`` or (null) as ``a`` itself."""
    load = pairs.groupBy("a").agg(F.count("*").alias("load"))
    blocks = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / PARTNERS)).alias("block"), "b")
    return blocks.select(F.col("b").alias("id"), "a", "block", "b").union(blocks.select(F.col("a").alias("id"), "a", "block", F.lit(None).cast("long").alias("b")).distinct())


def verify(roles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a`` and ``b`` of :func:`to_verify` that link.

    The set of ``a`` is sent once for each block of its partners and meets theirs one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre = None, []
        for batch in batches:
            found = []
            for a, block, b, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (a, block):
                    now, centre = (a, block), []
                own = np.frombuffer(items, np.uint64)
                if b is None:
                    centre.append(own)
                    continue
                both = common(own, centre)
                if any(100 * k >= percent * (len(own) + len(x) - k) for k, x in zip(both.tolist(), centre, strict=True)):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    ordered = sets.join(roles, "id").select("a", "block", "b", "items").repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, size: int, percent: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of
    ``size``-word shingles; the component is the smallest id reachable by links.
    """
    bounded_batches(docs.sparkSession)
    by = {"id_col": id_col, "text_col": text_col}
    rows, excess = signatures(docs, size, **by)
    classes = materialise(rows.where("cls is not null and id is not null").groupBy("cls").agg(F.min("id").alias("node")), "classes")
    found = entries(docs, size, percent, excess, **by)
    shared = materialise(found.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("token"), "shared")
    marks, _ = bit_table(shared, F.pmod("token", F.lit(BITS)), BITS)
    kept = entries(docs, size, percent, excess, marks, **by).join(shared, "token").distinct().join(classes, "cls")
    kept = kept.select("token", "node", F.shiftright("info", 8).alias("n"), (F.shiftright("info", 4) % 16).alias("level"), (F.col("info") % 16).alias("ell"))
    kept = materialise(kept, "prefixes")
    discard(shared)
    scratch: list[DataFrame] = []

    noded = rows.where("id is not null").join(classes, "cls")
    several = noded.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("id", "a")
    same = materialise(noded.join(several, "id").select("a", F.col("node").alias("b")).distinct(), "same")

    hubs = materialise(_hub_pairs(kept, percent, scratch), "hubs")
    roles = materialise(to_verify(hubs.where("may").select(F.col("hub").alias("a"), F.col("node").alias("b"))), "roles")
    sets = _wanted_sets(docs, roles.select("id").distinct(), size, **by)
    links = materialise(verify(roles, sets, percent).union(same), "links")
    labels = materialise(connected_components(links), "components")

    placed = materialise(_placed(kept.groupBy("node").agg(F.max("n").alias("n")), hubs, labels), "placed")
    pairs = materialise(_across(kept, placed, percent, scratch), "pairs")
    far = materialise(to_verify(pairs), "roles")
    near = materialise(_family_blocks(placed, scratch), "blocks")
    sets = materialise(_wanted_sets(docs, far.select("id").union(near.select("id")).distinct(), size, **by), "sets")
    more = materialise(verify(far, sets, percent).union(_within(near, sets, excess, percent)), "links")
    if not more.isEmpty():
        labels = materialise(connected_components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more)), "components")

    of = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("cls", F.coalesce("component", "node").alias("component"))
    scratch.append(materialise(of, "classes"))
    out = rows.join(scratch[-1], "cls", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
    out = materialise(out, "groups")
    discard(classes, kept, same, hubs, roles, links, placed, pairs, far, near, sets, more, *scratch)
    return out


def drop_near_duplicates(docs: DataFrame, size: int, percent: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest id, null ids last.

    Rows are told apart even where they share an id or have none: of rows that are
    equal one stays, and a text that only shares the id of a near-duplicate stays.
    Texts without words are no one's duplicates and stay.
    """
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")), "rows")
    keys = rows.select("row", F.col("doc").getField(id_col).alias("id"), F.col("doc").getField(text_col).alias("text"))
    groups = similar_groups(keys, size, percent, id_col="row")
    least = groups.join(keys.select("row", "id"), "row").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    return rows.join(least.select(F.col("first.row").alias("row")), "row", "left_semi").select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def _hub_pairs(kept: DataFrame, percent: int, scratch: list[DataFrame]) -> DataFrame:
    """``node``, ``hub`` and ``may``: for each node the hub that it meets most often, if it meets one often enough to be of its family, and whether they may link."""
    load = kept.groupBy("node").agg(F.count("*").alias("load"))
    known = kept.join(load, "node")
    best = known.groupBy("token").agg(F.min(F.struct((-F.col("load")).alias("rank"), "node", "n", "ell")).alias("hub")).select("token", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.ell").alias("hub_ell"))
    best = materialise(best, "best")
    scratch.append(best)
    pairs = kept.join(best, "token").where((F.col("node") != F.col("hub")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")))
    counted = pairs.groupBy("node", "hub").agg(F.count("*").alias("k"), F.min(F.least("ell", "hub_ell")).alias("ell")).where("2 * k >= ell")
    best = counted.groupBy("node").agg(F.max(F.struct("k", F.bitwise_not("hub").alias("hub"), "ell")).alias("best"))
    return best.select("node", F.bitwise_not("best.hub").alias("hub"), (F.col("best.k") >= F.col("best.ell")).alias("may"))


def _placed(nodes: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """``nodes`` with ``comp``, the component of each, and ``family``: that of its hub, or its own."""
    of = labels.select(F.col("id").alias("node"), "component")
    hub = hubs.select("node", "hub").join(of.withColumnRenamed("node", "hub").withColumnRenamed("component", "_c"), "hub", "left").select("node", F.coalesce("_c", "hub").alias("family"))
    out = nodes.join(of, "node", "left").join(hub, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    return out.withColumn("family", F.coalesce("family", "comp")).drop("component")


def _across(kept: DataFrame, placed: DataFrame, percent: int, scratch: list[DataFrame]) -> DataFrame:
    """Pairs of different components and families that share as many shingles as the smaller ``l`` of the two asks for."""
    blocks = kept.join(placed.select("node", "comp", "family"), "node")
    mixed = blocks.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("family").alias("f0"), F.max("family").alias("f1")).where("c0 < c1 and f0 < f1").select("token")
    blocks = materialise(blocks.join(mixed, "token"), "blocks")
    scratch.append(blocks)
    own = ("node", "n", "level", "ell", "comp", "family")
    x, y = (blocks.select("token", *(F.col(c).alias(f"{c}_{side}") for c in own)) for side in "ab")
    ell = F.least("ell_a", "ell_b")
    met = x.join(y, "token").where(
        (F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & (F.col("family_a") != F.col("family_b"))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (F.col("level_a") <= ell) & (F.col("level_b") <= ell)
    )
    return met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.count("*").alias("k"), F.min(ell).alias("ell")).where("k >= ell").select("a", "b")


def _family_blocks(placed: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """The roles of the nodes of families of several components in their comparison.

    Members outside a family's largest component (the outsiders) meet all others:
    outsiders are cut into sides of about :data:`HELD` shingles, members into parts of
    :data:`BLOCK` or as many as a side has, and each part meets each side; so nothing
    is sent more than about twice for each side. Columns: ``id``, ``family``, ``comp``,
    ``part``, ``side``, ``role`` (0: as an outsider, 1: as a member).
    """
    counts = materialise(placed.groupBy("family", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("n")), "counts")
    scratch.append(counts)
    of = counts.groupBy("family").agg(F.max(F.struct("k", "comp", "n")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("comps")).where("comps > 1")
    out = F.col("all") - F.col("main.n")
    of = of.select("family", F.col("main.comp").alias("main"), F.ceil(F.col("all") / F.greatest(F.lit(BLOCK), F.least(out, F.lit(HELD)))).alias("parts"), F.ceil(out / HELD).alias("sides"))
    of = materialise(of, "families")
    scratch.append(of)
    members = placed.join(of, "family")
    part, side = F.pmod(F.xxhash64("node"), F.col("parts")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("sides"))
    every = lambda c, f: F.transform(F.sequence(F.lit(0).cast("long"), F.col(c) - 1), f)
    place = lambda p, s, r: F.struct(p.alias("part"), s.alias("side"), F.lit(r).alias("role"))
    roles = every("sides", lambda x: place(part, x, 1))
    roles = F.when(F.col("comp") != F.col("main"), F.concat(roles, every("parts", lambda x: place(x, side, 0)))).otherwise(roles)
    return members.select(F.col("node").alias("id"), "family", "comp", F.explode(roles).alias("at")).select("id", "family", "comp", "at.*")


def _within(roles: DataFrame, sets: DataFrame, excess: np.ndarray, percent: int) -> DataFrame:
    """Links between different components of a family, from :func:`_family_blocks`; of equal pairs of components a task reports one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, others, seen = None, _Outsiders(excess, percent), set()
        for batch in batches:
            found = []
            for *key, role, node, comp, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    now, others, seen = key, _Outsiders(excess, percent), set()
                own = np.frombuffer(items, np.uint64)
                if role == 0:
                    others.add(node, comp, own)
                    continue
                for a, comp_a in others.links(node, comp, own, seen):
                    seen.add((comp_a, comp))
                    found.append((a, node))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    key = ("family", "part", "side")
    rows = sets.join(roles, "id").select(*key, "role", F.col("id").alias("node"), "comp", "items")
    return rows.repartition(*key).sortWithinPartitions(*key, "role").mapInArrow(run, "a long, b long")


class _Outsiders:
    """Some members of a family, ready to be compared with others of it."""

    def __init__(self, excess: np.ndarray, percent: int):
        self.excess, self.percent = excess, percent
        self.nodes, self.sets, self.token = [], [], None

    def add(self, node: int, comp: int, own: np.ndarray) -> None:
        self.nodes.append((node, comp))
        self.sets.append(own)

    def _index(self) -> None:
        """All prefix entries in the order of their shingles."""
        parts = [prefix(x, self.excess, self.percent) for x in self.sets]
        token, level = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.argsort(token)
        self.token, self.level = token[order], level[order]
        self.owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])[order]
        self.ell, self.n = np.array([p[2] for p in parts]), np.array([len(x) for x in self.sets])
        self.comp = np.array([c for _, c in self.nodes])

    def links(self, node: int, comp: int, own: np.ndarray, seen: set) -> Iterator[tuple[int, int]]:
        """Those of another component that the set links with, by prefixes and then exactly."""
        if not self.nodes or not len(own):
            return
        if self.token is None:
            self._index()
        token, level, ell = prefix(own, self.excess, self.percent)
        low, high = (np.searchsorted(self.token, token, side) for side in ("left", "right"))
        width = high - low
        at = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
        least = np.minimum(self.ell, ell)
        owner = self.owner[at]
        good = (self.level[at] <= least[owner]) & (np.repeat(level, width) <= least[owner])
        met = np.bincount(owner[good], minlength=len(self.nodes)) >= least
        met &= (self.comp != comp) & (100 * np.minimum(self.n, len(own)) >= self.percent * np.maximum(self.n, len(own)))
        chosen = [i for i in np.flatnonzero(met).tolist() if (self.nodes[i][1], comp) not in seen]
        for i, both in zip(chosen, common(own, [self.sets[i] for i in chosen]).tolist(), strict=True):
            if 100 * both >= self.percent * (len(own) + len(self.sets[i]) - both):
                yield self.nodes[i]
