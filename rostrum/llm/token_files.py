"""Token ids of whole texts in files of word-aligned blocks, in ascending order of document.

A file holds, little-endian: the magic; blocks of coded ids (:mod:`simple8b`:
words, then escapes); an index with offset, ids, words and escapes of each
block; a table with id, null mark and number of ids of each document; a footer
with the place and length of both. Documents follow each other without gaps, so
a block may hold the end of one and the start of the next.

Tables are dealt by ranges of the id and each range is written to one file; the
files' totals (a row for each file) give each file its place in the whole.

Null texts count as empty, null ids come first, repeated ids stand side by side
in the order of their texts, an empty table gives no file and no row, other
columns are not read. A text is encoded as a whole, however long.
"""

from __future__ import annotations

import os
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm import simple8b
from rostrum.llm.bpe import Memory, byte_letters
from rostrum.llm.runtime import Output, bounded_batches, chunks, fresh_path, materialise, open_input, text_list

MAGIC = b"S8BTOK01"
INDEX = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("words", "<u4"), ("escapes", "<u4")])
DOCS = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])
FOOTER = struct.Struct("<QQQQ8s")
#: Bytes of text of a file on average at most, and at least where there is work for more tasks.
FILE_BYTES, LEAST_BYTES = 256 << 20, 16 << 20
#: Blocks that are decoded at once.
AT_ONCE = 256
#: Entries of a worker's memories of words and of letter runs; beyond, one starts anew.
CACHED = 500_000
#: Letters that are their own normal form, then ASCII punctuation; the latter by itself.
PLAIN = regex.compile(r"([a-zA-ZÀ-ÖØ-öø-įı-ňŊ-ž]+)([!-/:-@\[-`{-~]*)")
PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: Python's split() cuts at these, the tokenizers' white space does not have them.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """The ids of whole texts as a tokenizer of the public library gives them.

    Where the tokenizer drops white space and never looks across it (its splitter
    keeps only matches, none of which can hold white space), words are encoded
    once and remembered; other tokenizers see whole texts. Of a word of plain letters,
    with plain punctuation after it or not, the normaliser only changes the case and
    the splitter only cuts before the punctuation, so the model is asked directly.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("pre_tokenizer") or {}
        first = (steps.get("pretokenizers") or [steps])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        self.by_word = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" and not any(x["lstrip"] or x["rstrip"] or any(c.isspace() for c in x["content"]) for x in spec["added_tokens"])
        letters = {b: c for c, b in byte_letters().items()}
        model = self.tokenizer.model

        def word(w: str) -> bytes:
            return packed([x.id for x in model.tokenize(w if w.isascii() else "".join(map(letters.__getitem__, w.encode())))])

        def chunk(c: str) -> bytes:
            if c.isascii():
                own = c.rstrip(PUNCTUATION)
                if own.isalpha():
                    return words[own.lower()] + words[c[len(own) :]] if len(own) < len(c) else words[own.lower()]
                return self.whole(c)
            m = PLAIN.fullmatch(c)
            if not m:
                return self.whole(c)
            return words[m[1].lower()] + (words[m[2]] if m[2] else b"")

        words = Memory(word, CACHED)
        self.chunks = Memory(chunk, CACHED)

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if not self.by_word or SEPARATORS.search(text):
            return self.whole(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Writer:
    """One file of coded ids; holds at most a few blocks in memory besides 17 bytes for each document."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        self.index, self.ids = [], 0
        self.doc_ids, self.doc_nulls, self.doc_sizes = array("q"), bytearray(), array("Q")
        self.pending, self.held = [], 0
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.doc_nulls.append(doc_id is None)
        self.doc_sizes.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= 4 * simple8b.BLOCK * AT_ONCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data = b"".join(self.pending)
        whole = len(data) if last else len(data) - len(data) % (4 * simple8b.BLOCK)
        for n, words, escapes in simple8b.encode(np.frombuffer(data, "<u4", whole // 4)):
            self.index.append((self.at, n, len(words), len(escapes)))
            self.stream.write(words.astype("<u8").tobytes())
            self.stream.write(escapes.astype("<u8").tobytes())
            self.at += 8 * (len(words) + len(escapes))
        self.pending, self.held = [data[whole:]], len(data) - whole

    def finish(self) -> tuple[int, int]:
        """Documents and ids of the file."""
        self._flush(True)
        index, docs = np.array(self.index, INDEX), np.zeros(len(self.doc_ids), DOCS)
        docs["id"], docs["null"], docs["n"] = self.doc_ids, np.frombuffer(self.doc_nulls, np.uint8), self.doc_sizes
        self.stream.write(index.tobytes())
        self.stream.write(docs.tobytes())
        self.stream.write(FOOTER.pack(self.at, len(index), self.at + index.nbytes, len(docs), MAGIC))
        return len(docs), self.ids


def read_file(uri: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """Documents of a file, in order: id, and its ids in pieces of bounded length."""
    with open_input(uri) as f:
        size = f.size()
        f.seek(size - FOOTER.size)
        index_at, blocks, docs_at, n_docs, magic = FOOTER.unpack(f.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no file of coded ids")
        f.seek(index_at)
        index = np.frombuffer(f.read(blocks * INDEX.itemsize), INDEX)
        f.seek(docs_at)
        docs = np.frombuffer(f.read(n_docs * DOCS.itemsize), DOCS)
        k, held = 0, np.zeros(0, np.uint64)
        for doc_id, null, n in docs.tolist():
            pieces, lacking = [], n
            while True:
                pieces.append(held[:lacking])
                held, lacking = held[lacking:], lacking - len(pieces[-1])
                if not lacking:
                    break
                some = index[k : k + AT_ONCE]
                f.seek(int(some[0]["offset"]))
                data = np.frombuffer(f.read(8 * int(some["words"].sum() + some["escapes"].sum())), "<u8")
                out, at = [], 0
                for _, ids, words, escapes in some.tolist():
                    out.append(simple8b.decode(ids, data[at : at + words], data[at + words : at + words + escapes]))
                    at += words + escapes
                held, k = np.concatenate(out), k + len(some)
            yield (None if null else doc_id), pieces


def write(docs: DataFrame, path: str, *, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, append ``end_id`` to each document and write the files; returns their list.

    Columns: ``file`` (its place among the files), ``uri``, ``n_docs``, ``n_ids``,
    ``start`` (ids of all files before it). ``path``: the tokenizer's file.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = fresh_path(spark, "tokens")
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        part, enc = TaskContext.get().partitionId(), encoder(path)
        uri = f"{folder}/{part:06d}-{uuid.uuid4().hex}.s8b"
        with Output(uri) as stream:
            writer = Writer(stream)
            for b in chunks((x for y in ([first], batches) for x in y), "text", 4 << 20):
                for doc_id, text in zip(b.column(0).to_pylist(), text_list(b.column(1)), strict=True):
                    writer.add(doc_id, enc.encode(text) + tail)
            n_docs, n_ids = writer.finish()
        yield pa.RecordBatch.from_pydict({"part": [part], "uri": [uri], "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-total // FILE_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LEAST_BYTES)), 1)
    first = (F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())
    #: rows of one id, or of none, may be dealt to several files, in the order of their texts
    ranged = rows.repartitionByRange(n, first[0], F.left("text", F.lit(32)).asc_nulls_first()).sortWithinPartitions(*first)
    files = materialise(ranged.mapInArrow(run, "part long, uri string, n_docs long, n_ids long"), "token-files")
    out, start = [], 0
    for i, r in enumerate(files.orderBy("part").collect()):  # a row for each file
        out.append((i, r.uri, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return spark.createDataFrame(out, "file int, uri string, n_docs long, n_ids long, start long")


def read(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each document in files that :func:`write` listed.

    Columns: ``id_col``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (unsigned, of the ids as little-endian unsigned 32-bit integers).
    """
    names = [id_col, "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, pieces in read_file(uri):
                    n, crc = 0, 0
                    for x in pieces:
                        n, crc = n + len(x), zlib.crc32(x.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, start, n, crc))
                    start += n
                    if len(rows) >= 10_000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    spread = files.select("uri", "start").repartition(max(1, files.count()))
    return spread.mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
