"""Byte-level BPE encoding and decoding by the rules of a public vocabulary file.

A text is cut at the special tokens, then into pretokens by the usual byte-level
pattern. Each pretoken is merged with a priority queue of merge ranks over a
doubly linked list of symbols: the queue's head is the pair of lowest rank and,
among equals, furthest left; an entry whose pair no longer stands is stale and
is skipped. Decoding joins the byte strings of the vocabulary.

Nulls in the text column count as the empty text: no ids, an empty decoded text.
Very long texts are cut into pretokens one at a time; repeated rows give repeated
rows; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import bounded_batches, chunks, text_list

#: Fixed value: the pattern of byte-level pretokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of which every Unicode version in use says the same: others take the library's own splitter.
SETTLED = regex.compile(r"[\x00-ԯ -⁯₠-₽←-⇿　-ゖ゙-ヿ一-龥가-힣]*+")
#: White space for which pretokens aren't looked for chunk by chunk.
OTHER_SPACE = regex.compile(r"[^\S \n]")
#: Entries of a worker's memory of chunks and of pretokens; beyond, it starts anew.
CACHED = 300_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << 24 | vocab[b], (rank + 1) << 24 | vocab[a + b])
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in (vocab | special).items():
            self.strings[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.special = {k: pack("<I", v) for k, v in special.items()}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pattern = regex.compile(PATTERN)
        self.splitter = None
        self.words: dict[str, bytes] = Memory(self._merge, CACHED)
        self.chunks: dict[str, bytes] = Memory(self._chunk, CACHED)

    def _merge(self, word: str) -> bytes:
        """Ids of one pretoken, as little-endian unsigned 32-bit integers."""
        first, merges = self.first, self.merges
        ids = [first[b] for b in word.encode()]
        n = len(ids)
        # pairs[i]: rank and result of the pair that starts at i now, 0 if there is none; an entry of the queue is stale unless they agree
        pairs = [merges.get(a << 24 | b, 0) for a, b in pairwise(ids)]
        pairs.append(0)
        queue = [(x >> 24) << 32 | i for i, x in enumerate(pairs) if x]
        if not queue:
            return pack(f"<{n}I", *ids)
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            pair = pairs[i]
            if not pair or pair >> 24 != entry >> 32:
                continue
            j = after[i]
            k = after[i] = after[j]
            ids[i] = merged = pair & 0xFFFFFF
            ids[j], pairs[j], pairs[i] = -1, 0, 0
            if k < n:
                before[k] = i
                if found := merges.get(merged << 24 | ids[k], 0):
                    pairs[i] = found
                    heappush(queue, (found >> 24) << 32 | i)
            h = before[i]
            if h >= 0:
                pairs[h] = found = merges.get(ids[h] << 24 | merged, 0)
                if found:
                    heappush(queue, (found >> 24) << 32 | h)
        ids = [x for x in ids if x >= 0]
        return pack(f"<{len(ids)}I", *ids)

    def _pretokens(self, text: str) -> list[str]:
        if text.isascii() or SETTLED.fullmatch(text):
            return self.pattern.findall(text)
        if self.splitter is None:
            from tokenizers import Tokenizer

            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk without a space, preceded by one."""
        return b"".join(map(self.words.__getitem__, self._pretokens(" " + chunk)))

    def _plain(self, text: str) -> bytes:
        """A single space between other characters than white space always starts a pretoken."""
        if not text:
            return b""
        if text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or OTHER_SPACE.search(text):
            return b"".join(map(self.words.__getitem__, self._pretokens(text)))
        first, *rest = text.split(" ")
        return b"".join(map(self.words.__getitem__, self._pretokens(first))) + b"".join(map(self.chunks.__getitem__, rest))

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        return b"".join(self.special[x] if i % 2 else self._plain(x) for i, x in enumerate(self.specials.split(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Ids beyond the vocabulary give nothing; bytes that aren't UTF-8 give the replacement character."""
        n, strings = len(self.strings), self.strings
        try:
            return b"".join(map(strings.__getitem__, ids)).decode("utf-8", "replace")
        except IndexError:
            return b"".join(strings[i] for i in ids if 0 <= i < n).decode("utf-8", "replace")


class Memory(dict):
    """A bounded memory of a function of a short text; beyond ``most`` entries it starts anew."""

    def __init__(self, of: Callable[[str], bytes], most: int):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, key: str) -> bytes:
        out = self.of(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = out
        return out


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The encoder of a file, once per process."""
    return Bpe(path)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (the token ids of the whole text), a row for each row of ``docs``."""
    kind = docs.schema[id_col].dataType
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in chunks(batches, 1):
            ids = [np.frombuffer(bpe.encode_bytes(t), "<u4").astype(np.int32) for t in text_list(b.column(1))]
            ends = np.cumsum([0, *map(len, ids)])
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: the decoded text; null ids count as none."""
    kind = tokens.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], [id_col, "text"])

    return tokens.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass; digests of both, so that no id list leaves the worker.

    Columns: ``id_col``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (of the decoded text in UTF-8).
    """
    kind = docs.schema[id_col].dataType
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in chunks(batches, 1):
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1):
                ids = bpe.encode_bytes(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_col), text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
