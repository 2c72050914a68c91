"""Problem 7: encoding of a corpus by a public byte-level BPE vocabulary.

Two tiers. A minimal perfect hash over the vocabulary (levels of bit arrays, the index being the rank of
the bit) resolves a pre-token that is a token itself; any other pre-token is merged with a heap over a
linked list of its bytes. The results of distinct pre-tokens are remembered by each worker in a table of
bounded size, so frequent pre-tokens cost one look-up.

Defined results: a null and an empty text both give the empty list; strings of special tokens in a text
are ordinary text; texts of any length are encoded whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import os
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.plans.shared import spread

VOCABULARY = "byte_bpe_50k.tiktoken"
FOLDER = os.environ.get("QUILLSPARK_TOKENIZERS", "/opt/tokenizers")
MEMO = 400_000
# Unicode White_Space, spelled out since Python's \s also has U+001C to U+001F.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
EXACT = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
FAST = rf"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\w{SPACE}]|_)+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def odd_numbers() -> str:
    """Character class of what Python's \\w takes although it is neither a letter nor a decimal digit."""
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalnum() and not (unicodedata.category(ch)[0] == "L" or unicodedata.category(ch) == "Nd"):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


class PerfectHash:
    """Minimal perfect hash: key i is found at the first level whose bit for it was set by it alone."""

    def __init__(self, keys: list[bytes], spare: float = 2.0) -> None:
        left = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        if len(np.unique(left)) != len(keys):
            raise ValueError("two keys have one 64-bit hash")
        self.levels: list[tuple[int, int, np.ndarray]] = []
        before, level = 0, 0
        while len(left):
            size = int(spare * len(left)) + 1
            at = self._place(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.where(alone, np.cumsum(alone) - 1 + before, -1).astype(np.int32)
            self.levels.append((level, size, ranks))
            before += int(alone.sum())
            left = left[~alone[at]]
            level += 1
        slots = self.index(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64))
        self.keys: list[bytes] = [b""] * len(keys)
        self.values = np.zeros(len(keys), dtype=np.int32)
        for i, (slot, key) in enumerate(zip(slots.tolist(), keys)):
            self.keys[slot] = key
            self.values[slot] = i

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (hashes + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15 + 2 * level)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        return (mixed % np.uint64(size)).astype(np.int64)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.arange(len(hashes))
        for level, size, ranks in self.levels:
            if not len(open_):
                break
            got = ranks[self._place(hashes[open_], level, size)]
            out[open_[got >= 0]] = got[got >= 0]
            open_ = open_[got < 0]
        return out

    def find(self, words: list[bytes]) -> list[int]:
        """The position of each word in the list of keys, -1 for other words."""
        slots = self.index(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words)))
        keys, values = self.keys, self.values.tolist()
        return [values[s] if s >= 0 and keys[s] == w else -1 for s, w in zip(slots.tolist(), words)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Byte-pair merges of one pre-token, the lowest rank first and the leftmost of equals first."""
    n = len(piece)
    start, end, after, before = list(range(n)), [i + 1 for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or end[j] != stop or end[i] != start[j]:
            continue
        alive[j] = False
        end[i] = stop
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(piece[start[i] : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[start[h] : stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    return tuple(ranks[piece[start[i] : end[i]]] for i in range(n) if alive[i])


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens by id; a rank file has one base64 token and its id per line."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Encoder:
    """Held once by each Python worker."""

    def __init__(self, table: PerfectHash) -> None:
        import regex

        self.table = table
        self.ranks = dict(zip(table.keys, table.values.tolist()))
        self.fast, self.exact, self.odd = re.compile(FAST), regex.compile(EXACT), re.compile(odd_numbers())
        self.memo: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str) -> list[str]:
        return (self.exact if self.odd.search(text) else self.fast).findall(text)

    def learn(self, words: set[str]) -> None:
        if len(self.memo) + len(words) > MEMO:
            self.memo = {}
        new = [w for w in words if w not in self.memo]
        raw = [w.encode("utf-8", "replace") for w in new]
        for word, piece, found in zip(new, raw, self.table.find(raw)):
            self.memo[word] = (found,) if found >= 0 else merge(piece, self.ranks)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin."""
        pieces = [self.pieces(t) if t else [] for t in texts]
        self.learn(set(itertools.chain.from_iterable(pieces)))
        get = self.memo.__getitem__
        each = [np.fromiter(itertools.chain.from_iterable(map(get, p)), dtype=np.int32) for p in pieces]
        offsets = np.zeros(len(each) + 1, dtype=np.int64)
        np.cumsum([len(e) for e in each], out=offsets[1:])
        return (np.concatenate(each) if each else np.zeros(0, np.int32)), offsets


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, folder: str = FOLDER) -> DataFrame:
    """(key, ids) of every row. What is broadcast is the vocabulary, whose size doesn't depend on the corpus."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(PerfectHash(read_vocabulary(os.path.join(folder, vocabulary))))

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            step = 512
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, offsets = encoder.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["key", "ids"])

    rows = spread(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")
