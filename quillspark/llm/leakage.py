"""Problem 8: passages of evaluation texts inside a corpus, whole or in part.

Q-gram lemma filtering on letter streams. A text's stream has its letters only, in lower case and in one
spelling of å, ø and æ, so that layout, punctuation, markup, numbering and hyphenation between or inside words
don't count. The q-grams of all items are indexed with their positions, but for those that many items share;
each item's threshold is what the lemma leaves of its indexed q-grams: the fewest in any run of the given number
of words, or, of the words that must be kept, when the edits are spread evenly. The q-grams which a document
shares with an item are counted by overlapping bands of diagonals (place in the document less place in the
item); regions that reach the threshold are verified by an alignment of words that is bound to the region. Text put
between the words, however much, moves the diagonal from band to band: where no region holds the item, the hits of
all bands are chained, the most that follow each other in document and item alike, and a chain that reaches the
threshold is verified by an alignment whose band follows it: of a document's words only those near the chain, or
between two of its hits that lie about as far apart in the item, are aligned.

The items are a stated query set of bounded size: their index is broadcast, in blocks of at most BLOCK letters,
and every document passes all blocks.

Defined results: null, empty and blank texts hold nothing; items without words are never found; repeated
documents and items each get their rows; documents of any length are searched whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.plans.shared import spread

Q, SHARED, BAND, LEAST, MOST = 9, 4, 96, 6, 10
RUN, KEPT = 12, 2 / 3
BLOCK = 8_000_000
INVISIBLE = re.compile("[­͏؜᠎​-‏⁠-⁤﻿︀-️]")
MARKUP = re.compile(r"<[^<>\n]{1,200}>|&(?:[a-zA-Z]{2,8}|#\d{1,6});")
HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*\n\s*(?=[^\W\d_])")
WORD, LETTERS = re.compile(r"[^\W_]+"), re.compile(r"[\W\d_]+")
# Spellings that count as one.
SPELLINGS = (("aa", "å"), ("ae", "æ"), ("oe", "ø"), ("ö", "ø"), ("ä", "æ"))
TABLE = 22


def clean(text: str) -> str:
    text = unicodedata.normalize("NFKC", HYPHEN.sub("", MARKUP.sub(" ", INVISIBLE.sub("", text)))).lower()
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    return text


def codes(streams: list[str]) -> np.ndarray:
    """Code points of the streams in a row, each followed by Q zeros."""
    gap = "\0" * Q
    return np.frombuffer((gap.join(streams) + gap).encode("utf-32-le", "replace"), dtype="<u4")


def grams(points: np.ndarray) -> np.ndarray:
    """Hash of the q-gram that begins at each place."""
    n = len(points) - Q + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(Q):
            h = h * np.uint64(0x100000001B3) + points[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Items:
    """Index of a block of items."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        cleaned = [clean(t) for t in texts]
        keep = [k for k, c in enumerate(cleaned) if WORD.search(c)]
        self.ids = [ids[k] for k in keep]
        self.words = [WORD.findall(cleaned[k]) for k in keep]
        self.masks: list[dict[str, int]] = []
        for words in self.words:
            mask: dict[str, int] = {}
            for k, w in enumerate(words):
                mask[w] = mask.get(w, 0) | 1 << k
            self.masks.append(mask)
        bare = [[LETTERS.sub("", w) for w in words] for words in self.words]
        self.streams = ["".join(b) for b in bare]
        self.runs = [list(dict.fromkeys("".join(b[k : k + RUN]) for k in range(len(b) - RUN + 1))) for b in bare]
        points = codes(self.streams)
        h = grams(points)
        starts = np.concatenate([[0], np.cumsum([len(s) + Q for s in self.streams])]).astype(np.int64)
        owner = np.repeat(np.arange(len(self.streams)), np.diff(starts))[: len(h)]
        place = np.arange(len(h)) - starts[owner]
        lengths = np.array([len(s) for s in self.streams], dtype=np.int64)
        whole = place <= lengths[owner] - Q
        h, owner, place = h[whole], owner[whole], place[whole]
        pairs = np.unique(np.stack([h, owner.astype(np.uint64)]), axis=1)
        values, counts = np.unique(pairs[0], return_counts=True)
        rare = counts[np.searchsorted(values, h)] <= SHARED
        self.need = np.full(len(self.streams), LEAST, dtype=np.int64)
        for i, b in enumerate(bare):
            mine = owner == i
            need = self._need(b, np.sort(place[mine & rare]))
            if need < LEAST:  # what the item shares with many others is all it has
                rare[mine] = True
                need = self._need(b, np.sort(place[mine]))
            self.need[i] = max(1, min(need, MOST))
        order = np.argsort(h[rare], kind="stable")
        self.h, self.owner, self.place = h[rare][order], owner[rare][order].astype(np.int64), place[rare][order]
        self.keys, self.first, self.count = np.unique(self.h, return_index=True, return_counts=True)
        self.seen = np.zeros(1 << TABLE, dtype=bool)
        self.seen[(self.keys & np.uint64((1 << TABLE) - 1)).astype(np.int64)] = True
        self.lengths = lengths

    @staticmethod
    def _need(bare: list[str], places: np.ndarray) -> int:
        """The fewest indexed q-grams in a passage that must be found."""
        ends = np.concatenate([[0], np.cumsum([len(w) for w in bare])])
        inside = lambda a, b: int(np.searchsorted(places, ends[b] - Q, "right") - np.searchsorted(places, ends[a])) if ends[b] - Q >= ends[a] else 0
        n = len(bare)
        least = min((inside(k, k + RUN) for k in range(n - RUN + 1)), default=1 << 30)
        step = 3
        return min(least, *(sum(inside(k, min(k + step - 1, n)) for k in range(f, n, step)) for f in range(step)))

    def hits(self, streams: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, place in the document, place in the item) of each shared indexed q-gram."""
        h = grams(codes(streams))
        maybe = np.flatnonzero(self.seen[(h & np.uint64((1 << TABLE) - 1)).astype(np.int64)])
        at = np.searchsorted(self.keys, h[maybe])
        at[at == len(self.keys)] = 0
        real = self.keys[at] == h[maybe] if len(self.keys) else np.zeros(0, bool)
        maybe, at = maybe[real], at[real]
        many = self.count[at]
        where = np.repeat(maybe, many)
        entry = np.repeat(self.first[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        starts = np.concatenate([[0], np.cumsum([len(s) + Q for s in streams])]).astype(np.int64)
        doc = np.searchsorted(starts, where, "right") - 1
        return doc, self.owner[entry], where - starts[doc], self.place[entry]

    def regions(self, streams: list[str]) -> dict[tuple[int, int], tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
        """(document, item) -> places in the document's stream between which the item's passage may lie; the places of all hits in document and item. Only those that have hits enough."""
        doc, item, there, here = self.hits(streams)
        if not len(doc):
            return {}
        order = np.lexsort((-here, there, item, doc))
        doc, item, there, here = doc[order], item[order], there[order], here[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]))
        size = np.diff(np.concatenate([new, [len(doc)]]))
        out = {}
        for k in np.flatnonzero(size >= self.need[item[new]]):
            i, t, h = int(item[new[k]]), there[new[k] : new[k] + size[k]], here[new[k] : new[k] + size[k]]
            spans = []
            for offset in (0, BAND // 2):  # bands overlap by half
                band = (t - h + (1 << 22) + offset) // BAND
                by = np.argsort(band, kind="stable")
                b, u = band[by], t[by]
                first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
                n = np.diff(np.concatenate([first, [len(b)]]))
                spans += [(int(u[first[x]]), int(u[first[x] + n[x] - 1]) + Q) for x in np.flatnonzero(n >= self.need[i])]
            pad = int(self.lengths[i]) // 2 + 2 * BAND
            merged: list[list[int]] = []
            for a, b_ in sorted(spans):
                if merged and a - pad <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b_ + pad)
                else:
                    merged.append([a - pad, b_ + pad])
            out[int(doc[new[k]]), i] = [(max(a, 0), b_) for a, b_ in merged], t, h
        return out

    def chain(self, i: int, there: np.ndarray, here: np.ndarray) -> list[tuple[int, int]]:
        """Parts of the document's stream along the longest chain of hits, [] for a chain under the threshold."""
        tails: list[int] = []
        last: list[int] = []
        before = np.full(len(here), -1, dtype=np.int64)
        for k, place in enumerate(here.tolist()):  # by place in the document, so the chain is the longest increasing run of places in the item
            at = bisect_left(tails, place)
            before[k] = last[at - 1] if at else -1
            tails[at : at + 1], last[at : at + 1] = [place], [k]
        if len(tails) < self.need[i]:
            return []
        links, k = [], last[-1]
        while k >= 0:
            links.append((int(there[k]), int(here[k])))
            k = before[k]
        links.reverse()
        parts = [[max(links[0][0] - links[0][1] - BAND, 0), links[0][0] + Q]]
        for (t, h), (u, g) in zip(links, links[1:]):
            gap = g - h + BAND // 2
            if u - t <= 2 * gap:
                parts[-1][1] = u + Q
            else:
                parts[-1][1] = max(parts[-1][1], t + gap + Q)
                parts.append([u - gap, u + Q])
        parts[-1][1] += int(self.lengths[i]) - links[-1][1] + BAND
        return [(a, b) for a, b in parts]

    def holds(self, i: int, words: list[str], stream: str) -> bool:
        """Whether a region's words hold enough of item i."""
        if any(run in stream for run in self.runs[i]):
            return True
        m, masks = len(self.words[i]), self.masks[i]
        full = (1 << m) - 1
        v = full
        for w in words:  # longest common subsequence of words, by bits
            if (x := masks.get(w)) is not None:
                u = v & x
                v = (v + u | v - u) & full
        return m - v.bit_count() >= KEPT * m - 1e-9

    def search(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(number of the text, item id) of every text that holds an item."""
        rows = [k for k, t in enumerate(texts) if t]
        cleaned = [clean(texts[k]) for k in rows]
        streams = [LETTERS.sub("", c) for c in cleaned]
        out, split = [], {}
        for (d, i), (spans, there, here) in sorted(self.regions(streams).items(), key=lambda x: x[0]):
            if d not in split:
                words = WORD.findall(cleaned[d])
                split = {d: (words, np.cumsum([len(LETTERS.sub("", w)) for w in words]))}
            words, ends = split[d]
            between = lambda a, b: words[np.searchsorted(ends, a) : np.searchsorted(ends, b, "right") + 1]  # noqa: E731, B023
            if any(self.holds(i, between(a, b), streams[d][a : b + Q]) for a, b in spans):
                out.append((rows[d], self.ids[i]))
            elif parts := self.chain(i, there, here):
                near, done = [], 0
                for a, b in parts:
                    lo, hi = max(int(np.searchsorted(ends, a)), done), int(np.searchsorted(ends, b, "right")) + 1
                    near += words[lo:hi]
                    done = max(done, hi)
                if self.holds(i, near, ""):
                    out.append((rows[d], self.ids[i]))
        return out


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id) of every document and item of which it holds enough."""
    spark = docs.sparkSession
    rows = spread(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where("trim(text) <> ''"))

    def block(held: list) -> DataFrame:
        index = spark.sparkContext.broadcast(Items([r["id"] for r in held], [r["text"] for r in held]))

        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    ids = part.column(0).to_pylist()
                    found = index.value.search(part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k, _ in found], pa.int64()), pa.array([i for _, i in found], pa.int64())], ["doc_id", "item_id"])

        return rows.mapInArrow(run, "doc_id long, item_id long")

    out, held, letters = None, [], 0
    query = items.select(F.col(item_key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("trim(text) <> ''").orderBy("id")
    for r in query.toLocalIterator():  # the query set, block by block
        held.append(r)
        letters += len(r["text"])
        if letters >= BLOCK:
            out = block(held) if out is None else out.unionByName(block(held))
            held, letters = [], 0
    if held or out is None:
        out = block(held) if out is None else out.unionByName(block(held))
    return out
