"""Problem 1: records that share most of their content although lines or words differ.

HyperMinHash sketches: each bucket keeps, of the smallest hash among a record's words (a word that comes again
is another element), the count of leading zeros (4 bits) and the mantissa bits that follow (4 bits). Each bucket
has a hash function of its own, so that short records leave none empty. The smallest elements of up to six further
buckets form a band, fewer where together they are nearly as rare as one record in all; records that agree in a band
are candidates. All words enter, each drawn alike: records of which 70 % of the words agree have a Jaccard similarity
of 0.7 / 1.3 at least, however often their words occur elsewhere. The similarity estimated from the registers, corrected for the
agreements that compression brings by chance, drops most false candidates; the rest are verified on the words themselves.

Equal records (same words, as often) are one class: only its representative is sketched and compared. A band that
more than HOT records share is compared in squares of HOT by HOT, which are tasks' work one by one.

Defined results: records without words (null, empty or blank text) are in no pair; letter case, punctuation and
order don't matter; repeated words count as often as they occur; texts of any length are used whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.plans.shared import drop_materialised, materialise, spread

WORD = re.compile(r"[^\W_]+")
BANDS, ROWS, MANTISSA = 40, 6, 4
#: Bits by which a band may be less rare than one record in all: so many false candidates of a band as its power of two.
SLACK = 2
#: Buckets whose compressed registers are kept for the estimate.
KEPT = 64
#: Words in at most this share of the records, or in FEW records, count as equally rare; FEW is the larger of both below 40,000 records.
#: The number of other words, which is broadcast, is at most the mean count of distinct words divided by this share.
COMMON, FEW = 0.0005, 20
#: The share of their words that records must have in common.
SHARE = 0.7
#: What an agreement of 70 % of the words guarantees, 0.7 / 1.3, less five standard errors of KEPT registers.
ESTIMATE = 0.22
#: Bytes of a band's key; steps to which the logarithm of a record's length is rounded for the first test of lengths.
KEY_BYTES, STEPS, HOT = 5, 8, 1000
#: Letters that old and new spelling exchange; sketches see the second form, verification never does.
SPELLINGS = {"å": "a", "æ": "e", "ä": "e", "ø": "o", "ö": "o", "w": "v", "q": "k", "c": "k", "z": "s", "j": "i", "y": "i", "ÿ": "i"}
FOLDED = str.maketrans(SPELLINGS)
DOUBLED = re.compile(r"(.)\1+|ae|oe")
MEMO, MASK = 300_000, (1 << 64) - 1


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def fold(word: str) -> str:
    """A word's form in sketches: without marks, doubled letters and differences of spelling."""
    word = unicodedata.normalize("NFKC", word).translate(FOLDED)
    return DOUBLED.sub(lambda m: {"ae": "e", "oe": "o"}.get(m[0], m[0][0]), word)


class Hasher:
    """Hashes of a word as it is and in its folded form, remembered up to a bound."""

    def __init__(self) -> None:
        self.plain: dict[str, int] = {}
        self.folded: dict[str, int] = {}

    def learn(self, found: list[str]) -> None:
        if len(self.plain) > MEMO:
            self.plain, self.folded = {}, {}
        for w in set(found).difference(self.plain):
            self.plain[w] = xxhash.xxh3_64_intdigest(w)
            self.folded[w] = xxhash.xxh3_64_intdigest(fold(w)) >> 1

    def __call__(self, found: list[str]) -> list[int]:
        self.learn(found)
        return list(map(self.folded.__getitem__, found))

    def bags(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each list that depend on its words and how often they occur, not on their order; no list is empty."""
        flat: list[int] = []
        for words_ in found:
            self.learn(words_)
            flat += map(self.plain.__getitem__, words_)
        hashes = np.array(flat, dtype=np.uint64)
        starts = np.concatenate([[0], np.cumsum([len(w) for w in found])[:-1]]).astype(np.int64)
        with np.errstate(over="ignore"):
            return tuple(np.add.reduceat(h, starts).view(np.int64) for h in (hashes, hashes * (hashes >> np.uint64(7) | np.uint64(1))))


def mixed(hashes: np.ndarray, b: int) -> np.ndarray:
    """The hash function of bucket b."""
    with np.errstate(over="ignore"):
        h = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * b * 0x51ED270B)
        np.bitwise_xor(h, h >> np.uint64(32), out=h)
        h *= np.uint64(0xD6E8FEB86659FD93 + 4 * b)
    return h


def compressed(low: np.ndarray) -> np.ndarray:
    """Registers of smallest hashes. One byte: leading zeros, then mantissa."""
    lead = np.minimum(63 - np.floor(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64), 15)
    keep = np.where(lead < 15, low << (lead + 1).astype(np.uint64), low << np.uint64(15))
    return (lead << MANTISSA).astype(np.uint8) | (keep >> np.uint64(64 - MANTISSA)).astype(np.uint8)


def registers(hashes: np.ndarray, starts: np.ndarray, buckets: int = KEPT) -> np.ndarray:
    """Registers of each record; its element hashes begin at starts."""
    return np.stack([compressed(np.minimum.reduceat(mixed(hashes, b), starts)) for b in range(buckets)], axis=1)


def band_hashes(hashes: np.ndarray, starts: np.ndarray, rarity: np.ndarray, enough: int) -> np.ndarray:
    """Keys of each record's bands. A band takes smallest elements until their rarity adds up to enough bits."""
    n, sizes = len(starts), np.diff(np.append(starts, len(hashes)))
    keys = np.empty((n, BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key, bits, left = np.full(n, band + 1, dtype=np.uint64), np.zeros(n, dtype=np.int64), np.arange(n)
        h, rare, at = hashes, rarity, starts
        for row in range(ROWS):
            if row:
                left = np.flatnonzero(bits < enough)
                if not len(left):
                    break
                if 3 * len(left) < n:  # of bands that few records go on with, only these are hashed
                    inside = np.repeat(bits < enough, sizes)
                    h, rare, at = hashes[inside], rarity[inside], np.concatenate([[0], np.cumsum(sizes[left])[:-1]])
            drawn = mixed(h, KEPT + band * ROWS + row)
            np.bitwise_and(drawn, np.uint64(MASK - 15), out=drawn)  # the lowest 4 bits are the element's rarity
            np.bitwise_or(drawn, rare, out=drawn)
            low = np.minimum.reduceat(drawn, at)
            low = low if len(low) == len(left) else low[left]
            with np.errstate(over="ignore"):
                more = (key[left] ^ low) * np.uint64(0x9E3779B97F4A7C15)
            key[left] = more ^ more >> np.uint64(29)
            bits[left] += (low & np.uint64(15)).astype(np.int64)
        with np.errstate(over="ignore"):
            keys[:, band] = key * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - 8 * KEY_BYTES)
    return keys


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two disjoint sets of n and m elements agree, by the cells of equal registers."""
    k = 1 << MANTISSA
    edges = np.concatenate([[0.0], *(2.0 ** -(z + 1) * (1 + np.arange(k) / k) for z in range(14, -1, -1)), [1.0]])
    left = lambda c: (1 - edges[None, :]) ** c[:, None]
    p, q = (-np.diff(left(x.astype(np.float64)), axis=1) for x in (n, m))
    return (p * q).sum(axis=1)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two matrices of registers, corrected for chance agreement."""
    by_chance = chance(n, m)
    return np.clip(((a == b).mean(axis=1) - by_chance) / (1 - by_chance), 0, 1)


def census(texts: DataFrame) -> DataFrame:
    """texts (id, text) -> (id, h1, h2, n) of each record with words: a 128-bit hash of its words and their number; and, with a null id, (h1, n) of words in their sketched form: how many records of a task hold them."""
    names, types = ["id", "h1", "h2", "n"], (pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def rows(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches):
        hasher, seen = Hasher(), Counter()
        for batch in (part for whole in batches for part in (whole.slice(k, 1000) for k in range(0, whole.num_rows, 1000))):
            ids, every = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t and (found := words(t)):
                    ids.append(i)
                    every.append(found)
                    seen.update(set(hasher(found)))
            if ids:
                yield rows(ids, *hasher.bags(every), [len(found) for found in every])
            if len(seen) > MEMO:
                yield rows([None] * len(seen), list(seen), [0] * len(seen), list(seen.values()))
                seen = Counter()
        if seen:
            yield rows([None] * len(seen), list(seen), [0] * len(seen), list(seen.values()))

    return texts.mapInArrow(run, "id long, h1 long, h2 long, n long")


def common_words(counted: DataFrame) -> tuple[dict[int, int], int, int]:
    """({hash: bits of rarity} of the words that more than COMMON of all records with words hold, bounded as said there; the bits of all other words; the bits that a band needs)."""
    total = counted.where("id IS NOT NULL").count()
    few = max(COMMON * total, FEW)
    bits = lambda n: min(max(int(math.log2(max(total, 1) / n)), 0), 15)
    per = counted.where("id IS NULL").groupBy("h1").agg(F.sum("n").alias("n")).where(F.col("n") > few)
    return {r["h1"]: bits(r["n"]) for r in per.collect()}, bits(few), max(math.ceil(math.log2(max(total, 2))) - SLACK, 1)


def sketches(texts: DataFrame, common: tuple[dict[int, int], int, int]) -> DataFrame:
    """(id, n, bands, regs) of each record with words: the number of its words, and the sketch of them."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        hasher, (bits, rare, enough) = Hasher(), shared.value
        for batch in (part for whole in batches for part in (whole.slice(k, 1000) for k in range(0, whole.num_rows, 1000))):
            keep, sizes, flat, rarity = [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t or not (found := words(t)):
                    continue
                times: dict[int, int] = {}
                for h in hasher(found):  # a word that comes again is another element
                    k = times[h] = times.get(h, -1) + 1
                    flat.append((h + k * 0x9E3779B97F4A7C15) & MASK)
                    rarity.append(bits.get(h, rare))
                keep.append(i)
                sizes.append(len(found))
            if keep:
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                hashes = np.array(flat, dtype=np.uint64)
                keys = band_hashes(hashes, starts, np.array(rarity, dtype=np.uint64), enough).view(np.uint8).reshape(len(keep), BANDS, 8)[:, :, :KEY_BYTES]
                binary = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (keys, registers(hashes, starts))]
                yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(sizes, pa.int32()), *binary], ["id", "n", "bands", "regs"])

    return texts.mapInArrow(run, "id long, n int, bands binary, regs binary")


def band_keys(sketched: DataFrame) -> DataFrame:
    """(key, id) of each band: KEY_BYTES of its key, then a byte for the rounded logarithm of the record's length."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.zeros((batch.num_rows * BANDS, 8), dtype=np.uint8)
            keys[:, 1 : KEY_BYTES + 1] = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, KEY_BYTES)
            keys[:, 0] = np.repeat(np.floor(STEPS * np.log2(batch.column(1).to_numpy())).astype(np.uint8), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)[:, 0]), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["key", "id"])

    return sketched.select("id", "n", "bands").mapInArrow(run, "key long, id long")


def shared_bands(bands: DataFrame) -> DataFrame:
    """(a, b, key) from band keys: pairs a < b of a band, its key being null; and, with a null b, each record of a band that more than HOT records share."""
    names, steps = ["a", "b", "key"], math.ceil(-STEPS * math.log2(SHARE)) + 1

    def rows(a, b, key):
        null = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), null if b is None else pa.array(b), null if key is None else pa.array(key)], names)

    def run(batches):
        key, ids, hot = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in (*batches, None):  # rows come sorted by key, and the last band may go on in the next batch
            if batch is not None:
                key, ids = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([ids, batch.column(1).to_numpy()])
            if not len(key):
                continue
            band = key >> 8
            whole = len(band) if batch is None else int(np.searchsorted(band, band[-1]))
            n_hot = int(np.searchsorted(band, hot, "right")) if hot is not None and band[0] == hot else 0
            if n_hot:
                yield rows(ids[:n_hot], None, key[:n_hot])
            first = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            size = np.diff(np.append(first, len(band)))
            big = np.repeat(size > HOT, size)
            big[:n_hot] = False
            if big.any():
                yield rows(ids[big], None, key[big])
            if big[-1] and batch is not None:
                hot = band[-1]
            few = np.repeat((size > 1) & (size <= HOT), size)
            few[whole:] = False
            few[:n_hot] = False
            at = np.flatnonzero(few)
            behind = (np.repeat(first + size, size) - np.arange(len(band)) - 1)[at]
            left = np.repeat(at, behind)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(behind) - behind, behind)
            # lengths were rounded down, so two that differ by log2(1 / SHARE) may differ by a step more
            ok = np.abs((key[left] & 255) - (key[right] & 255)) <= steps
            x, y = ids[left[ok]], ids[right[ok]]
            if len(x):
                yield rows(np.minimum(x, y), np.maximum(x, y), None)
            rest = len(band) if len(band) > whole and (big[-1] or n_hot == len(band)) else whole
            key, ids = key[rest:], ids[rest:]

    return bands.repartition(F.shiftright("key", 8)).sortWithinPartitions("key").mapInArrow(run, "a long, b long, key long")


def band_pairs(found: DataFrame) -> DataFrame:
    """shared_bands -> distinct pairs (a, b), a < b, that agree in a band and can agree by their lengths."""
    within = Window.partitionBy("band")
    every = within.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hot = found.where("b IS NULL").select(F.shiftright("key", 8).alias("band"), (F.col("key") % 256).alias("len"), F.col("a").alias("id"))
    hot = hot.withColumns({"many": F.count("*").over(every), "rank": F.row_number().over(within.orderBy("id"))})
    part, last = ((F.col("rank") - 1) / HOT).cast("int"), ((F.col("many") - 1) / HOT).cast("int")
    left = hot.select("band", "len", "id", part.alias("i"), F.explode(F.sequence(part, last)).alias("j"))
    right = hot.select("band", "len", "id", F.explode(F.sequence(F.lit(0), part)).alias("i"), part.alias("j"))
    alike = F.abs(F.col("x.len") - F.col("y.len")) <= math.ceil(-STEPS * math.log2(SHARE)) + 1
    squares = left.alias("x").join(right.alias("y").hint("merge"), ["band", "i", "j"]).where("x.id < y.id").where(alike)
    return found.where("b IS NOT NULL").select("a", "b").unionByName(squares.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))).distinct()


def candidates(sketched: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs of band_pairs whose estimated similarity is high enough."""
    pairs = band_pairs(found)
    side = lambda x: sketched.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"r_{x}"))
    joined = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").where(F.least("n_a", "n_b") >= SHARE * F.greatest("n_a", "n_b") - 1e-9)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            a, b = (np.frombuffer(b"".join(col[x].to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for x in ("r_a", "r_b"))
            ok = estimate(a, b, col["n_a"].to_numpy(), col["n_b"].to_numpy()) >= ESTIMATE
            yield pa.RecordBatch.from_arrays([col["a"], col["b"]], ["a", "b"]).filter(pa.array(ok))

    return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of which at least SHARE of the words agree, counted with repetition, with that share."""
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t_{x}"))
    joined = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")

    def run(batches):
        for batch in batches:
            a, b, ta, tb = (batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("a", "b", "t_a", "t_b"))
            rows, last, left = [], None, Counter()
            for i, j, s, t in zip(a, b, ta, tb):
                if i != last:
                    last, left = i, Counter(words(s))
                right = Counter(words(t))
                common, most = sum((left & right).values()), max(left.total(), right.total())
                if common >= SHARE * most - 1e-9:
                    rows.append((i, j, common / most))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "agree"])

    return joined.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long, agree double")


def near_duplicates(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts (id, text) -> (class pairs (a, b, agree) between representatives, members (id, rep))."""
    counted = materialise(census(texts), "census")
    common = common_words(counted)
    records = counted.where("id IS NOT NULL").select("id", "h1", "h2")
    reps = records.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = materialise(records.join(reps, ["h1", "h2"]).select("id", "rep"), "members")
    # a table of its own, so that Spark knows its size when it chooses between sending it and shuffling the texts
    copies = materialise(members.where("id <> rep").select("id"), "copies")
    sketched = materialise(sketches(texts.join(copies, "id", "left_anti"), common), "sketches")
    found = materialise(shared_bands(band_keys(sketched)), "bands")
    pairs = materialise(candidates(sketched, found), "candidates")
    for done in (counted, copies, sketched, found):
        drop_materialised(done)
    return materialise(verified(pairs, texts), "pairs"), members


def poem_texts(poems: DataFrame) -> DataFrame:
    """(id, text): all body lines of each poem."""
    lines = F.expr("filter(body.text, x -> x IS NOT NULL)")
    return spread(poems.select(F.col("poem_no").alias("id"), F.array_join(lines, "\n").alias("text")))


def all_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of rows: of linked classes, and within a class."""
    left = members.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    right = members.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    across = pairs.select("a", "b").join(left, "a").join(right, "b")
    within = left.join(right, F.col("a") == F.col("b")).where("x < y")
    return across.select("x", "y").unionByName(within.select("x", "y")).select(F.least("x", "y").alias("poem_a"), F.greatest("x", "y").alias("poem_b"))
