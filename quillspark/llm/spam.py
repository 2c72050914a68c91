"""Problem 9: pages of repeated keywords, link lists and product tags.

Texts are cut into blocks of lines, and a block is judged by its compression ratio (deflated bytes per character)
divided by the median ratio of the blocks of the same language and length, a median over the different texts of
all documents, and confirmed by a low density of sentence ends. Before a block is deflated, each address becomes
one character, so a list of links is redundant however its addresses differ, and lines that come again whole count
once, so the refrain of a song is no redundancy; a block of which little is left that way keeps all its lines.

Two measures, both over all documents. The first, plain deflate, finds blocks of extreme redundancy. The words
that many of these share are the preset dictionary of the second deflate, one dictionary per language, so that a
list of tags, too short to repeat itself, is still redundant to the keyword pages of the corpus. The
second ratio, normalised by its own medians, decides. A document is spam if most of its characters stand in such blocks.

Bounds: a median has a lower limit, the ratio of ordinary text of that length (ORDINARY), so that a corpus of little
but spam doesn't become its own measure. Medians are kept for two-letter codes, other codes being one class, and for
21 classes of length; a dictionary has DICTIONARY words of a language and as many of all, cut to deflate's window.

Defined results: null, empty, blank and very short texts (under LEAST_WORDS words) are no case; repeated rows
are judged alike; texts of any length are judged whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.plans.shared import drop_materialised, materialise, spread

BLOCK, LEAST_WORDS, FEW = 300, 8, 8
#: A block of extreme redundancy; a block redundant to the dictionary; most sentence ends per word; the share of a text that must be spam.
EXTREME, REDUNDANT, SENTENCES, MOST = 0.7, 0.75, 0.1, 0.5
DICTIONARY, BLOCKS_OF_WORD, WINDOW = 600, 3, 16_000
LONGEST_SIZE = 20
# Digits written for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
INNER_DIGIT = re.compile(r"[013457](?<=[^\W\d_].)(?=[^\W\d_]|\b)")
MIXED = re.compile(r"[013457](?<=[^\W\d_].)(?=[^\W\d_])")
SPACED = re.compile(r"(?:(?<=\s)|^)\w(?:[ _]\w| _ \w){4,}(?=\s|$)")
MAYBE_SPACED = re.compile(r" (?<=\w )\w \w \w")
DIGITS, BLANKS = re.compile(r"\d+"), re.compile(r"[^\S\n]{2,}|[^\S\n ]")
LINK, MARK = re.compile(r"(?:https?://|www\.)[^\s<>\")\]]+"), "⸱"
TOKEN = re.compile(rf"[^\W\d_]+|{MARK}")
SENTENCE = re.compile(r"[.!?](?<=[^\W\d_]{3}.)(?=[\"»)]?(?:\s|$))")


def _close(m: re.Match) -> str:
    """A spaced-out run as words."""
    return m[0].replace(" ", "").replace("_", " ")


def normal(text: str) -> str:
    """Lower case, letters for the digits that stand for them, spaced-out words closed, numbers as one digit."""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if MAYBE_SPACED.search(text) or "_ " in text:
        text = SPACED.sub(_close, text)
    if MIXED.search(text):
        text = INNER_DIGIT.sub(lambda m: LEET[m[0]], text)
    return BLANKS.sub(" ", DIGITS.sub("0", text))


def blocks(text: str) -> list[str]:
    out, now = [], ""
    for line in text.split("\n"):
        while len(line) > 2 * BLOCK:
            if now:
                out.append(now)
                now = ""
            cut = line.rfind(" ", BLOCK // 2, BLOCK)
            cut = cut if cut > 0 else BLOCK
            out.append(line[:cut])
            line = line[cut:]
        now = f"{now}\n{line}" if now else line
        if len(now) >= BLOCK:
            out.append(now)
            now = ""
    if now.strip():
        if out and len(now) < BLOCK // 3:
            out[-1] += "\n" + now
        else:
            out.append(now)
    return [b for b in out if b.strip()]


def once(block: str) -> str:
    """A block with each line once, if a third of it or more is left."""
    short = "\n".join(dict.fromkeys(block.split("\n")))
    return short if 3 * len(short) >= len(block) else block


def deflated(text: str, start=None) -> int:
    """Bytes of deflate, by a copy of start, a compressor that may know a dictionary."""
    c = start.copy() if start is not None else zlib.compressobj(6, zlib.DEFLATED, -15)
    return len(c.compress(text.encode("utf-8", "replace"))) + len(c.flush())


def sentences(block: str) -> float:
    """Sentence ends per word."""
    return len(SENTENCE.findall(block)) / max(1, len(block.split()))


def language(lang: str | None) -> str:
    code = (lang or "")[:2].lower()
    return code if len(code) == 2 and code.isascii() and code.isalpha() else "?"


def length(n: int) -> int:
    """Class of length of n characters."""
    return min(int(2 * math.log2(max(n, 16))), LONGEST_SIZE)


def ordinary(n: Column | float) -> Column | float:
    """Bytes per character that deflate needs at least for ordinary text of n characters."""
    return 0.85 * (0.42 + 3.5 / n**0.5)


MEASURED = "row long, key long, no int, h long, lang string, size int, chars int, n int, words int, ends double, ratio double, text string"


def measured(docs: DataFrame, key: str) -> DataFrame:
    """A row for each block (no 0 and up), with what deflate sees of it; a text without blocks has a row of number -1."""

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for k, text, lang in zip(*(part.column(i).to_pylist() for i in range(3))):
                    row += 1
                    found = blocks(normal(text)) if text and len(text) >= 2 * LEAST_WORDS else []
                    h, code = (xxhash.xxh3_64_intdigest(text) - (1 << 63), language(lang)) if found else (0, "?")
                    for no, block in enumerate(found):
                        kept = once(block)
                        seen = LINK.sub(MARK, kept) if "://" in kept or "www." in kept else kept
                        words = len(seen.split())
                        if words < LEAST_WORDS:
                            words = len(TOKEN.findall(seen))
                        out.append((row, k, no, h, code, length(len(kept)), len(block), len(kept), words, sentences(seen), round(deflated(seen) / len(kept), 3), seen))
                    if not found:
                        out.append((row, k, -1, 0, "?", 0, 0, 1, 0, 0.0, 0.0, ""))
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in MEASURED.split(", ")])

    rows = docs.select(F.col(key).cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return spread(rows).mapInArrow(run, MEASURED)


def with_median(of: DataFrame, ratio: str) -> DataFrame:
    """Adds middle: the median ratio of the blocks of the same language and length in different texts, not under that of ordinary text."""
    counted = of.where("no >= 0").select("h", "no", "lang", "size", ratio).distinct().groupBy("lang", "size", ratio).agg(F.count("*").alias("n"))
    sets = counted.groupingSets([["lang", "size"], ["size"], []], "lang", "size").agg(F.expr(f"percentile({ratio}, 0.5D, n)").alias("middle"), F.sum("n").alias("blocks"))
    rows = sets.where("blocks > 0").collect()
    # too few blocks of one language and length have no median of their own
    known = {(r["lang"], r["size"]): r["middle"] for r in rows if r["blocks"] >= FEW or r["lang"] is None}
    pairs = {(r["lang"], r["size"]) for r in rows if r["lang"] is not None}
    table = [(lang, size, next((m for k in ((lang, size), (None, size), (None, None)) if (m := known.get(k)) is not None))) for lang, size in sorted(pairs)]
    medians = F.broadcast(of.sparkSession.createDataFrame(table, "lang string, size int, middle double"))
    return of.join(medians, ["lang", "size"], "left").withColumn("middle", F.greatest(F.coalesce("middle", F.lit(0.0)), ordinary(F.col("n").cast("double"))))


def dictionaries(extreme: DataFrame) -> dict[str, bytes]:
    """Preset dictionary per language, '' for all others: the words that come in most blocks of extreme redundancy, the commonest last."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{L}{3,40}"), F.lit(0)))
    per = extreme.select("h", "no", "lang", "text").dropDuplicates(["h", "no"]).select("lang", F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")).where(F.col("n") >= BLOCKS_OF_WORD)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    rows = sorted(per.withColumn("rank", rank).where(F.col("rank") <= DICTIONARY).select("lang", "word", "n").collect(), key=lambda r: (-r["n"], r["word"]))
    every: Counter = Counter()
    own: dict[str, list[str]] = {}
    for r in rows:
        every[r["word"]] += r["n"]
        own.setdefault(r["lang"], []).append(r["word"])
    general = [w for w, _ in sorted(every.items(), key=lambda x: (-x[1], x[0]))[:DICTIONARY]]
    return {lang: " ".join(reversed(list(dict.fromkeys([*mine, *general])))).encode()[-WINDOW:] for lang, mine in {"": [], **own}.items()}


def again(found: DataFrame, presets: dict[str, bytes]) -> DataFrame:
    """The measured blocks with the ratio of the deflate that knows the dictionary, without their texts."""
    shared = found.sparkSession.sparkContext.broadcast(presets)
    names = ["row", "key", "no", "h", "lang", "size", "chars", "n", "words", "ends"]

    def run(batches):
        knows = {lang: zlib.compressobj(6, zlib.DEFLATED, -15, zdict=d) if d else zlib.compressobj(6, zlib.DEFLATED, -15) for lang, d in shared.value.items()}
        for batch in batches:
            ratios = [round(deflated(t, knows.get(lang) or knows[""]) / n, 3) for t, lang, n in zip(*(batch.column(i).to_pylist() for i in (10, 4, 7)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:10], pa.array(ratios, pa.float64())], [*names, "ratio"])

    kinds = ", ".join(f for f in MEASURED.split(", ") if f.split()[0] != "text")
    return found.select(*names, "text").mapInArrow(run, kinds)


def redundant(bound: float) -> Column:
    """Whether a block's normalised ratio is under bound, and its density of sentence ends low."""
    return (F.col("ratio") < bound * F.col("middle")) & (F.col("ends") < SENTENCES) & (F.col("words") >= LEAST_WORDS)


def keyword_shares(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, share) of every document: the share of its characters that stand in redundant blocks."""
    found = materialise(measured(docs, key), "blocks")
    presets = dictionaries(with_median(found, "ratio").where(redundant(EXTREME)))
    judged = materialise(again(found, presets), "judged")
    drop_materialised(found)
    spam = F.when(redundant(REDUNDANT), F.col("chars")).otherwise(0)
    per = with_median(judged, "ratio").groupBy("row").agg(F.first("key").alias(key), F.sum(spam).alias("spam"), F.sum("chars").alias("every"))
    return per.select(key, F.when(F.col("every") > 0, F.col("spam") / F.col("every")).otherwise(0.0).alias("share"))


def spam_pages(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return keyword_shares(docs, key).where(F.col("share") > MOST)
