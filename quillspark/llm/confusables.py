"""Problem 6: one consistent form for text that looks the same but differs in its characters.

Relational: the text is exploded to positioned code points, these are joined with broadcast tables of
decompositions, replacements and look-alikes (their size follows from the Unicode tables, not from the data),
combining marks are put in the order of their classes, composed with their base where one character exists,
and the strings are built again. A look-alike letter is replaced only in a word that also has a letter of the
Latin script. A text in which no character has an entry is in its form already and isn't exploded.

Defined results: null and empty texts are no case and stay as they are; words wholly of another script and
marks without a composed form stay as they are; texts of any length are processed whole.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm import mojibake

# Letters of other alphabets (and two phonetic ones) and the Latin letters they look like.
LOOKALIKES = {
    "Latin phonetic": dict(zip("ɑɡıɩʏ", "agiiy")),
    "Latin small capitals": dict(zip("ᴀʙᴄᴅᴇꜰɢʜᴊᴋʟᴍɴᴏᴘʀꜱᴛᴜᴠᴡᴢ", "abcdefghjklmnoprstuvwz")),
    "Cyrillic, older": dict(zip("ѵѴ", "vV")),
    "Greek, small": dict(zip("γω", "yw")),
    "Lisu": dict(zip("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ")),
    "Cyrillic": dict(zip("аеіјосрхуѕԁһԛԝкмтвнАВЕІЈКМНОРСТУХЅԌԚԜ", "aeijocpxysdhqwkmtbhABEIJKMHOPCTYXSGQW")),
    "Greek": dict(zip("οανιυρςϲκτΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳ", "oaviupscktABEZHIKMNOPTYXCj")),
    "Armenian": dict(zip("օսոհցքՕՍԼ", "ounhgpOUL")),
}
# Joiners, fillers and vowel separators that have no form of their own and aren't of the format category.
UNSEEN = (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0)
SPACE, INVISIBLE, WIDE, MARK, ALIKE = "space", "invisible", "wide", "mark", "alike"


@lru_cache(None)
def tables() -> tuple[list[tuple[str, str, str]], list[tuple[str, str]]]:
    """(character, replacement, kind) for what is replaced or decomposed, and (decomposed pair, composed character)."""
    one: list[tuple[str, str, str]] = []
    two: list[tuple[str, str]] = []
    alike = {k: v for script in LOOKALIKES.values() for k, v in script.items()}
    for c in range(0x80, sys.maxunicode + 1):
        ch = chr(c)
        kind = unicodedata.category(ch)
        parts = unicodedata.decomposition(ch)
        if kind in ("Cn", "Cs", "Co"):
            continue
        if kind == "Cf" or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or c in UNSEEN:
            one.append((ch, "", INVISIBLE))
        elif kind == "Zs":
            one.append((ch, " ", SPACE))
        elif parts.startswith("<wide>") or 0xFF01 <= c <= 0xFF5E:
            one.append((ch, unicodedata.normalize("NFKC", ch), WIDE))
        elif ch in alike:
            one.append((ch, alike[ch], ALIKE))
        elif parts.startswith("<font>") and (plain := unicodedata.normalize("NFKC", ch)).isascii() and plain.isalpha():  # letters of mathematical alphabets
            one.append((ch, plain, ALIKE))
        elif unicodedata.combining(ch):
            one.append((ch, ch, MARK))
        elif parts and not parts.startswith("<") and unicodedata.normalize("NFC", ch) != ch:
            one.append((ch, unicodedata.normalize("NFC", ch), MARK))
        if " " in parts and not parts.startswith("<") and unicodedata.normalize("NFC", parts_text(parts)) == ch:
            two.append((parts_text(parts), ch))
    return one, two


def parts_text(parts: str) -> str:
    return "".join(chr(int(x, 16)) for x in parts.split())


def _mapping(spark: SparkSession) -> DataFrame:
    rows = [(c, r, k, unicodedata.combining(c)) for c, r, k in tables()[0]]
    return F.broadcast(spark.createDataFrame(rows, "ch string, to string, kind string, ccc int"))


def canonical(texts: DataFrame, keys: tuple[str, ...] = ("poem_no", "line_id")) -> DataFrame:
    """(keys, text) -> (keys, text, form, kinds): the consistent form, and what was changed to reach it. The keys are unique."""
    spark = texts.sparkSession
    by = list(keys)
    here = Window.partitionBy(*by).orderBy("pos")
    points = texts.select(*by, "text", F.posexplode(F.split("text", "")).alias("pos", "ch")).where("ch <> ''")
    points = points.join(_mapping(spark), "ch", "left").select(
        *by, F.when(F.col("pos") == 0, F.col("text")).alias("source"), "pos", "ch", F.coalesce("to", "ch").alias("to"), "kind", F.coalesce("ccc", F.lit(0)).alias("ccc")
    ).repartition(*by)
    letter = F.col("to").rlike(r"^[\p{L}\p{M}]") | (F.coalesce("kind", F.lit("")) == INVISIBLE)
    latin = F.col("to").rlike(r"^[\p{IsLatin}]") & ~F.coalesce(F.col("kind") == ALIKE, F.lit(False))
    points = points.withColumn("word", F.sum(F.when(letter, 0).otherwise(1)).over(here)).withColumn("letter", letter)
    in_word = Window.partitionBy(*by, "word")
    mixed = F.max(latin & F.col("letter")).over(in_word) & F.col("letter")
    points = points.withColumn("mixed", mixed)
    is_alike = F.coalesce(F.col("kind") == ALIKE, F.lit(False))
    points = points.withColumn("out", F.when(is_alike & ~F.col("mixed"), F.col("ch")).otherwise(F.col("to")))
    points = points.withColumn("did", F.when(is_alike & ~F.col("mixed"), F.lit(None)).when(F.col("kind") == MARK, F.when(F.col("out") != F.col("ch"), F.lit(MARK))).otherwise(F.col("kind")))
    kept = points.withColumn("base", F.sum(F.when((F.col("ccc") == 0) & (F.col("out") != ""), 1).otherwise(0)).over(here))
    clusters = kept.groupBy(*by, "base").agg(
        F.array_sort(F.collect_list(F.when(F.col("out") != "", F.struct("ccc", "pos", "out")))).alias("parts"), F.collect_set("did").alias("did"), F.max("source").alias("source")
    )
    plain = F.array_join(F.transform("parts", lambda p: p["out"]), "")
    clusters = clusters.select(*by, "source", "base", "did", plain.alias("text"), F.when(F.size("parts") > 1, F.col("parts")).alias("parts"))
    return _rebuild(_compose(clusters, by), by)


@lru_cache(None)
def compositions() -> list[tuple[str, str]]:
    """(base and marks in order, composed character) of every character that has marks, from each of its forms."""
    pairs = dict(tables()[1])
    return sorted({**pairs, **{unicodedata.normalize("NFD", ch): ch for ch in pairs.values()}}.items())


def _compose(clusters: DataFrame, by: list[str]) -> DataFrame:
    """Compose base and marks: by a join where one character stands for all of a cluster, else one mark after the other; a mark without a composed form stays behind its base."""
    known = F.map_from_entries(F.array(*[F.struct(F.lit(pair), F.lit(whole)) for pair, whole in tables()[1]]))
    first = F.struct(F.element_at("parts", 1)["out"].alias("base"), F.lit("").alias("left"), F.lit(-1).alias("blocked"))

    def add(done: Column, mark: Column) -> Column:
        whole = F.try_element_at(known, F.concat(done["base"], mark["out"]))
        fits = (done["blocked"] < mark["ccc"]) & whole.isNotNull()
        return F.struct(
            F.when(fits, whole).otherwise(done["base"]).alias("base"),
            F.when(fits, done["left"]).otherwise(F.concat(done["left"], mark["out"])).alias("left"),
            F.when(fits, done["blocked"]).otherwise(mark["ccc"]).alias("blocked"),
        )

    by_steps = F.aggregate(F.slice("parts", 2, F.size("parts") - 1), first, add, lambda d: F.concat(d["base"], d["left"]))
    composed = F.broadcast(clusters.sparkSession.createDataFrame(compositions(), "text string, composed string"))
    marked = clusters.where("parts IS NOT NULL").join(composed, "text", "left")
    done = marked.select(*by, "source", "base", "did", "text", F.coalesce("composed", by_steps).alias("whole"))
    done = done.select(*by, "source", "base", F.when(F.col("whole") != F.col("text"), F.array_union("did", F.array(F.lit(MARK)))).otherwise(F.col("did")).alias("did"), F.col("whole").alias("text"))
    return clusters.where("parts IS NULL").select(*by, "source", "base", "did", "text").unionByName(done)


def _rebuild(clusters: DataFrame, by: list[str]) -> DataFrame:
    kinds = F.array_sort(F.array_distinct(F.flatten(F.collect_list("did")))).alias("kinds")
    built = clusters.groupBy(*by).agg(F.max("source").alias("text"), F.array_sort(F.collect_list(F.struct("base", F.col("text").alias("part")))).alias("parts"), kinds)
    return built.select(*by, "text", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("form"), "kinds")


def changed_poems(poems: DataFrame) -> DataFrame:
    """The titles and lines of poems whose form changes, without those that are garbled (problem 3)."""
    return canonical(mojibake.without_garbled(mojibake.units(poems))).where(F.size("kinds") > 0)
