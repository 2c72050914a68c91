"""Problem 2: the spellings of one author's name, linked by merge-and-rematch resolution.

Each name is parsed into readings (family name, first name or initial, middle names), without honorifics,
callings and brackets; names may stand in either order, as initials, as a file-name slug, or be an association's.
Readings enter blocks by family name (also with one letter left out, for slips of the pen) and initial; pairs of
profiles in a block are matched, matches are merged by connected components, and the merged profiles, which hold
all spellings and initials of their members, enter blocking again, until a round merges nothing. A profile that
has only initials or an abbreviation is merged only while it fits one fuller profile; which one it is can become
certain by earlier merges.

Defined results: null and blank names, and those that mean nobody, are no case; names are told apart exactly as
stored; a name that fits nothing else forms a group of its own; names of any length are parsed whole.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.components import components
from quillspark.plans.shared import drop_materialised, materialise

# What means nobody, words that aren't part of a name, words of associations, and short forms of first names.
NOBODY = ("anonymous", "anonym")
HONORIFICS = set("hr dr fr frk mag prof past h sr jr præst sognepræst provst biskop degn student kand digter forf forfatter d y æ den yngre ældre foreningen i af".split())
ASSOCIATIONS = ("forening", "selskab", "kreds", "samfund")
SHORT_FORMS = {
    "anker": "anders", "birte": "birgitte", "gitte": "birgitte", "chresten": "christoffer", "toffer": "christoffer", "dorte": "dorothea", "thea": "dorothea", "else": "elisabeth", "lise": "elisabeth", "lisbet": "elisabeth",
    "frits": "frederik", "hans": "johannes", "johan": "johannes", "jens": "johannes", "inge": "ingeborg", "stine": "kirstine", "lars": "laurids", "grethe": "margrethe", "grete": "margrethe", "mads": "mathias",
    "klaus": "nikolaj", "niels": "nikolaj", "tilli": "ottilia", "per": "peder", "ras": "rasmus", "fie": "sofie", "tobi": "tobias", "rikke": "ulrikke", "ville": "vilhelm", "volle": "wolmer", "gidius": "ægidius", "vind": "øjvind",
}
SPELLINGS = (("aa", "å"), ("ae", "æ"), ("oe", "ø"), ("ö", "ø"), ("ä", "æ"))
FOLDS = (("sz", "s"), ("w", "v"), ("ph", "f"), ("ck", "k"), ("th", "t"), ("j", "i"), ("ÿ", "y"), ("x", "ks"))
BRACKETS, TOKEN = re.compile(r"\([^)]*\)|\[[^\]]*\]"), re.compile(r"[^\W\d_]+")
SLUG = re.compile(r"([a-z]{3,})-([a-z]{1,5})")
DOUBLED = re.compile(r"([bcdfghjklmnpqrstvxz])\1+")
#: An abbreviation of more letters than this is an association's.
LONG = 3
READING = "struct<family:string,first:string,short:boolean,middle:array<string>,group:boolean>"


def spell(text: str) -> str:
    text = unicodedata.normalize("NFKC", text).lower()
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    return text


def fold(word: str) -> str:
    """A word without the differences of old and new spelling."""
    for a, b in FOLDS:
        word = word.replace(a, b)
    word = DOUBLED.sub(r"\1", word)
    return word[:-1] if len(word) > 2 and word.endswith("h") else word


def fold_given(word: str) -> str:
    """As fold, but for the first letter, which initials repeat as it was."""
    return word[0] + fold(word[1:])


FULL_FORMS = {fold_given(k): fold_given(v) for k, v in SHORT_FORMS.items()}


def near(a: str, b: str) -> bool:
    """Equal, or one letter put in, left out, replaced, or two neighbours exchanged."""
    if a == b:
        return True
    if min(len(a), len(b)) < 3 or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or a[k + 2 :] == b[k + 2 :] and a[k] == b[k + 1] and a[k + 1] == b[k]
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[k + 1 :] == shorter[k:]


def association(word: str) -> str | None:
    """The bare form of a word for an association, slips of the pen included; None for other words."""
    bare = re.sub(r"(?:en|et)$", "", word)
    for stem in ASSOCIATIONS:
        if len(bare) > len(stem) + 1 and any(near(bare[-k:], stem) for k in (len(stem), len(stem) - 1, len(stem) + 1)):
            return bare
    return None


def _reading(family: str, given: list[str], dotted: set[str]) -> dict | None:
    if not given or len(family) < 2:
        return None
    bare = association(given[0])
    first = bare or (fold_given(given[0]) if len(given[0]) > 1 else given[0])
    short = not bare and (len(given[0]) == 1 or given[0] in dotted)
    if not bare and not short:
        first = FULL_FORMS.get(first, first)
    middle = [fold_given(m) if len(m) > 1 else m for m in given[1:]]
    return {"family": fold(family), "first": first, "short": short, "middle": middle, "group": bool(bare)}


def parse(name: str) -> list[dict]:
    """The readings of a name; letters that may stand for one letter of the alphabet are read both ways."""
    out = _parse(name, spell)
    plain = _parse(name, str.lower) if spell(name) != unicodedata.normalize("NFKC", name).lower() else []
    return out + [r for r in plain if r not in out]


def _parse(name: str, spell) -> list[dict]:
    bare = BRACKETS.sub(" ", unicodedata.normalize("NFKC", name)).strip()
    if m := SLUG.fullmatch(bare):
        initials = m[2]
        for a, b in SPELLINGS:
            initials = initials.replace(a, b)
        ways = [list(initials)] + ([list(m[2])] if m[2].startswith("aa") else [])
        return [r for w in ways if (r := _reading(spell(m[1]), w, set()))]
    upper = bare.isupper()
    parts = []
    for part in bare.split(","):
        words = []
        for m in TOKEN.finditer(part):
            word = spell(m[0])
            dot = part[m.end() : m.end() + 1] == "."
            if word in HONORIFICS and not (len(word) == 1 and m[0].isupper()):
                continue
            if not upper and 1 < len(m[0]) <= 3 and m[0].isupper() and len(TOKEN.findall(bare)) > 1:
                words += [(w, True) for w in m[0].lower()]
            else:
                words.append((word, dot and len(word) > 1))
        if words:
            parts.append(words)
    dotted = {w for part in parts for w, dot in part if dot}
    if len(parts) > 1:
        family, given = [w for w, _ in parts[0]], [w for part in parts[1:] for w, _ in part]
        return [r for r in [_reading(family[-1], given, dotted)] if r] if family else []
    words = [w for w, _ in parts[0]] if parts else []
    if len(words) < 2:
        return [{"family": fold(words[0]), "first": "", "short": True, "middle": [], "group": False}] if words else []
    groups = [k for k, w in enumerate(words) if association(w)]
    if groups:
        rest = [w for k, w in enumerate(words) if k != groups[0]]
        family = rest[-1]
        forms = [family] + ([family[:-1]] if family.endswith("s") and groups[0] == len(words) - 1 else [])
        return [r for f in forms if (r := _reading(f, [words[groups[0]]], dotted))]
    ways = [(words[-1], words[:-1])]
    if len(words) == 2 and len(words[0]) > 2 and len(words[1]) > 1:
        # where the first word is a first name after all, short forms of two names don't become slips of one family name
        ways.append((FULL_FORMS.get(fold_given(words[0]), words[0]), words[1:]))
    return [r for f, g in ways if (r := _reading(f, g, dotted))]


def keys(readings: list[dict]) -> list[str]:
    """Blocks of a profile: family name whole or less one letter, with the initial, or with the first name less its initial."""
    out = set()
    for r in readings:
        if not r["first"]:
            continue
        family, kind = r["family"], "g" if r["group"] or r["short"] and len(r["first"]) > LONG else r["first"][0]
        out.add(f"{family}|{kind}")
        out |= {f"{family[:k]}{family[k + 1 :]}|{kind}" for k in range(len(family)) if len(family) > 3}
        if not r["short"] and len(r["first"]) > 2 and not r["group"]:
            out |= {f"{family}|-{r['first'][1:]}", f"{family}|-{r['first'][2:]}"}
    return sorted(out)


def _middle(a: list[str], b: list[str]) -> bool:
    same = lambda x, y: x[0] == y[0] or {x[0], y[0]} == {"a", "å"} or near(x, y)
    return all(same(x, y) for x, y in zip(a, b))


def agree(a: dict, b: dict) -> int:
    """0: two persons; 1: the same as far as initials or abbreviations tell; 2: the same."""
    if not a["first"] or not b["first"]:
        return 0
    long = [r["short"] and len(r["first"]) > LONG for r in (a, b)]
    if (a["group"] or long[0]) != (b["group"] or long[1]):
        return 0
    if a["family"] != b["family"] and not (min(len(a["family"]), len(b["family"])) > 3 and near(a["family"], b["family"])):
        return 0
    if not any(long) and not a["group"] and not _middle(a["middle"], b["middle"]):
        return 0
    x, y = a["first"], b["first"]
    if a["short"] or b["short"]:
        return int(x.startswith(y) or y.startswith(x))
    if near(x, y):
        return 2
    return 1 if len(min(x, y, key=len)) >= 2 and (x.startswith(y) or y.startswith(x)) else 0


def match(a: list[dict], b: list[dict]) -> int:
    return max((agree(x, y) for x in a for y in b), default=0)


def merged(readings: list[dict]) -> list[dict]:
    """A profile's readings once each; where a full reading has been confirmed by another, readings in a doubtful order go."""
    out = {(r["family"], r["first"], r["short"], tuple(r["middle"]), r["group"]): r for r in readings}
    return [out[k] for k in sorted(out)]


def short(readings: list[dict]) -> bool:
    return all(r["short"] for r in readings)


def _parsed(names: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            readings = [parse(n) for n in batch.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("family", pa.string()), ("first", pa.string()), ("short", pa.bool_()), ("middle", pa.list_(pa.string())), ("group", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(readings, kind)], ["id", "name", "readings"])

    return names.mapInArrow(run, f"id long, name string, readings array<{READING}>")


def _blocks(profiles: DataFrame) -> DataFrame:
    """(id, key) of each profile and each block it enters."""

    def block(batches):
        for batch in batches:
            rows = [(i, k) for i, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k in keys(r)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["id", "key"])

    return profiles.select("id", "readings").mapInArrow(block, "id long, key string")


def _links(blocks: DataFrame, profiles: DataFrame) -> DataFrame:
    """(a, b, grade, a_short, b_short) of profiles of one block that match, one of which at least is fresh; grade 1 says that one of them has initials only."""

    def judge(batches):
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if grade := match(x, y):
                    rows.append((a, b, grade, short(x), short(y)))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["a", "b", "grade", "a_short", "b_short"])

    x, y = blocks.where("fresh").select("key", F.col("id").alias("x")), blocks.select("key", F.col("id").alias("y"), "fresh")
    pairs = x.join(y.hint("merge"), "key").where("x < y OR (x > y AND NOT fresh)").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    side = lambda x: profiles.select(F.col("id").alias(x), F.col("readings").alias(f"r_{x}")).hint("merge")
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "r_a", "r_b").mapInArrow(judge, "a long, b long, grade int, a_short boolean, b_short boolean")


def _accepted(links: DataFrame) -> DataFrame:
    """Sure links; and the links of a short profile that fits no more than one fuller profile."""
    ends = links.where("grade = 1 AND a_short <> b_short").select(F.when(F.col("a_short"), F.col("a")).otherwise(F.col("b")).alias("x"), F.when(F.col("a_short"), F.col("b")).otherwise(F.col("a")).alias("full"))
    unclear = ends.groupBy("x").agg(F.countDistinct("full").alias("n")).where("n > 1").select("x")
    without = lambda x: unclear.withColumnRenamed("x", x).hint("merge")
    doubtful = links.where("grade = 1").join(without("a"), "a", "left_anti").join(without("b"), "b", "left_anti")
    return links.where("grade = 2").select("a", "b").unionByName(doubtful.select("a", "b"))


def resolve(names: DataFrame) -> DataFrame:
    """names (name, distinct) -> (name, group): the group is the id of one of its members.

    Rounds end when one merges nothing; each that goes on leaves fewer profiles. A round matches only pairs with a
    profile that the last one merged; the other matches are kept.
    """
    start = materialise(names.select(F.monotonically_increasing_id().alias("id"), "name"), "names")
    parsed = materialise(_parsed(start), "parsed")
    # names with equal readings are one profile from the start, so blocks hold each once
    reading = F.when(F.size("readings") > 0, F.to_json("readings")).otherwise(F.col("id").cast("string"))
    keyed = parsed.select("id", "name", reading.alias("key"))
    members = materialise(keyed.join(keyed.groupBy("key").agg(F.min("id").alias("group")).hint("merge"), "key").select("id", "name", "group"), "members")
    blocks, links, fresh = None, None, members.select(F.col("group").alias("id")).distinct()
    while True:
        profiles = members.join(parsed.select("id", "readings").hint("merge"), "id").groupBy(F.col("group").alias("id")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("readings")))).alias("readings"))
        profiles = materialise(profiles, "profiles")
        new = _blocks(profiles.join(fresh.hint("merge"), "id", "left_semi")).withColumn("fresh", F.lit(True))
        blocks = materialise(new if blocks is None else blocks.withColumn("fresh", F.lit(False)).unionByName(new), "blocks")
        found = _links(blocks, profiles)
        links = materialise(found if links is None else links.unionByName(found), "links")
        accepted = materialise(_accepted(links), "accepted")
        if not accepted.limit(1).count():
            break
        labels = materialise(components(accepted, "a", "b").select(F.col("x").alias("group"), "label"), "labels")
        after = materialise(members.join(labels.hint("merge"), "group", "left").select("id", "name", F.coalesce("label", "group").alias("group")), "members")
        merged_ids = lambda x: labels.select(F.col("group").alias(x)).hint("merge")  # noqa: E731, B023
        kept_links = materialise(links.join(merged_ids("a"), "a", "left_anti").join(merged_ids("b"), "b", "left_anti"), "links")
        kept_blocks = materialise(blocks.select("id", "key").join(merged_ids("id"), "id", "left_anti"), "blocks")
        for done in (members, profiles, blocks, links, accepted):
            drop_materialised(done)
        members, blocks, links, fresh = after, kept_blocks, kept_links, labels.select(F.col("label").alias("id")).distinct()
    return members.select("name", "group")


def author_names(poems: DataFrame) -> DataFrame:
    name = F.col("author.name")
    return poems.select(name.alias("name")).where(F.trim("name") != "").where(~F.lower(F.trim("name")).isin(*NOBODY)).distinct()


def pairs_of_names(groups: DataFrame) -> DataFrame:
    a, b = groups.select("group", F.col("name").alias("name_a")), groups.select("group", F.col("name").alias("name_b"))
    return a.join(b, "group").where("name_a < name_b").select("name_a", "name_b")
