"""Containment of documents in each other within blocks, and deletion plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.plans.shared import materialise, spread


def blocks(poems: DataFrame, key: str = "poem_no") -> DataFrame:
    """(key, block_title, block_source) of the rows whose compared title isn't empty; null source titles share a block."""
    return poems.select(key, T.normalise(F.col("title")).alias("block_title"), T.normalise(F.col("source.title")).alias("block_source")).where("block_title <> ''")


def block_sizes(poems: DataFrame, least: int = 2) -> DataFrame:
    return blocks(poems).groupBy("block_title", "block_source").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def line_sets(poems: DataFrame, key: str = "poem_no", least: int = 3) -> DataFrame:
    """(block_title, block_source, key, set, lines): the distinct compared lines of each poem in a block with others, and their number with repeats.

    Blocks with one poem go first, by counts that are summed before the shuffle, so only the bodies of the others are
    looked at; their lines are compared within the poem's row, nothing is exploded.
    """
    by = ["block_title", "block_source"]
    blocked = spread(poems.select(key, "title", F.struct(F.col("source.title")).alias("source"), "body")).select(key, T.normalise(F.col("title")).alias(by[0]), T.normalise(F.col("source.title")).alias(by[1]), "body").where("block_title <> ''")
    several = blocked.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 1").select(*by)
    texts = F.coalesce(F.expr("transform(body, x -> x.text)"), F.expr("cast(array() as array<string>)"))
    kept = F.filter(F.transform(texts, T.normalise), lambda x: F.length(x) >= least)
    rows = blocked.join(several, by, "left_semi").withColumn("all", kept)
    return rows.select(*by, key, F.array_sort(F.array_distinct("all")).alias("set"), F.size("all").cast("long").alias("lines"))


def contained_pairs(sets: DataFrame, by: list[str], key: str, share: float = 0.9) -> DataFrame:
    """(by, a, b, a_in_b, b_in_a, lines_a, lines_b) of keys in one block, a < b, one of which has at least share of its lines in the other.

    sets: (by, key, set, lines); they are written to the shared folder, as each of the steps reads them. Keys with
    equal sets are compared once, through a representative, and expanded at the end. Of a pair that qualifies, the
    smaller set has share of its lines in common with the other, so in any fixed order one of its first
    size - ceil(share * size) + 1 lines is common. Those prefixes, the rarest lines of the block first, are joined
    with all lines of the block; so rows meet only where they share a rare line, and no pair is lost.
    """
    signed = materialise(sets.where(F.size("set") > 0).withColumn("_h", F.sha2(F.array_join("set", "\n"), 256)), "sets")
    reps = signed.groupBy(*by, "_h").agg(F.min(key).alias("rep"))
    members = signed.join(reps, [*by, "_h"]).select(*by, key, "rep", "lines", "set")
    held = members.where(F.col(key) == F.col("rep")).select(*by, key, "set", F.size("set").alias("size"))
    rows = held.select(*by, key, "size", F.explode("set").alias("norm"))
    often = rows.groupBy(*by, "norm").agg(F.count("*").alias("df")).where("df > 1")
    # a line that one set alone has can't be common: it stays in the count of the prefix, first of all
    ranked = rows.join(often, [*by, "norm"], "left").withColumn("place", F.row_number().over(Window.partitionBy(*by, key).orderBy(F.coalesce("df", F.lit(1)), "norm")))
    shared = ranked.where("df IS NOT NULL")
    prefix = shared.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * share - 1e-9) + 1)
    met = (
        prefix.select(*by, "norm", F.col(key).alias("s")).join(shared.select(*by, "norm", F.col(key).alias("t")), [*by, "norm"]).where("s <> t")
        .select(*by, F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()
    )
    side = lambda x: held.select(*by, F.col(key).alias(x), F.col("set").alias(f"set_{x}"))
    common = met.join(side("a"), [*by, "a"]).join(side("b"), [*by, "b"]).withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    ratios = common.select(*by, F.col("a").alias("rep_a"), F.col("b").alias("rep_b"), (F.col("common") / F.size("set_a")).alias("x"), (F.col("common") / F.size("set_b")).alias("y"))
    found = ratios.where(F.greatest("x", "y") >= share - 1e-9)
    m = lambda x: members.select(*by, F.col("rep").alias(f"rep_{x}"), F.col(key).alias(x), F.col("lines").alias(f"lines_{x}"))
    across = found.join(m("a"), [*by, "rep_a"]).join(m("b"), [*by, "rep_b"])
    swap = F.col("a") > F.col("b")
    pick = lambda u, v: F.when(swap, F.col(v)).otherwise(F.col(u))
    ordered = across.select(
        *by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), pick("x", "y").alias("a_in_b"), pick("y", "x").alias("b_in_a"), pick("lines_a", "lines_b").alias("lines_a"), pick("lines_b", "lines_a").alias("lines_b")
    )
    within = m("a").join(m("b").withColumnRenamed("rep_b", "rep_a"), [*by, "rep_a"]).where("a < b").select(*by, "a", "b", F.lit(1.0).alias("a_in_b"), F.lit(1.0).alias("b_in_a"), "lines_a", "lines_b")
    return ordered.unionByName(within)


def contained_poems(poems: DataFrame, key: str = "poem_no", share: float = 0.9) -> DataFrame:
    """Pairs of poems of the same compared title and source title, one contained in the other."""
    return contained_pairs(line_sets(poems, key), ["block_title", "block_source"], key, share)


def most_contained_first(pairs: DataFrame, n: int | None = None) -> DataFrame:
    out = pairs.orderBy(F.desc(F.greatest("a_in_b", "b_in_a")), "a", "b")
    return out.limit(n) if n else out


def overlap_markers(pairs: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """(a, b, pos, text, marker) of each compared line of a: 'Y' if b has it, else '.'."""
    mine = lines.select(F.col(key).alias("a"), "pos", "text", "norm")
    theirs = lines.select(F.col(key).alias("b"), "norm").distinct().withColumn("has", F.lit(True))
    return pairs.select("a", "b").join(mine, "a").join(theirs, ["b", "norm"], "left").select("a", "b", "pos", "text", F.when(F.col("has"), "Y").otherwise(".").alias("marker"))


def parse_plan(lines: DataFrame) -> DataFrame:
    """(reason, delete, keep) from the rows (value) of a pipe table: the header and rows without two .json names are left out."""
    cells = F.transform(F.split("value", r"\|"), lambda x: T.strip(x))
    names = lambda k: F.regexp_replace(F.try_element_at("cells", F.lit(k)), "^`+|`+$", "")
    rows = lines.where(F.col("value").startswith("|")).where(~(F.col("value").contains("Reason") & F.col("value").contains("Delete")))
    out = rows.select(cells.alias("cells")).where(F.size("cells") >= 4).select(F.col("cells")[1].alias("reason"), names(3).alias("delete"), names(4).alias("keep"))
    return out.where(F.col("delete").endswith(".json") & F.col("keep").endswith(".json"))


def apply_plan(docs: DataFrame, plan: DataFrame, name: str = "file_name") -> DataFrame:
    """The documents that the plan doesn't delete; the input stays as it is."""
    return docs.join(plan.select(F.col("delete").alias(name)).distinct(), name, "left_anti")


def quarantined(docs: DataFrame, plan: DataFrame, name: str = "file_name") -> DataFrame:
    """The documents that the plan deletes, to be kept apart instead of lost."""
    return docs.join(plan.select(F.col("delete").alias(name)).distinct(), name, "left_semi")


def plan_audit(docs: DataFrame, plan: DataFrame, name: str = "file_name") -> DataFrame:
    """(delete, rows, present, status): each file once; what is planned twice is deleted once, and was missing for its later rows."""
    there = docs.select(F.col(name).alias("delete")).distinct().withColumn("present", F.lit(True))
    each = plan.groupBy("delete").agg(F.count("*").alias("rows")).join(there, "delete", "left")
    present = F.coalesce("present", F.lit(False))
    return each.select("delete", "rows", present.alias("present"), F.when(present, "deleted").otherwise("missing").alias("status"), (F.col("rows") - present.cast("int")).alias("missing_rows"))


def planned_often(plan: DataFrame) -> DataFrame:
    return plan.groupBy("delete").agg(F.count("*").alias("n")).where("n > 1")


def unsafe_keeps(plan: DataFrame, docs: DataFrame, name: str = "file_name") -> DataFrame:
    """Plan rows whose kept file is itself deleted or doesn't exist: to be looked at before a plan is applied."""
    gone = plan.select(F.col("delete").alias("keep")).distinct().withColumn("is_deleted", F.lit(True))
    there = docs.select(F.col(name).alias("keep")).distinct().withColumn("is_there", F.lit(True))
    return plan.join(gone, "keep", "left").join(there, "keep", "left").where("is_deleted OR is_there IS NULL").select("reason", "delete", "keep")
