"""Problem 5: the best record of each group of copies, field by field.

survivors() takes each field's copy from the usable values by the order stated for it: for the body the copy with
the most different lines left, then the highest trust, the latest fetch, the smallest number. That order names one
winner, so there is nothing for a model to decide, and none is run: agreement between sources can't outweigh trust.
Usable lines are counted in their row and the order is one aggregate, partial before its shuffle, so a group that
holds a third of all rows is no single task's.

judged() and true_values() give the choice of a model, without the stated order: a latent truth model with two-sided
source quality. A claim is that a source gives a value for a field of a group; a source that gives other values for
it is silent on the claim. Expectation: a claim's posterior follows from the sensitivity and specificity of the
sources that make it and of those that are silent. Maximisation: each source's sensitivity and specificity follow
from the posteriors. Fields may hold several true values (lines of a text do), so every value is judged by itself
and all that are judged true are kept. Values that only stand for a missing one, and values out of range, have the
prior of an impossible one. What many silent sources say is bounded (LEAST_SAID), so that a value that one of many
sources gives doesn't become impossible by their number.

Claims that the same sources make, among the same sources, have the same posterior. So claims are counted by
these two sets once, and the rounds run on the counts, until no quality changes by TOLERANCE.

Defined results: a group none of whose copies has a usable value has null for that field; null groups form a
group of their own; null trust and null times come last; repeated copies change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.plans.shared import drop_materialised, materialise

PRIOR, IMPOSSIBLE, TRUE, TOLERANCE = 0.5, 1e-60, 0.5, 0.002
#: Bounds of the log odds that all sources together add to the prior's: under the least no possible value becomes impossible, under the most no impossible one is let in.
LEAST_SAID, MOST_SAID = -20.0, 100.0
FIRST_YEAR, LAST_YEAR = 1400, 2026
# What stands for a missing title, in lower case and without punctuation; words of remarks on missing lines.
PLACEHOLDERS = (
    "ukendt", "ukendt titel", "unknown", "unknown title", "untitled", "uden titel", "ingen titel", "titel mangler", "titel", "title", "ikke oplyst", "uoplyst", "mangler",
    "null", "none", "nil", "nan", "na", "n a", "nn", "n n", "ut", "u t", "sn", "s n", "tba", "tbd", "xx", "xxx", "xxxx", "test",
)
REMARK = r"(?iu)^\s*[\[(<{][^\])>}]*(mangler|ulæselig|uleselig|missing|illegible|lakune|lacuna|udeladt)[^\])>}]*[\])>}]\s*$"


def title_usable(title: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", " "))
    return title.isNotNull() & (bare != "") & ~bare.isin(*PLACEHOLDERS)


def year_usable(year: Column) -> Column:
    return year.isNotNull() & year.between(FIRST_YEAR, LAST_YEAR)


def line_usable(line: Column) -> Column:
    return line.isNotNull() & line.rlike(r"[\p{L}\p{N}]") & ~line.rlike(REMARK)


def claims(copies: DataFrame) -> DataFrame:
    """(group_no, source, field, value, usable, k): one row per value that a copy gives."""
    given = F.array(
        F.struct(F.lit("title").alias("field"), F.col("source.title").alias("value"), title_usable(F.col("source.title")).alias("usable")),
        F.struct(F.lit("year").alias("field"), F.col("source.year_published").cast("string").alias("value"), year_usable(F.col("source.year_published")).alias("usable")),
    )
    texts = F.array_distinct(F.transform("body", lambda x: x["text"]))
    lines = F.transform(texts, lambda x: F.struct(F.lit("line").alias("field"), x.alias("value"), line_usable(x).alias("usable")))
    every = F.concat(given, F.coalesce(lines, F.expr("cast(array() as array<struct<field:string,value:string,usable:boolean>>)")))
    source = F.concat_ws("|", F.coalesce("source.corpus", F.lit("")), F.coalesce(F.col("trust").cast("string"), F.lit("")))
    out = copies.select("group_no", source.alias("source"), F.explode(every).alias("c"))
    return out.select("group_no", "source", "c.*", F.xxhash64("c.value").alias("k")).where("value IS NOT NULL")


def posteriors(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """claims -> ((group_no, field, k, p) of each claimed value, (source, field, sensitivity, specificity)).

    Within a field of a group, values are told apart by 64-bit hashes, so that no step moves their texts.
    """
    # the claims in a group that may not be null, for joins
    made = given.select(F.coalesce("group_no", F.lit(-(2**62))).alias("g"), "field", "k", "source", "usable")
    said = materialise(made.groupBy("g", "field", "k").agg(F.array_sort(F.collect_set("source")).alias("said"), F.max("usable").alias("usable")), "said")
    covers = said.select("g", "field", F.explode("said").alias("source")).groupBy("g", "field").agg(F.array_sort(F.collect_set("source")).alias("cover"))
    case = F.xxhash64("field", "usable", "said", "cover")
    facts = materialise(said.join(covers, ["g", "field"]).select("g", "field", "k", "said", "cover", "usable", case.alias("case")), "facts")
    cases = facts.groupBy("case", "field").agg(F.first("said").alias("said"), F.first("cover").alias("cover"), F.first("usable").alias("usable"), F.count("*").alias("n"))
    cases = materialise(cases.select("case", "field", "usable", "n", F.explode("cover").alias("source"), "said").select("case", "field", "usable", "n", "source", F.array_contains("said", F.col("source")).alias("says")), "cases")
    quality = cases.select("source", "field").distinct().select("source", "field", F.lit(0.7).alias("sensitivity"), F.lit(0.9).alias("specificity"))
    quality = materialise(quality, "quality")
    while True:
        judged = _judged(cases, quality)
        p, n = F.col("p"), F.col("n")
        sums = cases.join(judged, "case").groupBy("source", "field").agg(
            F.sum(n * p).alias("true"), F.sum(n * (1 - p)).alias("false"), F.sum(F.when(F.col("says"), n * p).otherwise(0.0)).alias("hit"), F.sum(F.when(F.col("says"), n * (1 - p)).otherwise(0.0)).alias("slip")
        )
        clip = lambda c: F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99))
        better = materialise(sums.select(
            "source", "field", clip((F.col("hit") + 7) / (F.col("true") + 10)).alias("sensitivity"),
            clip(F.greatest(F.lit(0.5), (F.col("false") - F.col("slip") + 9) / (F.col("false") + 10))).alias("specificity"),
        ), "quality")
        pair = quality.select("source", "field", F.col("sensitivity").alias("a"), F.col("specificity").alias("b")).join(better, ["source", "field"])
        moved = pair.agg(F.max(F.greatest(F.abs(F.col("a") - F.col("sensitivity")), F.abs(F.col("b") - F.col("specificity"))))).first()[0]
        drop_materialised(quality)
        quality = better
        if moved is None or moved < TOLERANCE:
            break
    known = facts.join(_judged(cases, quality), "case")
    return known.select(F.when(F.col("g") != -(2**62), F.col("g")).alias("group_no"), "field", "k", "p"), quality


def _judged(cases: DataFrame, quality: DataFrame) -> DataFrame:
    """(case, p): the posterior of the claims of each case."""
    speaks = F.log(F.col("sensitivity") / (1 - F.col("specificity")))
    silent = F.log((1 - F.col("sensitivity")) / F.col("specificity"))
    said = cases.join(quality, ["source", "field"]).groupBy("case").agg(F.sum(F.when(F.col("says"), speaks).otherwise(silent)).alias("said"), F.first("usable").alias("usable"))
    prior = F.when(F.col("usable"), F.lit(PRIOR)).otherwise(F.lit(IMPOSSIBLE))
    odds = F.log(prior / (1 - prior)) + F.least(F.greatest(F.col("said"), F.lit(LEAST_SAID)), F.lit(MOST_SAID))
    return said.select("case", (1 / (1 + F.exp(-odds))).alias("p"))


def survivors(copies: DataFrame) -> DataFrame:
    """(group_no, title_copy, year_copy, body_copy), one row per group."""
    lines = F.filter(F.array_distinct(F.transform("body", lambda x: x["text"])), line_usable)  # compared as stored
    rows = copies.select(
        "group_no", "copy_no", "trust", "fetched_at",
        title_usable(F.col("source.title")).alias("title"), year_usable(F.col("source.year_published")).alias("year"), F.size(lines).alias("lines"),
    )
    order = [F.col("trust"), F.col("fetched_at"), (-F.col("copy_no")).alias("least")]
    best = lambda on, *first: -F.max(F.when(on, F.struct(*first, *order)))["least"]
    return rows.groupBy("group_no").agg(
        best(F.col("title")).alias("title_copy"), best(F.col("year")).alias("year_copy"), best(F.col("lines") > 0, F.col("lines")).alias("body_copy")
    )


def judged(copies: DataFrame) -> DataFrame:
    """(group_no, title, title_p, year, year_p, lines): the title and year that the model holds most likely, with their posteriors, the smaller value of equals, and the number of different lines judged true."""
    given = claims(copies)
    facts, _ = posteriors(given)
    values = given.where("field <> 'line' AND usable").groupBy("group_no", "field", "k").agg(F.min("value").alias("value")).alias("v")
    f = facts.alias("f")
    same = F.col("v.group_no").eqNullSafe(F.col("f.group_no")) & (F.col("v.field") == F.col("f.field")) & (F.col("v.k") == F.col("f.k"))
    named = values.join(f, same).groupBy("v.group_no", "v.field").agg(F.min(F.struct((-F.round("f.p", 6)).alias("q"), F.col("v.value").alias("value"))).alias("best"))
    lines = facts.where((F.col("field") == "line") & (F.col("p") >= TRUE)).groupBy("group_no").agg(F.count("*").alias("lines"))
    of = lambda field, c: F.max(F.when(F.col("field") == field, F.col("best")[c]))
    wide = named.groupBy("group_no").agg(of("title", "value").alias("title"), (-of("title", "q")).alias("title_p"), of("year", "value").alias("year"), (-of("year", "q")).alias("year_p"))
    groups, out = copies.select("group_no").distinct(), ["title", "title_p", "year", "year_p"]
    with_values = groups.alias("g").join(wide.alias("w"), F.col("g.group_no").eqNullSafe(F.col("w.group_no")), "left").select("g.group_no", *out)
    whole = with_values.alias("g").join(lines.alias("l"), F.col("g.group_no").eqNullSafe(F.col("l.group_no")), "left")
    return whole.select("g.group_no", *out, F.coalesce("lines", F.lit(0)).alias("lines"))


def true_values(copies: DataFrame) -> DataFrame:
    """Every value of a field that is judged true, with its posterior: fields may have several."""
    given = claims(copies)
    facts, _ = posteriors(given)
    values = given.groupBy("group_no", "field", "k").agg(F.min("value").alias("value")).alias("v")
    kept = facts.where(F.col("p") >= TRUE).alias("f")
    same = F.col("v.group_no").eqNullSafe(F.col("f.group_no")) & (F.col("v.field") == F.col("f.field")) & (F.col("v.k") == F.col("f.k"))
    return values.join(kept, same).select("v.group_no", "v.field", "v.value", "f.p")
