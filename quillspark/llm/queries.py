"""Queries of problems 1 to 9 and, where SQL can express one, the SQL to compare it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import components, confusables, leakage, mojibake, names, neardup, spam, survivor, tokens
from quillspark.plans.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of poem rows that have at least 70 % of their words in common."""
    texts = neardup.poem_texts(table(spark, folder, "poems"))
    return neardup.all_pairs(*neardup.near_duplicates(texts))


def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One row per poem with words: its group (smallest poem_no reached by links), and its links to other classes."""
    texts = neardup.poem_texts(table(spark, folder, "poems"))
    pairs, members = neardup.near_duplicates(texts)
    linked = components.components(pairs, "a", "b").select(F.col("x").alias("rep"), "label")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    rows = members.join(linked, "rep", "left").join(ends, "rep", "left")
    return rows.select(F.col("id").alias("poem_no"), F.coalesce("label", "rep").alias("group_no"), F.coalesce("links", F.lit(0)).alias("links"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of different author names that mean the same author."""
    return names.pairs_of_names(names.resolve(names.author_names(table(spark, folder, "poems"))))


def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The names of each author, with the smallest of them as the group's name."""
    groups = names.resolve(names.author_names(table(spark, folder, "poems")))
    first = groups.groupBy("group").agg(F.min("name").alias("group_name"), F.count("*").alias("spellings"))
    return groups.join(first, "group").select("name", "group_name", "spellings")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every garbled title (line -1) and line of the poems."""
    return mojibake.garbled_poems(table(spark, folder, "poems")).select("poem_no", "line_id")


def p3_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The garbled places with the restored text."""
    return mojibake.garbled_poems(table(spark, folder, "poems"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every linked poem."""
    return components.components(table(spark, folder, "pairs"), "poem_a", "poem_b").select(F.col("x").alias("poem_no"), F.col("label").alias("group_no"))


P1_SQL = r"""
WITH w AS (SELECT poem_no, unnest(regexp_extract_all(lower(array_to_string(list_filter(list_transform(body, lambda x: x.text), lambda t: t IS NOT NULL), chr(10))), '[\p{L}\p{N}]+')) AS word FROM poems),
o AS (SELECT poem_no, word, row_number() OVER (PARTITION BY poem_no, word) AS k FROM w),
n AS (SELECT poem_no, count(*) AS n FROM o GROUP BY poem_no),
c AS (SELECT x.poem_no AS a, y.poem_no AS b, count(*) AS c FROM o x JOIN o y ON x.word = y.word AND x.k = y.k AND x.poem_no < y.poem_no GROUP BY ALL)
SELECT a AS poem_a, b AS poem_b FROM c JOIN n na ON na.poem_no = a JOIN n nb ON nb.poem_no = b WHERE c >= 0.7 * greatest(na.n, nb.n) - 1e-9
"""

P4_SQL = """
WITH RECURSIVE e AS (
  SELECT DISTINCT poem_a AS u, poem_b AS v FROM pairs WHERE poem_a <> poem_b
  UNION SELECT DISTINCT poem_b, poem_a FROM pairs WHERE poem_a <> poem_b
), r(x, y) AS (
  SELECT u, u FROM e UNION SELECT r.x, e.v FROM r JOIN e ON r.y = e.u
)
SELECT x AS poem_no, min(y) AS group_no FROM r GROUP BY x
"""


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The copy that gives each field of each group's surviving record."""
    return survivor.survivors(table(spark, folder, "poem_copies"))


def p5_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of each group's fields that is judged true."""
    return survivor.true_values(table(spark, folder, "poem_copies"))


def p5_judged(spark: SparkSession, folder: str) -> DataFrame:
    """The title and year of each group that the truth model holds most likely, and its number of true lines: the model's own choice, without the stated order."""
    return survivor.judged(table(spark, folder, "poem_copies"))


P5_SQL = """
WITH c AS (
  SELECT group_no, copy_no, trust, fetched_at, source.title AS title, source.year_published AS y,
    trim(regexp_replace(lower(source.title), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS bare,
    len(list_distinct(list_filter(list_transform(body, lambda x: x.text), lambda t: t IS NOT NULL AND regexp_matches(t, '[\\p{L}\\p{N}]')
      AND NOT regexp_matches(t, '(?i)^\\s*[\\[(<{][^\\])>}]*(mangler|ulæselig|uleselig|missing|illegible|lakune|lacuna|udeladt)[^\\])>}]*[\\])>}]\\s*$')))) AS n
  FROM poem_copies
), r AS (
  SELECT *, title IS NOT NULL AND bare <> '' AND bare NOT IN (PLACEHOLDERS) AS t_ok, coalesce(y BETWEEN 1400 AND 2026, false) AS y_ok, coalesce(n, 0) > 0 AS b_ok FROM c
)
SELECT g.group_no,
  (SELECT copy_no FROM r WHERE r.group_no = g.group_no AND t_ok ORDER BY trust DESC NULLS LAST, fetched_at DESC NULLS LAST, copy_no LIMIT 1) AS title_copy,
  (SELECT copy_no FROM r WHERE r.group_no = g.group_no AND y_ok ORDER BY trust DESC NULLS LAST, fetched_at DESC NULLS LAST, copy_no LIMIT 1) AS year_copy,
  (SELECT copy_no FROM r WHERE r.group_no = g.group_no AND b_ok ORDER BY n DESC, trust DESC NULLS LAST, fetched_at DESC NULLS LAST, copy_no LIMIT 1) AS body_copy
FROM (SELECT DISTINCT group_no FROM poem_copies) g
""".replace("PLACEHOLDERS", ", ".join(f"'{p}'" for p in survivor.PLACEHOLDERS))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every title (line -1) and line of the poems that is written with other characters."""
    return confusables.changed_poems(table(spark, folder, "poems")).select("poem_no", "line_id")


def p6_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The consistent form of each such title and line, and the kinds of changes."""
    return confusables.changed_poems(table(spark, folder, "poems"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item of which it holds 12 consecutive words or two thirds of the words in order."""
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of which most is keywords, links or tags."""
    return spam.spam_pages(table(spark, folder, "documents")).select("doc_id")


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Share of keyword blocks in every document."""
    return spam.keyword_shares(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_groups, p3_found, p3_restored, p4_found, p5_found, p5_values, p5_judged, p6_found, p6_forms, p7_ids, p8_found, p9_found, p9_shares)}
ORACLE: dict[str, str] = {"p1_found": P1_SQL, "p4_found": P4_SQL, "p5_found": P5_SQL}
