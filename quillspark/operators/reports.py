"""Counts and reports over pages, corpora and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T



def _n(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def anomalies(pages: DataFrame) -> DataFrame:
    """Pages on which exactly one of the two counts is positive."""
    return pages.where((_n("n_poetry") > 0) != (_n("n_verse_line") > 0))


def page_summary(pages: DataFrame, *by: str) -> DataFrame:
    """Counts of pages, poem pages, blocks, lines, anomalies and failures."""
    return pages.groupBy(*by).agg(
        F.count("*").alias("n_urls"), F.count_if(_n("n_poetry") > 0).alias("n_poem_pages"), F.sum(_n("n_poetry")).alias("n_poems_total"), F.sum(_n("n_verse_line")).alias("n_verse_lines_total"),
        F.count_if((_n("n_poetry") > 0) != (_n("n_verse_line") > 0)).alias("n_anomalies"), F.count_if(F.col("error").isNotNull()).alias("n_errors"),
    )


def run_report(results: DataFrame, by: str = "book_slug") -> DataFrame:
    """(by, ok, failed, failures): the failures as an ordered array of (url, error). A page has failed if it has an error."""
    failed = F.col("error").isNotNull()
    failures = F.array_sort(F.collect_list(F.when(failed, F.struct("url", "error"))))
    return results.groupBy(by).agg(F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"), failures.alias("failures"))


def scrape_log(results: DataFrame, started_at: str, finished_at: str, collisions: int) -> DataFrame:
    """One row: the totals of a run and the counts of each book as a map."""
    each = run_report(results)
    return each.agg(
        F.lit(started_at).alias("started_at"), F.lit(finished_at).alias("finished_at"), F.sum(F.col("ok") + F.col("failed")).alias("total_pages_attempted"), F.sum("ok").alias("total_ok"), F.sum("failed").alias("total_failed"),
        F.lit(collisions).alias("filename_collisions"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("book_slug", F.struct("ok", "failed", "failures"))))).alias("per_book"),
    )


def discovery_report(pages: DataFrame) -> DataFrame:
    """One row per book: its counts and its pages as an ordered array."""
    page = F.struct("path", "url", "n_poetry", "n_verse_line", "cached", "error")
    listed = pages.groupBy("book_slug").agg(F.max("discovered_at").alias("discovered_at"), F.array_sort(F.collect_list(page)).alias("pages"))
    return page_summary(pages, "book_slug").join(listed, "book_slug")


def poem_counts(lines: DataFrame, key: str = "poem_no") -> DataFrame:
    """(key, n_stanzas, n_lines, n_with_notes) from exploded lines."""
    return lines.groupBy(key).agg(F.count_distinct("stanza_id").alias("n_stanzas"), F.count("*").alias("n_lines"), F.count_if(F.size("notes") > 0).alias("n_with_notes"))


def corpus_report(poems: DataFrame, by: str) -> DataFrame:
    """Poems, stanzas, lines and lines with notes of each group, and a total row whose group is null and is_total 1.

    Counted within each row, so no line is shuffled.
    """
    body = F.expr("coalesce(filter(body, x -> x IS NOT NULL), array())")
    counted = poems.select(
        F.col(by), F.size(F.expr("array_distinct(transform(coalesce(filter(body, x -> x IS NOT NULL AND x.stanza_id IS NOT NULL), array()), x -> x.stanza_id))")).alias("s"),
        F.size(body).alias("l"), F.size(F.expr("filter(coalesce(body, array()), x -> size(x.marginal_notes) > 0)")).alias("m"),
    )
    return counted.rollup(by).agg(
        F.grouping(by).cast("int").alias("is_total"), F.count("*").alias("n_poems"), F.sum("s").alias("n_stanzas"), F.sum("l").alias("n_lines"), F.sum("m").alias("n_with_notes")
    )


def titles_in_several(poems: DataFrame, book: str, least: int = 2) -> DataFrame:
    """(title, books): compared titles that occur in several books."""
    rows = poems.select(T.normalise(F.col("title")).alias("title"), F.col(book).alias("book")).where("title <> '' AND book IS NOT NULL")
    return rows.groupBy("title").agg(F.count_distinct("book").alias("books")).where(F.col("books") >= least)


def year_forms(rows: DataFrame, text: str, book: str) -> DataFrame:
    """(kind, n, n_books): how dates are written."""
    return rows.groupBy(T.parse_year(F.col(text))["kind"].alias("kind")).agg(F.count("*").alias("n"), F.count_distinct(book).alias("n_books"))


def leaks(lines: DataFrame, text: str = "text") -> DataFrame:
    """One row of counts: lines with tags, brackets, entities, page sigils and manuscript signs that cleaning should have taken."""
    c = F.col(text)
    return lines.agg(
        F.count("*").alias("n_lines"), F.count_if(c.rlike(r"</?[A-Za-z][^<>]*>")).alias("tags"), F.count_if(c.rlike(r"[\[\]]")).alias("brackets"), F.count_if(c.rlike(r"&[A-Za-z]+;|&#[0-9]+;")).alias("entities"),
        F.count_if(c.rlike(r"\|")).alias("pipes"), F.count_if(c.rlike(r"[†‡¶]")).alias("signs"),
    )


def duplicates_manifest(pairs: DataFrame, titles: DataFrame, key: str = "poem_no") -> DataFrame:
    """Rows of a manifest of contained pairs, the most contained first: rank, shares in per cent, lines, title and names."""
    named = pairs.join(titles.select(F.col(key).alias("a"), F.col("title"), F.col("file_name").alias("file_a")), "a").join(titles.select(F.col(key).alias("b"), F.col("file_name").alias("file_b")), "b")
    ordered = named.orderBy(F.desc(F.greatest("a_in_b", "b_in_a")), "a", "b")
    return ordered.select(T.percent(F.col("a_in_b")).alias("a_in_b"), T.percent(F.col("b_in_a")).alias("b_in_a"), "lines_a", "lines_b", "title", "file_a", "file_b")


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))
