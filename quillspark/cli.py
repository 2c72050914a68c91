"""Command line: python -m quillspark.cli validate|duplicates|apply|discover|crawl|page|parse|authors ..."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.functions import text as T
from quillspark.operators import dedup, enrich, lines, quality, reports
from quillspark.plans import pages as plans
from quillspark.sources import readers, writers


def session() -> SparkSession:
    return SparkSession.builder.appName("quillspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _print(df: DataFrame) -> None:
    """All rows, one a line, part by part."""
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Cached pages in folders that are named by their books: (url, book_slug, html); the url is the page's path."""
    read = readers.pages(spark, f"{folder.rstrip(chr(47))}/*")
    parts = F.split(F.col("path"), "/")
    return read.select(F.col("path").alias("url"), F.element_at(parts, -2).alias("book_slug"), "html")


def validate(spark: SparkSession, path: str) -> int:
    """0: clean; 1: some document has an error; 2: there are no documents."""
    try:
        files = readers.documents(spark, path)
        empty = not files.limit(1).count()
    except AnalysisException:  # the path doesn't exist
        empty = True
    if empty:
        print(f"no .json files at {path}")
        return 2
    found = quality.findings(files).cache()
    quality.by_level(found).where("path IS NULL").show()
    _print(found.where("level <> 'info'").orderBy("path", "pos", "rule").select("path", "pos", "level", "rule", "message"))
    status = int(quality.has_errors(found))
    found.unpersist()  # a later call must see the files as they are then
    return status


def duplicates(spark: SparkSession, path: str, out: str) -> int:
    poems = readers.poems(spark, path)
    pairs = dedup.contained_poems(poems, "file_name").cache()
    writers.write_version(pairs, f"{out}/pairs")
    writers.write_version(dedup.overlap_markers(pairs, lines.compared_lines(lines.body_lines(poems, "file_name")), "file_name"), f"{out}/overlap")
    titles = poems.select("file_name", "title")
    named = pairs.join(titles.withColumnRenamed("file_name", "a"), "a").select(T.percent(F.col("a_in_b")).alias("a in b"), T.percent(F.col("b_in_a")).alias("b in a"), "lines_a", "lines_b", "title", "a", "b", F.greatest("a_in_b", "b_in_a").alias("most"))
    listed = named.orderBy(F.desc("most"), "a", "b").drop("most")
    if out.startswith("/") or "://" not in out:
        Path(out, "DUPLICATES.md").write_text(writers.markdown(listed, "Poems contained in another"), encoding="utf-8")
    # both copies of each pair in a folder of its own
    both = pairs.select(F.concat_ws("--in--", F.regexp_replace("a", r"\.json$", ""), F.regexp_replace("b", r"\.json$", "")).alias("pair"), F.explode(F.array("a", "b")).alias("file_name"))
    writers.write_version(both.join(readers.documents(spark, path).select("file_name", "text"), "file_name"), f"{out}/copies", "pair")
    dedup.most_contained_first(pairs, 20).show(20, False)
    pairs.unpersist()
    return 0


def apply(spark: SparkSession, path: str, plan: str, out: str, dry_run: bool) -> int:
    docs, planned = readers.documents(spark, path), readers.plan(spark, plan)
    audit = dedup.plan_audit(docs, planned)
    unsafe = dedup.unsafe_keeps(planned, docs)
    unsafe.show(20, False)
    audit.groupBy("status").count().show()
    if dry_run:
        return 0
    writers.write_version(dedup.apply_plan(docs, planned).drop("doc"), f"{out}/documents")
    writers.write_version(dedup.quarantined(docs, planned).drop("doc"), f"{out}/quarantine")
    writers.append_log(audit, f"{out}/deletions")
    return 0


def discover(spark: SparkSession, pages: str, out: str) -> int:
    read = readers.discovery(spark, pages)
    writers.write_report(reports.discovery_report(read), out)
    reports.anomalies(read).show(20, False)
    return 0


def crawl(spark: SparkSession, pages: str, out: str) -> int:
    """Discovery from cached pages: what each page holds, and the addresses that its book's pages load and the cache lacks."""
    read = _pages(spark, pages).cache()
    counts = H.marker_counts(F.col("html"))
    now = datetime.now(timezone.utc).isoformat()
    seen = read.select("book_slug", F.lit(now).alias("discovered_at"), F.col("url").alias("path"), "url", counts["n_poetry"].alias("n_poetry"), counts["n_verse_line"].alias("n_verse_line"), F.col("url").alias("cached"), F.when(F.col("html").isNull(), "no UTF-8").alias("error"))
    writers.write_report(reports.discovery_report(seen), f"{out}/books")
    links = read.select("book_slug", F.explode(H.book_paths(F.col("html"), F.col("book_slug"))).alias("path")).distinct()
    stem = F.regexp_replace(F.element_at(F.split("url", "/"), -1), r"\.html$", "")
    cached = read.select(F.concat(F.lit("/"), F.col("book_slug"), F.lit("/"), stem).alias("path"))
    writers.write_version(enrich.frontier(links, cached, "path"), f"{out}/frontier")
    reports.anomalies(seen).select("book_slug", "url", "n_poetry", "n_verse_line").show(20, False)
    read.unpersist()
    return 0


def page(spark: SparkSession | None, file: str) -> int:
    """The lines of one hymn page as JSON; 1: the page has none."""
    found = H.hymn_lines(Path(file).read_text(encoding="utf-8"))
    print(json.dumps(found, ensure_ascii=False, indent=2))
    return int(not found)


def parse(spark: SparkSession, pages: str, books: str, out: str, corpus: str, source: str) -> int:
    """All cached hymn pages to a file per poem, with a log of the run; 1: some page failed."""
    began = datetime.now(timezone.utc).isoformat()
    read = _pages(spark, pages)
    poems, failures = plans.hymns(read, readers.books(spark, books), corpus, source)
    record = poems.drop("url", "book_slug")
    writers.write_files(record, f"{out}/poems")
    results = poems.select("book_slug", "url", F.lit(None).cast("string").alias("error")).unionByName(failures.select("book_slug", "url", "error"))
    again = poems.where(F.col("file_name").rlike(r"--\d+\.json$")).count()
    log = reports.scrape_log(results, began, datetime.now(timezone.utc).isoformat(), again)
    writers.write_report(log, f"{out}/scrape_log")
    totals = log.select("total_ok", "total_failed").first()
    print(f"{totals['total_ok'] or 0} poems, {totals['total_failed'] or 0} pages failed, {again} names numbered")
    return int(bool(totals["total_failed"]))


def authors(spark: SparkSession, path: str, alias: str, dimension: str, source: str, out: str | None, dry_run: bool) -> int:
    """1: new names collide, unless it is a dry run. With out and without collisions the documents are written there with their authors and new names."""
    docs = readers.documents(spark, path, pattern=f"{source}--*.json")
    found = enrich.renamed(enrich.authors_of(docs.select("file_name"), spark.read.json(alias), spark.read.json(dimension)), source).cache()
    enrich.rename_counts(found).show()
    _print(found.where("new_name IS NOT NULL").orderBy("file_name").select("file_name", "new_name"))
    clash = enrich.collisions(found.where(F.col("new_name").isNotNull()), "new_name")
    status = int(not dry_run and clash.limit(1).count() > 0)
    if out and not dry_run and not status:
        known = found.select("file_name", "status", "new_name", "name_full", "wiki_id")
        read = readers.poems(spark, path, pattern=f"{source}--*.json").join(known, "file_name")
        changed = enrich.with_author(read, F.col("name_full"), F.col("wiki_id"), F.col("status") == "known")
        named = changed.withColumn("file_name", F.coalesce("new_name", "file_name")).drop("status", "new_name", "name_full", "wiki_id")
        writers.write_files(named, out)
    found.unpersist()
    return status


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quillspark")
    sub = p.add_subparsers(dest="what", required=True)
    for name, params in {"validate": ("path",), "duplicates": ("path", "out"), "apply": ("path", "plan", "out"), "discover": ("pages", "out"), "crawl": ("pages", "out"), "page": ("file",), "parse": ("pages", "books", "out", "corpus", "source"), "authors": ("path", "alias", "dimension", "source")}.items():
        s = sub.add_parser(name)
        for x in params:
            s.add_argument(x)
        if name in ("apply", "authors"):
            s.add_argument("--dry-run", action="store_true")
        if name == "authors":
            s.add_argument("--out")
    given = vars(p.parse_args(args))
    what = given.pop("what")
    return globals()[what](None if what == "page" else session(), **given)


if __name__ == "__main__":
    sys.exit(main())
