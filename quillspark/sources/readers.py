"""Reading documents, dimensions, crawl records, pages and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.dedup import parse_plan

AUTHOR = "struct<name:string,viaf:string,wiki:string,country:string,born:int,died:int>"
SOURCE = "struct<id:string,corpus:string,title:string,publisher:string,printer:string,place:string,year_published:int,url:string>"
RAW_LINE = "struct<id:int,stanza_id:int,text:string,part:variant,marginal_notes:array<string>>"
POEM = (
    f"id string, title string, year_created variant, neighbors array<string>, duplicate boolean, locations boolean, author {AUTHOR}, source {SOURCE}, "
    f"body array<{RAW_LINE}>, dramatic_poem boolean, diplomatic_edition boolean"
)
DISCOVERY = (
    "book_slug string, discovered_at string, n_urls int, n_poem_pages int, n_poems_total int, n_verse_lines_total int, n_anomalies int, "
    "pages array<struct<path:string,url:string,n_poetry:int,n_verse_line:int,cached:string,error:string>>"
)
BOOK = "slug string, title string, publisher string, printer string, place string, year_published int"


def poems(spark: SparkSession, *paths: str, pattern: str = "*.json", strict: bool = False) -> DataFrame:
    """One row per JSON file of the paths, typed, with file_name. Files that are no JSON are skipped; strict: they fail the read."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    read = spark.read.schema(POEM).option("multiLine", True).option("mode", mode).option("pathGlobFilter", pattern)
    return read.json(list(paths)).select("*", F.col("_metadata.file_name").alias("file_name"))


def documents(spark: SparkSession, *paths: str, pattern: str = "*.json") -> DataFrame:
    """(path, file_name, text, doc) of every file, doc a variant and null where the text is no JSON: for validation."""
    read = spark.read.option("pathGlobFilter", pattern).text(list(paths), wholetext=True)  # as an argument, since text() overrides the option
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"), F.try_parse_json("value").alias("doc"))


def typed_years(df: DataFrame) -> DataFrame:
    """Adds created_first, created_last and is_span from the variant year_created, and types the part of lines: false is null."""
    year = F.col("year_created")
    span = F.try_variant_get(year, "$", "array<int>")
    one = F.try_variant_get(year, "$", "int")
    first, last = F.coalesce(one, F.try_element_at(span, F.lit(1))), F.coalesce(one, F.try_element_at(span, F.lit(2)))
    part = lambda x: F.when(F.schema_of_variant(x["part"]) == "STRING", F.try_variant_get(x["part"], "$", "string"))
    body = F.transform("body", lambda x: x.withField("part", part(x)))
    return df.withColumns({"created_first": first, "created_last": last, "is_span": span.isNotNull(), "body": body})


def books(spark: SparkSession, path: str) -> DataFrame:
    """A manifest {books: [...]} or a list of books."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    listed = F.coalesce(F.try_variant_get("v", "$.books", f"array<struct<{_struct(BOOK)}>>"), F.try_variant_get("v", "$", f"array<struct<{_struct(BOOK)}>>"))
    return raw.select(F.explode(listed).alias("b")).select("b.*")


def _struct(ddl: str) -> str:
    return ",".join(":".join(f.split()) for f in ddl.split(", "))


def discovery(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the discovery records, with its book."""
    records = spark.read.schema(DISCOVERY).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json").json(path)
    return records.select("book_slug", "discovered_at", F.explode("pages").alias("p")).select("book_slug", "discovered_at", "p.*")


def pages(spark: SparkSession, path: str, pattern: str = "*.html", strict: bool = False) -> DataFrame:
    """(path, html) of raw pages in UTF-8. Bytes that are none become replacement characters; strict: html is null then."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    raw = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(raw), raw) if strict else F.make_valid_utf8(raw)
    return read.select("path", text.alias("html"))


def plan(spark: SparkSession, path: str) -> DataFrame:
    return parse_plan(spark.read.text(path))
