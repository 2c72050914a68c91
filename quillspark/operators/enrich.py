"""Look-ups, nested updates, names of files and their collisions, and the choice of editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.html import MUSIC_BOOKS
from quillspark.plans.skew import row_numbers


def first_of_key(dim: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the first by order, nulls last. Repeated keys would multiply what is looked up."""
    best = Window.partitionBy(key).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    return dim.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def pages_of_books(pages: DataFrame, books: DataFrame) -> DataFrame:
    """Poem-bearing pages with their book; pages of unknown books go."""
    bearing = pages.where(F.coalesce("n_poetry", F.lit(0)) > 0)
    known = first_of_key(books, "slug", "year_published", "title")
    return bearing.join(known, bearing["book_slug"] == known["slug"])


def frontier(links: DataFrame, cached: DataFrame, key: str = "url") -> DataFrame:
    """Links that aren't in the cache yet, once each."""
    return links.select(key).distinct().join(cached.select(key).distinct(), key, "left_anti")


def authors_of(files: DataFrame, alias: DataFrame, authors: DataFrame) -> DataFrame:
    """files (file_name) with name parts, status and the author's entry, by two look-ups: slug to key, key to author.

    status: malformed (fewer than four parts), anonymous, unknown (no key), missing_key (no author), known.
    """
    named = files.withColumn("parts", T.name_parts(F.col("file_name")))
    keyed = named.join(first_of_key(alias, "slug", "key").select(F.col("slug").alias("_slug"), F.col("key").alias("_key")), F.col("parts.author") == F.col("_slug"), "left")
    entry = first_of_key(authors, "key", "name_full").select(F.col("key").alias("_akey"), "name_full", "wiki_id")
    found = keyed.join(entry, F.col("_key") == F.col("_akey"), "left")
    status = (
        F.when(F.col("parts").isNull(), "malformed").when(F.col("parts.author") == "anonymous", "anonymous")
        .when(F.col("_key").isNull(), "unknown").when(F.col("_akey").isNull(), "missing_key").otherwise("known")
    )
    return found.withColumn("status", status).drop("_slug", "_akey").withColumnRenamed("_key", "author_key")


def renamed(found: DataFrame, source: str) -> DataFrame:
    """Adds new_name where it is known; a collision's number stays part of the name."""
    slug = F.when(F.col("status") == "anonymous", "anonymous").when(F.col("status") == "known", T.author_slug(F.col("name_full")))
    tail = F.coalesce(F.concat(F.lit("--"), F.col("parts.copy").cast("string")), F.lit(""))
    return found.withColumn("new_name", F.concat(F.lit(source + "--"), slug, F.lit("--"), F.col("parts.title"), F.lit("--"), F.col("parts.book"), tail, F.lit(".json")))


def rename_counts(found: DataFrame) -> DataFrame:
    """(status, n, to_rename)."""
    return found.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("new_name") != F.col("file_name")).alias("to_rename"))


def collisions(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(name).agg(F.count("*").alias("n")).where("n > 1")


def name_number(name: Column) -> Column:
    """struct(root, ext, number) of a name: x--3.json has the number 3, x.json the number 1."""
    stem = F.regexp_replace(name, r"\.json$", "")
    number = F.coalesce(F.regexp_extract(stem, r"--(\d+)$", 1).try_cast("long"), F.lit(1).cast("long"))
    return F.struct(F.regexp_replace(stem, r"(--\d+)+$", "").alias("root"), F.when(name.endswith(".json"), ".json").otherwise("").alias("ext"), number.alias("number"))


def highest_numbers(df: DataFrame, name: str) -> DataFrame:
    """(root, ext, high): the highest number among the names of each root."""
    return df.where(F.col(name).isNotNull()).select(name_number(F.col(name)).alias("x")).groupBy("x.root", "x.ext").agg(F.max("x.number").alias("high"))


def with_suffixes(df: DataFrame, name: str, *order: str, taken: DataFrame | None = None) -> DataFrame:
    """Adds unique_name: the second and later rows of one name get --2, --3 and so on, in the stated order.

    Numbers that other rows of the same root have anyhow (x--2 beside two x) aren't given away: numbering goes on
    behind the highest. taken (root, ext, high) holds the highest numbers given earlier; a name whose number isn't
    above that of its root counts as given. Null names stay null. One name may belong to a large part of all rows.
    """
    named = df.where(F.col(name).isNotNull()).withColumn("_x", name_number(F.col(name)))
    rows = named.select(*df.columns, F.col("_x.root").alias("_root"), F.col("_x.ext").alias("_ext"), F.col("_x.number").alias("_number"))
    ranked = row_numbers(rows, [name], list(order), "_n")
    high = ranked.groupBy("_root", "_ext").agg(F.max("_number").alias("_high"))
    before = F.lit(0).cast("long")
    if taken is not None:
        old = taken.select(F.col("root").alias("_root"), F.col("ext").alias("_ext"), F.col("high").alias("_old"))
        before = F.coalesce("_old", F.lit(0))
        ranked, high = ranked.join(old, ["_root", "_ext"], "left"), high.join(old, ["_root", "_ext"], "left")
    high = high.select("_root", "_ext", F.greatest("_high", before).alias("_high"))
    first = (F.col("_n") == 1) & (F.col("_number") > before)
    later = row_numbers(ranked.where(~first), ["_root", "_ext"], [name, "_n"], "_k").join(high, ["_root", "_ext"])
    given = F.concat("_root", F.lit("--"), (F.col("_high") + F.col("_k")).cast("string"), "_ext")
    whole = ranked.where(first).withColumn("unique_name", F.col(name)).unionByName(later.withColumn("unique_name", given), allowMissingColumns=True)
    nameless = df.where(F.col(name).isNull()).withColumn("unique_name", F.lit(None).cast("string"))
    return whole.select(*df.columns, "unique_name").unionByName(nameless)


def needs_author(doc: Column, name: Column) -> Column:
    """Whether a document's author has another name, or no key wiki at all."""
    old = F.try_variant_get(doc, "$.author.name", "string")
    return ~old.eqNullSafe(name) | F.try_variant_get(doc, "$.author.wiki", "variant").isNull()


def with_author(poems: DataFrame, name: Column, wiki: Column, when: Column) -> DataFrame:
    """Replaces two fields of the author where it is asked for; the others stay."""
    return poems.withColumn("author", F.when(when, F.col("author").withField("name", name).withField("wiki", wiki)).otherwise(F.col("author")))


def chosen_editions(works: DataFrame, slug: str = "slug") -> DataFrame:
    """Of each work the normalised edition, else the diplomatic one, never the modern translation."""
    kept = works.where(~F.col(slug).endswith(".da")).withColumn("work", T.base_work(F.col(slug)))
    best = Window.partitionBy("work").orderBy(F.col(slug).endswith("_dipl"), slug)
    return kept.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def without_lone_prose(pages: DataFrame, book: str = "book", kind: str = "kind", least: int = 3) -> DataFrame:
    """Prose pages stay only in books with enough verse or drama; books of prose alone go."""
    verse = F.count_if(F.col(kind).isin("line", "drama")).over(Window.partitionBy(book))
    return pages.withColumn("_v", verse).where((F.col(kind) != "prose") | (F.col("_v") >= least)).drop("_v")


def without_music_books(pages: DataFrame, book: str = "book", books: tuple[str, ...] = MUSIC_BOOKS) -> DataFrame:
    """Pages of books that hold settings of a poem and no poems go; pages without a book stay."""
    return pages.where(~F.coalesce(F.col(book).isin(*books), F.lit(False)))


def keeps_body(kind: Column, n_lines: Column) -> Column:
    """Whether a body is kept: one line alone only of prose, none never."""
    return (n_lines > 1) | ((n_lines == 1) & (kind == "prose"))


def titled(title: Column, book: Column) -> Column:
    """A title without its number; a placeholder gives way to the book's slug, '' to null."""
    bare = T.unnumbered(title)
    named = F.when(F.lower(bare).startswith("empty:") | (F.lower(bare) == "empty"), T.title_from_slug(book)).otherwise(bare)
    return F.nullif(named, F.lit(""))
