"""From raw pages to poem records, one plan per layout.

Every plan returns poems and failures: a page that yields no poem is a row with its reason, never an exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.functions import text as T
from quillspark.operators import enrich, lines
from quillspark.plans.shared import materialise, spread

NO_NOTES = "cast(array() as array<string>)"


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _numbered(found: Column) -> Column:
    return F.transform(found, lambda x, i: F.struct(i.alias("id"), x["stanza_id"].alias("stanza_id"), x["text"].alias("text"), F.lit(False).alias("part"), x["marginal_notes"].alias("marginal_notes")))


def hymns(pages: DataFrame, books: DataFrame, corpus: str, source: str) -> tuple[DataFrame, DataFrame]:
    """pages (url, book_slug, html) -> (poems with file_name, failures (url, book_slug, error)).

    A hymn's title is its first text; its author is anonymous. Lines are kept in the page's row; what is shuffled is
    the look-up of books and the names, which are numbered by themselves and joined to the parsed pages.
    """
    known = enrich.first_of_key(books, "slug", "year_published", "title").withColumnsRenamed({"title": "book_title", "slug": "book_slug"})
    page = spread(pages.select("url", "book_slug", "html")).select("url", "book_slug", H.clean_page(F.col("html")).alias("html")).join(known.withColumn("known", F.lit(True)), "book_slug", "left")
    error = (
        F.when(F.col("html").isNull(), "page is not cached").when(~H.is_poem_page(F.col("html")), "page has no poem")
        .when(F.col("known").isNull(), "book is not in the manifest").when(H.region(F.col("html")) == "", "page has no region")
    )
    tried = page.withColumn("error", error).withColumn("found", F.when(F.col("error").isNull(), H.hymn_lines_of("html"))).drop("html")
    tried = tried.withColumn("error", F.when(F.col("error").isNotNull(), F.col("error")).when(F.size("found") == 0, "page has no verse"))
    tried = materialise(tried.withColumn("_id", F.monotonically_increasing_id()), "pages")  # parsed once, for poems, names and failures
    good = tried.where("error IS NULL")
    title = F.try_element_at(F.filter("found", lambda x: x["text"] != ""), F.lit(1))["text"]
    poems = good.select(
        _null().alias("id"), title.alias("title"), F.col("year_published").alias("year_created"), F.expr("cast(array() as array<string>)").alias("neighbors"), F.lit(False).alias("duplicate"), F.lit(False).alias("locations"),
        F.struct(F.lit("anonymous").alias("name"), *[_null(k).alias(n) for n, k in (("viaf", "string"), ("wiki", "string"), ("country", "string"), ("born", "int"), ("died", "int"))]).alias("author"),
        F.struct(_null().alias("id"), F.lit(corpus).alias("corpus"), F.col("book_title").alias("title"), "publisher", "printer", "place", "year_published", "url").alias("source"),
        _numbered(F.col("found")).alias("body"), "url", "book_slug", "_id",
    )
    names = good.select("_id", "url", T.file_name(F.lit(source), F.lit("anonymous"), T.hymn_slug(title), F.col("book_slug")).alias("name"))
    unique = enrich.with_suffixes(names, "name", "url").select("_id", F.col("unique_name").alias("file_name"))
    return poems.join(unique, "_id").drop("_id"), tried.where("error IS NOT NULL").select("url", "book_slug", "error")


def ballads(pages: DataFrame, key: str = "url") -> DataFrame:
    """pages (key, html) -> (key, title, body): lines of the first table, in stanzas. A page without a table has a null body."""
    page = pages.select(key, T.reread(F.col("html")).alias("html"))
    rows = page.select(key, H.ballad_title_of("html").alias("title"), F.posexplode_outer(H.ballad_rows_of("html")).alias("pos", "row")).select(key, "title", "pos", "row.kind", "row.text")
    kept = rows.where("kind = 'stanza' OR coalesce(text, '') <> ''").where((F.col("kind") == "stanza") | ~F.col("text").rlike(r"^[\s*|:()?!\[\]<>]*$"))
    numbered = lines.number_lines(lines.number_stanzas(kept, key, F.col("kind") == "stanza"), key).withColumn("marginal_notes", F.expr(NO_NOTES))
    bodies = lines.to_body(numbered.withColumn("stanza_id", F.col("stanza_id").cast("int")), key)
    titles = rows.groupBy(key).agg(F.first("title").alias("title"))
    return titles.join(bodies, key, "left")


def publications(pages: DataFrame) -> DataFrame:
    """pages (book_slug, url, html) of books -> their author, year, language, title and addresses; only Danish books with metadata."""
    meta = H.metadata(F.col("html"))
    read = pages.select("book_slug", "url", H.language(F.col("html")).alias("language"), meta.alias("meta"), F.regexp_extract_all("html", F.lit(r"""href=(?:https?://[a-z.]+)?/books/([^/\s>]+/\d+)/?"""), F.lit(1)).alias("links"))
    kept = read.where(T.is_danish(F.col("language"))).where(F.size("meta") > 0)
    first = F.col("meta")[0]
    named = F.coalesce(T.strip(F.try_element_at(first, F.lit("Forfatter"))), F.lit(""))
    present = (named != "") & (F.lower(named) != "anonym")
    own = F.filter("links", lambda x: F.substring_index(x, "/", 1) == F.col("book_slug"))
    numbers = F.transform(F.array_sort(F.transform(F.array_distinct(F.transform(own, lambda x: F.substring_index(x, "/", -1))), lambda t: F.struct(t.cast("long").alias("n"), t.alias("t")))), lambda s: s["t"])
    return kept.select(
        "book_slug", F.when(present, named).otherwise("anonymous").alias("author"), present.alias("author_given"), T.whole_number(F.try_element_at(first, F.lit("Udgivelsesår"))).alias("year_published"),
        _null().alias("publisher"), "language", T.source_title(F.col("book_slug")).alias("source_title"), numbers.alias("text_links"), "url",
    )


def _crumbs(page: DataFrame) -> DataFrame:
    library = lambda x: F.lower(x["text"]).isin(*H.LIBRARY)
    crumbs = page.withColumn("crumbs", H.breadcrumbs(F.col("html")))
    meaning = F.filter("crumbs", lambda x: ~library(x))
    last, many = F.try_element_at("crumbs", F.lit(-1))["text"], F.size("crumbs") >= 2
    active = F.when(many & ~T.strip(last).isin("", ":"), T.split_crumb(last)["title"])
    opener = F.when(F.size(meaning) >= 2, meaning[0]["text"]).when(F.size(meaning) == 0, F.try_element_at("crumbs", F.lit(1))["text"])
    named = F.filter(F.transform(F.reverse(F.filter(meaning, lambda x: x["text"] != "")), lambda x: T.split_crumb(x["text"])["author"]), lambda a: a.isNotNull() & (F.lower(a) != "empty"))
    return crumbs.withColumn("crumb_title", active).withColumn("crumb_source", F.when(many, T.split_crumb(opener)["title"])).withColumn("crumb_author", F.try_element_at(named, F.lit(1)))


def archive(pages: DataFrame, books: DataFrame, corpus: str) -> DataFrame:
    """pages (url, book_slug, number, html, diplomatic), books as publications() gives -> poems with their url.

    A page without a title or a body, with music alone or with a single line of verse gives no poem.
    """
    page = _crumbs(pages.join(books.withColumnRenamed("url", "book_url"), "book_slug").where(~H.is_music_page(F.col("html"))))
    tag = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    from_tag, from_h1 = H.title_tag(F.col("html"))["title"], T.heading(H.title_h1(F.col("html")))
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    placeholder = lambda c: F.coalesce(F.lower(c).startswith("empty:"), F.lit(False))
    second = F.when(empty(F.col("crumb_title")), from_h1).otherwise(F.col("crumb_title"))
    usable = ~empty(from_tag) & ~placeholder(from_tag) & ~F.rtrim(tag).endswith(",")
    title = enrich.titled(F.when((empty(second) | placeholder(second)) & usable, from_tag).otherwise(second), F.col("book_slug"))
    year = F.coalesce(H.page_year(F.col("html")), F.col("year_published"))
    tag_author = T.split_crumb(F.when(F.col("html").rlike("<title>(.*?)</title>"), T.strip(tag)))["author"]
    tag_author = F.when(F.lower(tag_author) != "empty", tag_author)
    author = T.author_or_anonymous(F.coalesce(F.when(F.col("author_given"), F.col("author")).otherwise(F.coalesce("crumb_author", tag_author)), F.col("author")))
    base = F.regexp_replace("book_url", "/+$", "")
    address = F.when(F.col("number").isNull(), F.col("book_url")).otherwise(F.concat(base, F.lit("/"), F.col("number"), F.lit("/")))
    kind = H.body_type(F.col("html"))
    read = page.select(
        "url", "book_slug", title.alias("title"), year.alias("year"), author.alias("author"), address.alias("poem_url"), T.title_case("crumb_source").alias("source_title"), "publisher",
        F.coalesce("diplomatic", F.lit(False)).alias("diplomatic"), kind.alias("kind"), "html",
    ).where("title IS NOT NULL AND kind <> 'unknown'")
    plain = F.when(F.col("kind") == "line", H.archive_verse_of("html")).when(F.col("kind") == "prose", H.prose_lines_of("html"))
    of_verse = read.where("kind <> 'drama'").select("url", F.posexplode(plain).alias("pos", "x")).select("url", "pos", "x.*")
    events = read.where("kind = 'drama'").select("url", F.posexplode(H.drama_events_of("html")).alias("pos", "x")).select("url", "pos", "x.*")
    every = of_verse.unionByName(lines.speakers_to_stanzas(events, "url").withColumn("stanza_id", F.col("stanza_id").cast("int")))
    bodies = lines.to_body(lines.number_lines(every, "url"), "url")
    whole = read.drop("html").join(bodies, "url").where(enrich.keeps_body(F.col("kind"), F.size("body")))
    return whole.select(
        _null().alias("id"), "title", F.col("year").alias("year_created"), _null("array<string>").alias("neighbors"), F.lit(False).alias("duplicate"), F.lit(False).alias("locations"),
        F.struct(F.col("author").alias("name"), _null().alias("country")).alias("author"),
        F.struct(F.lit(corpus).alias("corpus"), F.col("source_title").alias("title"), "publisher", _null().alias("printer"), _null().alias("place"), F.col("year").alias("year_published"), F.col("poem_url").alias("url")).alias("source"),
        "body", F.when(F.col("diplomatic"), F.lit(True)).alias("diplomatic_edition"), F.when(F.col("kind") == "drama", F.lit(True)).alias("dramatic_poem"), "url", "book_slug",
    )
