"""More queries over the test tables: pages of all layouts, files read back, faults planted in documents, small functions.

The test tables hold no pages and no files, so both are made from the poems: every title and line of the table goes
into a page of each layout, with the markup that its extraction must see through, or into a file that is read back.
The SQL beside a query says what must come out without making pages or files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.functions import text as T
from quillspark.operators import enrich, lines, quality, reports
from quillspark.plans import pages as plans
from quillspark.plans.shared import shared_dir, table
from quillspark.queries import BARE, LINES, WS, _collapse, _long, _poem_files, _poems, query
from quillspark.sources import readers, writers

#: A line as pages hold it here: without signs that are markup or apparatus in some layout.
PLAIN = r"[<>&\[\]|†*!?():\"']"


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), PLAIN, "")


def _plain_sql(x: str) -> str:
    return "regexp_replace(coalesce({}, ''), '{}', '', 'g')".format(x, PLAIN.replace("'", "''"))


def _page(poems: DataFrame, each, before: str = "", after: str = "") -> DataFrame:
    """(poem_no, html): a page of each poem with lines, each line by a function of its text and place."""
    body = F.array_join(F.transform("body", lambda x, i: each(_plain(x["text"]), i)), "\n")
    return poems.where(F.size("body") > 0).select("poem_no", F.concat(F.lit(before), body, F.lit(after)).alias("html"))


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _lines_of(pages: DataFrame, found: Column) -> DataFrame:
    rows = pages.select("poem_no", F.explode(found).alias("l")).select("poem_no", "l.stanza_id", "l.text", F.array_join("l.marginal_notes", " / ").alias("notes"))
    return _long(rows, "stanza_id")


TEXTS = f"SELECT poem_no, pos, {_collapse(_plain_sql('l.text'))} AS text FROM ({LINES})"


@query(f"SELECT poem_no, pos AS stanza_id, text, 'Luc. 2 v. ' || pos AS notes FROM ({TEXTS})")
def hymn_apparatus(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of hymn pages with nested elements, page breaks in page breaks, critical notes, witnesses and notes in the margin."""
    line = lambda t, i: _cat(
        '<div class="a poetry x"><div class="verse-line"><div><b>', t, '</b></div><span class="legacy-page-break"><span class="page-break-mark">|</span><a class="facsimile-link" href="#">3v</a></span>†',
        '<span class="textcriticalnote">1</span><span class="app">lemma</span><span class="appnotecontents">note</span><span class="marginal-note"><span class="marginal-note-content"> Luc. 2 v. ', i.cast("string"), " </span></span></div></div>",
    )
    pages = _page(_poems(spark, folder), line, '<script>"<div class=\'poetry\'>"</script><!-- <div class="poetry"> --><div id="region-content"><results>', "</results></div>")
    return _lines_of(pages, H.hymn_lines_of(H.clean_page(F.col("html"))))


@query(f"SELECT poem_no, pos AS stanza_id, text, '' AS notes FROM ({TEXTS}) WHERE text <> ''")
def archive_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Verse of archive pages: page marks, apparatus buttons and breaks go, emphasis stays as text, empty lines go and leave a gap in the stanzas."""
    line = lambda t, i: _cat('<div class="mt-3 mb-4"><div class=line><span class=pageBegin>12</span><em>', t, '</em><sup></sup><strong></strong><button id="App', i.cast("string"), '" data-x="<div></div>">n</button><a class=page-break-mark></a><br></div></div>')
    return _lines_of(_page(_poems(spark, folder), line, "<div class=text-container>", "</div><div class=footer>"), H.archive_verse_of("html"))


@query(f"SELECT poem_no, 0 AS stanza_id, text, '' AS notes FROM ({TEXTS}) WHERE text <> ''")
def archive_prose(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs of archive pages; empty ones go."""
    line = lambda t, i: _cat("<p class=x>", t, '<button id=n7>x</button></p>')
    return _lines_of(_page(_poems(spark, folder), line, "<div class=text-container>", "</div><div class=footer>"), H.prose_lines_of("html"))


@query(f"SELECT poem_no, pos AS stanza_id, text, 'Speaker: P' || pos AS notes FROM ({TEXTS}) WHERE text <> ''")
def archive_drama(spark: SparkSession, folder: str) -> DataFrame:
    """Drama pages: a wrapper for each line, and in front of it two speakers, of whom the first one speaks."""
    line = lambda t, i: _cat("<p class=drama-speaker>[3] | P", i.cast("string"), '</p><p class=drama-speaker>Q</p><div class="mt-3 mb-4"><div class=drama-line>', t, "</div></div>")
    pages = _page(_poems(spark, folder), line, "<div class=text-container><div class=drama>", "</div></div>")
    events = pages.select("poem_no", F.posexplode(H.drama_events_of("html")).alias("pos", "x")).select("poem_no", "pos", "x.*")
    rows = lines.speakers_to_stanzas(events, "poem_no").select("poem_no", "stanza_id", "text", F.array_join("marginal_notes", " / ").alias("notes"))
    return _long(rows, "stanza_id")


# ballads keep white space other than blanks and tabs
BALLADS = f"SELECT poem_no, pos, regexp_replace(regexp_replace({_plain_sql('l.text')}, '[ \\t]+', ' ', 'g'), '^[{WS}]+|[{WS}]+$', '', 'g') AS text FROM ({LINES})"


@query(f"""SELECT poem_no, row_number() OVER (PARTITION BY poem_no ORDER BY pos) - 1 AS line_id, row_number() OVER (PARTITION BY poem_no ORDER BY pos) - 1 AS stanza_id, text
FROM ({BALLADS}) WHERE regexp_matches(text, '[^{WS}]') AND NOT regexp_matches(text, '(?i)\\bf[ie]nis\\b')""")
def ballad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of ballad pages: numbered stanzas, notes and tooltips in tooltips gone, insertions opened, those written as entities too; empty stanzas leave no gap."""
    line = lambda t, i: _cat(
        "<tr><td><br/>[", i.cast("string"), ']</td></tr><tr><td><span class="source"><em>', t, '</em><sup>1</sup><div class="tooltip">a<span class="tooltiptext">note</span></div><span class="layout">x</span></span>&nbsp;</td><td>',
        'translation</td></tr><tr><br/></tr>',
    )
    keep = F.expr("filter(body, x -> NOT coalesce(x.text, '') RLIKE '(?i)\\\\bf[ie]nis\\\\b')")
    poems = _poems(spark, folder).withColumn("body", keep)
    read = plans.ballads(_page(poems, line, "<b>Titel:</b> (En viſe)<br/><table>", "</table>"), "poem_no")
    rows = read.select("poem_no", F.explode("body").alias("l")).select("poem_no", F.col("l.id").alias("line_id"), "l.stanza_id", "l.text")
    return _long(rows, "line_id", "stanza_id")


TITLE = rf"regexp_replace(regexp_replace({BARE.format('author.name')} || ': »' || {BARE.format('title')} || '«', '^[{WS}]+|[{WS}]+$', '', 'g'), '\n', ' ', 'g')"


@query(rf"""
SELECT poem_no, regexp_replace(CASE WHEN regexp_matches(raw, '{{Q}}') THEN regexp_extract(raw, '{{Q}}', 2) WHEN strpos(raw, ': ') > 0 THEN CASE WHEN contains(rest, ', ') THEN regexp_extract(rest, '^.*, (.*)$', 1) ELSE rest END ELSE raw END, '{{E}}', '', 'g') AS title,
  regexp_replace(CASE WHEN regexp_matches(raw, '{{Q}}') THEN regexp_extract(raw, '{{Q}}', 1) WHEN strpos(raw, ': ') > 0 THEN substr(raw, 1, strpos(raw, ': ') - 1) END, '{{E}}', '', 'g') AS author
FROM (SELECT poem_no, raw, substr(raw, strpos(raw, ': ') + 2) AS rest FROM (SELECT poem_no, {TITLE} AS raw FROM poems WHERE len(body) > 0))""".replace("{Q}", r"^([^:]+):\s*»([^«]+)«").replace("{E}", rf"^[{WS}]+|[{WS}]+$"))
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Title and author of 'Author: »Title«' in a page's head; titles with their own quotes or colons too."""
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[<>&]", ""), "\n", " ")
    html = F.concat(F.lit("<head><title>"), bare(F.col("author.name")), F.lit(": »"), bare(F.col("title")), F.lit("«</title></head>"))
    rows = _poems(spark, folder).where(F.size("body") > 0).select("poem_no", H.title_tag(html).alias("t"))
    return rows.select("poem_no", "t.title", "t.author")


@query(f"SELECT poem_no, {_collapse('chr(187) || coalesce(title, chr(32)) || chr(171)')} AS text FROM poems WHERE NOT contains(coalesce(title, ''), '&')")
def entities_and_space(spark: SparkSession, folder: str) -> DataFrame:
    """Titles with entities for three kinds of signs, as characters again."""
    escaped = F.concat(F.lit("&raquo;"), F.replace(F.replace(F.coalesce("title", F.lit(" ")), F.lit("ø"), F.lit("&oslash;")), F.lit("å"), F.lit("&#xe5;")), F.lit("&#171;"))
    return _poems(spark, folder).where(~F.coalesce("title", F.lit("")).contains("&")).select("poem_no", T.clean(escaped).alias("text"))


@query(rf"""SELECT b.book_slug AS url, CAST(year_published AS BIGINT) AS year_created, n_lines, n_stanzas, title FROM (SELECT poem_no AS book_slug, len(body) AS n_lines, len(body) AS n_stanzas FROM poems WHERE len(body) > 0) b
JOIN (SELECT poem_no, source.year_published AS year_published FROM poems) y ON y.poem_no = b.book_slug
LEFT JOIN (SELECT poem_no, arg_min(text, pos) AS title FROM ({TEXTS}) WHERE text <> '' GROUP BY poem_no) t ON t.poem_no = b.book_slug""")
def hymn_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole poem records of hymn pages, each with a book of its own: the year of the book, the first text as title, all lines."""
    line = lambda t, i: _cat('<div class="poetry"><div class="verse-line">', t, "</div></div>")
    poems = _poems(spark, folder)
    pages = _page(poems, line, '<div id="region-content"><results>', "</results></div>").select(F.col("poem_no").cast("string").alias("url"), F.col("poem_no").cast("string").alias("book_slug"), "html")
    books = poems.select(F.col("poem_no").cast("string").alias("slug"), "source.title", "source.publisher", "source.printer", "source.place", "source.year_published")
    records, _ = plans.hymns(pages, books, "hymns", "hymns")
    rows = records.select(F.col("url").cast("long").alias("url"), "year_created", F.size("body").alias("n_lines"), F.size(F.array_distinct(F.transform("body", lambda x: x["stanza_id"]))).alias("n_stanzas"), "title")
    return _long(rows, "year_created", "n_lines", "n_stanzas")


FAILURES = ("", "page is not cached", "page has no poem", "page has no region", "book is not in the manifest")


@query(f"SELECT e AS error, count(*) AS n FROM poems JOIN (VALUES {', '.join(f'({k}, {chr(39)}{e}{chr(39)})' for k, e in enumerate(FAILURES) if e)}) v(k, e) ON k = poem_no % 5 WHERE len(body) > 0 GROUP BY e")
def hymn_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Why pages gave no record: four fifths of the pages lack something, by turns."""
    line = lambda t, i: _cat('<div class="poetry"><div class="verse-line">', t, "</div></div>")
    poems, k = _poems(spark, folder), F.col("poem_no") % 5
    html = F.when(k == 1, F.lit(None)).when(k == 2, F.replace("html", F.lit("poetry"), F.lit("prose"))).when(k == 3, F.replace("html", F.lit("</results>"), F.lit(""))).otherwise(F.col("html"))
    book = F.when(k == 4, F.lit("none")).otherwise(F.col("poem_no").cast("string"))
    pages = _page(poems, line, '<div id="region-content"><results>', "</results></div>").select(F.col("poem_no").cast("string").alias("url"), book.alias("book_slug"), html.alias("html"))
    books = poems.select(F.col("poem_no").cast("string").alias("slug"), "source.title", "source.publisher", "source.printer", "source.place", "source.year_published")
    return plans.hymns(pages, books, "hymns", "hymns")[1].groupBy("error").agg(F.count("*").alias("n"))


# Files read back


def _files(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quillspark/{label}-{uuid.uuid4().hex}"


@query(f"""SELECT poem_no || '.json' AS file_name, title, author.name AS author, source.title AS source_title, CAST(coalesce(len(body), 0) AS BIGINT) AS n_lines,
TRY_CAST(CASE WHEN starts_with(trim(year_created), '[') THEN split_part(trim(year_created, '[] '), ',', 1) ELSE year_created END AS BIGINT) AS created_first, starts_with(trim(year_created), '[') AS is_span FROM poems""")
def files_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Every poem written as a file of its own and read again, typed."""
    at = _files(spark, "poems")
    poems = _poems(spark, folder).withColumn("year_created", F.try_parse_json("year_created"))
    named = poems.select(F.concat(F.col("poem_no").cast("string"), F.lit(".json")).alias("file_name"), *quality.KEYS, *writers.OPTIONAL)
    writers.write_files(named, at)
    read = readers.typed_years(readers.poems(spark, at))
    rows = read.select("file_name", "title", F.col("author.name").alias("author"), F.col("source.title").alias("source_title"), F.coalesce(F.size("body"), F.lit(0)).alias("n_lines"), "created_first", F.when(F.col("year_created").isNotNull() & ~F.is_variant_null("year_created"), "is_span").alias("x"), F.col("is_span"), F.col("year_created").alias("y"))
    span = F.when(F.is_variant_null("y"), F.lit(None)).otherwise(F.col("is_span"))
    return _long(rows.select("file_name", "title", "author", "source_title", F.greatest("n_lines", F.lit(0)).alias("n_lines"), "created_first", span.alias("is_span")), "n_lines", "created_first")


@query("SELECT 'V34' AS rule, count(*) AS n FROM poems UNION ALL SELECT 'V22', count(*) FROM poems WHERE body IS NULL HAVING count(*) > 0")
def files_validated(spark: SparkSession, folder: str) -> DataFrame:
    """Two rules on every poem as a file of several lines, read as it is."""
    at = _files(spark, "documents")
    poems = _poems(spark, folder).withColumn("year_created", F.try_parse_json("year_created"))
    writers.write_files(poems.select(F.concat(F.col("poem_no").cast("string"), F.lit(".json")).alias("file_name"), *quality.KEYS), at)
    return quality.findings(readers.documents(spark, at)).where("rule IN ('V22', 'V34')").groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT slug, title, publisher, printer, place, CAST(year_published AS BIGINT) AS year_published FROM books")
def books_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of books as one JSON file, read again."""
    at = _files(spark, "books")
    row = F.to_json(F.struct(F.col("slug"), "title", "publisher", "printer", "place", "year_published"))
    listed = table(spark, folder, "books").select(row.alias("j")).agg(F.concat(F.lit('{"books":['), F.array_join(F.collect_list("j"), ","), F.lit("]}")).alias("value"))
    listed.coalesce(1).write.text(at)
    return _long(readers.books(spark, at).select("slug", "title", "publisher", "printer", "place", "year_published"), "year_published")


@query("""SELECT book_slug, path, url, CAST(n_poetry AS BIGINT) AS n_poetry, CAST(n_verse_line AS BIGINT) AS n_verse_line, cached, error FROM discovery_pages WHERE book_slug IS NOT NULL""")
def discovery_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """The report of discovery, one record a book, written and read again page by page."""
    at = _files(spark, "discovery")
    writers.write_report(reports.discovery_report(table(spark, folder, "discovery_pages").withColumn("discovered_at", F.col("discovered_at").cast("string"))), at)
    records = spark.read.schema(readers.DISCOVERY).json(at)
    rows = records.select("book_slug", F.explode("pages").alias("p")).select("book_slug", "p.*")
    return _long(rows, "n_poetry", "n_verse_line")


@query("""SELECT count(*) AS attempted, count(*) FILTER (WHERE error IS NULL) AS ok, count(error) AS failed, CAST(count(DISTINCT book_slug) AS BIGINT) AS books, max(f) AS most_failed FROM
(SELECT *, count(error) OVER (PARTITION BY book_slug) AS f FROM discovery_pages WHERE book_slug IS NOT NULL)""")
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a run over all pages: totals, and the map of its books."""
    log = reports.scrape_log(table(spark, folder, "discovery_pages").where("book_slug IS NOT NULL"), "a", "b", 0)
    most = F.array_max(F.transform(F.map_values("per_book"), lambda x: x["failed"]))
    return _long(log.select(F.col("total_pages_attempted").alias("attempted"), F.col("total_ok").alias("ok"), F.col("total_failed").alias("failed"), F.size("per_book").alias("books"), most.alias("most_failed")), "books")


# Years, authors, findings

FORMS = ["{}", "Før {}", "Efter {}", "{}-{+7}", "{+7}-{}", "{}'erne", "{}erne", " {} ", "ca. {}", "før {}", "x{}", ""]


def _form(k: int, year: Column) -> Column:
    text, out = FORMS[k], []
    for part in text.replace("{+7}", "\0+\0").replace("{}", "\0y\0").split("\0"):
        out.append(year.cast("string") if part == "y" else (year + 7).cast("string") if part == "+" else F.lit(part))
    return F.concat(*out) if out else F.lit("")


YEAR_ROWS = f"SELECT poem_no, source.year_published AS y, CAST(poem_no % {len(FORMS)} AS INT) AS k FROM poems WHERE source.year_published BETWEEN 100 AND 9000"


@query(f"""SELECT poem_no, CASE WHEN k IN (0, 1, 2, 7) THEN 'int' WHEN k BETWEEN 3 AND 6 THEN 'list' WHEN k = 11 THEN 'empty' ELSE 'malformed' END AS kind,
CAST(CASE WHEN k <= 7 THEN y END AS BIGINT) AS first, CAST(CASE WHEN k IN (0, 1, 2, 7) THEN y WHEN k IN (3, 4) THEN y + 7 WHEN k IN (5, 6) THEN y + 9 END AS BIGINT) AS last FROM ({YEAR_ROWS})""")
def year_spans(spark: SparkSession, folder: str) -> DataFrame:
    """The year of every poem's source, written in twelve ways by turns and parsed."""
    rows = _poems(spark, folder).where("source.year_published BETWEEN 100 AND 9000").withColumn("k", (F.col("poem_no") % len(FORMS)).cast("int"))
    text = F.coalesce(*[F.when(F.col("k") == k, _form(k, F.col("source.year_published"))) for k in range(len(FORMS))])
    return _long(rows.select("poem_no", T.parse_year(text).alias("y")).select("poem_no", "y.kind", "y.first", "y.last"), "first", "last")


@query(f"SELECT kind, count(*) AS n, count(DISTINCT y) AS n_books FROM (SELECT y, CASE WHEN k IN (0, 1, 2, 7) THEN 'int' WHEN k BETWEEN 3 AND 6 THEN 'list' WHEN k = 11 THEN 'empty' ELSE 'malformed' END AS kind FROM ({YEAR_ROWS})) GROUP BY kind")
def year_span_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = _poems(spark, folder).where("source.year_published BETWEEN 100 AND 9000").withColumn("k", (F.col("poem_no") % len(FORMS)).cast("int"))
    text = F.coalesce(*[F.when(F.col("k") == k, _form(k, F.col("source.year_published"))) for k in range(len(FORMS))])
    return reports.year_forms(rows.select(text.alias("text"), F.col("source.year_published").alias("book")), "text", "book")


PARTS_SQL = r"SELECT poem_no, file_name, string_split(regexp_replace(file_name, '\.json$', ''), '--') AS p FROM poems"


@query(f"""
WITH named AS (SELECT *, CASE WHEN len(p) >= 4 THEN p[2] END AS slug FROM ({PARTS_SQL})),
alias AS (SELECT slug, min(n) AS key FROM (SELECT n.slug, p.author.name AS n FROM named n JOIN poems p USING (poem_no) WHERE p.poem_no % 5 < 4 AND p.author.name IS NOT NULL AND n.slug IS NOT NULL) GROUP BY slug),
entry AS (SELECT author.name AS key, min(author.wiki) AS wiki FROM poems WHERE author.name IS NOT NULL AND poem_no % 7 < 5 GROUP BY author.name)
SELECT poem_no, CASE WHEN len(p) < 4 THEN 'malformed' WHEN named.slug = 'anonymous' THEN 'anonymous' WHEN alias.key IS NULL THEN 'unknown' WHEN entry.key IS NULL THEN 'missing_key' ELSE 'known' END AS status, alias.key AS author_key, entry.wiki AS wiki_id
FROM named LEFT JOIN alias ON alias.slug = named.slug LEFT JOIN entry ON entry.key = alias.key""")
def author_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Files to authors by two look-ups, in dimensions that are made from four and five of the poems by turns, so that keys and entries are missing."""
    poems = _poems(spark, folder)
    named = poems.where("author.name IS NOT NULL").select("poem_no", T.name_parts(F.col("file_name"))["author"].alias("slug"), F.col("author.name").alias("key"), F.col("author.wiki").alias("wiki_id"))
    alias = named.where("poem_no % 5 < 4 AND slug IS NOT NULL").groupBy("slug").agg(F.min("key").alias("key"))
    authors = named.where("poem_no % 7 < 5").groupBy("key").agg(F.min("wiki_id").alias("wiki_id")).withColumn("name_full", F.col("key"))
    return enrich.authors_of(poems.select("poem_no", "file_name"), alias, authors).select("poem_no", "status", "author_key", "wiki_id")


AUTHOR = '"author":{"name":"N","viaf":null,"wiki":null,"country":null,"born":1600,"died":null}'
SOURCE = '"source":{"corpus":"C","title":"T","year_published":1600,"place":"P","url":"https://x.example/1","printer":null}'
LINE_0, LINE_1 = '{"id":0,"stanza_id":0,"text":"a","part":false,"marginal_notes":null}', '{"id":1,"stanza_id":1,"text":"b","part":"M","marginal_notes":["n"]}'
GOOD = '{"id":"","title":TITLE,"year_created":1600,' + AUTHOR + "," + SOURCE + ',"body":[' + LINE_0 + "," + LINE_1 + '],"neighbors":[],"duplicate":false,"locations":false}'
E, W, I = "error", "warning", "info"
# What is replaced in a document without faults, by what, and which findings must follow besides the banner V34.
FAULTS = (
    ("", "", []), ("{\"id\"", "{{\"id\"", [("V01", E, 1)]), (GOOD, "[1]", [("V02", E, 1)]), ('"id":"",', '"id":"","more":1,', [("V03", W, 1)]), ('"neighbors":[],', "", [("V04", E, 1)]), ('"neighbors":[],"duplicate":false,', "", [("V04", E, 2)]),
    ('"id":"",', '"id":"x",', [("V05", I, 1)]), ('"title":TITLE', '"title":5', [("V06", E, 1)]), ("[1600,1]", "", []), ('"year_created":1600', '"year_created":[1600]', [("V07", E, 1)]), ('"year_created":1600', '"year_created":[1600,"x"]', [("V07", E, 1)]),
    ('"year_created":1600', '"year_created":[1700,1600]', [("V08", E, 1)]), ('"year_created":1600', '"year_created":[1600,1700]', []), ('"year_created":1600', '"year_created":"1600"', [("V09", E, 1)]), ('"year_created":1600', '"year_created":true', [("V09", E, 1)]),
    (AUTHOR, '"author":"N"', [("V10", E, 1)]), ('"name":"N",', "", [("V11", E, 1)]), ('"name":"N"', '"name":" "', [("V12", E, 1)]), ('"name":"N"', '"name":7', [("V12", E, 1)]), ('"born":1600', '"born":"1600"', [("V13", E, 1)]), ('"born":1600', '"born":true', []),
    ('"wiki":null', '"wiki":" "', [("V14", E, 1)]), ('"wiki":null', '"wiki":"1Q"', [("V15", W, 1)]), (SOURCE, '"source":[]', [("V16", E, 1)]), ('"corpus":"C",', "", [("V17", E, 1)]), ('"corpus":"C"', '"corpus":""', [("V18", E, 1)]),
    ('"place":"P",', "", [("V19", W, 1)]), ('"year_published":1600', '"year_published":"1600"', [("V20", E, 1)]), ('"url":"https', '"url":"ftp', [("V21", E, 1)]), ('"printer":null', '"printer":3', [("V21", E, 1)]), ('"body":[' + LINE_0 + "," + LINE_1 + "]", '"body":"a"', [("V22", E, 1)]),
    (LINE_0 + ",", '"line",{"id":0,"stanza_id":0,"text":"a"},', [("V23", E, 1)]), ('"text":"a",', "", [("V24", E, 1)]), ('"id":1,', '"id":true,', [("V25", E, 1)]), ('"id":1,', '"id":4,', [("V26", W, 1)]), ('"stanza_id":1', '"stanza_id":1.5', [("V27", E, 1)]),
    ('"stanza_id":0', '"stanza_id":2', [("V28", W, 1)]), ('"text":"a"', '"text":null', [("V29", E, 1)]), ('"part":"M"', '"part":"M","words":["w"]', [("V30", I, 1)]), ('"part":"M"', '"part":"Z"', [("V31", W, 1)]), ('"part":"M"', '"part":0', []),
    ('["n"]', '"n"', [("V32", E, 1)]), ('["n"]', "[1]", [("V32", E, 1)]), ('["n"]', '[" "]', [("V33", W, 1)]),
)
HAS_BANNER = [k for k, f in enumerate(FAULTS) if f[2][:1] != [("V01", E, 1)]]
EXPECTED = [(k, *x) for k, f in enumerate(FAULTS) for x in f[2]] + [(k, "V34", I, 1) for k in HAS_BANNER]
EXPECTED_SQL = "(VALUES " + ", ".join(f"({k}, '{r}', '{level}', {n})" for k, r, level, n in EXPECTED) + ") e(k, rule, level, n)"


def _faulty(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text): a document for each poem, with its title and one of the faults by turns."""
    title = F.coalesce(F.regexp_extract(F.to_json(F.struct("title")), r'(?s)^\{"title":(.*)\}$', 1), F.lit("null"))
    title = F.when(F.col("title").isNull(), "null").otherwise(title)
    texts = [F.when(F.col("poem_no") % len(FAULTS) == k, F.replace(F.lit(GOOD.replace(old, new, 1) if old else GOOD), F.lit("TITLE"), title)) for k, (old, new, _) in enumerate(FAULTS)]
    return _poems(spark, folder).select(F.concat(F.col("poem_no").cast("string"), F.lit(".json")).alias("path"), F.coalesce(*texts).alias("text"))


@query(f"SELECT rule, level, CAST(sum(n) AS BIGINT) AS n FROM poems JOIN {EXPECTED_SQL} ON k = poem_no % {len(FAULTS)} GROUP BY rule, level")
def planted_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Findings of every rule, on documents with one planted fault each."""
    return quality.findings(_faulty(spark, folder)).groupBy("rule", "level").agg(F.count("*").alias("n"))


@query(f"""SELECT path, CAST(coalesce(sum(n) FILTER (WHERE level = 'error'), 0) AS BIGINT) AS errors, CAST(coalesce(sum(n) FILTER (WHERE level = 'warning'), 0) AS BIGINT) AS warnings
FROM (SELECT poem_no || '.json' AS path, level, n FROM poems JOIN {EXPECTED_SQL} ON k = poem_no % {len(FAULTS)}) GROUP BY ROLLUP (path)""")
def planted_faults_by_level(spark: SparkSession, folder: str) -> DataFrame:
    """Errors and warnings of each faulty document, and of all."""
    return quality.by_level(quality.findings(_faulty(spark, folder)))


@query(f"SELECT CAST(k AS BIGINT) AS variant, bool_or(level = 'error') AS has_errors FROM (SELECT DISTINCT poem_no % {len(FAULTS)} AS v FROM poems) JOIN {EXPECTED_SQL} ON k = v GROUP BY k")
def planted_faults_found(spark: SparkSession, folder: str) -> DataFrame:
    """Which kinds of faulty documents have errors."""
    variant = F.substring_index("path", ".", 1).cast("long") % len(FAULTS)
    return quality.findings(_faulty(spark, folder)).groupBy(variant.alias("variant")).agg(F.bool_or(F.col("level") == "error").alias("has_errors"))


@query(rf"""SELECT poem_no, substr(regexp_replace(regexp_replace(regexp_replace(replace(lower({{T}}), 'æ', 'ae'), '[^a-z0-9]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS slug
FROM poems WHERE regexp_full_match(coalesce(title, ''), '[\x20-\x7eæøåÆØÅäöüÄÖÜéÉ]*')""".replace("{T}", "strip_accents(coalesce(title, ''))"))
def title_slugs_plain(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of the titles in plain letters, where SQL's removal of accents says the same as decomposition."""
    rows = _poems(spark, folder).where(F.coalesce("title", F.lit("")).rlike("^[\\x20-\\x7eæøåÆØÅäöüÄÖÜéÉ]*$"))
    return rows.select("poem_no", F.substring(T.title_slug(F.col("title"), 1000), 1, 80).alias("slug"))
