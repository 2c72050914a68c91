"""The reference capabilities as queries over the test tables, each with the SQL to compare it with where SQL has the means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.functions import text as T
from quillspark.operators import dedup, enrich, lines, quality, reports
from quillspark.plans import pages as plans
from quillspark.plans.shared import table
from quillspark.sources import writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
#: White space in RE2.
WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _norm(x: str) -> str:
    s = f"lower(translate(translate(coalesce({x}, ''), '{T.SIGNS}', ''), 'ſ', 's'))"
    for a, b in T.COMPARED.items():
        s = f"replace({s}, '{a}', '{b}')"
    return f"regexp_replace(trim(regexp_replace({s}, '[{WS}]+', ' ', 'g')), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


LINES = "SELECT poem_no, i - 1 AS pos, body[i] AS l FROM (SELECT poem_no, body, unnest(range(1, len(body) + 1)) AS i FROM poems)"


def _poems(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "poems")


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


# Lines and order


@query(f"SELECT poem_no, CAST(pos AS BIGINT) AS pos, CAST(l.id AS BIGINT) AS line_id, CAST(l.stanza_id AS BIGINT) AS stanza_id, l.text AS text FROM ({LINES}) WHERE l IS NOT NULL")
def lines_exploded(spark: SparkSession, folder: str) -> DataFrame:
    return _long(lines.body_lines(_poems(spark, folder)).drop("notes"), "pos", "line_id", "stanza_id")


@query(f"SELECT poem_no, CAST(pos AS BIGINT) AS pos, norm FROM (SELECT poem_no, pos, {_norm('l.text')} AS norm FROM ({LINES}) WHERE l IS NOT NULL) WHERE length(norm) >= 3")
def text_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return _long(lines.compared_lines(lines.body_lines(_poems(spark, folder))).select("poem_no", "pos", "norm"), "pos")


DOC_LINES = r"SELECT doc_id, i - 1 AS pos, parts[i] AS text FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS parts FROM documents WHERE text IS NOT NULL))"


@query(f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS line_id, text FROM ({DOC_LINES}) WHERE regexp_matches(text, '[^{WS}]')")
def line_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.text_lines(table(spark, folder, "documents")).where(T.strip(F.col("text")) != "")
    return _long(lines.number_lines(rows, "doc_id").select("doc_id", "line_id", "text"), "line_id")


@query(f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, dense_rank() OVER (PARTITION BY doc_id ORDER BY raw) - 1 AS stanza_id FROM (
  SELECT doc_id, pos, text, sum(CASE WHEN regexp_matches(text, '[^{WS}]') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS raw FROM ({DOC_LINES})
) WHERE regexp_matches(text, '[^{WS}]')""")
def stanza_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.text_lines(table(spark, folder, "documents"))
    return _long(lines.number_stanzas(rows, "doc_id", T.strip(F.col("text")) == "").select("doc_id", "pos", "stanza_id"), "pos", "stanza_id")


@query(f"SELECT poem_no, arg_min(l.text, pos) FILTER (WHERE coalesce(l.text, '') <> '') AS title FROM ({LINES}) WHERE l IS NOT NULL GROUP BY poem_no")
def first_nonempty_line(spark: SparkSession, folder: str) -> DataFrame:
    return lines.first_text(lines.body_lines(_poems(spark, folder)), "poem_no")


@query(f"""
SELECT poem_no, CAST(pos AS BIGINT) AS pos, CAST(coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY poem_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS BIGINT) AS before
FROM (SELECT poem_no, pos, CASE WHEN coalesce(l.text, '') <> '' THEN l.id END AS v FROM ({LINES}))""")
def last_valid_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.body_lines(_poems(spark, folder)).withColumn("v", F.when(F.coalesce("text", F.lit("")) != "", F.col("line_id")))
    return _long(rows.select("poem_no", "pos", lines.last_valid_before(F.col("v"), "poem_no", "pos").alias("before")), "pos", "before")


# Blocks, containment, plans

BLOCKS = f"SELECT poem_no, {_norm('title')} AS block_title, {_norm('source.title')} AS block_source FROM poems"


@query(f"SELECT block_title, block_source, count(*) AS n FROM ({BLOCKS}) WHERE block_title <> '' GROUP BY ALL HAVING count(*) >= 2")
def dedup_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.block_sizes(_poems(spark, folder))


CONTAINED = f"""
WITH b AS (SELECT * FROM ({BLOCKS}) WHERE block_title <> ''),
l AS (SELECT poem_no, norm, count(*) AS times FROM (SELECT poem_no, {_norm('l.text')} AS norm FROM ({LINES}) WHERE l IS NOT NULL) WHERE length(norm) >= 3 GROUP BY ALL),
s AS (SELECT poem_no, count(*) AS size, sum(times) AS n FROM l GROUP BY ALL),
j AS (SELECT x.block_title, x.block_source, x.poem_no AS a, y.poem_no AS b, count(*) AS c FROM b x JOIN b y ON x.block_title = y.block_title AND x.block_source = y.block_source AND x.poem_no < y.poem_no
  JOIN l lx ON lx.poem_no = x.poem_no JOIN l ly ON ly.poem_no = y.poem_no AND ly.norm = lx.norm GROUP BY ALL),
p AS (SELECT block_title, block_source, a, b, c / sa.size AS a_in_b, c / sb.size AS b_in_a, CAST(sa.n AS BIGINT) AS lines_a, CAST(sb.n AS BIGINT) AS lines_b
  FROM j JOIN s sa ON sa.poem_no = a JOIN s sb ON sb.poem_no = b WHERE greatest(c / sa.size, c / sb.size) >= 0.9 - 1e-12)
"""


@query(CONTAINED + "SELECT a, b, round(a_in_b, 9) AS a_in_b, round(b_in_a, 9) AS b_in_a, lines_a, lines_b FROM p")
def dedup_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of poems of one title and source title, one contained in the other."""
    pairs = dedup.contained_poems(_poems(spark, folder))
    return pairs.select("a", "b", F.round("a_in_b", 9).alias("a_in_b"), F.round("b_in_a", 9).alias("b_in_a"), "lines_a", "lines_b")


@query(CONTAINED + "SELECT a, b, round(greatest(a_in_b, b_in_a), 9) AS most FROM p ORDER BY greatest(a_in_b, b_in_a) DESC, a, b LIMIT 20")
def dedup_top20(spark: SparkSession, folder: str) -> DataFrame:
    top = dedup.most_contained_first(dedup.contained_poems(_poems(spark, folder)), 20)
    return top.select("a", "b", F.round(F.greatest("a_in_b", "b_in_a"), 9).alias("most"))


@query(CONTAINED + f"""SELECT a, b, CAST(x.pos AS BIGINT) AS pos, x.text, CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.poem_no = p.b AND l.norm = x.norm) THEN 'Y' ELSE '.' END AS marker
FROM p JOIN (SELECT poem_no, pos, l.text AS text, {_norm('l.text')} AS norm FROM ({LINES}) WHERE l IS NOT NULL) x ON x.poem_no = p.a WHERE length(x.norm) >= 3""")
def overlap_markers(spark: SparkSession, folder: str) -> DataFrame:
    poems = _poems(spark, folder)
    rows = lines.compared_lines(lines.body_lines(poems))
    return _long(dedup.overlap_markers(dedup.contained_poems(poems), rows, "poem_no"), "pos")


PLAN = "SELECT matched_on AS reason, b.file_name AS \"delete\", a.file_name AS keep FROM pairs JOIN poems a ON a.poem_no = poem_a JOIN poems b ON b.poem_no = poem_b"


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    poems = _poems(spark, folder).select("poem_no", "file_name")
    a, b = poems.toDF("poem_a", "keep"), poems.toDF("poem_b", "delete")
    return table(spark, folder, "pairs").join(a, "poem_a").join(b, "poem_b").select(F.col("matched_on").alias("reason"), "delete", "keep")


@query(f"SELECT poem_no, file_name FROM poems WHERE file_name NOT IN (SELECT \"delete\" FROM ({PLAN}))")
def plan_applied(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.apply_plan(_poems(spark, folder).select("poem_no", "file_name"), _plan(spark, folder))


@query(f"""SELECT "delete", count(*) AS "rows", bool_or(there) AS present, CASE WHEN bool_or(there) THEN 'deleted' ELSE 'missing' END AS status, count(*) - CAST(bool_or(there) AS BIGINT) AS missing_rows
FROM (SELECT p."delete", p."delete" IN (SELECT file_name FROM poems WHERE duplicate IS NOT TRUE) AS there FROM ({PLAN}) p) GROUP BY ALL""")
def plan_audit(spark: SparkSession, folder: str) -> DataFrame:
    there = _poems(spark, folder).where("NOT coalesce(duplicate, false)")
    return _long(dedup.plan_audit(there, _plan(spark, folder)), "rows", "missing_rows")


@query(f"SELECT \"delete\", count(*) AS n FROM ({PLAN}) GROUP BY ALL HAVING count(*) > 1")
def plan_multi(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.planned_often(_plan(spark, folder))


@query(f"SELECT reason, \"delete\", keep FROM ({PLAN}) WHERE keep IN (SELECT \"delete\" FROM ({PLAN}))")
def plan_unsafe_keeps(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.unsafe_keeps(_plan(spark, folder), _poems(spark, folder))


# Crawled pages and books


@query("SELECT book_slug, url, CAST(n_poetry AS BIGINT) AS n_poetry, CAST(n_verse_line AS BIGINT) AS n_verse_line FROM discovery_pages WHERE (coalesce(n_poetry, 0) > 0) <> (coalesce(n_verse_line, 0) > 0)")
def page_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return _long(reports.anomalies(table(spark, folder, "discovery_pages")).select("book_slug", "url", "n_poetry", "n_verse_line"), "n_poetry", "n_verse_line")


SUMMARY = """count(*) AS n_urls, count(*) FILTER (WHERE coalesce(n_poetry, 0) > 0) AS n_poem_pages, CAST(sum(coalesce(n_poetry, 0)) AS BIGINT) AS n_poems_total, CAST(sum(coalesce(n_verse_line, 0)) AS BIGINT) AS n_verse_lines_total,
count(*) FILTER (WHERE (coalesce(n_poetry, 0) > 0) <> (coalesce(n_verse_line, 0) > 0)) AS n_anomalies, count(error) AS n_errors"""


@query(f"SELECT book_slug, {SUMMARY} FROM discovery_pages GROUP BY book_slug")
def page_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.page_summary(table(spark, folder, "discovery_pages"), "book_slug")


FIRST_BOOK = "SELECT * FROM books QUALIFY row_number() OVER (PARTITION BY slug ORDER BY year_published ASC NULLS LAST, title ASC NULLS LAST) = 1"


@query(f"SELECT p.url, p.book_slug, CAST(b.year_published AS BIGINT) AS year_published FROM discovery_pages p JOIN ({FIRST_BOOK}) b ON p.book_slug = b.slug WHERE coalesce(n_poetry, 0) > 0")
def lookup_inner(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich.pages_of_books(table(spark, folder, "discovery_pages"), table(spark, folder, "books"))
    return _long(rows.select("url", "book_slug", "year_published"), "year_published")


@query("SELECT DISTINCT url FROM discovery_pages WHERE url NOT IN (SELECT url FROM discovery_pages WHERE cached IS NOT NULL AND url IS NOT NULL)")
def crawl_frontier(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "discovery_pages")
    return enrich.frontier(pages.where("url IS NOT NULL"), pages.where("cached IS NOT NULL"))


@query("""SELECT book_slug, count(*) FILTER (WHERE error IS NULL) AS ok, count(error) AS failed,
coalesce(string_agg(url || ' ' || error, '; ' ORDER BY url, error) FILTER (WHERE error IS NOT NULL), '') AS failures FROM discovery_pages GROUP BY book_slug""")
def group_failures(spark: SparkSession, folder: str) -> DataFrame:
    each = reports.run_report(table(spark, folder, "discovery_pages"))
    return each.withColumn("failures", F.array_join(F.transform("failures", lambda f: F.concat_ws(" ", f["url"], f["error"])), "; "))


@query(rf"SELECT url, regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, split_part(url, '?', 1) AS path FROM (SELECT DISTINCT url FROM discovery_pages)")
def url_slug(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "discovery_pages").select("url").distinct().select("url", T.url_slug(F.col("url")).alias("slug"), T.url_path(F.col("url")).alias("path"))


@query("""SELECT file_name, p[1] AS source, p[2] AS author, p[3] AS title, p[4] AS book, TRY_CAST(p[5] AS BIGINT) AS copy FROM (SELECT file_name, string_split(regexp_replace(file_name, '\\.json$', ''), '--') AS p FROM poems) WHERE len(p) >= 4""")
def filename_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _poems(spark, folder).select("file_name", T.name_parts(F.col("file_name")).alias("p")).where("p IS NOT NULL")
    return _long(rows.select("file_name", "p.*"), "copy")


# Names


def _author_sql(x: str) -> str:
    s = f"lower(regexp_replace({x}, '(?i)^(?:Hr\\.|Dr\\.|Fr\\.|Prof\\.|H\\.)[{WS}]+', ''))"
    for a, b in T.IN_AUTHOR_SLUGS.items():
        s = f"replace({s}, '{a}', '{b}')"
    s = f"regexp_replace(regexp_replace({s}, '^[{WS}]+|[{WS}]+$', '', 'g'), '[{WS}]+', '-', 'g')"
    return f"regexp_replace(regexp_replace({s}, '[^a-z0-9\\-]', '', 'g'), '-+', '-', 'g')"


@query(f"SELECT DISTINCT author.name AS name, CASE WHEN author.name <> '' THEN {_author_sql('author.name')} END AS slug FROM poems")
def author_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return _poems(spark, folder).select(F.col("author.name").alias("name")).distinct().select("name", T.author_slug(F.col("name")).alias("slug"))


@query()
def title_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of titles in the three manners, and of books. Compatibility decomposition isn't SQL's."""
    return _poems(spark, folder).select(
        "poem_no", T.hymn_slug(F.col("title")).alias("hymn"), T.word_slug(F.col("title")).alias("word"), T.title_slug(F.col("title")).alias("title"), T.book_slug(F.col("source.title"), F.col("source.year_published")).alias("book")
    )


BASE = r"regexp_replace(file_name, '(--\d+)?\.json$', '.json')"


@query(f"SELECT poem_no, name, CASE WHEN n = 1 THEN name ELSE regexp_replace(name, '\\.json$', '') || '--' || n || '.json' END AS unique_name FROM (SELECT poem_no, {BASE} AS name, row_number() OVER (PARTITION BY {BASE} ORDER BY poem_no) AS n FROM poems)")
def name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    named = _poems(spark, folder).select("poem_no", F.regexp_replace("file_name", r"(--\d+)?\.json$", ".json").alias("name"))
    return enrich.with_suffixes(named, "name", "poem_no")


@query(f"SELECT name, count(*) AS n FROM (SELECT {BASE} AS name FROM poems) GROUP BY ALL HAVING count(*) > 1")
def colliding_names(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.collisions(_poems(spark, folder).select(F.regexp_replace("file_name", r"(--\d+)?\.json$", ".json").alias("name")), "name")


EDITIONS = "SELECT poem_no, split_part(file_name, '--', 3) || (['', '_dipl', '.da'])[1 + CAST(poem_no % 3 AS INT)] AS slug FROM poems"


@query(f"""SELECT slug, regexp_replace(slug, '(_dipl|\\.da)$', '') AS work FROM (SELECT DISTINCT slug FROM ({EDITIONS})) WHERE NOT ends_with(slug, '.da')
QUALIFY row_number() OVER (PARTITION BY regexp_replace(slug, '(_dipl|\\.da)$', '') ORDER BY ends_with(slug, '_dipl'), slug) = 1""")
def edition_choice(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.element_at(F.array(F.lit(""), F.lit("_dipl"), F.lit(".da")), (F.col("poem_no") % 3 + 1).cast("int"))
    works = _poems(spark, folder).select(F.concat(F.split("file_name", "--")[2], suffix).alias("slug")).distinct()
    return enrich.chosen_editions(works)


# Reports


@query("""
SELECT corpus, CAST(grouping(corpus) AS BIGINT) AS is_total, count(*) AS n_poems, CAST(sum(s) AS BIGINT) AS n_stanzas, CAST(sum(l) AS BIGINT) AS n_lines, CAST(sum(m) AS BIGINT) AS n_with_notes FROM (
  SELECT source.corpus AS corpus, coalesce(len(list_distinct(list_transform(body, lambda x: x.stanza_id))), 0) AS s, coalesce(len(list_filter(body, lambda x: x IS NOT NULL)), 0) AS l,
    coalesce(len(list_filter(body, lambda x: len(x.marginal_notes) > 0)), 0) AS m FROM poems
) GROUP BY ROLLUP (corpus)""")
def group_report_rollup(spark: SparkSession, folder: str) -> DataFrame:
    poems = _poems(spark, folder).select(F.col("source.corpus").alias("corpus"), "body")
    return _long(reports.corpus_report(poems, "corpus"), "is_total", "n_stanzas", "n_lines", "n_with_notes")


@query(f"SELECT poem_no, count(DISTINCT l.stanza_id) AS n_stanzas, count(*) AS n_lines, count(*) FILTER (WHERE len(l.marginal_notes) > 0) AS n_with_notes FROM ({LINES}) WHERE l IS NOT NULL GROUP BY poem_no")
def poem_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.poem_counts(lines.body_lines(_poems(spark, folder)))


@query(f"SELECT title, count(DISTINCT book) AS books FROM (SELECT {_norm('title')} AS title, source.title AS book FROM poems) WHERE title <> '' AND book IS NOT NULL GROUP BY title HAVING count(DISTINCT book) >= 2")
def titles_in_several(spark: SparkSession, folder: str) -> DataFrame:
    return reports.titles_in_several(_poems(spark, folder), "source.title")


@query(f"""SELECT count(*) AS n_lines, count(*) FILTER (WHERE regexp_matches(t, '</?[A-Za-z][^<>]*>')) AS tags, count(*) FILTER (WHERE regexp_matches(t, '[\\[\\]]')) AS brackets,
count(*) FILTER (WHERE regexp_matches(t, '&[A-Za-z]+;|&#[0-9]+;')) AS entities, count(*) FILTER (WHERE contains(t, '|')) AS pipes, count(*) FILTER (WHERE regexp_matches(t, '[†‡¶]')) AS signs
FROM (SELECT l.text AS t FROM ({LINES}) WHERE l IS NOT NULL)""")
def leak_audit(spark: SparkSession, folder: str) -> DataFrame:
    return reports.leaks(lines.body_lines(_poems(spark, folder)))


@query()
def mojibake_reread(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of which the whole value is UTF-8 read as Latin-1, read again."""
    rows = _poems(spark, folder).select("poem_no", "title", T.reread(F.col("title")).alias("reread"))
    return rows.where("title <> reread")


# Quality


def _poem_files(spark: SparkSession, folder: str) -> DataFrame:
    """The poems as JSON documents."""
    poems = _poems(spark, folder).withColumn("year_created", F.try_parse_json("year_created"))
    keep = [*quality.KEYS, *writers.OPTIONAL]
    return poems.select(F.concat(F.col("poem_no").cast("string"), F.lit(".json")).alias("path"), writers.as_json(poems.select(*keep)).alias("text"))


V = f"""
WITH n AS (SELECT poem_no, l, pos, coalesce(last_value(l.id IGNORE NULLS) OVER w, -1) AS id0, coalesce(last_value(l.stanza_id IGNORE NULLS) OVER w, -1) AS st0 FROM ({LINES}) WINDOW w AS (PARTITION BY poem_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT rule, level, count(*) AS n FROM (
  SELECT 'V34' AS rule, 'info' AS level FROM poems
  UNION ALL SELECT 'V03', 'warning' FROM poems WHERE dramatic_poem IS NOT NULL OR diplomatic_edition IS NOT NULL
  UNION ALL SELECT 'V05', 'info' FROM poems WHERE coalesce(id, '') <> ''
  UNION ALL SELECT 'V10', 'error' FROM poems WHERE author IS NULL
  UNION ALL SELECT 'V12', 'error' FROM poems WHERE author IS NOT NULL AND (author.name IS NULL OR NOT regexp_matches(author.name, '[^\\s\\x{{a0}}]'))
  UNION ALL SELECT 'V14', 'error' FROM poems WHERE author.wiki IS NOT NULL AND NOT regexp_matches(author.wiki, '[^\\s\\x{{a0}}]')
  UNION ALL SELECT 'V15', 'warning' FROM poems WHERE regexp_matches(author.wiki, '[^\\s\\x{{a0}}]') AND NOT regexp_matches(author.wiki, '^\\p{{L}}')
  UNION ALL SELECT 'V16', 'error' FROM poems WHERE source IS NULL
  UNION ALL SELECT 'V18', 'error' FROM poems WHERE source IS NOT NULL AND (source.corpus IS NULL OR NOT regexp_matches(source.corpus, '[^\\s\\x{{a0}}]'))
  UNION ALL SELECT 'V21', 'error' FROM poems WHERE source.url IS NOT NULL AND NOT regexp_matches(source.url, '^https?://')
  UNION ALL SELECT 'V22', 'error' FROM poems WHERE body IS NULL
  UNION ALL SELECT 'V23', 'error' FROM n WHERE l IS NULL
  UNION ALL SELECT 'V25', 'error' FROM n WHERE l IS NOT NULL AND l.id IS NULL
  UNION ALL SELECT 'V26', 'warning' FROM n WHERE l.id <> id0 + 1
  UNION ALL SELECT 'V27', 'error' FROM n WHERE l IS NOT NULL AND l.stanza_id IS NULL
  UNION ALL SELECT 'V28', 'warning' FROM n WHERE l.stanza_id < st0
  UNION ALL SELECT 'V29', 'error' FROM n WHERE l IS NOT NULL AND l.text IS NULL
  UNION ALL SELECT 'V31', 'warning' FROM n WHERE l.part NOT IN ('I', 'M', 'F')
  UNION ALL SELECT 'V32', 'error' FROM n WHERE len(list_filter(l.marginal_notes, lambda x: x IS NULL)) > 0
  UNION ALL SELECT 'V33', 'warning' FROM n WHERE len(list_filter(l.marginal_notes, lambda x: x IS NOT NULL AND NOT regexp_matches(x, '[^\\s\\x{{a0}}]'))) > 0
) GROUP BY ALL"""


@query(V)
def findings_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return quality.findings(_poem_files(spark, folder)).groupBy("rule", "level").agg(F.count("*").alias("n"))


# Pages: made from the poems, since the test tables hold none


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """(poem_no, url, book_slug, html): a page of the hymnals' layout for each poem with lines, each line a stanza."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[<>&]", "")
    line = lambda x: F.concat(F.lit('<div class="poetry"><div class="verse-line">'), bare(x["text"]), F.lit("</div></div>"))
    body = F.array_join(F.transform("body", line), "\n")
    html = F.concat(
        F.lit("<html><head><title>"), bare(F.col("author.name")), F.lit(": »"), bare(F.col("title")), F.lit('«</title><script>var poetry = "<div class=\\"poetry\\">";</script></head><body><h1>'), bare(F.col("title")),
        F.lit('</h1><a data-ajax-url="/b/'), F.col("poem_no").cast("string"), F.lit('?x=1">next</a><div id="region-content"><results>'), body, F.lit("</results></div></body></html>"),
    )
    poems = _poems(spark, folder).where(F.size("body") > 0)
    return poems.select("poem_no", F.concat(F.lit("https://x.example/"), F.col("poem_no").cast("string")).alias("url"), T.name_parts(F.col("file_name"))["book"].alias("book"), html.alias("html"))


BARE = "regexp_replace(coalesce({}, ''), '[<>&]', '', 'g')"


@query(f"SELECT poem_no, pos AS stanza_id, {_collapse('replace(replace(' + BARE.format('l.text') + ', chr(124), chr(0)), chr(8224), chr(0))')} AS text FROM ({LINES})".replace("chr(0)", "''"))
def html_nested_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of hymn pages by depth counting, without page breaks and signs."""
    rows = _pages(spark, folder).select("poem_no", F.explode(H.hymn_lines_of(H.clean_page(F.col("html")))).alias("l"))
    return _long(rows.select("poem_no", "l.stanza_id", "l.text"), "stanza_id")


@query("SELECT poem_no, len(body) AS n_poetry, len(body) AS n_verse_line FROM poems WHERE len(body) > 0")
def page_tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _long(_pages(spark, folder).select("poem_no", H.marker_counts(F.col("html")).alias("c")).select("poem_no", "c.*"), "n_poetry", "n_verse_line")


@query("SELECT poem_no, ['/b/' || poem_no] AS paths FROM poems WHERE len(body) > 0")
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("poem_no", H.book_paths(F.col("html"), F.lit("b")).alias("paths"))


@query()
def hymn_poems(spark: SparkSession, folder: str) -> DataFrame:
    """Whole poem records from hymn pages."""
    pages = _pages(spark, folder).select("url", F.col("book").alias("book_slug"), "html")
    poems, _ = plans.hymns(pages, table(spark, folder, "books"), "hymns", "hymns")
    return poems.select("file_name", "title", "year_created", F.size("body").alias("n_lines"), F.col("source.title").alias("source_title"))


from quillspark import page_queries  # noqa: E402, F401  (adds its queries)
