from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.plans import pages as P

HYMN = """<html><script>"<div class='poetry'>"</script><!-- <div class="poetry"> --><div id="region-content">
<div class="x poetry"><div class="verse-line">Je<span class="legacy-page-break"><span class="page-break-mark">|</span><a class="facsimile-link">3v</a></span>sum
 <b>Krist</b>†</div><div class="verse-line"></div></div>
<div class="poetry"><div class="verse-line"><div>nested</div> &amp; more<span class="marginal-note"><span class="marginal-note-content"> Luc. 2 </span></span></div></div></results></div></html>"""
H_CLEAN = HYMN.split("-->")[1]
BALLAD = """<b>Titel:</b> (Ridder &amp; mø)<br/><table><tr><td><span class="source">f&oslash;r<sup>1</sup></span>&nbsp;</td></tr><tr><td><br/>[1]</td></tr><tr><td><span class="source"><em>H</em>er &lt;st&gt;aar</span>&nbsp;</td><td>mod</td></tr>
<tr><br/></tr><tr><td><br/>2.</td></tr><tr><td><span class="source">* | *</span></td></tr><tr><td><br/>3</td></tr><tr><td><span class="source">slut [men] finis</span></td></tr></table>"""
CRUMBS = "<ol class=breadcrumb><li class=breadcrumb-item><a href=/>Bibliotek</a></li><li class=breadcrumb-item><a href=/books/b_x/>Anna And: nye digte</a></li><li class='breadcrumb-item active'>Afsnit: Sangen</li></ol>"
VERSE = f"""<title>Anna And: »Sangen«</title>{CRUMBS}<div class=text-container><h1>33 | Sangen</h1><div class="mt-3 mb-4"><div class=line>En <button id=n1>x</button>linje<br></div><div class=line>To <button id=note1 data='<div class="a">b</div>'>!</button></div></div>
<div class="mt-3 mb-4"><div class=line>Tre &aelig;</div></div></div><div class=footer>"""
DRAMA = """<title>Bo: Spillet</title><div class=text-container><div class=drama><p class=drama-speaker>[3] | ANNA</p><p class=drama-speaker>B</p><div class="mt-3 mb-4"><div class=drama-line>Ja</div><div class=drama-line>O</div></div>
<p class=drama-speaker>BO</p><div class="mt-3 mb-4"><div class=drama-line>Nej</div></div><p class=drama-speaker>LOST</p></div></div>"""
PROSE = "<title>Prosa</title><div class=text-container><p>En &amp; to</p><p class=x></p><p>Tre</p></div>"
MUSIC = "<title>M</title><div class=text-container><div class=metadata>noder</div><p>x</p></div>"
BOOK = """<div class="p-4 bg-light"><dl class=row><dt>Forfatter</dt><dd>Anna <b>And</b></dd><dt>Sprog</dt><dd><a href=/languages/yngre-nydansk>y</a></dd><dt>Udgivelsesår</dt><dd>1862</dd></dl></div>
<div class="p-4 bg-light"><dl class=row><dt>Udgiver</dt><dd>E</dd></dl></div><a href=/books/b_x/10/>a</a><a href=/books/b_x/2>b</a><a href=/books/b_x/2>c</a>"""


def one(spark, html, f):
    return spark.createDataFrame([(html,)], "html string").select(f(F.col("html")).alias("x")).first()["x"]


def test_hymn(spark):
    books = spark.createDataFrame([("b", "Bog", None, "Trykker", "Kbh", 1569), ("b", None, None, None, None, None)], "slug string, title string, publisher string, printer string, place string, year_published int")
    broken = HYMN.replace("</results>", "")
    pages = spark.createDataFrame([("u1", "b", HYMN), ("u0", "b", HYMN), ("u2", "b", broken), ("u3", "b", None), ("u4", "b", "<p>"), ("u5", "z", HYMN)], "url string, book_slug string, html string")
    poems, failed = P.hymns(pages, books, "C", "src")
    rows = {r["url"]: r for r in poems.collect()}
    assert [(x["stanza_id"], x["text"], x["marginal_notes"]) for x in rows["u0"]["body"]] == [(0, "Jesum Krist", []), (0, "", []), (1, "nested &amp; more", ["Luc. 2"])]
    assert rows["u0"]["title"] == "Jesum Krist" and rows["u0"]["source"]["printer"] == "Trykker" and rows["u0"]["year_created"] == 1569
    assert (rows["u0"]["file_name"], rows["u1"]["file_name"]) == ("src--anonymous--jesum-krist--b.json", "src--anonymous--jesum-krist--b--2.json")
    assert dict(failed.select("url", "error").collect()) == {"u2": "page has no region", "u3": "page is not cached", "u4": "page has no poem", "u5": "book is not in the manifest"}


def test_hymn_markers(spark):
    assert tuple(one(spark, HYMN, H.marker_counts)) == (3, 3)  # comments count here, scripts don't
    assert one(spark, "<a data-ajax-url=\"/b/2?x\"><a data-ajax-url=\"/b/1\"><a data-ajax-url=\"/c/1\">", lambda c: H.book_paths(c, F.lit("b"))) == ["/b/1", "/b/2"]
    assert one(spark, HYMN, H.marginal_notes) == ["Luc. 2"]


def test_unclosed_element_ends_the_list():
    assert H.elements('<div class="poetry">a</div><div class="poetry">b', H.with_class("div", "poetry")) == ["a"]
    assert H.inside("x</divider></div>y", "div", 0, strict=True) is None  # a closing tag before a letter is skipped
    assert H.inside("x</divider></div>", "div", 0, strict=True) == (11, 17)


def test_ballad(spark):
    row = P.ballads(spark.createDataFrame([("u", BALLAD), ("v", "<p>none</p>"), ("w", None)], "url string, html string")).collect()
    rows = {r["url"]: r for r in row}
    assert rows["u"]["title"] == "Ridder & mø"
    assert [(x["id"], x["stanza_id"], x["text"]) for x in rows["u"]["body"]] == [(0, 0, "før"), (1, 1, "Her staar"), (2, 2, "slut men")]
    assert rows["v"]["body"] is None and rows["w"]["title"] is None


def test_archive(spark):
    books = P.publications(spark.createDataFrame([("b_x", "https://a/books/b_x/", BOOK), ("b_y", "https://a/books/b_y/", BOOK.replace("yngre-nydansk", "latin")), ("b_z", "u", None)], "book_slug string, url string, html string"))
    book = books.collect()
    assert len(book) == 1 and book[0]["author"] == "Anna And" and book[0]["year_published"] == 1862 and book[0]["text_links"] == ["2", "10"] and book[0]["source_title"] == "x"
    pages = [("v", "b_x", "2", VERSE), ("d", "b_x", "3", DRAMA), ("p", "b_x", None, PROSE), ("m", "b_x", "4", MUSIC), ("n", "b_x", "5", None), ("s", "b_x", "6", VERSE.replace('<div class="mt-3 mb-4"><div class=line>Tre &aelig;</div></div>', "").replace("<div class=line>To", "<div>To"))]
    poems = {r["url"]: r for r in P.archive(spark.createDataFrame([(*p, None) for p in pages], "url string, book_slug string, number string, html string, diplomatic boolean"), books, "C").collect()}
    assert set(poems) == {"v", "d", "p"}
    v, d, p = poems["v"], poems["d"], poems["p"]
    assert v["title"] == "Sangen" and v["source"]["title"] == "Nye Digte" and v["source"]["url"] == "https://a/books/b_x/2/" and v["author"]["name"] == "Anna And"
    assert [(x["stanza_id"], x["text"]) for x in v["body"]][0] == (0, "En linje") and v["body"][2]["text"] == "Tre æ" and v["body"][2]["stanza_id"] == 1
    assert [(x["stanza_id"], x["text"], x["marginal_notes"]) for x in d["body"]] == [(0, "Ja", ["Speaker: ANNA"]), (0, "O", []), (1, "Nej", ["Speaker: BO"])] and d["dramatic_poem"]
    assert [x["text"] for x in p["body"]] == ["En & to", "Tre"] and p["title"] == "Prosa" and p["dramatic_poem"] is None


def test_leaking_note_button_can_be_taken_out():
    raw = "To <button id=note1 data='x'>!</button>"
    assert "button" in H.archive_text(raw) and H.archive_text(raw, notes_too=True) == "To"


def test_page_predicates(spark):
    assert [one(spark, x, H.body_type) for x in (VERSE, DRAMA, PROSE, "<p>")] == ["line", "drama", "prose", "unknown"]
    assert [one(spark, x, H.is_music_page) for x in (VERSE, MUSIC)] == [False, True]
    assert [tuple(x) for x in one(spark, VERSE, H.breadcrumbs)] == [("Bibliotek", "/"), ("Anna And: nye digte", "/books/b_x/"), ("Afsnit: Sangen", "")]
    assert one(spark, VERSE, lambda c: H.is_standalone(H.breadcrumbs(c))) is False and one(spark, PROSE, lambda c: H.is_standalone(H.breadcrumbs(c))) is True
    assert "Krist" in H.first_stanza(H_CLEAN) and H.first_stanza("<p>") == ""
    assert one(spark, "<div class=text-container><h1>Del I</h1><h1>Vise<br><small>x</small></h1><h1>Nr. 3</h1>", H.title_h1) == "Vise"
    assert tuple(one(spark, "<title>A: Bog, Titel</title>", H.title_tag)) == ("Titel", "A") and tuple(one(spark, "<p>", H.title_tag)) == (None, None)
    assert one(spark, BOOK, H.metadata)[0] == {"Forfatter": "Anna And", "Sprog": "y", "Udgivelsesår": "1862"}
    assert one(spark, "Sprog</dt><dd>yngre nydansk</dd>", H.language) == "yngre-nydansk" and one(spark, "x", H.language) is None
    assert one(spark, BOOK, lambda c: H.text_numbers(c, "b_x")) == ["2", "10"] and one(spark, BOOK, H.page_year) == 1862
