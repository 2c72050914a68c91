import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import text as T


def values(spark, f, inputs, kind="string"):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], f"k int, x {kind}")
    return [r[0] for r in rows.select("k", f(F.col("x")).alias("y")).orderBy("k").select("y").collect()]


CASES = [
    (T.normalise, [("¶ Oſten, Ærø! ", "osten, aeroe"), (None, ""), ("", ""), ("  a\u00a0\u2003b\t", "a b"), ("_x_", "x"), ("—", ""), ("wÿ ö", "wy o")]),
    (T.hymn_slug, [("Christ stod op aff døde/", "christ-stod-op-aff-dde"), (None, ""), (" Å b ", "a-b"), ("x" * 90, "x" * 80)]),
    (T.word_slug, [("Christ stod op aff døde/", "christ-stod-op-aff-døde"), ("Ærø", "ærø")]),
    (T.title_slug, [("Rimkrøniken", "rimkr-niken"), ("46. Ostmer, konge i Skåne", "46-ostmer-konge-i-skane"), (None, ""), ("Mit Livs Eventyr", "mit-livs-eventyr"), ("Æ", "ae")]),
    (T.author_slug, [("Hr. Åge Sø", "aage-so"), (None, None), ("", None), ("H. C. Ørsted", "c-orsted"), ("Müller", "mueller")]),
    (T.url_slug, [("https://a.example/B/1", "a_example_1"), ("http://x/y?z=1", "x_y_z_1"), (None, None)]),
    (T.url_path, [("/b/1?x=2", "/b/1"), ("/b", "/b")]),
    (T.reread, [("Ã¸", "ø"), ("ø", "ø"), ("€", "€"), ("€ Ã¸", "€ Ã¸"), (None, None), ("abc", "abc")]),
    (T.base_work, [("w", "w"), ("w_dipl", "w"), ("w.da", "w"), ("w_dipl.da", "w_dipl")]),
    (T.source_title, [("andersen-hc_1862", "1862"), ("heiberg-jl_nye-digte", "nye digte"), ("anon_dyrerim_dipl", "dyrerim dipl"), ("plain", "plain")]),
    (T.title_from_slug, [("anon_den-lille", "den lille"), ("b-c", "b c")]),
    (T.heading, [("33 | Skagen", "Skagen"), ("[7]| X", "X"), ("1862", "")]),
    (T.unnumbered, [("Nr. 4. Vise", "Vise"), ("Nr 4", "Nr 4")]),
    (T.author_or_anonymous, [("Anonym", "anonymous"), ("", "anonymous"), (None, "anonymous"), ("Kingo", "Kingo")]),
    (T.speaker, [("[3] | Anna", "Anna"), ("32 | <b>Bo</b>", "Bo"), ("Claus", "Claus")]),
    (T.without_page_sigil, [("tekst | 3r", "tekst"), ("4v | tekst", "tekst"), ("a | b", "a | b")]),
    (T.clean, [("a &amp;  b&oslash;", "a & bø"), (None, None)]),
    (T.title_case, [("(eventyr) 2den d'or", "(Eventyr) 2Den D'Or"), (None, None)]),
    (T.is_danish, [("dansk", True), ("%C3%A6ldre-nydansk", True), ("latin", False), (None, False), ("", False), ("a+b", False)]),
    (T.whole_number, [(" 1862 ", 1862), ("x", None), ("", None), ("18.5", None), (None, None)]),
]


@pytest.mark.parametrize("f,cases", CASES)
def test_cases(spark, f, cases):
    assert values(spark, f, [a for a, _ in cases]) == [b for _, b in cases]


def test_years(spark):
    got = values(spark, T.parse_year, ["1589", "Før 1555", "Efter 1598", "1575-1590", "1590-1575", "1630'erne", "1630ERNE", "", None, "før 1555", "ca. 1600"])
    assert [tuple(g) for g in got] == [
        ("int", 1589, 1589, None), ("int", 1555, 1555, None), ("int", 1598, 1598, None), ("list", 1575, 1590, None), ("list", 1575, 1590, None), ("list", 1630, 1639, None), ("list", 1630, 1639, None),
        ("empty", None, None, None), ("empty", None, None, None), ("malformed", None, None, "før 1555"), ("malformed", None, None, "ca. 1600"),
    ]


def test_crumbs_and_names(spark):
    crumbs = values(spark, T.split_crumb, ["A: T", "A:\nT", "T", " ", None, ": T", "A:"])
    assert [tuple(c) for c in crumbs] == [("A", "T"), ("A:", "T"), (None, "T"), (None, None), (None, None), (None, "T"), ("A", None)]
    names = values(spark, T.name_parts, ["s--a--t--b.json", "s--a--t--b--6.json", "a--b.json", None])
    assert [tuple(n) if n else n for n in names] == [("s", "a", "t", "b", None), ("s", "a", "t", "b", 6), None, None]


def test_book_slug(spark):
    rows = spark.createDataFrame([("Digte", 1), (None, 1830), (None, None), ("", 0)], "t string, y int")
    assert [r[0] for r in rows.select(T.book_slug(F.col("t"), F.col("y"))).collect()] == ["digte", "1830", "unknown", "unknown"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=40))
def test_slugs_are_stable(spark, texts):
    for f in (T.title_slug, T.hymn_slug):
        once = values(spark, f, texts)
        assert values(spark, f, once) == once
    once = values(spark, T.normalise, texts)
    assert all(len(x) <= 80 for x in values(spark, T.title_slug, texts)) and len(once) == len(texts)
