import json
import os

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import dedup, enrich, lines, quality, reports
from quillspark.plans.skew import row_numbers
from quillspark.sources import readers, writers

BODY = "array<struct<id:int,stanza_id:int,text:string,part:string,marginal_notes:array<string>>>"
POEM = f"poem_no long, file_name string, title string, source struct<title:string,corpus:string>, body {BODY}"


def poem(no, title, source, texts):
    return (no, f"f{no}.json", title, (source, "c"), None if texts is None else [(k, 0, t, None, []) for k, t in enumerate(texts)])


def brute(poems, share=0.9):
    import re

    def norm(s):
        s = re.sub("[†‡¶⁕*✝]", "", s or "").replace("ſ", "s").lower()
        for a, b in T.COMPARED.items():
            s = s.replace(a, b)
        return re.sub(r"^[\W_]+|[\W_]+$", "", re.sub(r"\s+", " ", s).strip())

    out = {}
    rows = [(no, (norm(t), norm(s[0])), [x for x in (norm(b[2]) for b in (body or [])) if len(x) >= 3]) for no, _, t, s, body in poems]
    for i, (a, ka, la) in enumerate(rows):
        for b, kb, lb in rows[i + 1 :]:
            if ka == kb and ka[0] and la and lb:
                x, y = len(set(la) & set(lb)) / len(set(la)), len(set(la) & set(lb)) / len(set(lb))
                if max(x, y) >= share:
                    out[min(a, b), max(a, b)] = (round(x, 9), round(y, 9), len(la), len(lb)) if a < b else (round(y, 9), round(x, 9), len(lb), len(la))
    return out


def test_containment_equals_brute_force(spark):
    import random

    rnd = random.Random(1)
    base = [f"linje nummer {k}" for k in range(40)]
    poems = [poem(1, "T", "S", base[:10]), poem(2, "t!", "s", base[:10]), poem(3, "T", "S", base[:9] + ["noget andet"]), poem(4, "T", "S", base[:8] + ["x y z", "æ ø å"]), poem(5, "T", None, base[:10]), poem(6, "T", None, base[:20]),
             poem(7, "", "S", base[:10]), poem(8, None, "S", base[:10]), poem(9, "T", "S", None), poem(10, "T", "S", []), poem(11, "T", "S", [None, "", "ab"]), poem(12, "T", "S", base[:10] + base[:10])]
    for k in range(13, 80):
        poems.append(poem(k, rnd.choice("TU"), "Q", rnd.sample(base, rnd.randint(1, 12)) + [base[0]] * rnd.randint(0, 2)))
    df = spark.createDataFrame(poems, POEM).withColumns({"norm": F.lit(1), "size": F.lit(2), "a": F.lit("clash"), "set": F.lit(3), "lines": F.lit(4)})
    got = {(r["a"], r["b"]): (round(r["a_in_b"], 9), round(r["b_in_a"], 9), r["lines_a"], r["lines_b"]) for r in dedup.contained_poems(df).collect()}
    assert got == brute(poems) and len(got) > 10
    assert dedup.contained_poems(df.limit(0)).count() == 0


def test_plan(spark):
    text = ["# x", "| Reason | Delete | Keep |", "|---|---|---|", "| r1 | `a.json` | `b.json` |", "| r2 | a.json | c.json |", "| r3 | `z.json` | `a.json` |", "| no | a.txt | b.json |", "|x|"]
    plan = dedup.parse_plan(spark.createDataFrame([(t,) for t in text], "value string"))
    assert [tuple(r) for r in plan.collect()] == [("r1", "a.json", "b.json"), ("r2", "a.json", "c.json"), ("r3", "z.json", "a.json")]
    docs = spark.createDataFrame([("a.json",), ("b.json",), ("c.json",)], "file_name string")
    assert sorted(r[0] for r in dedup.apply_plan(docs, plan).collect()) == ["b.json", "c.json"]
    assert [r[0] for r in dedup.quarantined(docs, plan).collect()] == ["a.json"]
    audit = {r["delete"]: (r["rows"], r["status"], r["missing_rows"]) for r in dedup.plan_audit(docs, plan).collect()}
    assert audit == {"a.json": (2, "deleted", 1), "z.json": (1, "missing", 1)}
    assert [tuple(r) for r in dedup.planned_often(plan).collect()] == [("a.json", 2)]
    assert [r["keep"] for r in dedup.unsafe_keeps(plan, docs).collect()] == ["a.json"]


def test_lines(spark):
    rows = [(1, 0, "x"), (1, 1, None), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "b"), (2, 0, None), (2, 1, "c")]
    df = spark.createDataFrame(rows, "k int, pos int, text string")
    got = lines.number_stanzas(df, "k", F.col("text").isNull()).orderBy("k", "pos").select("k", "text", "stanza_id").collect()
    assert [tuple(r) for r in got] == [(1, "x", 0), (1, "a", 1), (1, "b", 2), (2, "c", 0)]
    assert [tuple(r) for r in lines.first_text(df, "k").orderBy("k").collect()] == [(1, "x"), (2, "c")]
    ids = spark.createDataFrame([(1, 0, 0), (1, 1, None), (1, 2, 1), (1, 3, 5)], "k int, pos int, v int")
    assert [r[0] for r in ids.select(lines.last_valid_before(F.col("v"), "k", "pos").alias("b"), "pos").orderBy("pos").collect()] == [-1, 0, 0, 1]
    docs = spark.createDataFrame([(1, "a\r\nb\rc\n"), (2, None), (3, "")], "doc_id int, text string")
    assert [tuple(r) for r in lines.text_lines(docs).orderBy("doc_id", "pos").collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, ""), (3, 0, "")]


def test_row_numbers_split_a_large_group(spark):
    rows = [("hot" if k % 3 else f"g{k}", k % 50, k) for k in range(3000)] + [(None, 1, -1), (None, 0, -2)]
    df = spark.createDataFrame(rows, "g string, o int, k int").repartition(7)
    got = row_numbers(df, ["g"], ["o", "k"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["n"], r["o"], r["k"]))
    assert len(got) == len(rows)
    for v in by.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, len(v) + 1)) and [x[1:] for x in v] == sorted(x[1:] for x in v)
    assert row_numbers(df.limit(0), ["g"], ["o"]).count() == 0


def test_suffixes_and_editions(spark):
    df = spark.createDataFrame([("x.json", 1), ("x.json", 2), ("x--2.json", 3), ("y.json", 4), ("x.json", 5), (None, 6)], "name string, o int")
    got = {r["o"]: r["unique_name"] for r in enrich.with_suffixes(df, "name", "o").collect()}
    assert got == {1: "x.json", 2: "x--3.json", 3: "x--2.json", 4: "y.json", 5: "x--4.json", 6: None}
    works = spark.createDataFrame([("w",), ("w_dipl",), ("w.da",), ("v_dipl",), ("v.da",), ("u.da",)], "slug string")
    assert sorted(r["slug"] for r in enrich.chosen_editions(works).collect()) == ["v_dipl", "w"]
    music = spark.createDataFrame([("ingemann-bs_aftensang",), ("x",), (None,)], "book string")
    assert [r[0] for r in enrich.without_music_books(music).collect()] == ["x", None]
    pages = spark.createDataFrame([("b", "line")] * 3 + [("b", "prose"), ("c", "prose"), ("d", "line"), ("d", "prose")], "book string, kind string")
    assert sorted(map(tuple, enrich.without_lone_prose(pages).collect())) == [("b", "line")] * 3 + [("b", "prose"), ("d", "line")]


def test_authors(spark):
    files = spark.createDataFrame([("s--hc-x--t--b.json",), ("s--hc-x--t--b--2.json",), ("s--anonymous--t--b.json",), ("s--who--t--b.json",), ("s--lost--t--b.json",), ("bad.json",), (None,)], "file_name string")
    alias = spark.createDataFrame([("hc-x", "x-hc"), ("lost", "gone")], "slug string, key string")
    authors = spark.createDataFrame([("x-hc", "Hr. H. C. Øx", "Q1"), ("x-hc", "Z", "Q2")], "key string, name_full string, wiki_id string")
    found = enrich.renamed(enrich.authors_of(files, alias, authors), "s")
    got = {r["file_name"]: (r["status"], r["new_name"]) for r in found.collect()}
    assert got["s--hc-x--t--b.json"] == ("known", "s--h-c-ox--t--b.json") and got["s--hc-x--t--b--2.json"] == ("known", "s--h-c-ox--t--b--2.json")
    assert [got[k][0] for k in ("s--anonymous--t--b.json", "s--who--t--b.json", "s--lost--t--b.json", "bad.json", None)] == ["anonymous", "unknown", "missing_key", "malformed", "malformed"]


GOOD = {"id": None, "title": "t", "year_created": 1570, "author": {"name": "a", "wiki": None}, "source": {"corpus": "c", "title": "s", "year_published": 1570, "place": None, "url": "https://x"},
        "body": [{"id": 0, "stanza_id": 0, "text": "l", "part": False, "marginal_notes": []}, {"id": 1, "stanza_id": 1, "text": "m", "part": "I", "marginal_notes": None}], "neighbors": None, "duplicate": False, "locations": False}


def changed(**top):
    d = json.loads(json.dumps(GOOD))
    for k, v in top.items():
        at, *rest = k.split("__")
        if rest:
            d[at][int(rest[0]) if rest[0].isdigit() else rest[0]] = v if len(rest) == 1 else {**d[at][int(rest[0])], rest[1]: v}
        elif v is KeyError:
            del d[at]
        else:
            d[at] = v
    return d


MUTATIONS = [
    ("V03", changed(extra=1)), ("V04", changed(neighbors=KeyError)), ("V05", changed(id="x")), ("V06", changed(title=3)), ("V07", changed(year_created=[1, True])), ("V07", changed(year_created=[1])), ("V07", changed(year_created=[])),
    ("V08", changed(year_created=[1590, 1575])), ("V09", changed(year_created="1570")), ("V09", changed(year_created=1620.5)), ("V09", changed(year_created=True)), ("V10", changed(author="x")), ("V11", changed(author={"wiki": None})),
    ("V12", changed(author__name=" ")), ("V12", changed(author__name=None)), ("V13", changed(author__born="1")), ("V14", changed(author__wiki=" ")), ("V15", changed(author__wiki="1Q")), ("V16", changed(source=None)),
    ("V17", changed(source={"title": 1, "year_published": None, "place": None})), ("V18", changed(source__corpus=4)), ("V19", changed(source={"corpus": "c", "title": None, "place": None})), ("V20", changed(source__year_published="x")),
    ("V21", changed(source__url="ftp://x")), ("V21", changed(source__printer=1)), ("V22", changed(body="x")), ("V23", changed(body__1="x")), ("V24", changed(body__1={"id": 1, "stanza_id": 0})), ("V25", changed(body__1__id=True)),
    ("V26", changed(body__1__id=5)), ("V27", changed(body__1__stanza_id="0")), ("V28", changed(body__1__stanza_id=-1)), ("V29", changed(body__1__text=None)), ("V30", changed(body__1__words=["w"])), ("V31", changed(body__1__part="X")),
    ("V31", changed(body__1__part=True)), ("V32", changed(body__1__marginal_notes="x")), ("V32", changed(body__1__marginal_notes=[1])), ("V33", changed(body__1__marginal_notes=[" "])),
]


def rules(spark, docs):
    df = spark.createDataFrame([(str(k), d if isinstance(d, str) or d is None else json.dumps(d)) for k, d in enumerate(docs)], "path string, text string")
    out = {str(k): [] for k in range(len(docs))}
    for r in quality.findings(df).collect():
        if r["rule"] != "V34":
            out[r["path"]].append(r["rule"])
    return [sorted(out[str(k)]) for k in range(len(docs))]


def test_each_rule_finds_its_mutation(spark):
    got = rules(spark, [d for _, d in MUTATIONS])
    assert got == [[r] for r, _ in MUTATIONS]


def test_whole_documents(spark):
    old = {k: v for k, v in GOOD.items() if k not in ("neighbors", "duplicate", "locations")}
    broken = changed()
    broken["body"] = [{"id": 0, "stanza_id": 0, "text": "a"}, {"id": "x", "stanza_id": 0, "text": "b"}, {"id": 1, "stanza_id": 0, "text": "c"}]
    got = rules(spark, [GOOD, old, {"body": 1, "title": "x"}, "{", "", None, "[1]", "3", broken, changed(body=[]), changed(body__1__part=0)])
    assert got[0] == [] and got[1] == ["V04"] * 3 and got[2] == ["V04"] * 7 + ["V22"]
    assert got[3:8] == [["V01"], ["V01"], ["V01"], ["V02"], ["V02"]] and got[8] == ["V25"] and got[9:] == [[], []]


def test_levels(spark):
    df = spark.createDataFrame([("a", json.dumps(GOOD)), ("b", "{"), ("c", json.dumps(changed(extra=1)))], "path string, text string")
    found = quality.findings(df)
    got = {r["path"]: (r["errors"], r["warnings"]) for r in quality.by_level(found).collect()}
    assert got == {"a": (0, 0), "b": (1, 0), "c": (0, 1), None: (1, 1)} and quality.has_errors(found)
    assert quality.findings(df.limit(0)).count() == 0 and not quality.has_errors(quality.findings(df.where("path = 'a'")))


def test_reports(spark):
    pages = spark.createDataFrame([("b", "2024", "/1", "u1", 1, 2, "c", None), ("b", "2024", "/2", "u2", 0, 2, "c", None), ("b", "2024", "/3", "u3", None, None, None, "boom"), ("d", "2024", "/4", "u4", 0, 0, "c", None)],
                                  "book_slug string, discovered_at string, path string, url string, n_poetry int, n_verse_line int, cached string, error string")
    assert [r["url"] for r in reports.anomalies(pages).collect()] == ["u2"]
    got = {r["book_slug"]: (r["ok"], r["failed"], [tuple(f) for f in r["failures"]]) for r in reports.run_report(pages).collect()}
    assert got == {"b": (2, 1, [("u3", "boom")]), "d": (1, 0, [])}
    log = reports.scrape_log(pages, "s", "f", 3).first()
    assert (log["total_ok"], log["total_failed"], log["total_pages_attempted"], log["per_book"]["b"]["failed"]) == (3, 1, 4, 1)
    assert {r["book_slug"]: len(r["pages"]) for r in reports.discovery_report(pages).collect()} == {"b": 3, "d": 1}
    books = spark.createDataFrame([("b", "B", None), ("b", "C", 1500)], "slug string, title string, year_published int")
    assert [tuple(r) for r in enrich.pages_of_books(pages, books).select("url", "title").collect()] == [("u1", "C")]
    poems = spark.createDataFrame([poem(1, "T", "S", ["a", "b"]), poem(2, "t", "R", None)], POEM)
    total = {(r["title"], r["is_total"]): (r["n_poems"], r["n_stanzas"], r["n_lines"], r["n_with_notes"]) for r in reports.corpus_report(poems.select(F.col("source.title").alias("title"), "body"), "title").collect()}
    assert total == {("S", 0): (1, 1, 2, 0), ("R", 0): (1, 0, 0, 0), (None, 1): (2, 1, 2, 0)}
    assert [tuple(r) for r in reports.titles_in_several(poems, "source.title").collect()] == [("t", 2)]


def test_nested_update_keeps_other_fields(spark):
    df = spark.createDataFrame([((("old"), "v", None),)], "author struct<name:string,viaf:string,wiki:string>")
    got = enrich.with_author(df, F.lit("new"), F.lit("Q1"), F.lit(True)).first()["author"]
    assert tuple(got) == ("new", "v", "Q1")
    docs = spark.createDataFrame([('{"author":{"name":"a","wiki":null}}',), ('{"author":{"name":"a"}}',), ('{"author":{"name":"b","wiki":"Q"}}',), ("{}",)], "t string").select(F.parse_json("t").alias("d"))
    assert [r[0] for r in docs.select(enrich.needs_author(F.col("d"), F.lit("a"))).collect()] == [False, True, True, True]


def test_sources_round_trip(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    for name, text in {"a--b--c--d.json": json.dumps(GOOD), "span.json": json.dumps(changed(year_created=[1570, 1579], dramatic_poem=True)), "bad.json": "{", "other.txt": "x"}.items():
        (tmp_path / "in" / name).write_text(text, encoding="utf-8")
    poems = readers.typed_years(readers.poems(spark, folder).where("title IS NOT NULL"))
    got = {r["file_name"]: (r["created_first"], r["created_last"], r["is_span"], r["body"][1]["part"], r["body"][0]["part"]) for r in poems.collect()}
    assert got == {"a--b--c--d.json": (1570, 1570, False, "I", None), "span.json": (1570, 1579, True, "I", None)}
    docs = readers.documents(spark, folder)
    assert {r["file_name"]: r["doc"] is None for r in docs.collect()} == {"a--b--c--d.json": False, "span.json": False, "bad.json": True}
    raw = readers.poems(spark, folder).where("title IS NOT NULL")
    writers.write_files(raw, str(tmp_path / "out"))
    back = json.loads((tmp_path / "out" / "span.json").read_text(encoding="utf-8"))
    assert back["year_created"] == [1570, 1579] and back["dramatic_poem"] is True and back["neighbors"] is None
    assert "dramatic_poem" not in json.loads((tmp_path / "out" / "a--b--c--d.json").read_text(encoding="utf-8"))
    (tmp_path / "m.json").write_text(json.dumps({"books": [{"slug": "s", "title": "T", "publisher": None, "printer": None, "place": None, "year_published": 1569}]}))
    assert [tuple(r) for r in readers.books(spark, str(tmp_path / "m.json")).collect()] == [("s", "T", None, None, None, 1569)]
    (tmp_path / "p.html").write_bytes(b"a\xffb")
    assert readers.pages(spark, str(tmp_path), "p.html").first()["html"] == "a�b" and readers.pages(spark, str(tmp_path), "p.html", strict=True).first()["html"] is None
    table = spark.createDataFrame([("a|b", 1)], "x string, y int")
    assert writers.markdown(table, "H").splitlines()[-1] == "| a\\|b | 1 |"
    with pytest.raises(ValueError):
        writers.markdown(spark.range(5), "H", limit=3)
    writers.append_log(table, str(tmp_path / "log"))
    writers.append_log(table, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
