from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from quillspark.llm import queries
from quillspark.llm import survivor as S

COPY = "copy_no long, group_no long, title string, trust int, source struct<corpus:string,title:string,year_published:int>, body array<struct<id:int,text:string>>, fetched_at timestamp"
DAY = [datetime(2025, 1, d) for d in range(1, 10)]


def copy(no, group, trust, title, year, lines, day):
    return (no, group, "t", trust, ("c", title, year), None if lines is None else [(k, x) for k, x in enumerate(lines)], DAY[day] if day is not None else None)


ROWS = [
    copy(1, 1, 1, "Digte", 1600, ["a", "b"], 0), copy(2, 1, 3, "[uden titel]", 9999, ["a", "[tekst mangler]", "* * *"], 1), copy(3, 1, 2, "Digt", 1601, ["a", "b", "a"], 2), copy(4, 1, 2, "Digte", None, [], 3),
    copy(5, 2, 2, None, 0, None, 0), copy(6, 2, 2, "  ", 1399, [None, "", "…", "(resten mangler)"], 1),
    copy(7, 3, 2, "A", 1400, ["x"], 1), copy(8, 3, 2, "B", 2026, ["x"], 1), copy(8, 3, 2, "B", 2026, ["x"], 1),
    copy(9, None, None, "N", 1700, ["n"], None), copy(10, None, 1, "M", 1701, ["m", "[ulæseligt]"], 0),
]


def test_fields_are_chosen_in_the_stated_order(spark):
    df = spark.createDataFrame(ROWS, COPY).withColumns({"field": F.lit("x"), "value": F.lit("y"), "usable": F.lit(True), "p": F.lit(1)})
    got = {r["group_no"]: (r["title_copy"], r["year_copy"], r["body_copy"]) for r in S.survivors(df).collect()}
    assert got == {1: (4, 3, 3), 2: (None, None, None), 3: (7, 7, 7), None: (10, 10, 10)}
    assert S.survivors(df.limit(0)).count() == 0


def test_equals_sql(spark, folder):
    got = sorted(map(tuple, queries.p5_found(spark, folder).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW poem_copies AS SELECT * FROM '{folder}/poem_copies.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["p5_found"]).fetchall())


def test_the_stated_order_alone_chooses(spark, monkeypatch, tmp_path):
    """No model runs and no table is written for it; rows of one number don't lend each other lines."""
    monkeypatch.setattr(S, "posteriors", lambda given: 1 / 0)
    monkeypatch.setattr(S, "materialise", lambda df, label: 1 / 0)
    rows = [copy(1, 1, 1, "A", 1600, ["a", "b"], 0), copy(1, 1, 1, "A", 1600, ["c", "d"], 0), copy(2, 1, 2, "B", 9999, ["x", "y", "z"], 0), copy(3, 2, 1, "titel", None, ["[mangler]"], None), copy(4, 2, None, "C", None, None, 0)]
    df = spark.createDataFrame(rows, COPY)
    got = sorted(map(tuple, S.survivors(df).collect()))
    assert got == [(1, 2, 1, 2), (2, 4, None, None)]
    df.coalesce(1).write.parquet(f"{tmp_path}/copies")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW poem_copies AS SELECT * FROM '{tmp_path}/copies/*.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["p5_found"]).fetchall())


def test_the_model_finds_bad_sources_and_keeps_several_values(spark):
    rows, no = [], 0
    for g in range(60):
        for corpus, title in (("good", f"T{g}"), ("fair", f"T{g}"), ("bad", f"wrong{g}"), ("fair2", f"T{g}")):
            no += 1
            rows.append((no, g, "t", 2, (corpus, title, 1600), [(0, f"l{g}"), (1, f"m{g}")], DAY[0]))
    given = S.claims(spark.createDataFrame(rows, COPY))
    facts, sources = S.posteriors(given)
    facts = facts.join(given.select("group_no", "field", "k", "value").distinct(), ["group_no", "field", "k"])
    p = {(r["group_no"], r["value"]): r["p"] for r in facts.where("field = 'title'").collect()}
    assert all(p[g, f"T{g}"] > 0.9 and p[g, f"wrong{g}"] < 0.1 for g in range(60))
    sense = {r["source"]: r["sensitivity"] for r in sources.where("field = 'title'").collect()}
    assert sense["bad|2"] < 0.2 < 0.8 < sense["good|2"]
    assert facts.where("field = 'line' AND p > 0.5").count() == 120
    assert S.true_values(spark.createDataFrame(rows, COPY)).where("field = 'title'").count() == 60
    got = {r["group_no"]: (r["title"], r["year"], r["lines"]) for r in S.judged(spark.createDataFrame(rows, COPY)).collect()}
    assert got == {g: (f"T{g}", "1600", 2) for g in range(60)}


def test_the_model_prefers_one_good_source_to_two_bad_ones(spark):
    """Where the bad sources agree by chance in a few groups, plain voting errs and the learned qualities don't."""
    rows, no = [], 0
    for g in range(80):
        bad = f"same{g}" if g < 6 else None
        for corpus, title in (("good", f"T{g}"), ("fine", f"T{g}" if g >= 6 else None), ("bad", bad or f"w{g}"), ("worse", bad or f"v{g}")):
            no += 1
            rows.append((no, g, "t", 2, (corpus, title, 1600), [(0, f"l{g}")], DAY[0]))
    got = {r["group_no"]: r["title"] for r in S.judged(spark.createDataFrame(rows, COPY)).collect()}
    assert all(got[g] == f"T{g}" for g in range(80))


def test_many_silent_sources_rule_out_nothing_usable(spark):
    rows = [(k, 1, "t", 3 if k == 0 else 1, (f"c{k}", "Alone" if k == 0 else "Others", 1600), [(0, "x")], DAY[0]) for k in range(40)]
    assert [r["title_copy"] for r in S.survivors(spark.createDataFrame(rows, COPY)).collect()] == [0]
    assert S.judged(spark.createDataFrame(rows, COPY).limit(0)).count() == 0
