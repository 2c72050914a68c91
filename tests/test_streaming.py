from quillspark.streaming import crawl


def test_new_pages_are_read_once(spark, tmp_path):
    pages, out, mark = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "mark")
    pages.mkdir()
    (pages / "a.html").write_text('<div class="poetry"><div class="verse-line">x</div></div>')
    for _ in range(2):
        crawl.append(crawl.probe(crawl.new_pages(spark, str(pages))), out, mark).awaitTermination()
    assert [(r["n_poetry"], r["n_verse_line"]) for r in spark.read.parquet(out).collect()] == [(1, 1)]
    (pages / "b.html").write_text("<p>")
    crawl.append(crawl.probe(crawl.new_pages(spark, str(pages))), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_names_stay_unique_over_batches(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    for k in range(2):
        (source / f"{k}.json").write_text('{"name":"x.json","url":"u1"}\n{"name":"x.json","url":"u2"}\n')
        stream = spark.readStream.schema("name string, url string").json(str(source))
        crawl.append_named(stream, out, mark, "name", "url").awaitTermination()
    names = sorted(r["unique_name"] for r in spark.read.parquet(out).collect())
    assert names == ["x--2.json", "x--3.json", "x--4.json", "x.json"]


def test_a_name_given_as_a_suffix_is_given_once(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    batches = (["x.json", "x--2.json", None, None], ["x.json", "y--4.json", None], ["y--5.json", "y.json", "x--3.json", "x--9.json"])
    for k, names in enumerate(batches):
        (source / f"{k}.json").write_text("".join('{"name":%s,"url":"u%d"}\n' % ("null" if n is None else f'"{n}"', j) for j, n in enumerate(names)))
        crawl.append_named(spark.readStream.schema("name string, url string").json(str(source)), out, mark, "name", "url").awaitTermination()
    names = [r["unique_name"] for r in spark.read.parquet(out).collect()]
    kept = sorted(n for n in names if n is not None)
    assert kept == sorted(["x.json", "x--2.json", "x--3.json", "y--4.json", "y--5.json", "y--6.json", "x--9.json", "x--10.json"]) and names.count(None) == 3


def test_late_visits_are_counted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"discovered_at":"2025-01-02T00:00:00Z","book_slug":"b","error":null}\n{"discovered_at":"2025-01-01T05:00:00Z","book_slug":"b","error":"e"}\n')
    stream = spark.readStream.schema("discovered_at timestamp, book_slug string, error string").json(str(source))
    crawl.latest_visits(stream).writeStream.format("memory").queryName("visits").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    assert sorted((str(r["window"]["start"])[:10], r["n"], r["failed"]) for r in spark.table("visits").collect()) == [("2025-01-01", 1, 1), ("2025-01-02", 1, 0)]
