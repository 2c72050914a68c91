import json

from quillspark import cli
from tests.test_operators import GOOD


def test_commands(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    assert cli.main(["validate", str(tmp_path / "nowhere")]) == 2 and cli.main(["validate", str(docs)]) == 2
    for name in ("s--a-b--t--k.json", "s--a-b--t--k--2.json"):
        (docs / name).write_text(json.dumps({**GOOD, "body": [{"id": k, "stanza_id": 0, "text": f"linje {k}", "part": False, "marginal_notes": None} for k in range(5)]}))
    assert cli.main(["validate", str(docs)]) == 0
    assert cli.main(["duplicates", str(docs), str(tmp_path / "dup")]) == 0
    assert spark.read.parquet(str(tmp_path / "dup" / "pairs")).count() == 1 and spark.read.parquet(str(tmp_path / "dup" / "overlap")).count() == 5
    plan = tmp_path / "PLAN.md"
    plan.write_text("| Reason | Delete | Keep |\n|---|---|---|\n| same | `s--a-b--t--k--2.json` | `s--a-b--t--k.json` |\n")
    assert cli.main(["apply", str(docs), str(plan), str(tmp_path / "new"), "--dry-run"]) == 0 and not (tmp_path / "new").exists()
    assert cli.main(["apply", str(docs), str(plan), str(tmp_path / "new")]) == 0
    assert [r["file_name"] for r in spark.read.parquet(str(tmp_path / "new" / "documents")).collect()] == ["s--a-b--t--k.json"]
    assert spark.read.parquet(str(tmp_path / "new" / "quarantine")).count() == 1 and len(list(docs.iterdir())) == 2
    (tmp_path / "alias.json").write_text('{"slug":"a-b","key":"b-a"}\n')
    (tmp_path / "authors.json").write_text('{"key":"b-a","name_full":"A. B.","wiki_id":"Q1"}\n')
    assert cli.main(["authors", str(docs), str(tmp_path / "alias.json"), str(tmp_path / "authors.json"), "s"]) == 0
    found = tmp_path / "found"
    found.mkdir()
    (found / "b.json").write_text(json.dumps({"book_slug": "b", "discovered_at": "2025", "pages": [{"path": "/1", "url": "u", "n_poetry": 0, "n_verse_line": 2, "cached": "c"}]}))
    assert cli.main(["discover", str(found), str(tmp_path / "report")]) == 0
    (docs / "bad.json").write_text("{")
    assert cli.main(["validate", str(docs)]) == 1


def test_pages_to_files(spark, tmp_path, capsys):
    pages = tmp_path / "pages"
    (pages / "b1").mkdir(parents=True)
    page = '<a data-ajax-url="/b1/3?x">n</a><div id="region-content"><results><div class="poetry"><div class="verse-line">Jesum</div></div></results></div>'
    for k in (1, 2):
        (pages / "b1" / f"{k}.html").write_text(page)
    (pages / "b1" / "9.html").write_text("<p>")
    (tmp_path / "books.json").write_text(json.dumps({"books": [{"slug": "b1", "title": "Bog", "year_published": 1569}]}))
    assert cli.main(["parse", str(pages), str(tmp_path / "books.json"), str(tmp_path / "out"), "C", "src"]) == 1
    assert "2 poems, 1 pages failed, 1 names numbered" in capsys.readouterr().out
    files = sorted(p.name for p in (tmp_path / "out" / "poems").iterdir())
    assert files == ["src--anonymous--jesum--b1--2.json", "src--anonymous--jesum--b1.json"]
    written = json.loads((tmp_path / "out" / "poems" / files[1]).read_text())
    assert written["body"][0]["text"] == "Jesum" and written["source"]["year_published"] == 1569
    assert cli.main(["page", str(pages / "b1" / "1.html")]) == 0 and json.loads(capsys.readouterr().out)[0]["text"] == "Jesum"
    assert cli.main(["crawl", str(pages), str(tmp_path / "found")]) == 0
    assert [r["path"] for r in spark.read.parquet(str(tmp_path / "found" / "frontier")).collect()] == ["/b1/3"]
    (tmp_path / "alias.json").write_text('{"slug":"anonymous","key":"x"}\n')
    (tmp_path / "authors.json").write_text('{"key":"x","name_full":"X","wiki_id":"Q1"}\n')
    assert cli.main(["authors", str(tmp_path / "out" / "poems"), str(tmp_path / "alias.json"), str(tmp_path / "authors.json"), "src", "--out", str(tmp_path / "renamed")]) == 0
    assert sorted(p.name for p in (tmp_path / "renamed").iterdir()) == files
