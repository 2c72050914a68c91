import random

from pyspark.sql import functions as F

from quillspark.llm import spam as S

rnd = random.Random(9)
KEYS = ["salmebog tilbud", "billige salmebøger", "køb visebog online", "lydbog vers", "gratis fragt digte", "sange til bryllup"]
NOUNS = ["sol", "måne", "ring", "vej", "høst", "sang", "dag", "kors", "bøg", "ånd", "lam", "træ", "hav", "stjerne"]


def verse(n):
    return "\n".join(f"{rnd.choice(['Den', 'En', 'Hver'])} {rnd.choice(NOUNS)}{rnd.choice(NOUNS)}en {rnd.choice(['synger', 'går', 'hviler'])} {rnd.choice(['over', 'ved', 'under'])} {rnd.choice(NOUNS)}{rnd.choice(NOUNS)}et{rnd.choice(',.;')}" for _ in range(n))


def keywords(n, sep):
    few = rnd.sample(KEYS, 2)
    return sep.join(rnd.choice(few) for _ in range(n))


def documents():
    rows = []
    for k in range(400):
        rows.append((len(rows), verse(rnd.randint(6, 30)), "da", False))
    for k in range(40):
        rows.append((len(rows), keywords(rnd.randint(30, 80), rnd.choice([" | ", " • ", "\n", "; "])), "da", True))
        rows.append((len(rows), verse(1) + "\n" + "\n".join(f"https://x{rnd.randrange(50)}.example/{rnd.choice(KEYS).replace(' ', '-')}/{rnd.randrange(9999)} {rnd.choice(KEYS)}" for _ in range(20)), "DA", True))
        refrain = verse(1)
        rows.append((len(rows), "\n".join(f"{verse(2)}\n{refrain}" for _ in range(6)), None, False))
        rows.append((len(rows), verse(14) + "\nSe også: https://a.example/1 https://b.example/2", "da", False))
    return rows


def test_pages(spark):
    rows = documents()
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").withColumns({"share": F.lit("x"), "key": F.lit(1)})
    got = {r["doc_id"] for r in S.spam_pages(df).collect()}
    want = {r[0] for r in rows if r[3]}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 2


def test_dirty(spark):
    rows = [(1, None, None), (2, "", "da"), (3, " \n ", "da"), (4, "A", "xx"), (5, "ord " * 50_000, "da"), (1, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert S.keyword_shares(df).count() == 6 and S.keyword_shares(df.limit(0)).count() == 0
    assert {r["doc_id"]: r["share"] for r in S.keyword_shares(df).collect()}[4] == 0.0


def test_normal_form():
    assert "salmebog" in S.normal("salm3b0g") and "sange til" in S.normal("s a n g e _ t i l") and S.normal("1783") == "0" and S.normal("A5") == "a0"
    assert "".join(S.blocks("x\n" * 900)).count("x") == 900
    assert sum(len(b) for b in S.blocks("y" * 5000)) == 5000


def test_words_of_no_other_page_are_judged_by_ratio_and_links(spark):
    links = "\n".join(f"https://x{k}.example/side/{k * 7919}" for k in range(30))
    rows = [(k, verse(20), "da") for k in range(60)] + [(60, "kvalmebog " * 500, "da"), (61, links, "da"), (62, links, None)]
    got = {r["doc_id"] for r in S.spam_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {60, 61, 62}


def test_a_corpus_of_little_but_links_is_no_measure_of_itself(spark):
    links = lambda k: "\n".join(f"https://x{k * j}.example/side/{j * 7919 + k}" for j in range(40))
    rows = [(k, links(k), "da") for k in range(30)] + [(30, verse(20), "da")]
    got = {r["doc_id"] for r in S.spam_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == set(range(30))


def test_without_extreme_blocks_nothing_is_spam_and_a_dictionary_finds_short_lists(spark):
    tags = "hardback visebog guldsnit lommeformat konfirmation indbundet gaveæske paperback restsalg julegave bryllup nodebog læderryg vintage samler".split()
    plain = [(k, verse(20), "da") for k in range(60)]
    assert not S.spam_pages(spark.createDataFrame(plain, "doc_id long, text string, lang string")).count()
    rng = random.Random(3)
    short = ", ".join(rng.sample(tags, 14))
    extreme = [(100 + k, ", ".join(rng.choice(tags[k % 5 :: 5]) for _ in range(200)), "da") for k in range(15)]
    rows = plain + extreme + [(60, short, "da"), (61, short, "xx-unknown")]
    got = {r["doc_id"] for r in S.spam_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {r[0] for r in extreme} | {60, 61}


def test_refrains_count_once():
    song = "\n".join(x for k in range(8) for x in (f"linje {k} om skoven og havet i vest", "og alt det kommer aldrig mere igen"))
    assert S.once(song).count("aldrig") == 1
    assert S.once("køb bog\n" * 40) == "køb bog\n" * 40


def test_medians_are_of_all_different_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "ordinary", lambda n: F.lit(0.0))
    texts = [(k, verse(12), "da") for k in range(300)]
    df = spark.createDataFrame(texts + [(k, texts[0][1], "da") for k in range(1000, 1400)], "doc_id long, text string, lang string")
    found = S.measured(df, "doc_id")
    sizes = {}
    for _, t, _ in texts:
        for b in S.blocks(S.normal(t)):
            k = S.once(b)
            sizes.setdefault(S.length(len(k)), []).append(round(S.deflated(k) / len(k), 3))
    got = {r["size"]: r["middle"] for r in S.with_median(found, "ratio").select("size", "middle").distinct().collect()}
    for size, ratios in sizes.items():
        if len(ratios) >= 50:
            assert abs(got[size] - sorted(ratios)[len(ratios) // 2]) < 0.01
