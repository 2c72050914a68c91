import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillspark.llm import leakage as L

rnd = random.Random(5)
SYLLABLES = ["sol", "måne", "ring", "vej", "høst", "sang", "dag", "kors", "bøg", "ånd", "lam", "træ", "hav", "stjerne", "kalk", "duel", "brev", "gård"]
SMALL = ["og", "i", "den", "på", "en", "til", "af", "som", "han", "vi"]


def text(n):
    return " ".join(rnd.choice(SMALL) if k % 3 == 0 else rnd.choice(SYLLABLES) + rnd.choice(SYLLABLES) + rnd.choice(SYLLABLES) for k in range(n))


def brute(doc, item):
    d, w = L.WORD.findall(L.clean(doc)), L.WORD.findall(L.clean(item))
    if not w:
        return False
    at = defaultdict(list)
    for k, x in enumerate(w):
        at[x].append(k)
    best, before = 0, {}
    for x in d:
        before = {k: before.get(k - 1, 0) + 1 for k in at.get(x, ())}
        best = max([best, *before.values()])
    row = [0] * (len(w) + 1)
    for x in d:
        new = row[:]
        for k, y in enumerate(w):
            new[k + 1] = row[k] + 1 if x == y else max(new[k], row[k + 1])
        row = new
    return best >= 12 or row[-1] >= 2 / 3 * len(w)


ITEMS = [(k, text(rnd.randint(25, 60))) for k in range(30)]


def leaky(k):
    words = ITEMS[k][1].split()
    at = rnd.randrange(len(words) - 14)
    run = words[at : at + 13]
    return {
        "run": " ".join(run), "short": " ".join(words[at : at + 8]), "shuffled": " ".join(rnd.sample(words, len(words))), "edited": " ".join(w if i % 6 else "andet" for i, w in enumerate(words)),
        "marked": "<i>" + "</i><br/><i>".join(run) + "</i>", "split": " ".join(w[:3] + "\xad" + w[3:4] + "​" + w[4:] for w in run), "hyphened": "\n".join(w[:4] + "-\n" + w[4:] if len(w) > 6 else w for w in run),
        "spelled": " ".join(run).replace("å", "aa").replace("ø", "ö").replace("æ", "ae").upper(), "punctuated": " / ".join(run),
    }


EXPECTED = {"run": True, "short": False, "shuffled": False, "edited": True, "marked": True, "split": True, "hyphened": True, "spelled": True, "punctuated": True}


def test_disguises_and_decoys(spark):
    docs, want = [], set()
    for k, item in ITEMS:
        for kind, passage in leaky(k).items():
            docs.append((len(docs), f"{text(30)}. {passage}\n{text(20)}"))
            if EXPECTED[kind]:
                want.add((len(docs) - 1, k))
    docs += [(10_000, None), (10_001, ""), (10_002, "  \n"), (10_003, text(20_000)), (10_004, ITEMS[0][1]), (10_004, ITEMS[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(1), "doc": F.lit("x")})
    items = spark.createDataFrame([*ITEMS, (900, None), (901, ""), (902, "...")], "item_id long, text string").withColumn("doc_id", F.lit(2))
    got = {(r["doc_id"], r["item_id"]) for r in L.leaks(df, items).collect()}
    assert {x for x in got if x[0] < 10_000} == want and {x for x in got if x[0] >= 10_000} == {(10_004, 0)}
    assert L.leaks(df.limit(0), items).count() == 0 and L.leaks(df, items.limit(0)).count() == 0


def test_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in L.leaks(docs, items).collect()}
    small = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] and len(r["text"]) < 3000][:60]
    want = {(d, r["item_id"]) for d, t in small for r in items.collect() if brute(t, r["text"])}
    assert want <= got


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"{text(10)} {ITEMS[k][1]}") for k in range(8)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, L.leaks(docs, items).collect()))
    monkeypatch.setattr(L, "BLOCK", 2000)
    assert sorted(map(tuple, L.leaks(docs, items).collect())) == whole and len(whole) >= 8


@pytest.mark.parametrize(("foreign", "every"), [(10, 2), (20, 2), (40, 3), (200, 3)])
def test_text_put_between_the_words(foreign, every):
    rng = random.Random(foreign)
    word = lambda: "".join(rng.choice("abdefghiklmnoprstuv") for _ in range(rng.randint(2, 9)))
    items = [[word() for _ in range(60)] for _ in range(20)]
    index = L.Items(list(range(20)), [" ".join(t) for t in items])
    docs = [" ".join(w + (" " + " ".join(word() for _ in range(foreign)) if k % every == every - 1 else "") for k, w in enumerate(t)) for t in items]
    assert index.search(docs) == [(k, k) for k in range(20)]
    turned = [" ".join(w + (" " + " ".join(word() for _ in range(foreign)) if k % every == every - 1 else "") for k, w in enumerate(t[40:] + t[20:40] + t[:20])) for t in items]
    assert index.search(turned) == []
