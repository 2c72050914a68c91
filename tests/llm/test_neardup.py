import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quillspark.llm import neardup as N
from quillspark.llm import queries


def agree(a, b):
    x, y = Counter(N.words(a)), Counter(N.words(b))
    return sum((x & y).values()) / max(x.total(), y.total())


def texts_of(n, seed):
    rnd = random.Random(seed)
    vocab = [f"ord{k}" + "abcdefg"[k % 7] * 3 for k in range(900)]
    common = ["og", "den", "i", "en"]
    out = []
    while len(out) < n:
        base = [rnd.choice(vocab) if rnd.random() < 0.6 else rnd.choice(common) for _ in range(rnd.randint(8, 70))]
        out.append(base)
        for _ in range(rnd.choice([0, 0, 1, 3])):
            near = [w if rnd.random() > 0.12 else rnd.choice(vocab) for w in base]
            if rnd.random() < 0.5:
                rnd.shuffle(near)
            out.append(near)
    return [(k, " ".join(t).upper() if k % 5 == 0 else ", ".join(t) + "!") for k, t in enumerate(out[:n])]


def found(spark, rows):
    df = spark.createDataFrame(rows, "id long, text string").withColumns({"a": F.lit(1), "regs": F.lit("x")}).select("id", "text")
    pairs, members = N.near_duplicates(df)
    return {(r["poem_a"], r["poem_b"]) for r in N.all_pairs(pairs, members).collect()}


def test_equals_brute_force(spark):
    rows = texts_of(260, 3)
    want = {(a, b) for a, s in rows for b, t in rows if a < b and agree(s, t) >= 0.7}
    got = found(spark, rows)
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 100


def test_nulls_empties_copies_and_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " .,- "), (4, "en to tre"), (5, "tre, TO en"), (6, "en to tre"), (7, long), (8, long + " x"), (9, "og"), (10, "og"), (11, "og og")]
    assert found(spark, rows) == {(4, 5), (4, 6), (5, 6), (7, 8), (9, 10)}
    assert found(spark, []) == set()


def test_estimate_follows_similarity():
    rnd = np.random.default_rng(1)
    for share in (0.0, 0.3, 0.6, 1.0):
        got = []
        for _ in range(40):
            n = 40
            both = int(round(2 * n * share / (1 + share)))
            a = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
            b = np.concatenate([a[:both], rnd.integers(0, 1 << 63, n - both, dtype=np.uint64)])
            regs = N.registers(np.concatenate([a, b]), np.array([0, n]))
            got.append(N.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0])
        assert abs(np.mean(got) - both / (2 * n - both)) < 0.03


def test_groups_give_one_row_a_poem(spark, folder):
    rows = queries.p1_groups(spark, folder).collect()
    assert len({r["poem_no"] for r in rows}) == len(rows)
    group = {r["poem_no"]: r["group_no"] for r in rows}
    assert all(group[r["poem_a"]] == group[r["poem_b"]] for r in queries.p1_found(spark, folder).collect())


def slipped(rnd, base, n):
    out = list(base)
    for k in rnd.sample(range(len(base)), n):
        w = out[k]
        at = rnd.randrange(len(w))
        out[k] = w[:at] + rnd.choice("bdfghkmnprtu") + w[at:] + rnd.choice("bdfghkmnprtu")
    return out


def background(rnd, n, vocab):
    return [[rnd.choice(vocab) if rnd.random() < 0.4 else rnd.choice(["og", "den", "i", "en", "som", "det"]) for _ in range(rnd.randint(20, 60))] for _ in range(n)]


def recall(spark, texts):
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    bags = [Counter(t) for t in texts]
    most = [max(b.total(), 1) for b in bags]
    want = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if min(most[a], most[b]) >= 0.7 * max(most[a], most[b]) and sum((bags[a] & bags[b]).values()) >= 0.7 * max(most[a], most[b]) - 1e-9}
    got = found(spark, rows)
    assert got <= want
    return len(got) / len(want), len(want)


def test_a_third_of_the_rows_are_edited_copies_of_one_poem(spark):
    rnd = random.Random(11)
    vocab = [f"ord{k}" for k in range(3000)]
    poem = background(rnd, 1, vocab)[0]
    share, n = recall(spark, background(rnd, 400, vocab) + [slipped(rnd, poem, rnd.randint(1, 4)) for _ in range(200)])
    assert n > 15_000 and share >= 0.99


def test_slips_of_the_pen_near_the_threshold(spark):
    rnd = random.Random(12)
    vocab = [f"ord{k}" for k in range(3000)]
    texts = background(rnd, 500, vocab)
    near = [slipped(rnd, t, int(len(t) * (0.2 + 0.1 * rnd.random()))) for t in texts]
    share, n = recall(spark, texts + near)
    assert n >= 500 and share >= 0.98


def test_bands_of_many_records_are_compared_in_squares(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT", 7)
    rnd = random.Random(13)
    vocab = [f"ord{k}" for k in range(900)]
    poem = background(rnd, 1, vocab)[0]
    share, n = recall(spark, background(rnd, 60, vocab) + [slipped(rnd, poem, rnd.randint(1, 3)) for _ in range(50)])
    assert n > 1000 and share >= 0.99
