import random

import pytest

from quillspark.llm.components import components


def union_find(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


rnd = random.Random(4)
GRAPHS = {
    "dirty": [(1, 2), (2, 1), (1, 2), (3, 3), (None, 4), (5, None), (2, 6), (9, 8)],
    "empty": [],
    "only loops": [(1, 1), (None, None)],
    "chain": [(k, k + 1) for k in range(1, 200)],
    "chain in disorder": (lambda p: [(p[k], p[k + 1]) for k in range(99)])(rnd.sample(range(1000), 100)),
    "star beside chains": [(0, k) for k in range(1, 60)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5001)],
    "random": [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)],
    "two hubs": [(1, k) for k in range(10, 40)] + [(2, k) for k in range(40, 70)] + [(39, 40)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_equals_union_find(spark, name):
    df = spark.createDataFrame([(a, b, "x", 7) for a, b in GRAPHS[name]], "poem_a long, poem_b long, label string, u int")
    got = [(r["x"], r["label"]) for r in components(df, "poem_a", "poem_b").collect()]
    assert len(got) == len(set(got)) and dict(got) == union_find(GRAPHS[name])
