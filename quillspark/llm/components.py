"""Problem 4: one group number for all records that are linked directly or through others.

The giant component is peeled first: breadth-first search by frontier joins from the vertex of highest degree,
after which what was reached leaves the edge table by anti-join. The components left are labelled by minimum
propagation, each round doing a large-star and a small-star step, so that long chains shrink to a fraction per
round instead of by one link. A search that stops paying (a frontier below a share of the vertices) is ended
early; the part reached is then contracted to its smallest member, which keeps the result exact.

Defined results: a row with a null end or of a record with itself is no link; reversed and repeated rows count
once; other columns are ignored, whatever their names; without links the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.plans.shared import drop_materialised, materialise

#: The search goes on while a frontier has at least this share of all vertices, and for so many rounds at most.
FRONTIER_SHARE, SEARCH_ROUNDS = 0.001, 24


def links(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links (u, v) with v < u."""
    e = pairs.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    return e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")


def _check(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u") % 1_000_003)).first())


def peel(edges: DataFrame) -> tuple[DataFrame, int | None]:
    """(the vertices reached from the vertex of highest degree, the smallest of them); (none, None) without edges."""
    arcs = both_ways(edges)
    degree = arcs.groupBy("u").agg(F.count("*").alias("n"))
    top = degree.orderBy(F.desc("n"), "u").limit(1).collect()
    if not top:
        return edges.select(F.col("u").alias("x")).limit(0), None
    vertices = degree.count()
    spark = edges.sparkSession
    frontier = spark.createDataFrame([(top[0]["u"],)], "x long")
    reached, old = frontier, []
    for _ in range(SEARCH_ROUNDS):
        step = arcs.join(frontier.withColumnRenamed("x", "u"), "u", "left_semi").select(F.col("v").alias("x")).distinct()
        frontier = materialise(step.join(reached, "x", "left_anti"), "frontier")
        found = frontier.count()
        old.append(frontier)
        if not found:
            break
        reached = reached.unionByName(frontier)
        if found < FRONTIER_SHARE * vertices:
            break
    kept = materialise(reached, "reached")
    for f in old:
        drop_materialised(f)
    return kept, kept.agg(F.min("x")).first()[0]


def propagate(edges: DataFrame) -> DataFrame:
    """(x, label) of each vertex of edges, the label being the smallest vertex of its component."""
    now = materialise(edges, "links")
    mark = _check(now)
    while True:
        arcs = both_ways(now)
        least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = arcs.join(least, "u").where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        then = materialise(small.select("e.u", "e.v").where("u > v").distinct(), "links")
        drop_materialised(now)
        new = _check(then)
        now = then
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("v").alias("x"), F.col("v").alias("label"))
    return now.select(F.col("u").alias("x"), F.col("v").alias("label")).unionByName(roots).distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(x, label) of every vertex that has a link."""
    edges = materialise(links(pairs, a, b), "edges")
    reached, least = peel(edges)
    if least is None:
        return edges.select(F.col("u").alias("x"), F.col("v").alias("label"))
    inside = reached.select("x", F.lit(True).alias("in"))
    rest = (
        edges.join(inside.select(F.col("x").alias("u"), F.col("in").alias("u_in")), "u", "left")
        .join(inside.select(F.col("x").alias("v"), F.col("in").alias("v_in")), "v", "left")
        .where("u_in IS NULL OR v_in IS NULL")
        .select(F.when(F.col("u_in"), F.lit(least)).otherwise(F.col("u")).alias("u"), F.when(F.col("v_in"), F.lit(least)).otherwise(F.col("v")).alias("v"))
    )
    labels = propagate(rest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    own = labels.where(F.col("x") == least).select(F.min("label").alias("l"))
    label = F.coalesce(F.lit(own.first()["l"]), F.lit(least))
    return labels.join(reached, "x", "left_anti").unionByName(reached.select("x", label.cast("long").alias("label")))
