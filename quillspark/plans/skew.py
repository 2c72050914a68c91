"""Numbering rows within groups, one of which may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.plans.shared import materialise


def row_numbers(df: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """Adds name, 1 and up within each group by order; rows that are equal in all order columns come in any order.

    A window alone sorts a group in one task. Here rows are split into ranges of (group, order), so a large group
    spans many tasks; each numbers its own part, and the sizes of a group's earlier parts, a row per part, are added.
    The ranges are written once to the shared folder, since both steps must see the same ones.
    """
    parts = materialise(df.repartitionByRange(*[F.col(c) for c in (*group, *order)]).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_part", *group).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("_before", before).where("_before IS NOT NULL").select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], "_before")
    local = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_part", *group).orderBy(*order)))
    same = F.col("_part") == F.col("_p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    joined = local.join(offsets, same, "left")
    return joined.withColumn(name, (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("long")).select(*df.columns, name)
