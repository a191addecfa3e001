"""Numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def places(rows: DataFrame, order: Column, name: str, ranges: int = 200) -> DataFrame:
    """`rows` with the place of each in the order of a number, from 1 (ties are numbered in any order).

    Approximate quantiles cut the number into ranges; each range is numbered by itself, after what the ranges
    before it hold. Rows without the number come last."""
    keyed = rows.withColumn("_order", order)
    cuts = keyed.agg(F.percentile_approx("_order", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    edges = F.array(*map(F.lit, sorted(set(cuts)))).cast("array<double>")
    ranged = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("_order"))), F.lit(ranges))
    keyed = keyed.withColumn("_range", F.when(F.col("_order").isNull(), ranges).otherwise(ranged))
    counts = keyed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # at most as many rows as there are ranges
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_order"))
    numbered = keyed.withColumn("_own", own).join(F.broadcast(counts), "_range")
    return numbered.withColumn(name, F.col("_before") + F.col("_own")).drop("_order", "_range", "_own", "_before")
