"""Exact quantiles of groups of any size, by histograms that are refined.

`median` and `percentile_cont` keep every distinct value of a group in one buffer. Here a quantile is the value of
a rank, and a rank's value is searched for: the range that holds it is cut into buckets, counted by partial
aggregation, and replaced by the bucket that holds the rank, with the smallest and largest value that it has, until
they are one. A task never holds more than a row for each bucket that it has met. The ranges, a few rows for each
group, stay in Spark's cache while the result is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def exact_quantiles(rows: DataFrame, by: list[str], value: str, at: dict[str, float], buckets: int = BUCKETS) -> DataFrame:
    """For each group of `by` the interpolated quantile of `value` (a number) under each name of `at`, as
    `percentile_cont` defines it. Nulls have no part; a group of nulls alone has null quantiles."""
    if any(not 0 <= p <= 1 for p in at.values()):
        raise ValueError("quantiles lie between 0 and 1")
    values = rows.select(*by, F.col(value).cast("double").alias("_v"))
    groups = values.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    # the two ranks that each quantile lies between
    place = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), end.alias("rank")) for name, p in at.items() for end in (F.floor(place(p)), F.ceil(place(p)))))
    ranks = groups.filter("_n > 0").select(*by, "_low", "_high", F.explode(F.array_distinct(F.transform(wanted, lambda w: w["rank"]))).alias("_rank"))
    open_, found = ranks.withColumn("_below", F.lit(0).cast("long")).persist(), None
    while True:
        done = open_.filter("_low = _high").select(*by, "_rank", F.col("_low").alias("_value"))
        found = done if found is None else found.unionByName(done)
        still = open_.filter("_low < _high")
        if still.isEmpty():
            break
        ranges = still.groupBy(*by, "_low", "_high", "_below").agg(F.collect_list("_rank").alias("_ranks"))
        own = [F.col(f"v.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
        inside = F.col("v._v").between(F.col("r._low"), F.col("r._high"))
        met = values.alias("v").join(ranges.alias("r"), [*own, inside] if own else inside)
        bucket = F.least(F.floor((F.col("v._v") - F.col("r._low")) / (F.col("r._high") - F.col("r._low")) * buckets), F.lit(buckets - 1))
        counted = met.groupBy(*(F.col(f"v.{c}").alias(c) for c in by), F.col("r._low").alias("_of"), F.col("r._below").alias("_base"), F.col("r._ranks").alias("_ranks"), bucket.alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_in"), F.min("v._v").alias("_low"), F.max("v._v").alias("_high")
        )
        until = F.col("_base") + F.sum("_in").over(Window.partitionBy(*by, "_of", "_base", "_ranks").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
        narrowed = counted.withColumn("_until", until).withColumn("_below", F.col("_until") - F.col("_in"))
        narrowed = narrowed.select(*by, "_low", "_high", "_below", "_until", F.explode("_ranks").alias("_rank")).filter("_rank >= _below and _rank < _until").drop("_until")
        open_ = narrowed.select(*open_.columns).persist()
    joined = groups.select(*by, "_n")
    for i, (name, p) in enumerate(at.items()):
        for end, rank in (("low", F.floor(place(p))), ("high", F.ceil(place(p)))):
            side = found.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_rank").alias("_at"), F.col("_value").alias(f"_{end}{i}"))
            joined = joined.join(side, [*(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by), F.col("_at") == rank], "left").drop("_at", *(f"_{c}" for c in by))
        share = place(p) - F.floor(place(p))
        joined = joined.withColumn(name, F.when(share == 0, F.col(f"_low{i}")).otherwise(F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * share)).drop(f"_low{i}", f"_high{i}")
    return joined.drop("_n")
