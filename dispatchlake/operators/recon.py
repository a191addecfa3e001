"""Reconciliation of two copies, and profiles of what a table holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.content import row_hash, signed32


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of `a` that `b` lacks (side gone) and the other way round (side come), repeats counted."""
    side = lambda df, name: df.select(F.lit(name).alias("side"), *df.columns)
    return side(a.exceptAll(b), "gone").unionByName(side(b.exceptAll(a), "come"))


def table_hash(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows and two sums of signed 32-bit slices of row hashes by group: the same in any order."""
    hashed = rows.withColumn("_hash", row_hash(columns))
    part = lambda at: F.sum(signed32(F.substring("_hash", at, 8)))
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), part(1).alias("hash_a"), part(9).alias("hash_b"))


def compare(a: DataFrame, b: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Outcome of each group: matched, differs, only_left or only_right."""
    left, right = (df.select(*by, F.struct(*measures).alias(name)) for df, name in ((a, "_l"), (b, "_r")))
    joined = left.join(right, by, "full_outer")
    outcome = F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").when(F.col("_l") == F.col("_r"), "matched").otherwise("differs")
    return joined.select(*by, outcome.alias("outcome"))


def batch_totals(rows: DataFrame, batch: list[str], measures: list[str], month: str) -> DataFrame:
    """Count, sums of measures and months of each batch of a migration."""
    sums = [F.sum(m).alias(m) for m in measures]
    return rows.groupBy(*batch, month).agg(F.count(F.lit(1)).alias("n"), *sums)


def availability(rows: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Share of values that are there, by column and group, and the state that follows from it."""
    counted = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(c) for c in columns))
    long = counted.unpivot([by, "n"], columns, "column_name", "present")
    share = F.col("present") / F.col("n")
    state = F.when(share == 1, "full").when(share >= 0.9, "partial").when(share > 0, "sparse").otherwise("none")
    return long.select(by, "column_name", "n", "present", state.alias("state"))


STATES = ("none", "sparse", "partial", "full")


def metric_state(profile: DataFrame, inputs: dict[str, list[str]], by: str) -> DataFrame:
    """A metric is as available as its worst input column."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column_name")) for m, cs in inputs.items() for c in cs]
    needs = profile.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))
    worst = profile.join(F.broadcast(needs), "column_name").groupBy("metric", by).agg(F.min(rank).cast("int").alias("rank"))
    return worst.select("metric", by, F.element_at(F.array(*map(F.lit, STATES)), F.col("rank")).alias("state"))


def value_profile(rows: DataFrame, column: str, seen: str) -> DataFrame:
    """Occurrences, share and first and last sight of each value of a column."""
    counted = rows.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("occurrences"), F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    return counted.crossJoin(F.broadcast(total)).select("value", "occurrences", (F.col("occurrences") / F.col("_total")).alias("share"), "first_seen", "last_seen")
