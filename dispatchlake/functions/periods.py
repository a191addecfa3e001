"""Days, spines of days and coarser periods. Weeks begin on Sunday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRANULARITIES = ("day", "week", "month", "quarter", "year")


def period(day: Column, granularity: str) -> Column:
    if granularity not in GRANULARITIES:
        raise ValueError(f"no such granularity: {granularity}")
    if granularity == "day":
        return day
    if granularity == "week":
        return F.date_sub(day, F.dayofweek(day) - 1)
    return F.date_trunc(granularity, day).cast("date")


def spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row for each day from first to last, inclusive."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day"))


def spine_of(days: DataFrame) -> DataFrame:
    """The days from the least to the greatest of the column day."""
    ends = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a is not null")
    return ends.select(F.explode(F.sequence("a", "b")).alias("day"))


def calendar(days: DataFrame) -> DataFrame:
    """date_key and attributes of days; the weekend is Friday and Saturday."""
    day = F.col("day")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.dayofweek(day).alias("weekday"), F.dayofweek(day).isin(6, 7).alias("is_weekend"), period(day, "week").alias("week_start"),
    )
