"""Publication of day marts: provisional (version 0), closed (1) and corrected (2 and up) days.

A publication record has one row for each mart, day and version, days without rows included. All
functions take the day as an argument. The record and the days are small; the marts' rows are only joined
with them and written by partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import spine

CORRECTION_DAYS = 7
INTRADAY_DAYS = 7
RECORD = "mart string, day date, close_version int, publication_seq long, row_count long"


def closed_days(record: DataFrame, mart: str) -> DataFrame:
    """day and newest version of the closed days of a mart."""
    return record.filter((F.col("mart") == mart) & (F.col("close_version") >= 1)).groupBy("day").agg(F.max("close_version").alias("close_version"))


def open_days(spark: SparkSession, record: DataFrame, mart: str, first: Column, today: str) -> DataFrame:
    """Days after the last closed one (or from `first` on) up to today."""
    last = closed_days(record, mart).agg(F.max("day").alias("d"))
    start = F.coalesce(F.date_add("d", 1), first)
    day = F.lit(today).cast("date")
    return last.filter(start <= day).select(F.explode(F.sequence(start, day)).alias("day"))


def intraday(days: DataFrame, today: str, depth: int = INTRADAY_DAYS) -> DataFrame:
    """Open days that are rewritten as provisional."""
    return days.filter(F.col("day") > F.date_sub(F.lit(today).cast("date"), depth)).withColumn("close_version", F.lit(0))


def final_days(days: DataFrame, sweeps: DataFrame, batches: DataFrame, first_sweep: Column, source_zone: str, report_zone: str) -> DataFrame:
    """Days all of whose source days have been swept again by a successful run whose batches are all settled.

    sweeps: source_day, run_id, outcome; batches: run_id, batch_seq, settled (in core, or discarded)."""
    midnight = lambda d: F.to_utc_timestamp(d.cast("timestamp"), report_zone)
    local = lambda t: F.to_date(F.from_utc_timestamp(t, source_zone))
    needed = days.select("day", F.explode(F.sequence(local(midnight(F.col("day"))), local(midnight(F.date_add("day", 1)) - F.expr("interval 1 second")))).alias("source_day"))
    needed = needed.filter(F.col("source_day") >= first_sweep)
    settled = batches.groupBy("run_id").agg(F.bool_and("settled").alias("settled"))
    swept = sweeps.filter("outcome = 'succeeded'").join(settled, "run_id", "left").filter(F.coalesce("settled", F.lit(True))).select("source_day").distinct()
    blocked = needed.join(swept, "source_day", "left_anti").select("day").distinct()
    return days.join(blocked, "day", "left_anti")


def closable(days: DataFrame, final: DataFrame) -> DataFrame:
    """Final days in order, up to the first that is not."""
    blocked = days.join(final, "day", "left_anti").agg(F.min("day").alias("_first"))
    return final.crossJoin(F.broadcast(blocked)).filter(F.col("_first").isNull() | (F.col("day") < F.col("_first"))).drop("_first").withColumn("close_version", F.lit(1))


def corrections(record: DataFrame, mart: str, published: DataFrame, computed: DataFrame, depth: int = CORRECTION_DAYS) -> DataFrame:
    """day and next version of the last `depth` closed days whose rows differ, as multisets, from what was published.

    published and computed: day, close_version (published only) and the mart's columns."""
    closed = closed_days(record, mart)
    last = closed.agg(F.max("day").alias("_last"))
    recent = closed.crossJoin(F.broadcast(last)).filter(F.col("day") > F.date_sub("_last", depth)).drop("_last")
    # at most `depth` days: as literals they prune the partitions that are read
    days = [r["day"] for r in recent.select("day").collect()]
    columns = ["day", *(c for c in computed.columns if c != "day")]
    old = published.filter(F.col("day").isin(days)).join(F.broadcast(recent), ["day", "close_version"], "left_semi")
    new = computed.filter(F.col("day").isin(days))
    # equal multisets cancel out, each side being read once
    both = old.select(*columns, F.lit(1).alias("_side")).unionByName(new.select(*columns, F.lit(-1).alias("_side")))
    changed = both.groupBy(*columns).agg(F.sum("_side").alias("_left")).filter("_left <> 0").select("day").distinct()
    return recent.join(changed, "day", "left_semi").select("day", (F.col("close_version") + 1).alias("close_version"))


def rows_to_publish(computed: DataFrame, days: DataFrame, seq: int) -> DataFrame:
    """The mart's rows of the days that are published, with version and number."""
    return computed.join(F.broadcast(days.select("day", "close_version")), "day").withColumn("publication_seq", F.lit(seq).cast("long"))


def records(days: DataFrame, rows: DataFrame, mart: str, seq: int) -> DataFrame:
    """Record rows of a publication, days without rows included."""
    counted = rows.groupBy("day").agg(F.count(F.lit(1)).alias("row_count"))
    out = days.select("day", "close_version").join(counted, "day", "left")
    return out.select(F.lit(mart).alias("mart"), "day", F.col("close_version").cast("int").alias("close_version"), F.lit(seq).cast("long").alias("publication_seq"), F.coalesce("row_count", F.lit(0)).alias("row_count"))


def next_seq(record: DataFrame) -> int:
    """One number for each publication: there is a single writer."""
    return int(record.agg(F.coalesce(F.max("publication_seq"), F.lit(0))).first()[0]) + 1


@dataclass(frozen=True)
class Publisher:
    """A mart on Parquet: rows under `path`/rows, partitioned by day and version, records under `path`/record."""

    spark: SparkSession
    path: str
    mart: str

    def record(self) -> DataFrame:
        try:
            return self.spark.read.schema(RECORD).parquet(f"{self.path}/record")
        except Exception as error:  # nothing was published yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], RECORD)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def publish(self, computed: DataFrame, days: DataFrame) -> int:
        """Writes rows first and the record after: a crash in between leaves versions that no reader chooses."""
        seq = next_seq(self.record())
        rows = rows_to_publish(computed, days, seq)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "close_version").parquet(f"{self.path}/rows")
        records(days, rows, self.mart, seq).coalesce(1).write.mode("append").parquet(f"{self.path}/record")
        return seq


def days_of(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spine(spark, first, last)
