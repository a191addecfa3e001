"""Metrics of the platform itself, from run logs, batches and checks. Times are seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def success_rate(runs: DataFrame, by: str) -> DataFrame:
    """Runs, those that succeeded (quarantining a batch is success), and their ratio."""
    good = F.count_if(F.col("outcome").isin("succeeded", "quarantined"))
    return runs.groupBy(by).agg(F.count(F.lit(1)).alias("runs"), good.alias("succeeded"), F.try_divide(good.cast("double"), F.count(F.lit(1))).alias("rate"))


def repair_times(runs: DataFrame, source: str, at: str) -> DataFrame:
    """By source: outages (a failure after a success, or the first run), their mean length until the next success
    (mttr) and the mean time from one outage's start to the next (mtbf)."""
    order = Window.partitionBy(source).orderBy(at, "run_id")
    failed = F.col("outcome") == "failed"
    marked = runs.withColumns({"_failed": failed, "_before": F.lag(failed, 1, False).over(order)})
    turns = marked.filter(F.col("_failed") != F.col("_before"))
    turns = turns.withColumns({"_until": F.lead(at).over(order), "_next": F.lead(at, 2).over(order)}).filter("_failed")
    return turns.groupBy(source).agg(F.count(F.lit(1)).alias("outages"), F.avg(F.col("_until") - F.col(at)).alias("mttr"), F.avg(F.col("_next") - F.col(at)).alias("mtbf"))


def availability(runs: DataFrame, by: str) -> DataFrame:
    """Share of the periods in which at least one run succeeded."""
    per = runs.groupBy(by, "period").agg(F.bool_or(F.col("outcome") == "succeeded").alias("_up"))
    return per.groupBy(by).agg(F.count(F.lit(1)).alias("periods"), F.try_divide(F.count_if("_up").cast("double"), F.count(F.lit(1))).alias("availability"))


def watermark_lag(watermarks: DataFrame, by: str, as_of: Column) -> DataFrame:
    """How far the newest watermark of each source is behind."""
    return watermarks.groupBy(by).agg((as_of - F.max("watermark")).alias("lag"))


def latency(queries: DataFrame, by: str, took: str) -> DataFrame:
    """Median, 95th and 99th percentile of query times."""
    p = lambda q: F.expr(f"percentile_cont({q}) WITHIN GROUP (ORDER BY {took})")
    return queries.groupBy(by).agg(F.count(F.lit(1)).alias("queries"), p(0.5).alias("p50"), p(0.95).alias("p95"), p(0.99).alias("p99"))


def quarantined(batches: DataFrame, by: str) -> DataFrame:
    return batches.groupBy(by).agg(F.count(F.lit(1)).alias("batches"), F.count_if(F.col("state") == "pending").alias("pending"), F.count_if(F.col("state") == "discarded").alias("discarded"))


def unmapped_share(rows: DataFrame, column: str, by: str) -> DataFrame:
    bad = F.count_if(F.col(column) == "unmapped")
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.try_divide(bad.cast("double"), F.count(F.lit(1))).alias("share"))


def variance_rate(outcomes: DataFrame) -> DataFrame:
    """Share of reconciled groups that did not match."""
    bad = F.count_if(F.col("outcome") != "matched")
    return outcomes.agg(F.count(F.lit(1)).alias("groups"), F.try_divide(bad.cast("double"), F.count(F.lit(1))).alias("rate"))


def replication_lag(log: DataFrame, by: str) -> DataFrame:
    """By source and day: how far replicas were behind their primary, on average and at most. log: by, day, written_at and
    applied_at; what has not been applied yet counts up to the newest that has."""
    newest = log.groupBy(by).agg(F.max("applied_at").alias("_newest"))
    lag = F.greatest(F.lit(0), F.coalesce("applied_at", "_newest") - F.col("written_at"))
    joined = log.join(newest, by).withColumn("_lag", lag)
    return joined.groupBy(by, "day").agg(F.count(F.lit(1)).alias("writes"), F.avg("_lag").alias("mean"), F.max("_lag").alias("most"))


def utilisation(samples: DataFrame, by: list[str]) -> DataFrame:
    """Used of what there is, by component, resource and day: on average over the samples and at their peak. A
    component without capacity has no ratio."""
    share = F.try_divide(F.col("used").cast("double"), F.col("capacity"))
    total = F.try_divide(F.sum(F.when(F.col("capacity") > 0, F.col("used"))).cast("double"), F.sum(F.when(F.col("capacity") > 0, F.col("capacity"))))
    return samples.groupBy(*by).agg(F.count(F.lit(1)).alias("samples"), total.alias("ratio"), F.max(share).alias("peak"))


def accesses(audit: DataFrame, by: list[str]) -> DataFrame:
    """Queries and exports, and the users behind them, of what the audit log has."""
    return audit.groupBy(*by).agg(F.count_if(F.col("action") == "query").alias("queries"), F.count_if(F.col("action") == "export").alias("exports"), F.count_distinct("user").alias("users"))


def workload(calls: DataFrame, incidents: DataFrame, by: list[str]) -> DataFrame:
    """Calls answered and incidents taken in by a person and period. calls, incidents: `by`, a row each."""
    a = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"))
    b = incidents.groupBy(*by).agg(F.count(F.lit(1)).alias("incidents"))
    both = a.join(b, by, "full_outer").fillna(0, ["calls", "incidents"])
    return both.withColumn("handled", F.col("calls") + F.col("incidents"))


def state_times(changes: DataFrame, agent: str, at: str, state: str) -> DataFrame:
    """Seconds in each state: from a change to the agent's next one. A state that is still open counts nothing."""
    until = F.lead(at).over(Window.partitionBy(agent).orderBy(at, "seq"))
    return changes.withColumn("_s", until - F.col(at)).groupBy(state).agg(F.sum("_s").alias("seconds"), F.count("_s").alias("changes"))
