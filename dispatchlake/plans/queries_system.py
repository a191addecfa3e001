"""Platform metrics over events as a run log, and the remaining incident and resource metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import system
from .adapter import BASE, all_calls, legs, table
from .queries_incidents import _TREE, _dispatches, _incidents, _turnouts
from .registry import query

_RUNS = """WITH runs AS (SELECT event_id AS run_id, user_id % 10 AS source, floor(epoch(ts))::BIGINT AS started, ts::DATE AS day, ts::DATE AS period, value,
  CASE WHEN event_id % 5 = 0 OR event_id % 7 = 1 THEN 'failed' WHEN event_id % 11 = 0 THEN 'quarantined' ELSE 'succeeded' END AS outcome FROM events)"""


def _runs(spark, sf):
    outcome = F.when((F.col("event_id") % 5 == 0) | (F.col("event_id") % 7 == 1), "failed").when(F.col("event_id") % 11 == 0, "quarantined").otherwise("succeeded")
    day = F.to_date("ts")
    return table(spark, sf, "events").select(F.col("event_id").alias("run_id"), (F.col("user_id") % 10).alias("source"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("started"), day.alias("day"), day.alias("period"), "value", outcome.alias("outcome"))


@query("metric_s07_success_rate", f"{_RUNS} SELECT source, count(*) AS runs, count(*) FILTER (WHERE outcome <> 'failed') AS succeeded, count(*) FILTER (WHERE outcome <> 'failed')::DOUBLE / count(*) AS rate FROM runs GROUP BY 1")
def _(spark, sf):
    return system.success_rate(_runs(spark, sf), "source")


@query("metric_s02_s03_repair_times", f"""{_RUNS}, t AS (SELECT *, outcome = 'failed' AS f, coalesce(lag(outcome = 'failed') OVER (PARTITION BY source ORDER BY started, run_id), false) AS b FROM runs),
  u AS (SELECT *, lead(started) OVER (PARTITION BY source ORDER BY started, run_id) AS n1, lead(started, 2) OVER (PARTITION BY source ORDER BY started, run_id) AS n2 FROM t WHERE f <> b)
  SELECT source, count(*) AS outages, avg(n1 - started) AS mttr, avg(n2 - started) AS mtbf FROM u WHERE f GROUP BY 1""")
def _(spark, sf):
    return system.repair_times(_runs(spark, sf), "source", "started")


@query("metric_s01_availability", f"{_RUNS} SELECT source, count(*) AS periods, count(*) FILTER (WHERE up)::DOUBLE / count(*) AS availability FROM (SELECT source, period, bool_or(outcome = 'succeeded') AS up FROM runs GROUP BY 1, 2) GROUP BY 1")
def _(spark, sf):
    return system.availability(_runs(spark, sf), "source")


@query("metric_s06_watermark_lag", f"{_RUNS} SELECT source, 1800000000 - max(started) AS lag FROM runs WHERE outcome = 'succeeded' GROUP BY 1")
def _(spark, sf):
    marks = _runs(spark, sf).filter("outcome = 'succeeded'").select("source", F.col("started").alias("watermark"))
    return system.watermark_lag(marks, "source", F.lit(1_800_000_000))


@query("metric_s05_query_latency", f"{_RUNS} SELECT source, count(*) AS queries, quantile_cont(took, 0.5) AS p50, quantile_cont(took, 0.95) AS p95, quantile_cont(took, 0.99) AS p99 FROM (SELECT source, run_id % 977 AS took FROM runs) GROUP BY 1")
def _(spark, sf):
    return system.latency(_runs(spark, sf).withColumn("took", F.col("run_id") % 977), "source", "took")


@query("metric_s08_quarantined", f"{_RUNS} SELECT source, count(*) AS batches, count(*) FILTER (WHERE outcome = 'quarantined') AS pending, count(*) FILTER (WHERE outcome = 'failed') AS discarded FROM runs GROUP BY 1")
def _(spark, sf):
    state = F.when(F.col("outcome") == "quarantined", "pending").when(F.col("outcome") == "failed", "discarded").otherwise("released")
    return system.quarantined(_runs(spark, sf).withColumn("state", state), "source")


@query("metric_s09_unmapped_share", f"{BASE} SELECT date_key // 10000 AS year, count(*) AS rows, count(*) FILTER (WHERE direction = 'unmapped')::DOUBLE / count(*) AS share FROM calls GROUP BY 1")
def _(spark, sf):
    return system.unmapped_share(all_calls(spark, sf).withColumn("year", F.floor(F.col("date_key") / 10000).cast("int")), "direction", "year")


@query("metric_s10_variance_rate", "SELECT count(*) AS groups, count(*) FILTER (WHERE d)::DOUBLE / count(*) AS rate FROM (SELECT o_custkey, bool_or(o_orderkey % 50 = 0) AS d FROM orders GROUP BY 1)")
def _(spark, sf):
    groups = table(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderkey") % 50 == 0).alias("d"))
    return system.variance_rate(groups.select(F.when(F.col("d"), "differs").otherwise("matched").alias("outcome")))


@query("metric_r03_state_times", "SELECT event_type AS state, sum(n - s)::BIGINT AS seconds, count(n) AS changes FROM (SELECT event_type, floor(epoch(ts))::BIGINT AS s, lead(floor(epoch(ts))::BIGINT) OVER (PARTITION BY user_id ORDER BY floor(epoch(ts))::BIGINT, event_id) AS n FROM events) GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), F.col("event_type").alias("state"), F.col("event_id").alias("seq"))
    return system.state_times(e, "user_id", "at", "state")


@query("metric_r05_officer_turnouts", "SELECT l_linenumber AS officer, count(*) AS turnouts FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber FROM lineitem) GROUP BY 1")
def _(spark, sf):
    return _turnouts(spark, sf).groupBy("officer").agg(F.count(F.lit(1)).alias("turnouts"))


@query("metric_i07_response_time", f"{_TREE} SELECT site, count(*) AS turnouts, avg(arrived_at - reported_at) AS mean FROM turnouts JOIN incidents USING (incident) WHERE arrived_at >= reported_at GROUP BY 1")
def _(spark, sf):
    joined = _turnouts(spark, sf).join(_incidents(spark, sf), "incident").filter("arrived_at >= reported_at")
    return joined.groupBy("site").agg(F.count(F.lit(1)).alias("turnouts"), F.avg(F.col("arrived_at") - F.col("reported_at")).alias("mean"))


@query("metric_i03_i08_intake_and_end_to_end", f"{BASE}, first AS (SELECT call_id, offered_at FROM calls) SELECT o_custkey % 10 AS site, count(*) AS incidents, avg(offered_at - epoch(o_orderdate)::BIGINT) AS intake, avg(closed - offered_at) FILTER (WHERE closed >= offered_at) AS end_to_end FROM orders JOIN first ON call_id = o_orderkey JOIN (SELECT l_orderkey, epoch(max(l_shipdate))::BIGINT AS closed FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, sf):
    # only the first call of an incident counts; here an incident has one
    first = all_calls(spark, sf).select(F.col("call_id").alias("incident"), F.unix_timestamp("offered_at").alias("offered_at"))
    last = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("incident")).agg(F.unix_timestamp(F.max("l_shipdate").cast("timestamp")).alias("closed"))
    joined = _incidents(spark, sf).drop("closed_at").join(first, "incident").join(last, "incident")
    ended = F.when(F.col("closed") >= F.col("offered_at"), F.col("closed") - F.col("offered_at"))
    return joined.groupBy("site").agg(F.count(F.lit(1)).alias("incidents"), F.avg(F.col("offered_at") - F.col("reported_at")).alias("intake"), F.avg(ended).alias("end_to_end"))


@query("metric_i11_i12_cancelled_and_media", "SELECT o_custkey % 10 AS site, count(*) FILTER (WHERE o_orderstatus = 'F') AS cancelled, sum(o_orderkey % 4)::BIGINT AS media FROM orders GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy((F.col("o_custkey") % 10).alias("site")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("cancelled"), F.sum(F.col("o_orderkey") % 4).alias("media"))


@query("metric_r06_unit_availability", f"{_TREE} SELECT agency, count(*) AS days, count(*) FILTER (WHERE NOT busy)::DOUBLE / count(*) AS availability FROM (SELECT agency, dispatched_at // 86400 AS day, bool_or(is_initial) AS busy FROM dispatches GROUP BY 1, 2) GROUP BY 1")
def _(spark, sf):
    days = _dispatches(spark, sf).groupBy("agency", F.floor(F.col("dispatched_at") / 86400).alias("day")).agg(F.bool_or("is_initial").alias("busy"))
    return days.groupBy("agency").agg(F.count(F.lit(1)).alias("days"), F.try_divide(F.count_if(~F.col("busy")).cast("double"), F.count(F.lit(1))).alias("availability"))


@query("metric_s04_replication_lag", """WITH log AS (SELECT user_id % 10 AS source, ts::DATE AS day, floor(epoch(ts))::BIGINT AS w, CASE WHEN event_id % 9 <> 0 THEN floor(epoch(ts))::BIGINT + event_id % 61 END AS a FROM events),
  m AS (SELECT source, max(a) AS newest FROM log GROUP BY 1) SELECT source, day, count(*) AS writes, avg(greatest(0, coalesce(a, newest) - w)) AS mean, max(greatest(0, coalesce(a, newest) - w)) AS most FROM log JOIN m USING (source) GROUP BY 1, 2""")
def _(spark, sf):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    log = table(spark, sf, "events").select((F.col("user_id") % 10).alias("source"), F.to_date("ts").alias("day"), at.alias("written_at"), F.when(F.col("event_id") % 9 != 0, at + F.col("event_id") % 61).alias("applied_at"))
    return system.replication_lag(log, "source")


@query("metric_s11_utilisation", """SELECT l_shipdate::DATE AS day, l_linenumber AS component, l_returnflag AS resource, count(*) AS samples,
  sum(l_quantity::BIGINT) FILTER (WHERE l_orderkey % 17 <> 0)::DOUBLE / sum(CASE WHEN l_orderkey % 17 <> 0 THEN 64 END) AS ratio, max(CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity::BIGINT / 64.0 END)::DOUBLE AS peak FROM lineitem GROUP BY 1, 2, 3""")
def _(spark, sf):
    capacity = F.when(F.col("l_orderkey") % 17 != 0, 64).otherwise(0)
    samples = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("component"), F.col("l_returnflag").alias("resource"), F.col("l_quantity").cast("long").alias("used"), capacity.alias("capacity"))
    return system.utilisation(samples, ["day", "component", "resource"])


@query("metric_s12_queries_and_exports", """SELECT ts::DATE AS day, event_type AS object, count(*) FILTER (WHERE event_id % 8 <> 0) AS queries, count(*) FILTER (WHERE event_id % 8 = 0) AS exports, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def _(spark, sf):
    audit = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("object"), F.col("user_id").alias("user"), F.when(F.col("event_id") % 8 == 0, "export").otherwise("query").alias("action"))
    return system.accesses(audit, ["day", "object"])


@query("metric_p01_workload", f"""{BASE}, a AS (SELECT device_no AS agent, date_key // 100 AS month, count(*) AS calls FROM legs WHERE device_type_code = 2 AND call_begin IS NOT NULL GROUP BY 1, 2),
  b AS (SELECT o_custkey AS agent, strftime(o_orderdate, '%Y%m')::INTEGER AS month, count(*) AS incidents FROM orders GROUP BY 1, 2)
  SELECT agent, month, coalesce(calls, 0) AS calls, coalesce(incidents, 0) AS incidents, coalesce(calls, 0) + coalesce(incidents, 0) AS handled FROM a FULL JOIN b USING (agent, month)""")
def _(spark, sf):
    answered = legs(spark, sf).filter("device_type_code = 2 and call_begin is not null").select(F.col("device_no").alias("agent"), F.floor(F.col("date_key") / 100).cast("int").alias("month"))
    taken = table(spark, sf, "orders").select(F.col("o_custkey").alias("agent"), F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month"))
    return system.workload(answered, taken, ["agent", "month"])
