"""Incident and resource metrics over the document tree: an order is an incident, (order, supplier) a
dispatch, a deduplicated line a turnout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incidents as ops
from .adapter import BASE, legs, table
from .registry import query

_DAY = 86400


def _second(name: str):
    return F.unix_timestamp(F.col(name).cast("timestamp"))


def _incidents(spark, sf):
    last = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    o = table(spark, sf, "orders")
    return o.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("incident"), (F.col("o_custkey") % 10).alias("site"), _second("o_orderdate").alias("reported_at"), F.when(F.col("o_orderstatus") != "P", _second("closed")).alias("closed_at"))


def _dispatches(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("l_orderkey").alias("incident"), F.col("l_suppkey").alias("agency")).agg(F.min(_second("o_orderdate") + F.col("l_linenumber") * 600).alias("dispatched_at"), F.bool_or(F.col("l_linenumber") == 1).alias("is_initial"))


def _turnouts(spark, sf):
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return j.groupBy(F.col("l_orderkey").alias("incident"), F.col("l_suppkey").alias("agency"), F.col("l_linenumber").alias("officer")).agg(F.max(_second("l_shipdate")).alias("arrived_at"))


_TREE = """WITH incidents AS (SELECT o_orderkey AS incident, o_custkey % 10 AS site, epoch(o_orderdate)::BIGINT AS reported_at, CASE WHEN o_orderstatus <> 'P' THEN epoch(closed)::BIGINT END AS closed_at FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
dispatches AS (SELECT l_orderkey AS incident, l_suppkey AS agency, min(epoch(o_orderdate)::BIGINT + l_linenumber * 600) AS dispatched_at, bool_or(l_linenumber = 1) AS is_initial FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
turnouts AS (SELECT l_orderkey AS incident, l_suppkey AS agency, l_linenumber AS officer, max(epoch(l_shipdate)::BIGINT) AS arrived_at FROM lineitem GROUP BY 1, 2, 3),
arrivals AS (SELECT incident, agency, arrived_at - dispatched_at AS s, arrived_at, dispatched_at FROM turnouts JOIN dispatches USING (incident, agency) WHERE arrived_at >= dispatched_at)"""


@query("metric_i05_i20_i21_arrivals", f"""{_TREE}, d AS (SELECT incident, agency, min(s) AS f, min(arrived_at) AS a, min(dispatched_at) AS o FROM arrivals GROUP BY 1, 2), i AS (SELECT incident, min(a) - min(o) AS f FROM d GROUP BY 1)
  SELECT (SELECT count(*) FROM arrivals) AS turnouts, (SELECT count(*) FROM d) AS dispatches, (SELECT count(*) FROM i) AS incidents, (SELECT sum(s)::DOUBLE / count(*) FROM arrivals) AS turnout_mean, (SELECT sum(f)::DOUBLE / count(*) FROM d) AS dispatch_mean, (SELECT sum(f)::DOUBLE / count(*) FROM i) AS incident_mean""")
def _(spark, sf):
    return ops.arrival_times(_dispatches(spark, sf), _turnouts(spark, sf))


@query("metric_i06_i22_i23_handling", f"{_TREE} SELECT site, count(*) AS n, avg(closed_at - reported_at) AS mean, median(closed_at - reported_at) AS median, quantile_cont(closed_at - reported_at, 0.9) AS p90 FROM incidents WHERE closed_at >= reported_at GROUP BY 1")
def _(spark, sf):
    return ops.handling_times(_incidents(spark, sf), "site")


@query("metric_i01_i02_dispatch_ratio", f"{_TREE} SELECT site, count(*) AS incidents, count(h) AS dispatched, count(h)::DOUBLE / count(*) AS ratio FROM incidents LEFT JOIN (SELECT DISTINCT incident, true AS h FROM dispatches) USING (incident) GROUP BY 1")
def _(spark, sf):
    return ops.dispatch_ratio(_incidents(spark, sf), _dispatches(spark, sf), "site")


@query("metric_i04_initial_dispatch", f"{_TREE} SELECT site, count(*) AS orders, sum(dispatched_at - reported_at)::DOUBLE / count(*) AS mean FROM incidents JOIN dispatches USING (incident) WHERE is_initial GROUP BY 1")
def _(spark, sf):
    return ops.initial_dispatch_time(_incidents(spark, sf), _dispatches(spark, sf), "site")


@query("metric_i10_late_dispatches", f"{_TREE} SELECT d.agency, count(*) AS dispatches, count(*) FILTER (WHERE a IS NULL OR a - dispatched_at > 2592000) AS late FROM dispatches d LEFT JOIN (SELECT incident, agency, min(arrived_at) AS a FROM turnouts GROUP BY 1, 2) USING (incident, agency) GROUP BY 1")
def _(spark, sf):
    return ops.late(_dispatches(spark, sf), _turnouts(spark, sf), 30 * _DAY, "agency")


@query("metric_i24_i25_closed", f"{_TREE} SELECT DATE '1970-01-01' + (closed_at // 86400)::INTEGER AS closed_day, count(*) AS closed, count(*) FILTER (WHERE reported_at // 86400 < closed_at // 86400) AS retrospective FROM incidents WHERE closed_at IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return ops.closed_by_day(_incidents(spark, sf))


@query("metric_r01_r02_on_duty", "SELECT day, count(DISTINCT agent_no) AS agents, sum(signout - signin)::BIGINT AS seconds FROM (SELECT user_id AS agent_no, ts::DATE AS day, floor(epoch(ts))::BIGINT AS signin, floor(epoch(ts))::BIGINT + 60 * (event_id % 90) AS signout FROM events WHERE event_type = 'signup') GROUP BY 1")
def _(spark, sf):
    at = _second("ts")
    s = table(spark, sf, "events").filter("event_type = 'signup'").select(F.col("user_id").alias("agent_no"), F.to_date("ts").alias("day"), at.alias("signin"), (at + 60 * (F.col("event_id") % 90)).alias("signout"))
    return ops.on_duty(s, "day")


@query("metric_r04_occupancy", f"{BASE} SELECT device_no AS agent_no, (coalesce(sum(talk_seconds), 0) + sum(wait_seconds))::DOUBLE / nullif(count(*) * 600, 0) AS occupancy FROM legs WHERE device_type_code = 2 GROUP BY 1")
def _(spark, sf):
    days = legs(spark, sf).filter("device_type_code = 2").select(F.col("device_no").alias("agent_no"), F.coalesce("talk_seconds", F.lit(0)).alias("talk_seconds"), F.col("wait_seconds").alias("acw_seconds"), F.lit(600).alias("signin_seconds"))
    return ops.occupancy(days, "agent_no")


@query("metric_r08_r09_open_turnouts", f"{_TREE} SELECT agency, count(*) AS open, 915148800 - min(dispatched_at) AS longest FROM turnouts JOIN dispatches USING (incident, agency) WHERE dispatched_at <= 915148800 AND arrived_at > 915148800 GROUP BY 1")
def _(spark, sf):
    t = _turnouts(spark, sf).join(_dispatches(spark, sf), ["incident", "agency"]).withColumnRenamed("dispatched_at", "ordered_at")
    return ops.open_turnouts(t, 915148800, "agency")


_UTM = """WITH places AS (SELECT radians(21.4 + (o_orderkey % 30) / 1000) AS phi, radians(39.8 + (o_custkey % 40) / 1000 - 39.0) AS lam FROM orders),
f AS (SELECT 1 / 298.257223563 AS f), e AS (SELECT f * (2 - f) AS e2, f * (2 - f) / (1 - f * (2 - f)) AS ep2 FROM f),
t AS (SELECT phi, e2, ep2, 6378137.0 / sqrt(1 - e2 * sin(phi) ** 2) AS n, tan(phi) ** 2 AS t, ep2 * cos(phi) ** 2 AS c, lam * cos(phi) AS a,
  6378137.0 * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * phi)
    + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * phi) - (35 * e2 ** 3 / 3072) * sin(6 * phi)) AS m FROM places, e),
g AS (SELECT floor((500000 + 0.9996 * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a ** 5 / 120)) / 500)::BIGINT AS x,
  floor(0.9996 * (m + n * tan(phi) * (a ** 2 / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a ** 6 / 720)) / 500)::BIGINT AS y FROM t)
SELECT x, y, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 5"""


@query("metric_i13_hotspots", _UTM)
def _(spark, sf):
    places = table(spark, sf, "orders").select((39.8 + (F.col("o_custkey") % 40) / 1000).alias("longitude"), (21.4 + (F.col("o_orderkey") % 30) / 1000).alias("latitude"))
    return ops.hotspots(places)
