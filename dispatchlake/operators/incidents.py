"""Incidents, their dispatches and turnouts: times and counts along the document tree.

incidents: incident, site, reported_at, closed_at; dispatches: incident, agency, dispatched_at, is_initial;
turnouts: incident, agency, officer, arrived_at. Times are seconds. Three arrival metrics are three
definitions: by turnout, the first of each dispatch, the first of each incident.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(n: Column, d: Column) -> Column:
    return F.try_divide(F.sum(n).cast("double"), F.count(d))


def arrival_times(dispatches: DataFrame, turnouts: DataFrame) -> DataFrame:
    """turnout_mean, dispatch_mean and incident_mean, in seconds, and how many of each there are."""
    joined = turnouts.join(dispatches, ["incident", "agency"]).withColumn("s", F.col("arrived_at") - F.col("dispatched_at")).filter("s >= 0")
    per_dispatch = joined.groupBy("incident", "agency").agg(F.sum("s").alias("s"), F.count("s").alias("n"), F.min("s").alias("first"), F.min("arrived_at").alias("arrived_at"), F.min("dispatched_at").alias("dispatched_at"))
    per_incident = per_dispatch.groupBy("incident").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("first").alias("first"), F.count(F.lit(1)).alias("dispatches"), (F.min("arrived_at") - F.min("dispatched_at")).alias("incident_first"))
    return per_incident.agg(
        F.sum("n").alias("turnouts"), F.sum("dispatches").alias("dispatches"), F.count(F.lit(1)).alias("incidents"),
        F.try_divide(F.sum("s").cast("double"), F.sum("n")).alias("turnout_mean"), F.try_divide(F.sum("first").cast("double"), F.sum("dispatches")).alias("dispatch_mean"), _mean(F.col("incident_first"), F.col("incident_first")).alias("incident_mean"),
    )


def handling_times(incidents: DataFrame, by: str) -> DataFrame:
    """Mean, median and 90th percentile of closing less reporting time, by a column."""
    done = incidents.filter("closed_at >= reported_at").withColumn("s", F.col("closed_at") - F.col("reported_at"))
    return done.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("mean"), F.median("s").alias("median"), F.expr("percentile_cont(0.9) WITHIN GROUP (ORDER BY s)").alias("p90"))


def dispatch_ratio(incidents: DataFrame, dispatches: DataFrame, by: str) -> DataFrame:
    """Incidents, those with a dispatch, and their ratio."""
    had = dispatches.select("incident", F.lit(True).alias("_had")).distinct()
    joined = incidents.join(had, "incident", "left")
    return joined.groupBy(by).agg(F.count(F.lit(1)).alias("incidents"), F.count("_had").alias("dispatched"), F.try_divide(F.count("_had").cast("double"), F.count(F.lit(1))).alias("ratio"))


def initial_dispatch_time(incidents: DataFrame, dispatches: DataFrame, by: str) -> DataFrame:
    """Mean time from the report to the initial orders only."""
    joined = incidents.join(dispatches.filter("is_initial"), "incident").withColumn("s", F.col("dispatched_at") - F.col("reported_at"))
    return joined.groupBy(by).agg(F.count(F.lit(1)).alias("orders"), _mean(F.col("s"), F.col("s")).alias("mean"))


def late(dispatches: DataFrame, turnouts: DataFrame, limit: int, by: str) -> DataFrame:
    """Dispatches whose first arrival came after `limit` seconds, or never."""
    first = turnouts.groupBy("incident", "agency").agg(F.min("arrived_at").alias("arrived_at"))
    joined = dispatches.join(first, ["incident", "agency"], "left")
    is_late = F.col("arrived_at").isNull() | (F.col("arrived_at") - F.col("dispatched_at") > limit)
    return joined.groupBy(by).agg(F.count(F.lit(1)).alias("dispatches"), F.count_if(is_late).alias("late"))


def closed_by_day(incidents: DataFrame) -> DataFrame:
    """By the day of closing: incidents closed, and how many of them were reported on an earlier day."""
    day = F.floor(F.col("closed_at") / 86400)
    return incidents.filter("closed_at is not null").groupBy(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).alias("closed_day")).agg(F.count(F.lit(1)).alias("closed"), F.count_if(F.floor(F.col("reported_at") / 86400) < day).alias("retrospective"))


def on_duty(sessions: DataFrame, by: str) -> DataFrame:
    """Agents with a session and their signed-in seconds, by a column."""
    return sessions.groupBy(by).agg(F.count_distinct("agent_no").alias("agents"), F.sum(F.col("signout") - F.col("signin")).alias("seconds"))


def occupancy(days: DataFrame, by: str) -> DataFrame:
    """(talk + after-call work) / signed-in time."""
    return days.groupBy(by).agg(F.try_divide((F.sum("talk_seconds") + F.sum("acw_seconds")).cast("double"), F.sum("signin_seconds")).alias("occupancy"))


def open_turnouts(turnouts: DataFrame, as_of: int, by: str) -> DataFrame:
    """Turnouts that have not arrived by `as_of`, and how long the oldest has been open."""
    waiting = turnouts.filter((F.col("ordered_at") <= as_of) & (F.col("arrived_at").isNull() | (F.col("arrived_at") > as_of)))
    return waiting.groupBy(by).agg(F.count(F.lit(1)).alias("open"), (F.lit(as_of) - F.min("ordered_at")).alias("longest"))


#: WGS 84 and UTM.
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996


def utm(longitude: Column, latitude: Column, central: float = 39.0) -> tuple[Column, Column]:
    """Easting and northing (northern hemisphere), the transverse Mercator series to the sixth order."""
    e2 = _F * (2 - _F)
    ep2 = e2 / (1 - e2)
    phi = F.radians(latitude)
    n = _A / F.sqrt(1 - e2 * F.pow(F.sin(phi), F.lit(2)))
    t, c = F.pow(F.tan(phi), F.lit(2)), ep2 * F.pow(F.cos(phi), F.lit(2))
    a = F.radians(longitude - central) * F.cos(phi)
    m = _A * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - (35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    p = lambda k: F.pow(a, F.lit(k))
    east = 500000 + _K0 * n * (a + (1 - t + c) * p(3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * p(5) / 120)
    north = _K0 * (m + n * F.tan(phi) * (p(2) / 2 + (5 - t + 9 * c + 4 * c * c) * p(4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * p(6) / 720))
    return east, north


def hotspots(incidents: DataFrame, cell: int = 500, least: int = 5) -> DataFrame:
    """Incidents by grid cell of `cell` metres; cells with fewer than `least` are not shown."""
    east, north = utm(F.col("longitude"), F.col("latitude"))
    gridded = incidents.groupBy(F.floor(east / cell).alias("x"), F.floor(north / cell).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return gridded.filter(F.col("n") >= least)
