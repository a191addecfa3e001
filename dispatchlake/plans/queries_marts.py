"""Calls, marts and the metrics formed from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls as call_ops
from . import marts
from .adapter import BASE, all_calls, legs
from .registry import query

_CALL = "call_id, date_key, direction, caller_number, first_queue, agent_no, call_result, wait_seconds, talk_seconds, leg_count, agent_legs, answered_legs, released_by, is_transferred, is_complete, first_leg_seq"
_CALL_COLUMNS = _CALL.split(", ")


def seconds(name: str):
    return F.unix_timestamp(name).alias(name)


@query("call_01_calls_from_legs", f"{BASE} SELECT {_CALL}, offered_at, answered_at, ended_at FROM calls")
def _(spark, sf):
    return all_calls(spark, sf).select(*_CALL_COLUMNS, seconds("offered_at"), seconds("answered_at"), seconds("ended_at"))


@query("call_02_results", f"{BASE} SELECT coalesce(call_result, 'in_progress') AS call_result, direction, count(*) AS calls FROM calls GROUP BY ALL")
def _(spark, sf):
    return all_calls(spark, sf).groupBy(F.coalesce("call_result", F.lit("in_progress")).alias("call_result"), "direction").agg(F.count(F.lit(1)).alias("calls"))


@query("call_03_waits_and_transfers", f"{BASE} SELECT is_transferred, is_complete, count(*) AS calls, sum(wait_seconds)::BIGINT AS wait, sum(talk_seconds)::BIGINT AS talk, count(ended_at) AS ended FROM calls GROUP BY ALL")
def _(spark, sf):
    return all_calls(spark, sf).groupBy("is_transferred", "is_complete").agg(F.count(F.lit(1)).alias("calls"), F.sum("wait_seconds").alias("wait"), F.sum("talk_seconds").alias("talk"), F.count("ended_at").alias("ended"))


@query("call_04_disagreeing_legs", f"{BASE} SELECT call_id, count(DISTINCT device_no) AS n_values, count(*) AS n_legs FROM legs GROUP BY 1 HAVING count(DISTINCT device_no) > 1")
def _(spark, sf):
    return call_ops.disagreeing(legs(spark, sf), "device_no")


_VOLUME = """SELECT date_key, count(*) AS calls, count(*) FILTER (WHERE direction = 'inbound' AND is_complete) AS offered,
  count(*) FILTER (WHERE direction = 'inbound' AND call_result = 'answered') AS answered, count(*) FILTER (WHERE direction = 'inbound' AND call_result = 'abandoned') AS abandoned,
  count(*) FILTER (WHERE direction = 'inbound' AND call_result = 'unanswered_system') AS unanswered_system, count(*) FILTER (WHERE direction = 'inbound' AND call_result = 'ivr_only') AS ivr_only,
  count(*) FILTER (WHERE direction = 'inbound' AND is_complete AND is_transferred) AS transferred, count(*) FILTER (WHERE NOT is_complete) AS in_progress FROM calls GROUP BY 1"""


@query("mrt_01_calls_volume", f"{BASE} {_VOLUME}")
def _(spark, sf):
    return marts.volume(all_calls(spark, sf))


_QUEUE = """SELECT date_key, first_queue::VARCHAR AS queue, count(*) AS queued, count(*) FILTER (WHERE call_result = 'answered') AS answered,
  count(*) FILTER (WHERE call_result = 'answered' AND wait_seconds <= 20) AS answered_within, count(*) FILTER (WHERE call_result = 'abandoned') AS abandoned, sum(wait_seconds)::BIGINT AS wait_seconds
  FROM calls WHERE direction = 'inbound' AND is_complete AND first_queue IS NOT NULL GROUP BY ALL"""


@query("mrt_02_queue_service", f"{BASE} {_QUEUE}")
def _(spark, sf):
    return marts.queue_service(all_calls(spark, sf))


_AGENT = """SELECT date_key, device_no::VARCHAR AS agent, count(*) AS presented, count(call_begin) AS answered, count(*) - count(call_begin) AS missed,
  coalesce(sum(talk_seconds), 0)::BIGINT AS talk_seconds FROM legs WHERE device_type_code = 2 GROUP BY ALL"""


@query("mrt_03_agent_handling", f"{BASE} {_AGENT}")
def _(spark, sf):
    return marts.agent_handling(legs(spark, sf))


_RELEASE = "SELECT date_key, coalesce(released_by, 'unmapped') AS released_by, count(*) AS calls, (sum(count(*)) OVER (PARTITION BY date_key))::BIGINT AS day_calls FROM calls WHERE direction = 'inbound' AND is_complete GROUP BY 1, 2"


@query("mrt_04_release", f"{BASE} {_RELEASE}")
@query("wn_06_window_over_aggregate", f"{BASE} {_RELEASE}")
def _(spark, sf):
    return marts.release(all_calls(spark, sf))


_REPEAT = """, repeated AS (SELECT date_key, caller_number, count(*) AS n FROM calls WHERE direction = 'inbound' AND call_result IN ('abandoned', 'unanswered_system') GROUP BY ALL HAVING count(*) >= 2)
SELECT d.date_key, count(n) AS callers, coalesce(sum(n), 0)::BIGINT AS failed_calls FROM (SELECT DISTINCT date_key FROM calls) d LEFT JOIN repeated r USING (date_key) GROUP BY 1"""


@query("mrt_05_repeat_failed", f"{BASE} {_REPEAT}")
@query("ag_09_two_level_zero_filled", f"{BASE} {_REPEAT}")
def _(spark, sf):
    return marts.repeat_failed(all_calls(spark, sf))


@query("metric_answer_rate_daily", f"{BASE}, v AS ({_VOLUME}) SELECT date_key, offered, answered, CASE WHEN offered > 0 THEN answered::DOUBLE / offered END AS answer_rate FROM v")
def _(spark, sf):
    return marts.volume(all_calls(spark, sf)).select("date_key", "offered", "answered", F.try_divide(F.col("answered").cast("double"), F.col("offered")).alias("answer_rate"))


def _ratio(name: str, mart: str, sql: str, numerator: str | None, denominator: str | None, by: str | None = None):
    """A metric over a mart: a sum, or a ratio of sums (NULL where the denominator is 0)."""
    group = f"date_key // 10000 AS year{', ' + by if by else ''}"
    value = f"sum({numerator})::DOUBLE / nullif(sum({denominator}), 0)" if denominator else f"sum({numerator})::BIGINT"

    @query(name, f"{BASE}, m AS ({sql}) SELECT {group}, {value} AS value FROM m GROUP BY ALL")
    def _(spark, sf):
        m = marts.build(mart, all_calls(spark, sf), legs(spark, sf))
        total = F.sum(numerator)
        out = F.try_divide(total.cast("double"), F.sum(denominator)) if denominator else total
        return m.groupBy(F.floor(F.col("date_key") / 10000).cast("int").alias("year"), *([by] if by else [])).agg(out.alias("value"))


_V, _Q, _A = "calls_day_volume", "calls_day_queue_service", "legs_day_agent_handling"
_ratio("metric_c01_offered", _V, _VOLUME, "offered", None)
_ratio("metric_c02_answered", _V, _VOLUME, "answered", None)
_ratio("metric_c03_abandoned", _V, _VOLUME, "abandoned", None)
_ratio("metric_c04_answer_rate", _V, _VOLUME, "answered", "offered")
_ratio("metric_c05_service_level", _Q, _QUEUE, "answered_within", "queued", "queue")
_ratio("metric_c06_average_wait", _Q, _QUEUE, "wait_seconds", "queued", "queue")
_ratio("metric_c07_average_talk", _A, _AGENT, "talk_seconds", "answered", "agent")
_ratio("metric_c09_presented", _A, _AGENT, "presented", None, "agent")
_ratio("metric_c10_handled", _A, _AGENT, "answered", None, "agent")
_ratio("metric_c11_release_share", "calls_day_release", _RELEASE, "calls", "day_calls", "released_by")
_ratio("metric_c12_missed", _A, _AGENT, "missed", None, "agent")
_ratio("metric_c13_transferred", _V, _VOLUME, "transferred", None)


@query("metric_c15_repeat_failed", f"{BASE} {_REPEAT.replace('SELECT d.date_key, count(n) AS callers, coalesce(sum(n), 0)::BIGINT AS failed_calls', 'SELECT d.date_key // 10000 AS year, count(n) AS value')}".replace("GROUP BY 1", "GROUP BY ALL"))
def _(spark, sf):
    m = marts.repeat_failed(all_calls(spark, sf))
    return m.groupBy(F.floor(F.col("date_key") / 10000).cast("int").alias("year")).agg(F.sum("callers").alias("value"))
