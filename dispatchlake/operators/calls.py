"""Calls derived from their legs alone: every column can be recomputed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUEUE, AGENT, IVR = 1, 2, 3
LAST = -1
AFTER_ALL = 2147483647


def leg_order() -> Column:
    """A call's last leg has the sequence -1."""
    return F.when(F.col("leg_seq") == LAST, AFTER_ALL).otherwise(F.col("leg_seq"))


def call_result(complete: Column, answered: Column, reached: Column, released_by: Column) -> Column:
    return (
        F.when(~complete, F.lit(None))
        .when(answered >= 1, "answered")
        .when((reached > 0) & (released_by == "caller"), "abandoned")
        .when(reached > 0, "unanswered_system")
        .otherwise("ivr_only")
    )


def from_legs(legs: DataFrame, key: str = "call_id") -> DataFrame:
    """One row for each call, in one aggregation: first and earliest legs are min_by over structs."""
    queue, agent = F.col("device_type_code") == QUEUE, F.col("device_type_code") == AGENT
    answered = agent & F.col("call_begin").isNotNull()
    last = F.col("leg_seq") == LAST
    place = F.struct(leg_order(), F.col("leg_seq"))
    first_leg = lambda c: F.min_by(c, place)
    by_answer = F.when(answered, F.struct(F.col("call_begin"), leg_order()))
    by_queue = F.when(queue, F.struct(F.col("wait_begin"), leg_order()))
    summed = legs.groupBy(key).agg(
        first_leg("date_key").alias("date_key"),
        first_leg("direction").alias("direction"),
        first_leg("caller").alias("caller_number"),
        first_leg("wait_begin").alias("offered_at"),
        first_leg("leg_seq").alias("first_leg_seq"),
        F.min_by("device_no", by_queue).alias("first_queue"),
        F.min_by("device_no", by_answer).alias("agent_no"),
        F.min(F.when(answered, F.col("call_begin"))).alias("answered_at"),
        F.max(F.when(last, F.coalesce("call_end", "wait_end"))).alias("_ended_at"),
        F.coalesce(F.sum(F.when(queue, F.col("wait_seconds"))), F.lit(0)).alias("wait_seconds"),
        F.coalesce(F.sum(F.when(agent, F.col("talk_seconds"))), F.lit(0)).alias("talk_seconds"),
        F.count(F.lit(1)).alias("leg_count"),
        F.count_if(queue).alias("queue_legs"),
        F.count_if(agent).alias("agent_legs"),
        F.count_if(answered).alias("answered_legs"),
        F.max(F.when(last, F.col("release_source"))).alias("released_by"),
        F.bool_or(last).alias("is_complete"),
    )
    result = call_result(F.col("is_complete"), F.col("answered_legs"), F.col("queue_legs") + F.col("agent_legs"), F.col("released_by"))
    return summed.withColumns({"call_result": result, "is_transferred": F.col("answered_legs") >= 2, "ended_at": F.when(F.col("is_complete"), F.col("_ended_at"))}).drop("_ended_at")


def disagreeing(legs: DataFrame, column: str, key: str = "call_id") -> DataFrame:
    """Calls whose legs disagree on a column that a call has one of."""
    return legs.groupBy(key).agg(F.count_distinct(column).alias("n_values"), F.count(F.lit(1)).alias("n_legs")).filter("n_values > 1")


#: What `recomputed` derives a second time.
RECOMPUTED = ("date_key", "direction", "caller_number", "offered_at", "first_leg_seq", "first_queue", "agent_no", "answered_at", "ended_at", "wait_seconds", "talk_seconds", "leg_count", "queue_legs", "agent_legs", "answered_legs", "released_by", "is_complete", "is_transferred", "call_result")


def recomputed(legs: DataFrame, key: str = "call_id") -> DataFrame:
    """Every derived column by another way (ranks instead of aggregates of structs), to be compared with from_legs."""
    queue, agent = F.col("device_type_code") == QUEUE, F.col("device_type_code") == AGENT
    answered, last = agent & F.col("call_begin").isNotNull(), F.col("leg_seq") == LAST
    rank = lambda cond, *by: F.row_number().over(Window.partitionBy(key, cond).orderBy(*by))
    ranked = legs.withColumns(
        {
            "_first": F.row_number().over(Window.partitionBy(key).orderBy(leg_order())),
            "_queue": rank(queue, F.asc_nulls_last("wait_begin"), leg_order()),
            "_answer": rank(answered, F.asc_nulls_last("call_begin"), leg_order()),
        }
    )
    one = lambda c, cond: F.max(F.when(cond, F.col(c)))
    first = F.col("_first") == 1
    total = lambda c, cond: F.sum(F.when(cond, F.coalesce(c, F.lit(0))).otherwise(0))
    number = lambda cond: F.sum(cond.cast("long"))
    told = ranked.groupBy(key).agg(
        *(one(c, first).alias(name) for c, name in (("date_key", "date_key"), ("direction", "direction"), ("caller", "caller_number"), ("wait_begin", "offered_at"), ("leg_seq", "first_leg_seq"))),
        one("device_no", queue & (F.col("_queue") == 1)).alias("first_queue"),
        one("device_no", answered & (F.col("_answer") == 1)).alias("agent_no"),
        one("call_begin", answered & (F.col("_answer") == 1)).alias("answered_at"),
        F.max(F.when(last, F.coalesce("call_end", "wait_end"))).alias("ended_at"),
        total("wait_seconds", queue).alias("wait_seconds"),
        total("talk_seconds", agent).alias("talk_seconds"),
        F.max("_first").cast("long").alias("leg_count"),
        *(number(cond).alias(name) for cond, name in ((queue, "queue_legs"), (agent, "agent_legs"), (answered, "answered_legs"))),
        one("release_source", last).alias("released_by"),
        (number(last) > 0).alias("is_complete"),
    )
    reached, open_ = F.col("queue_legs") + F.col("agent_legs") > 0, ~F.col("is_complete")
    results = F.array_compact(F.array(F.when(F.col("answered_legs") > 0, "answered"), F.when(reached & (F.col("released_by") == "caller"), "abandoned"), F.when(reached, "unanswered_system"), F.lit("ivr_only")))
    return told.withColumns({"is_transferred": F.col("answered_legs") > 1, "call_result": F.when(~open_, F.get(results, F.lit(0)))})
