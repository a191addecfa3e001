"""Day marts: additive columns by day and one or two dimensions. Ratios are formed when they are asked for."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.calls import AGENT

WITHIN_SECONDS = 20
REPEAT_THRESHOLD = 2
UNLINKED = "unlinked"


def volume(calls: DataFrame) -> DataFrame:
    """Calls by day: counts of inbound calls by result, of transfers and of calls in progress."""
    inbound = F.col("direction") == "inbound"
    done = inbound & F.col("is_complete")
    result = lambda r: F.count_if(done & (F.col("call_result") == r))
    return calls.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(done).alias("offered"),
        result("answered").alias("answered"),
        result("abandoned").alias("abandoned"),
        result("unanswered_system").alias("unanswered_system"),
        result("ivr_only").alias("ivr_only"),
        F.count_if(done & F.col("is_transferred")).alias("transferred"),
        F.count_if(~F.col("is_complete")).alias("in_progress"),
    )


def queue_service(calls: DataFrame, within: int = WITHIN_SECONDS) -> DataFrame:
    """Complete inbound calls that reached a queue, by day and first queue. Waits are those of all queue legs."""
    queued = calls.filter((F.col("direction") == "inbound") & F.col("is_complete") & F.col("first_queue").isNotNull())
    answered = F.col("call_result") == "answered"
    return queued.groupBy("date_key", F.coalesce(F.col("first_queue").cast("string"), F.lit(UNLINKED)).alias("queue")).agg(
        F.count(F.lit(1)).alias("queued"),
        F.count_if(answered).alias("answered"),
        F.count_if(answered & (F.col("wait_seconds") <= within)).alias("answered_within"),
        F.count_if(F.col("call_result") == "abandoned").alias("abandoned"),
        F.coalesce(F.sum("wait_seconds"), F.lit(0)).alias("wait_seconds"),
    )


def agent_handling(legs: DataFrame, agents: DataFrame | None = None) -> DataFrame:
    """Agent legs by the leg's own day and agent; agents that the dimension (agent_no) lacks are `unlinked`."""
    own = legs.filter(F.col("device_type_code") == AGENT)
    agent = F.col("device_no")
    if agents is not None:
        known = agents.select(F.col("agent_no").alias("_known")).distinct()
        own = own.join(known, own.device_no == known["_known"], "left")
        agent = F.col("_known")
    return own.groupBy("date_key", F.coalesce(agent.cast("string"), F.lit(UNLINKED)).alias("agent")).agg(
        F.count(F.lit(1)).alias("presented"),
        F.count_if(F.col("call_begin").isNotNull()).alias("answered"),
        F.count_if(F.col("call_begin").isNull()).alias("missed"),
        F.coalesce(F.sum("talk_seconds"), F.lit(0)).alias("talk_seconds"),
    )


def release(calls: DataFrame) -> DataFrame:
    """Complete inbound calls by day and who released them, with the day's total repeated on each row."""
    done = calls.filter((F.col("direction") == "inbound") & F.col("is_complete"))
    counted = done.groupBy("date_key", F.coalesce("released_by", F.lit("unmapped")).alias("released_by")).agg(F.count(F.lit(1)).alias("calls"))
    return counted.withColumn("day_calls", F.sum("calls").over(Window.partitionBy("date_key")))


def repeat_failed(calls: DataFrame, threshold: int = REPEAT_THRESHOLD) -> DataFrame:
    """Callers with at least `threshold` failed complete inbound calls on a day; days without any have 0."""
    done = calls.filter((F.col("direction") == "inbound") & F.col("is_complete"))
    failed = done.filter(F.col("call_result").isin("abandoned", "unanswered_system"))
    repeated = failed.groupBy("date_key", "caller_number").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= threshold)
    by_day = repeated.groupBy("date_key").agg(F.count(F.lit(1)).alias("callers"), F.sum("n").alias("failed_calls"))
    days = calls.select("date_key").distinct()
    return days.join(by_day, "date_key", "left").select("date_key", F.coalesce("callers", F.lit(0)).alias("callers"), F.coalesce("failed_calls", F.lit(0)).alias("failed_calls"))


@dataclass(frozen=True)
class Mart:
    """How a mart may be read."""

    name: str
    dimensions: tuple[str, ...]
    measures: tuple[str, ...]
    roles: frozenset[str] = frozenset({"admin", "supervisor", "analyst"})
    row_filter: str = "none"
    required: tuple[str, ...] = ()
    attributes: dict[str, str] = field(default_factory=dict)
    sensitive: tuple[str, ...] = ()


MARTS = {
    m.name: m
    for m in (
        Mart("calls_day_volume", (), ("calls", "offered", "answered", "abandoned", "unanswered_system", "ivr_only", "transferred", "in_progress")),
        Mart("calls_day_queue_service", ("queue",), ("queued", "answered", "answered_within", "abandoned", "wait_seconds")),
        Mart("legs_day_agent_handling", ("agent",), ("presented", "answered", "missed", "talk_seconds"), frozenset({"admin", "supervisor", "agent"}), "self", (), {}, ("agent",)),
        Mart("calls_day_release", ("released_by",), ("calls", "day_calls")),
        Mart("calls_day_repeat_failed", (), ("callers", "failed_calls")),
    )
}


def build(name: str, calls: DataFrame, legs: DataFrame) -> DataFrame:
    return {
        "calls_day_volume": lambda: volume(calls),
        "calls_day_queue_service": lambda: queue_service(calls),
        "legs_day_agent_handling": lambda: agent_handling(legs),
        "calls_day_release": lambda: release(calls),
        "calls_day_repeat_failed": lambda: repeat_failed(calls),
    }[name]()
