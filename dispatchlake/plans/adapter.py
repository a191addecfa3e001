"""The domain's tables as projections of the driver's tables (orders are calls, lines are legs).

The same formulas stand in SQL (BASE), so that every operator has an independent second derivation.
Keys repeat on purpose: a repeated line is a re-observation of its leg.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import calls, incremental

LEG = ["call_id", "line"]
LEG_CONTENT = ["leg_seq", "device_type_code", "device_no", "wait_begin", "wait_seconds", "talk_seconds", "direction", "release_source", "caller"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observed_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation of every leg."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    line, cents = F.col("l_linenumber"), F.round(F.col("l_extendedprice") * 100).cast("long")
    last = (line == F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))) & (F.col("o_orderstatus") != "P")
    device = F.when(line == 1, calls.IVR).when(line % 2 == 0, calls.QUEUE).otherwise(calls.AGENT)
    answered = (device == calls.AGENT) & (F.col("l_returnflag") != "R")
    begin = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + (F.col("l_orderkey") * 7919) % 86400 + line * 60
    wait, talk = F.col("l_quantity").cast("long"), F.when(answered, cents % 600)
    priority = F.col("o_orderpriority")
    direction = F.when(priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "inbound").when(priority == "4-NOT SPECIFIED", "outbound").otherwise("unmapped")
    released = F.element_at(F.array(*map(F.lit, ("agent", "caller", "system", "unmapped"))), (F.col("o_custkey") % 4 + 1).cast("int"))
    instant = F.timestamp_seconds
    rows = joined.select(
        F.col("l_orderkey").alias("call_id"),
        line.alias("line"),
        F.col("l_shipdate").alias("observed_at"),
        F.md5(F.concat_ws("|", "l_partkey", "l_suppkey", cents)).alias("content_hash"),
        F.when(last, calls.LAST).otherwise(line).cast("int").alias("leg_seq"),
        device.alias("device_type_code"),
        F.when(device == calls.QUEUE, F.col("l_partkey") % 5).when(device == calls.AGENT, F.col("l_suppkey")).otherwise(0).cast("long").alias("device_no"),
        instant(begin).alias("wait_begin"),
        instant(begin + wait).alias("wait_end"),
        F.when(answered, instant(begin + wait)).alias("call_begin"),
        F.when(answered, instant(begin + wait + talk)).alias("call_end"),
        wait.alias("wait_seconds"),
        talk.alias("talk_seconds"),
        direction.alias("direction"),
        F.when(last, released).alias("release_source"),
        (F.col("o_custkey") % 10).alias("caller"),
        F.col("o_orderdate").alias("ordered_at"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("long").alias("batch_seq"),
    )
    return rows.withColumn("date_key", keys.date_key(F.col("wait_begin")))


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest observation of each leg."""
    return incremental.newest(observed_legs(spark, sf_dir), LEG, "observed_at", "content_hash")


def all_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.from_legs(legs(spark, sf_dir))


#: DuckDB's derivation of obs, legs and calls; instants are seconds since 1970.
BASE = """
WITH obs AS (
  SELECT *, strftime(DATE '1970-01-01' + ((wait_begin + 10800) // 86400)::INTEGER, '%Y%m%d')::INTEGER AS date_key,
    wait_begin + wait_seconds AS wait_end, CASE WHEN answered THEN wait_begin + wait_seconds END AS call_begin,
    CASE WHEN answered THEN wait_begin + wait_seconds + talk_seconds END AS call_end
  FROM (
    SELECT *, device_type_code = 2 AND returnflag <> 'R' AS answered, CASE WHEN device_type_code = 2 AND returnflag <> 'R' THEN cents % 600 END AS talk_seconds,
      CASE device_type_code WHEN 1 THEN partkey % 5 WHEN 2 THEN suppkey ELSE 0 END AS device_no,
      CASE WHEN leg_seq = -1 THEN ['agent', 'caller', 'system', 'unmapped'][custkey % 4 + 1] END AS release_source
    FROM (
      SELECT l_orderkey AS call_id, l_linenumber AS line, l_shipdate AS observed_at, l_partkey AS partkey, l_suppkey AS suppkey, o_custkey AS custkey, l_returnflag AS returnflag,
        round(l_extendedprice * 100)::BIGINT AS cents,
        md5(l_partkey::VARCHAR || '|' || l_suppkey::VARCHAR || '|' || round(l_extendedprice * 100)::BIGINT::VARCHAR) AS content_hash,
        CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) AND o_orderstatus <> 'P' THEN -1 ELSE l_linenumber END AS leg_seq,
        CASE WHEN l_linenumber = 1 THEN 3 WHEN l_linenumber % 2 = 0 THEN 1 ELSE 2 END AS device_type_code,
        epoch(o_orderdate)::BIGINT + (l_orderkey * 7919) % 86400 + l_linenumber * 60 AS wait_begin, l_quantity::BIGINT AS wait_seconds,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'inbound' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'outbound' ELSE 'unmapped' END AS direction,
        o_custkey % 10 AS caller, o_orderdate AS ordered_at, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS batch_seq
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    )
  )
),
legs AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY call_id, line ORDER BY observed_at DESC, content_hash) = 1),
ordered AS (SELECT *, CASE WHEN leg_seq = -1 THEN 2147483647 ELSE leg_seq END AS place FROM legs),
summed AS (
  SELECT call_id, arg_min(date_key, place) AS date_key, arg_min(direction, place) AS direction, arg_min(caller, place) AS caller_number, arg_min(wait_begin, place) AS offered_at,
    arg_min(leg_seq, place) AS first_leg_seq,
    arg_min(device_no, wait_begin * 10 + least(place, 9)) FILTER (WHERE device_type_code = 1) AS first_queue,
    arg_min(device_no, call_begin * 10 + least(place, 9)) FILTER (WHERE call_begin IS NOT NULL) AS agent_no,
    min(call_begin) AS answered_at, max(coalesce(call_end, wait_end)) FILTER (WHERE leg_seq = -1) AS last_end,
    coalesce(sum(wait_seconds) FILTER (WHERE device_type_code = 1), 0)::BIGINT AS wait_seconds,
    coalesce(sum(talk_seconds) FILTER (WHERE device_type_code = 2), 0)::BIGINT AS talk_seconds, count(*) AS leg_count,
    count(*) FILTER (WHERE device_type_code = 1) AS queue_legs, count(*) FILTER (WHERE device_type_code = 2) AS agent_legs, count(call_begin) AS answered_legs,
    max(release_source) FILTER (WHERE leg_seq = -1) AS released_by, bool_or(leg_seq = -1) AS is_complete
  FROM ordered GROUP BY call_id
),
calls AS (
  SELECT *, CASE WHEN NOT is_complete THEN NULL WHEN answered_legs >= 1 THEN 'answered' WHEN queue_legs + agent_legs > 0 AND released_by = 'caller' THEN 'abandoned'
    WHEN queue_legs + agent_legs > 0 THEN 'unanswered_system' ELSE 'ivr_only' END AS call_result,
    answered_legs >= 2 AS is_transferred, CASE WHEN is_complete THEN last_end END AS ended_at
  FROM summed
)
"""
