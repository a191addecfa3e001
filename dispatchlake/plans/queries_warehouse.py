"""Incremental loading, dimensions with versions, batches, publication, requests, reconciliation and tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import periods
from ..operators import calls as call_ops
from ..operators import incremental, quality, recon, scd2
from ..streaming import windows
from . import marts, publication, semantic
from .adapter import BASE, LEG, LEG_CONTENT, all_calls, legs, observed_legs, table
from .registry import query

# --- batches: events by day; a day is a batch ------------------------------------------------------

_EVENTS = """WITH raw AS (SELECT event_id, user_id, event_type, value, floor(epoch(ts))::BIGINT AS tm, date_diff('day', (SELECT min(ts)::DATE FROM events), ts::DATE) AS batch_seq FROM events),
batches AS (SELECT batch_seq, count(*) AS n FROM raw GROUP BY 1),
quarantine AS (SELECT batch_seq, CASE WHEN batch_seq % 7 = 0 THEN 'discarded' WHEN batch_seq % 5 = 0 THEN 'pending' ELSE 'released' END AS state FROM batches WHERE batch_seq % 5 = 0 OR batch_seq % 7 = 0 OR batch_seq % 3 = 0),
registry AS (SELECT batch_seq FROM batches WHERE batch_seq < 10),
held AS (SELECT batch_seq FROM quarantine WHERE state IN ('pending', 'discarded'))"""


def _raw(spark, sf):
    e = table(spark, sf, "events")
    first = e.agg(F.min(F.to_date("ts")).alias("first_day"))
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return e.crossJoin(F.broadcast(first)).select(F.lit("r1").alias("run_id"), F.datediff(F.to_date("ts"), "first_day").cast("long").alias("batch_seq"), "event_id", "user_id", "event_type", "value", at.alias("at"))


def _batches(spark, sf):
    return _raw(spark, sf).groupBy("run_id", "batch_seq").agg(F.count(F.lit(1)).alias("n"))


def _quarantine_events(spark, sf):
    """pending first, then the decision, then a second one that no longer counts."""
    b = _batches(spark, sf).filter("batch_seq % 5 = 0 or batch_seq % 7 = 0 or batch_seq % 3 = 0")
    decided = F.when(F.col("batch_seq") % 7 == 0, "discarded").when(F.col("batch_seq") % 5 == 0, "pending").otherwise("released")
    steps = F.array(F.struct(F.lit(1).alias("event_seq"), F.lit("pending").alias("state")), F.struct(F.lit(2).alias("event_seq"), decided.alias("state")), F.struct(F.lit(3).alias("event_seq"), F.when(decided == "pending", "pending").otherwise("released").alias("state")))
    return b.select("run_id", "batch_seq", F.inline(steps))


def _quarantine(spark, sf):
    return incremental.latest_state(_quarantine_events(spark, sf))


def _registry(spark, sf):
    return incremental.registrations(_batches(spark, sf).filter("batch_seq < 10"), "stg_events")


@query("inc_01_processable_batches", f"{_EVENTS} SELECT batch_seq, n FROM batches WHERE batch_seq NOT IN (SELECT * FROM held) AND batch_seq NOT IN (SELECT * FROM registry)")
def _(spark, sf):
    return incremental.processable(_batches(spark, sf), _quarantine(spark, sf), _registry(spark, sf), "stg_events").select("batch_seq", "n")


@query("inc_02_register_batches", f"{_EVENTS} SELECT 'stg_events' AS model, 'r1' AS run_id, batch_seq FROM batches")
@query("inc_03_register_core_batches", f"{_EVENTS} SELECT 'stg_events' AS model, 'r1' AS run_id, batch_seq FROM batches")
def _(spark, sf):
    open_ = incremental.processable(_batches(spark, sf), _quarantine(spark, sf).filter("false"), _registry(spark, sf), "stg_events")
    return _registry(spark, sf).unionByName(incremental.registrations(open_, "stg_events"))


@query("inc_03_core_batches_with_empty", f"{_EVENTS} SELECT 'core_events' AS model, 'r1' AS run_id, batch_seq FROM batches WHERE batch_seq >= 5 AND (batch_seq < 10 OR batch_seq NOT IN (SELECT * FROM held))")
def _(spark, sf):
    """Every fourth batch wrote no row; the core model has the first five."""
    ingested = _batches(spark, sf).withColumn("rows_written", F.when(F.col("batch_seq") % 4 == 1, 0).otherwise(F.col("n")))
    open_ = incremental.processable(_batches(spark, sf), _quarantine(spark, sf), _registry(spark, sf), "stg_events")
    staged = _registry(spark, sf).unionByName(incremental.registrations(open_, "stg_events"))
    core = incremental.registrations(_batches(spark, sf).filter("batch_seq < 5"), "core_events")
    rows = incremental.scan_batches(_raw(spark, sf).filter("batch_seq % 4 <> 1"), staged)
    return incremental.core_registrations(rows, ingested, staged.unionByName(core), "stg_events", "core_events")


@query("inc_04_forget_model", f"{_EVENTS} SELECT 'core_events' AS model, batch_seq FROM registry WHERE batch_seq < 5")
def _(spark, sf):
    both = _registry(spark, sf).unionByName(incremental.registrations(_batches(spark, sf).filter("batch_seq < 5"), "core_events"))
    return incremental.forget(both, "stg_events").select("model", "batch_seq")


@query("str_00_quarantine_state", f"{_EVENTS} SELECT batch_seq, state FROM quarantine")
def _(spark, sf):
    return _quarantine(spark, sf).select("batch_seq", "state")


@query("inc_05_raw_dedup", f"{BASE} SELECT call_id, line, content_hash, count(*) AS n FROM obs o WHERE batch_seq % 2 = 1 AND NOT EXISTS (SELECT 1 FROM obs r WHERE r.call_id = o.call_id AND r.line = o.line AND r.content_hash = o.content_hash AND r.batch_seq % 2 = 0 AND r.batch_seq % 10 <> 0) GROUP BY ALL")
def _(spark, sf):
    rows = observed_legs(spark, sf).withColumn("run_id", F.lit("r1"))
    raw = rows.filter("batch_seq % 2 = 0")
    held = raw.filter("batch_seq % 10 = 0").select("run_id", "batch_seq").distinct().withColumn("state", F.lit("pending"))
    return incremental.new_rows(rows.filter("abs(batch_seq % 2) = 1 and batch_seq % 2 = 1"), raw, held, LEG).groupBy(*LEG, "content_hash").agg(F.count(F.lit(1)).alias("n"))


@query("inc_06_changed_since_last", f"{_EVENTS}, last AS (SELECT user_id, event_type FROM raw WHERE batch_seq < 15 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY tm DESC, event_type) = 1) SELECT r.event_id FROM raw r LEFT JOIN last l USING (user_id) WHERE r.batch_seq >= 15 AND r.event_type IS DISTINCT FROM l.event_type")
def _(spark, sf):
    raw = _raw(spark, sf).withColumn("content_hash", F.col("event_type"))
    return incremental.changed_since_last(raw.filter("batch_seq >= 15"), raw.filter("batch_seq < 15"), ["user_id"], "at").select("event_id")


_CONTENT_DIFFERS = " OR ".join(f"c.{c} IS DISTINCT FROM s.{c}" for c in LEG_CONTENT)
_UPSERT = f"""{BASE}, stored AS (SELECT * FROM obs WHERE batch_seq % 3 = 0 QUALIFY row_number() OVER (PARTITION BY call_id, line ORDER BY observed_at DESC, content_hash) = 1),
cand AS (SELECT * FROM obs WHERE batch_seq % 3 = 1 QUALIFY row_number() OVER (PARTITION BY call_id, line ORDER BY observed_at DESC, content_hash) = 1),
written AS (SELECT c.* FROM cand c LEFT JOIN stored s USING (call_id, line) WHERE s.call_id IS NULL OR (({_CONTENT_DIFFERS}) AND c.observed_at >= s.observed_at))"""


def _two_loads(spark, sf):
    rows = observed_legs(spark, sf)
    return (incremental.newest(rows.filter(f"batch_seq % 3 = {i}"), LEG, "observed_at", "content_hash") for i in (0, 1))


@query("inc_07_upsert_newest", f"{_UPSERT} SELECT call_id, line, content_hash FROM written")
@query("inc_12_upsert_keys", f"{_UPSERT} SELECT call_id, line, content_hash FROM written")
def _(spark, sf):
    stored, candidates = _two_loads(spark, sf)
    return incremental.upserts(candidates, stored, LEG, LEG_CONTENT, "observed_at").select(*LEG, "content_hash")


def _upsert_sql(key):
    """Upsert of observed events by agent and `key`: a text of the sign-in hour, or a day."""
    one = lambda i: f"SELECT * FROM seen WHERE event_id % 3 = {i} AND NOT EXISTS (SELECT 1 FROM seen o WHERE o.agent_no = seen.agent_no AND o.k = seen.k AND o.event_id % 3 = {i} AND (o.ts > seen.ts OR (o.ts = seen.ts AND o.content_hash < seen.content_hash)))"
    return f"WITH seen AS (SELECT user_id AS agent_no, {key} AS k, ts, event_id, event_type, md5(event_id::VARCHAR) AS content_hash FROM events), stored AS ({one(0)}), cand AS ({one(1)}) SELECT c.agent_no, c.k, c.content_hash FROM cand c LEFT JOIN stored s USING (agent_no, k) WHERE s.agent_no IS NULL OR (c.event_type IS DISTINCT FROM s.event_type AND c.ts >= s.ts)"


def _agent_upserts(spark, sf, key, name):
    rows = table(spark, sf, "events").select(F.col("user_id").alias("agent_no"), key.alias(name), "ts", "event_id", "event_type", F.md5(F.col("event_id").cast("string")).alias("content_hash"))
    stored, candidates = (incremental.newest(rows.filter(f"event_id % 3 = {i}"), ["agent_no", name], "ts", "content_hash") for i in (0, 1))
    return incremental.upserts(candidates, stored, ["agent_no", name], ["event_type"], "ts").select("agent_no", name, "content_hash")


@query("inc_12_upsert_sessions", f"SELECT agent_no, k AS in_time, content_hash FROM ({_upsert_sql("strftime(ts, '%Y-%m-%d %H')")})")
def _(spark, sf):
    return _agent_upserts(spark, sf, F.date_format("ts", "yyyy-MM-dd HH"), "in_time")


@query("inc_12_upsert_days", f"SELECT agent_no, k AS date_key, content_hash FROM ({_upsert_sql("strftime(ts, '%Y%m%d')::INTEGER")})")
def _(spark, sf):
    return _agent_upserts(spark, sf, F.date_format("ts", "yyyyMMdd").cast("int"), "date_key")


@query("src_10_after_upsert", f"{_UPSERT} SELECT date_key // 100 AS month, count(*) AS n FROM (SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM written w WHERE w.call_id = s.call_id AND w.line = s.line) UNION ALL SELECT * FROM written) GROUP BY 1")
def _(spark, sf):
    stored, candidates = _two_loads(spark, sf)
    written = incremental.upserts(candidates, stored, LEG, LEG_CONTENT, "observed_at")
    after = incremental.merged(stored, written, LEG)
    return after.groupBy(F.floor(F.col("date_key") / 100).cast("int").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("inc_08_placeable", f"{BASE} SELECT count(*) AS n FROM obs WHERE call_begin IS NOT NULL AND release_source IS NOT NULL")
def _(spark, sf):
    return incremental.placeable(observed_legs(spark, sf), ["call_begin", "release_source"]).agg(F.count(F.lit(1)).alias("n"))


@query("inc_10_calls_to_rebuild", "SELECT DISTINCT l_orderkey AS call_id FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-05-31 00:00:00'")
def _(spark, sf):
    return incremental.to_rebuild(observed_legs(spark, sf), "call_id", "observed_at", F.lit("2001-06-01").cast("timestamp_ntz"))


@query("inc_11_changed_calls", f"{BASE}, old AS (SELECT call_id, CASE WHEN call_id % 4 = 0 THEN 'ivr_only' ELSE call_result END AS call_result FROM calls WHERE call_id % 5 <> 0) SELECT c.call_id FROM calls c LEFT JOIN old o USING (call_id) WHERE c.call_id % 5 = 0 OR o.call_result IS DISTINCT FROM c.call_result")
def _(spark, sf):
    new = all_calls(spark, sf)
    old = new.filter("call_id % 5 <> 0").withColumn("call_result", F.when(F.col("call_id") % 4 == 0, "ivr_only").otherwise(F.col("call_result")))
    return incremental.changed_rows(new, old, ["call_id"], ["call_result"]).select("call_id")


@query("inc_13_clarifications", "SELECT 'crm' AS source_id, 'priority' AS column_name, o_orderpriority AS value, count(*) AS occurrences, 'open' AS status FROM orders WHERE o_orderpriority NOT IN ('1-URGENT') GROUP BY 3")
def _(spark, sf):
    raised = table(spark, sf, "orders").select(F.lit("crm").alias("source_id"), F.lit("priority").alias("column_name"), F.col("o_orderpriority").alias("value"))
    queue = spark.createDataFrame([("crm", "priority", "1-URGENT", "asked"), ("crm", "priority", "5-LOW", "closed")], "source_id string, column_name string, value string, status string")
    return incremental.clarifications(raised, queue)


# --- dimensions: suppliers in three snapshots ------------------------------------------------------

_TIMES = ("2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00")


def _snapshots(spark, sf):
    one = lambda v, t: table(spark, sf, "supplier").filter(f"s_suppkey % 7 <> {v}").select(F.col("s_suppkey").alias("agent_no"), F.lit(t).cast("timestamp").alias("snapshot_at"), F.concat("s_name", F.when(F.col("s_suppkey") % 5 == v, f"*{v}").otherwise("")).alias("name"))
    out = one(1, _TIMES[0])
    for v in (2, 3):
        out = out.unionByName(one(v, _TIMES[v - 1]))
    return out


def _changes(spark, sf):
    stamp = lambda t: F.lit(t).cast("timestamp")
    times = spark.range(3).select(F.element_at(F.array(*map(stamp, _TIMES)), (F.col("id") + 1).cast("int")).alias("snapshot_at"))
    marks = table(spark, sf, "supplier").filter("s_suppkey % 11 = 0").select(F.col("s_suppkey").alias("agent_no"), stamp("2026-01-01 12:00:00").alias("starts_at"), stamp("2026-01-02 12:00:00").alias("ends_at"), F.lit("lead").alias("role"), F.lit("chief").alias("author"))
    current = spark.createDataFrame([], "agent_no long, name string, role string, valid_from timestamp, valid_to timestamp")
    return scd2.timeline(_snapshots(spark, sf), times, marks, current, "agent_no", ["name"], stamp("2026-02-01")), marks


_TIMELINE = """WITH points AS (
  SELECT s_suppkey AS agent_no, unnest([TIMESTAMP '2026-01-01', TIMESTAMP '2026-01-02', TIMESTAMP '2026-01-03']) AS tm FROM supplier
  UNION SELECT s_suppkey, unnest([TIMESTAMP '2026-01-01 12:00:00', TIMESTAMP '2026-01-02 12:00:00']) FROM supplier WHERE s_suppkey % 11 = 0),
stated AS (SELECT agent_no, tm, 1 + (tm >= TIMESTAMP '2026-01-02')::INTEGER + (tm >= TIMESTAMP '2026-01-03')::INTEGER AS v, s_name FROM points JOIN supplier ON s_suppkey = agent_no),
states AS (SELECT agent_no, tm, agent_no % 7 <> v AS present, CASE WHEN agent_no % 7 <> v THEN s_name || CASE WHEN agent_no % 5 = v THEN '*' || v::VARCHAR ELSE '' END END AS name,
  CASE WHEN agent_no % 7 <> v AND agent_no % 11 = 0 AND tm >= TIMESTAMP '2026-01-01 12:00:00' AND tm < TIMESTAMP '2026-01-02 12:00:00' THEN 'lead' END AS role FROM stated),
before AS (SELECT *, coalesce(lag(present) OVER w, false) AS p0, lag(name) OVER w AS n0, lag(role) OVER w AS r0 FROM states WINDOW w AS (PARTITION BY agent_no ORDER BY tm)),
changes AS (SELECT *, lead(tm) OVER (PARTITION BY agent_no ORDER BY tm) AS next_at FROM before WHERE present <> p0 OR name IS DISTINCT FROM n0 OR role IS DISTINCT FROM r0)"""


@query("scd_04_timeline", f"{_TIMELINE} SELECT agent_no, epoch(tm)::BIGINT AS changed_at, present, name, role, epoch(next_at)::BIGINT AS next_at FROM changes")
def _(spark, sf):
    return _changes(spark, sf)[0].select("agent_no", F.unix_timestamp("at").alias("changed_at"), "present", "name", "role", F.unix_timestamp("next_at").alias("next_at"))


_NEW_VERSIONS = f"{_TIMELINE}, versions AS (SELECT agent_no, name, role, CASE WHEN tm = TIMESTAMP '2026-01-01' THEN TIMESTAMP '1970-01-01' ELSE tm END AS valid_from, coalesce(next_at, TIMESTAMP '9999-12-31') AS valid_to FROM changes WHERE present)"


def _new_versions(spark, sf):
    return scd2.new_versions(_changes(spark, sf)[0], "agent_no", ["name"], F.lit(_TIMES[0]).cast("timestamp"))


@query("scd_05_sentinel_start", f"{_NEW_VERSIONS} SELECT epoch(valid_from)::BIGINT AS valid_from, count(*) AS n FROM versions GROUP BY 1")
def _(spark, sf):
    return _new_versions(spark, sf).groupBy(F.unix_timestamp("valid_from").alias("valid_from")).agg(F.count(F.lit(1)).alias("n"))


@query("scd_06_close_versions", f"{_TIMELINE}, ends AS (SELECT agent_no, min(tm) AS tm FROM changes WHERE tm > TIMESTAMP '2026-01-01' GROUP BY 1) SELECT s_suppkey AS agent_no, coalesce(epoch(tm), 253402214400)::BIGINT AS valid_to FROM supplier LEFT JOIN ends ON agent_no = s_suppkey")
def _(spark, sf):
    current = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("agent_no"), F.lit(scd2.OPEN).cast("timestamp").alias("valid_to"))
    later = _changes(spark, sf)[0].filter(F.col("at") > F.lit(_TIMES[0]).cast("timestamp"))
    return scd2.closed(current, later, "agent_no").select("agent_no", F.unix_timestamp("valid_to").alias("valid_to"))


@query("scd_07_change_log", f"""{_TIMELINE} SELECT agent_no, epoch(tm)::BIGINT AS changed_at, 'name' AS field, n0 AS "before", name AS "after", 'sync' AS author FROM changes WHERE name IS DISTINCT FROM n0
  UNION ALL SELECT agent_no, epoch(tm)::BIGINT, 'role', r0, role, CASE WHEN tm IN (TIMESTAMP '2026-01-01 12:00:00', TIMESTAMP '2026-01-02 12:00:00') THEN 'chief' ELSE 'sync' END FROM changes WHERE role IS DISTINCT FROM r0""")
def _(spark, sf):
    changes, marks = _changes(spark, sf)
    return scd2.change_log(changes, "agent_no", ["name", "role"], marks).withColumn("changed_at", F.unix_timestamp("at")).drop("at")


@query("scd_08_insert_versions", f"{_NEW_VERSIONS} SELECT agent_no, name, role, epoch(valid_from)::BIGINT AS valid_from, epoch(valid_to)::BIGINT AS valid_to FROM versions")
def _(spark, sf):
    return _new_versions(spark, sf).withColumns({"valid_from": F.unix_timestamp("valid_from"), "valid_to": F.unix_timestamp("valid_to")})


@query("scd_09_to_reconfirm", f"{_TIMELINE} SELECT agent_no, n0 AS was, name AS \"is\", 'pending_reconfirm' AS status FROM changes WHERE present AND p0 AND name IS DISTINCT FROM n0")
def _(spark, sf):
    return scd2.to_reconfirm(_changes(spark, sf)[0], "agent_no", "name")


@query("scd_01_site_scope", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (3, 7, 11)")
def _(spark, sf):
    return scd2.in_scope(table(spark, sf, "supplier"), F.col("s_nationkey").cast("string"), ["3", "7", "11"]).select("s_suppkey")


def _datasets(spark, sf):
    """Snapshot versions of 25 datasets (nations): version v comes in batch v; batch 4 is not usable."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("dataset"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("version"))
    snapshots = n.select("dataset", "version", F.lit("r1").alias("run_id"), F.col("version").alias("batch_seq"))
    usable = spark.range(1, 6).filter("id <> 4").select(F.lit("r1").alias("run_id"), F.col("id").cast("int").alias("batch_seq"))
    applied = n.filter(F.col("version") <= F.col("dataset") % 4).select("dataset", "version")
    return snapshots, applied, usable


_DATASETS = "WITH n AS (SELECT n_nationkey AS dataset, unnest([1, 2, 3, 4, 5]) AS version FROM nation), pending AS (SELECT * FROM n WHERE version <> 4 AND version > dataset % 4)"


@query("scd_02_pending_snapshots", f"{_DATASETS} SELECT dataset, version FROM pending")
def _(spark, sf):
    return scd2.pending_snapshots(*_datasets(spark, sf)).select("dataset", "version")


@query("scd_03_in_force", f"{_DATASETS} SELECT dataset, min(version) AS version, true AS is_pending FROM pending GROUP BY 1")
def _(spark, sf):
    snapshots, applied, usable = _datasets(spark, sf)
    return scd2.snapshot_in_force(scd2.pending_snapshots(snapshots, applied, usable), applied)


def _agent_legs(spark, sf):
    return legs(spark, sf).filter("device_type_code = 2").select(*LEG, "date_key", "wait_begin", F.col("device_no").alias("agent_no"))


_LINKS = "versions AS (SELECT s_suppkey AS agent_no, s_suppkey * 10 + v AS agent_sk, ['1970-01-01', '1998-01-01'][v]::TIMESTAMP AS valid_from, ['1998-01-01', '9999-12-31'][v]::TIMESTAMP AS valid_to FROM supplier, (SELECT unnest([1, 2]) AS v) WHERE s_suppkey % 9 <> 0)"


def _links(spark, sf):
    v = F.inline(F.array(*(F.struct(F.lit(i).alias("v"), F.lit(a).cast("timestamp").alias("valid_from"), F.lit(b).cast("timestamp").alias("valid_to")) for i, a, b in ((1, "1970-01-01", "1998-01-01"), (2, "1998-01-01", "9999-12-31")))))
    return table(spark, sf, "supplier").filter("s_suppkey % 9 <> 0").select(F.col("s_suppkey").alias("agent_no"), v).withColumn("agent_sk", F.col("agent_no") * 10 + F.col("v"))


_RELINK = f"{BASE}, {_LINKS} SELECT l.call_id, l.line, v.agent_sk FROM legs l LEFT JOIN versions v ON v.agent_no = l.device_no AND l.wait_begin >= epoch(valid_from) AND l.wait_begin < epoch(valid_to) WHERE device_type_code = 2 AND v.agent_sk IS DISTINCT FROM l.device_no * 10 + 1"


@query("scd_10_relink_touched", f"{_RELINK} AND l.device_no % 4 = 0")
def _(spark, sf):
    facts = _agent_legs(spark, sf).withColumn("stored_sk", F.col("agent_no") * 10 + 1)
    touched = table(spark, sf, "supplier").filter("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("agent_no"))
    return scd2.relinked(facts, _links(spark, sf), "agent_no", "wait_begin", "agent_sk", "stored_sk", touched).select(*LEG, "agent_sk")


@query("scd_11_relink_all", _RELINK)
@query("dq_10_leg_links", _RELINK)
@query("dq_03_agent_links", _RELINK)
def _(spark, sf):
    facts = _agent_legs(spark, sf).withColumn("stored_sk", F.col("agent_no") * 10 + 1)
    return scd2.relinked(facts, _links(spark, sf), "agent_no", "wait_begin", "agent_sk", "stored_sk").select(*LEG, "agent_sk")


@query("scd_12_unlinked_members", f"{BASE} SELECT device_no AS agent_no, count(*) AS n FROM legs WHERE device_type_code = 2 AND device_no % 9 = 0 GROUP BY 1")
@query("dq_13_legs_without_dimension", f"{BASE} SELECT device_no AS agent_no, count(*) AS n FROM legs WHERE device_type_code = 2 AND device_no % 9 = 0 GROUP BY 1")
def _(spark, sf):
    from ..operators.intervals import version_at

    linked = version_at(_agent_legs(spark, sf), _links(spark, sf), "agent_no", "wait_begin", ["agent_sk"])
    return scd2.unlinked(linked, _links(spark, sf), "agent_no", "agent_sk")


_QUEUES = "queues AS (SELECT q AS device_no, CASE WHEN q = 3 THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '9999-12-31' END AS valid_to FROM (SELECT unnest([1, 2, 3, 4]) AS q))"


@query("dq_13_unlinked_agent_and_queue_legs", f"""{BASE}, {_LINKS}, {_QUEUES} SELECT device_type_code, device_no, count(*) AS legs, min(wait_begin) AS first_leg, max(wait_begin) AS last_leg FROM legs l
  WHERE (device_type_code = 2 AND NOT EXISTS (SELECT 1 FROM versions v WHERE v.agent_no = l.device_no AND l.wait_begin >= epoch(valid_from) AND l.wait_begin < epoch(valid_to)))
     OR (device_type_code = 1 AND NOT EXISTS (SELECT 1 FROM queues q WHERE q.device_no = l.device_no AND l.wait_begin < epoch(valid_to))) GROUP BY 1, 2""")
def _(spark, sf):
    """Queue 0 has no version, that of queue 3 ends in 1998."""
    until = F.when(F.col("id") == 3, F.lit("1998-01-01")).otherwise(F.lit(scd2.OPEN)).cast("timestamp")
    queues = spark.range(1, 5).select(F.col("id").alias("device_no"), F.lit(scd2.SENTINEL).cast("timestamp").alias("valid_from"), until.alias("valid_to"))
    agents = _links(spark, sf).withColumnRenamed("agent_no", "device_no")
    found = quality.legs_without_dimension(legs(spark, sf), {call_ops.AGENT: agents, call_ops.QUEUE: queues})
    return found.withColumns({c: F.unix_timestamp(c) for c in ("first_leg", "last_leg")})


@query("scd_13_reference_codes", """WITH o AS (SELECT n_regionkey AS domain, n_nationkey AS code, n_name AS label, n_nationkey % 6 <> 0 AS was FROM nation WHERE n_nationkey % 4 <> 0), n AS (SELECT n_regionkey AS domain, n_nationkey AS code, n_name || CASE WHEN n_nationkey % 5 = 0 THEN '!' ELSE '' END AS label FROM nation WHERE n_nationkey % 3 <> 0 AND n_regionkey IN (0, 1, 2))
  SELECT domain, code, CASE WHEN domain < 3 THEN coalesce(n.label, o.label) ELSE o.label END AS label, CASE WHEN domain < 3 THEN n.label IS NOT NULL ELSE was END AS is_current,
  CASE WHEN domain >= 3 THEN 'untouched' WHEN was IS NULL THEN 'inserted' WHEN n.label IS NULL THEN CASE WHEN was THEN 'retired' ELSE 'untouched' END WHEN NOT was THEN 'returned' WHEN o.label <> n.label THEN 'relabelled' ELSE 'untouched' END AS action
  FROM o FULL JOIN n USING (domain, code)""")
def _(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_regionkey").alias("domain"), F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    old = n.filter("code % 4 <> 0").withColumn("is_current", F.col("code") % 6 != 0)
    new = n.filter("code % 3 <> 0 and domain in (0, 1, 2)").withColumn("label", F.concat("label", F.when(F.col("code") % 5 == 0, "!").otherwise("")))
    return scd2.reference_codes(old, new, [0, 1, 2])


# --- windows, watermarks and batch checks ----------------------------------------------------------


@query("str_02_watermark", f"{_EVENTS} SELECT max(tm)::BIGINT AS watermark FROM raw WHERE batch_seq NOT IN (SELECT * FROM held)")
def _(spark, sf):
    held = incremental.held(_quarantine(spark, sf))
    return _raw(spark, sf).join(held, ["run_id", "batch_seq"], "left_anti").agg(F.max("at").alias("watermark"))


@query("str_03_lookback_rows", f"{_EVENTS} SELECT count(*) AS n FROM raw WHERE tm >= (SELECT max(tm) FROM raw WHERE batch_seq < 20) - 900 AND tm < (SELECT max(tm) FROM raw WHERE batch_seq < 20) + 3600")
def _(spark, sf):
    raw = _raw(spark, sf)
    mark = raw.filter("batch_seq < 20").agg(F.max("at").alias("mark"))
    return raw.crossJoin(F.broadcast(mark)).filter((F.col("at") >= F.col("mark") - 900) & (F.col("at") < F.col("mark") + 3600)).agg(F.count(F.lit(1)).alias("n"))


@query("str_04_resweep_day", f"{_EVENTS} SELECT count(*) AS n FROM raw WHERE tm >= (SELECT epoch(min(ts)::DATE)::BIGINT FROM events) + 5 * 86400 - 900 AND tm < (SELECT epoch(min(ts)::DATE)::BIGINT FROM events) + 6 * 86400 + 900")
def _(spark, sf):
    raw = _raw(spark, sf)
    first = raw.agg((F.floor(F.min("at") / 86400) * 86400).alias("first"))
    a, b = windows.resweep(5, 900)
    return raw.crossJoin(F.broadcast(first)).filter((F.col("at") >= F.col("first") + a) & (F.col("at") < F.col("first") + b)).agg(F.count(F.lit(1)).alias("n"))


@query("str_05_open_calls", f"{BASE} SELECT count(*) FILTER (WHERE NOT is_complete) AS open_calls, count(*) FILTER (WHERE NOT is_complete AND call_id % 3 <> 0) AS usable FROM calls")
def _(spark, sf):
    open_ = all_calls(spark, sf).filter(~F.col("is_complete"))
    return open_.agg(F.count(F.lit(1)).alias("open_calls"), F.count_if(F.col("call_id") % 3 != 0).alias("usable"))


@query("str_06_after_midnight", f"{_EVENTS} SELECT count(*) AS n FROM raw WHERE (tm + 10800) % 86400 < 1800")
def _(spark, sf):
    return _raw(spark, sf).filter(windows.just_after_midnight(F.col("at"), 10800, 30)).agg(F.count(F.lit(1)).alias("n"))


_BATCH_CHECK = """WITH b AS (SELECT o_orderdate::DATE AS day, * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 r AS (SELECT day, sum(n) AS repeated FROM (SELECT day, l_orderkey, l_linenumber, count(*) AS n FROM b GROUP BY ALL HAVING count(*) > 1) GROUP BY 1)
 SELECT day, count(*) FILTER (WHERE l_shipdate < o_orderdate) AS inverted, count(*) FILTER (WHERE l_quantity > 49) AS too_long, coalesce(any_value(repeated), 0)::BIGINT AS repeated,
 CASE WHEN count(*) FILTER (WHERE l_quantity > 49) > 0 OR coalesce(any_value(repeated), 0) > 0 THEN 'pending' ELSE 'accepted' END AS state FROM b LEFT JOIN r USING (day) GROUP BY day"""


@query("str_07_batch_check", _BATCH_CHECK)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("day", F.to_date("o_orderdate"))
    found = quality.batch_findings(rows, {"inverted": F.col("l_shipdate") < F.col("o_orderdate"), "too_long": F.col("l_quantity") > 49}, ["day"])
    found = found.join(quality.repeats(rows, ["l_orderkey", "l_linenumber"], ["day"]), "day")
    return quality.verdicts(found, ["too_long", "repeated"]).select("day", "inverted", "too_long", "repeated", "state")


@query("str_08_snapshot_check", "SELECT n_regionkey AS batch, count(*) FILTER (WHERE n > 1 AND k IS NOT NULL) AS repeated_keys, coalesce(sum(n) FILTER (WHERE k IS NULL), 0)::BIGINT AS without_key, sum(n)::BIGINT AS n, sum(n) - coalesce(sum(n) FILTER (WHERE k IS NULL), 0) = 0 AS emptied FROM (SELECT n_regionkey, nullif(n_nationkey % 3, 0) AS k, count(*) AS n FROM nation GROUP BY ALL) GROUP BY 1")
def _(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_regionkey").alias("batch"), F.nullif(F.col("n_nationkey") % 3, F.lit(0)).alias("k"))
    return quality.snapshot_findings(n, "k", table(spark, sf, "region"), ["batch"])


@query("str_09_session_check", f"{_EVENTS} SELECT batch_seq, count(*) FILTER (WHERE user_id % 50 = 0) AS not_asked, count(*) FILTER (WHERE value IS NULL) AS missing, count(*) FILTER (WHERE value <> floor(value)) AS not_whole, count(*) AS n FROM raw GROUP BY 1")
def _(spark, sf):
    rules = {"not_asked": F.col("user_id") % 50 == 0, "missing": F.col("value").isNull(), "not_whole": F.col("value") != F.floor("value")}
    return quality.batch_findings(_raw(spark, sf), rules, ["batch_seq"])


@query("str_11_agents_to_query", "SELECT DISTINCT user_id FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) OR user_id % 2 = 0")
def _(spark, sf):
    raw = _raw(spark, sf)
    newest = raw.agg(F.max("batch_seq").alias("newest"))
    return raw.crossJoin(F.broadcast(newest)).filter("batch_seq = newest").select("user_id").union(raw.filter("user_id % 2 = 0").select("user_id")).distinct()


@query("str_12_heartbeat_bound", f"{_EVENTS} SELECT count(*) AS n FROM raw WHERE tm <= (SELECT max(tm) FROM raw WHERE event_type = 'login' OR event_type = 'signup')")
def _(spark, sf):
    raw = _raw(spark, sf)
    beats = raw.filter("event_type in ('login', 'signup')").select("at", F.lit(True).alias("ok"))
    return windows.below_heartbeat(raw, beats, "at").agg(F.count(F.lit(1)).alias("n"))


# --- publication -----------------------------------------------------------------------------------

_MART_RECORD = "record AS (SELECT 'm' AS mart, DATE '1997-01-01' + i::INTEGER AS day, 1 AS close_version FROM range(10) t(i))"


def _days_mart(spark, sf):
    """The volume mart by day (a date)."""
    m = marts.volume(all_calls(spark, sf))
    return m.withColumn("day", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")).drop("date_key")


_DAY = "strptime(date_key::VARCHAR, '%Y%m%d')::DATE"


def _record(spark):
    closed = periods.spine(spark, "1997-01-01", "1997-01-10")
    return closed.select(F.lit("m").alias("mart"), "day", F.lit(1).alias("close_version"), F.lit(1).cast("long").alias("publication_seq"), F.lit(1).cast("long").alias("row_count"))


@query("pub_05_corrections", f"{BASE}, m AS (SELECT {_DAY} AS day, count(*) AS calls FROM calls GROUP BY 1) SELECT day, 2 AS close_version FROM m WHERE day BETWEEN DATE '1997-01-04' AND DATE '1997-01-10' AND day(day) % 3 = 0")
def _(spark, sf):
    computed = _days_mart(spark, sf)
    published = computed.withColumn("close_version", F.lit(1)).withColumn("calls", F.when(F.dayofmonth("day") % 3 == 0, F.col("calls") + 1).otherwise(F.col("calls")))
    return publication.corrections(_record(spark), "m", published, computed)


def _published(spark, sf):
    days = periods.spine(spark, "1997-01-03", "1997-01-12").withColumn("close_version", F.lit(1))
    rows = publication.rows_to_publish(_days_mart(spark, sf), days, publication.next_seq(_record(spark)))
    return days, rows


@query("pub_06_records", f"{BASE}, m AS (SELECT {_DAY} AS day, count(*) AS calls FROM calls GROUP BY 1) SELECT 'm' AS mart, DATE '1997-01-03' + i::INTEGER AS day, 1 AS close_version, 2::BIGINT AS publication_seq, count(m.day) AS row_count FROM range(10) t(i) LEFT JOIN m ON m.day = DATE '1997-01-03' + i::INTEGER GROUP BY ALL")
def _(spark, sf):
    days, rows = _published(spark, sf)
    return publication.records(days, rows, "m", 2)


@query("pub_07_published_rows", f"{BASE} SELECT {_DAY} AS day, count(*) AS calls, 1 AS close_version, 2::BIGINT AS publication_seq FROM calls WHERE date_key BETWEEN 19970103 AND 19970112 GROUP BY 1")
def _(spark, sf):
    return _published(spark, sf)[1].select("day", "calls", "close_version", "publication_seq")


# --- requests --------------------------------------------------------------------------------------


#: Ranges that together cover the tables, each within what one request may ask for, cut between weeks.
_RANGES = ((date(1995, 1, 1), date(1997, 12, 27)), (date(1997, 12, 28), date(2000, 12, 23)), (date(2000, 12, 24), date(2002, 1, 5)))


def _request(spark, sf, metrics, dims=(), filters=None, granularity=None, mart="calls_day_volume", principal=None):
    """A request for each range over a mart whose days are closed."""
    rows = marts.build(mart, all_calls(spark, sf), legs(spark, sf))
    # a row for each day and member: built once, read by each range
    rows = rows.withColumn("day", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")).withColumn("close_version", F.lit(1)).persist()
    record = periods.spine(spark, str(_RANGES[0][0]), str(_RANGES[-1][1])).select(F.lit(mart).alias("mart"), "day", F.lit(1).alias("close_version"), F.lit(1).cast("long").alias("publication_seq"))
    out = None
    for first, last in _RANGES:
        request = semantic.Request(tuple(metrics), first, last, tuple(dims), filters or {}, granularity)
        plan = semantic.plan(request, principal or semantic.Principal("u", ("admin",)))
        result = semantic.execute(plan, rows, record)[0]
        out = result if out is None else out.unionByName(result)
    return out


_RANGE = "(date_key > 19971227)::INTEGER + (date_key > 20001223)::INTEGER"
_VOLUME_CTE = "v AS (SELECT date_key, count(*) FILTER (WHERE direction = 'inbound' AND is_complete) AS offered, count(*) FILTER (WHERE direction = 'inbound' AND call_result = 'answered') AS answered FROM calls GROUP BY 1)"


@query("qry_08_metadata", f"""{BASE}, v AS (SELECT {_RANGE} AS i, count(*) FILTER (WHERE date_key % 3 = 0 AND NOT is_complete) AS in_progress FROM calls GROUP BY 1),
  u AS (SELECT {_RANGE} AS i, bool_or(device_no % 5 = 0) AS has_unlinked FROM legs WHERE device_type_code = 2 GROUP BY 1)
  SELECT [DATE '1995-01-01', DATE '1997-12-28', DATE '2000-12-24'][i + 1] AS first, coalesce(in_progress, 0)::BIGINT AS in_progress, coalesce(has_unlinked, false) AS has_unlinked FROM range(3) t(i) LEFT JOIN v USING (i) LEFT JOIN u USING (i)""")
def _(spark, sf):
    """Metadata of requests for the volume mart and for the agents' mart, in which every fifth agent is unlinked; a third of
    the days is provisional."""
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    version = F.when(F.col("date_key") % 3 == 0, 0).otherwise(1)
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("agent_no")).filter("agent_no % 5 <> 0")
    volume = marts.volume(all_calls(spark, sf)).withColumns({"day": day, "close_version": version}).persist()
    handling = marts.agent_handling(legs(spark, sf), known).withColumns({"day": day, "close_version": version}).persist()
    spine = periods.spine(spark, str(_RANGES[0][0]), str(_RANGES[-1][1])).withColumn("close_version", F.when(F.date_format("day", "yyyyMMdd").cast("int") % 3 == 0, 0).otherwise(1))
    out = None
    for first, last in _RANGES:
        own = []
        for code, mart, rows in (("M-C01", "calls_day_volume", volume), ("M-C09", "legs_day_agent_handling", handling)):
            record = spine.select(F.lit(mart).alias("mart"), "day", "close_version", F.lit(1).cast("long").alias("publication_seq"))
            plan = semantic.plan(semantic.Request((code,), first, last), semantic.Principal("u", ("admin",)))
            own.append(semantic.metadata(plan, rows, record))
        both = own[0].select("in_progress").crossJoin(own[1].select("has_unlinked")).select(F.lit(first).alias("first"), "in_progress", "has_unlinked")
        out = both if out is None else out.unionByName(both)
    return out


@query("qry_06_by_month", f"{BASE}, {_VOLUME_CTE} SELECT date_trunc('month', {_DAY})::DATE AS period, sum(offered)::DOUBLE AS \"M-C01\", 1 AS \"M-C01_version\" FROM v GROUP BY 1, {_RANGE}")
def _(spark, sf):
    return _request(spark, sf, ["M-C01"], granularity="month")


@query("qry_07_ratio", f"{BASE}, {_VOLUME_CTE} SELECT date_trunc('week', {_DAY} + 1)::DATE - 1 AS period, sum(answered)::DOUBLE / nullif(sum(offered), 0) AS \"M-C04\", 1 AS \"M-C04_version\" FROM v GROUP BY 1, {_RANGE}")
def _(spark, sf):
    return _request(spark, sf, ["M-C04"], granularity="week")


@query("qry_03_filtered_members", f"{BASE} SELECT first_queue::VARCHAR AS queue, count(*) FILTER (WHERE call_result = 'answered' AND wait_seconds <= 20)::DOUBLE / count(*) AS \"M-C05\", 1 AS \"M-C05_version\" FROM calls WHERE direction = 'inbound' AND is_complete AND first_queue IN (1, 3) GROUP BY 1, {_RANGE}")
def _(spark, sf):
    return _request(spark, sf, ["M-C05"], ["queue"], {"queue": ("1", "3")}, mart="calls_day_queue_service")


@query("prj_17_row_filter", f"{BASE} SELECT device_no::VARCHAR AS agent, count(*)::DOUBLE AS \"M-C09\", 1 AS \"M-C09_version\" FROM legs WHERE device_type_code = 2 AND device_no = 7 GROUP BY 1, {_RANGE}")
@query("qry_11_own_rows_only", f"{BASE} SELECT device_no::VARCHAR AS agent, count(*)::DOUBLE AS \"M-C09\", 1 AS \"M-C09_version\" FROM legs WHERE device_type_code = 2 AND device_no = 7 GROUP BY 1, {_RANGE}")
def _(spark, sf):
    return _request(spark, sf, ["M-C09"], ["agent"], mart="legs_day_agent_handling", principal=semantic.Principal("a7", ("agent",), "7"))


@query("qry_09_members", f"{BASE} SELECT DISTINCT first_queue::VARCHAR AS member FROM calls WHERE first_queue IS NOT NULL AND direction = 'inbound' AND is_complete")
def _(spark, sf):
    return semantic.members(marts.queue_service(all_calls(spark, sf)), "queue")


@query("qry_15_record_search", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_orderkey > 100 ORDER BY 1 LIMIT 50")
def _(spark, sf):
    return semantic.search(table(spark, sf, "orders"), {"o_orderstatus": "F", "o_orderpriority": "5-LOW"}, ("o_orderstatus", "o_orderpriority"), "o_orderkey", 100).select("o_orderkey")


@query("so_02_limit_overflow", "SELECT count(*) > 10000 AS too_large FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey").limit(semantic.MAX_ROWS + 1).agg((F.count(F.lit(1)) > semantic.MAX_ROWS).alias("too_large"))


# --- reconciliation --------------------------------------------------------------------------------

_SIGNED = lambda at: f"sum(CASE WHEN ('0x' || substr(h, {at}, 8))::BIGINT >= 2147483648 THEN ('0x' || substr(h, {at}, 8))::BIGINT - 4294967296 ELSE ('0x' || substr(h, {at}, 8))::BIGINT END)::BIGINT"
_HASHES = f"SELECT o_orderstatus, count(*) AS n, {_SIGNED(1)} AS hash_a, {_SIGNED(9)} AS hash_b FROM (SELECT o_orderstatus, md5('=' || o_orderkey::VARCHAR || '|=' || o_custkey::VARCHAR) AS h FROM orders) GROUP BY 1"


@query("rec_01_table_hash", _HASHES)
@query("ag_11_order_free_hash", _HASHES)
def _(spark, sf):
    return recon.table_hash(table(spark, sf, "orders"), ["o_orderstatus"], ["o_orderkey", "o_custkey"])


@query("rec_02_batch_reconciliation", "SELECT month, CASE WHEN b.n IS NULL THEN 'only_left' WHEN a.n = b.n THEN 'matched' ELSE 'differs' END AS outcome FROM (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1) a LEFT JOIN (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01') AND NOT (o_custkey % 50 = 3 AND month(o_orderdate) = 5) GROUP BY 1) b USING (month)")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    copy = o.filter("month <> date'1997-02-01' and not (o_custkey % 50 = 3 and month(o_orderdate) = 5)")
    total = lambda df: recon.batch_totals(df, [], ["o_custkey"], "month")
    return recon.compare(total(o), total(copy), ["month"], ["n", "o_custkey"])


_AVAILABLE = "WITH p AS (SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, count(nullif(o_orderstatus, 'O')) AS status, count(o_custkey) AS customer FROM orders GROUP BY 1), l AS (SELECT year, n, 'status' AS column_name, status AS present FROM p UNION ALL SELECT year, n, 'customer', customer FROM p), s AS (SELECT *, CASE WHEN present = n THEN 'full' WHEN present >= 0.9 * n THEN 'partial' WHEN present > 0 THEN 'sparse' ELSE 'none' END AS state FROM l)"


def _profile(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.nullif("o_orderstatus", F.lit("O")).alias("status"), F.col("o_custkey").alias("customer"))
    return recon.availability(o, ["status", "customer"], "year")


@query("rec_03_availability", f"{_AVAILABLE} SELECT year, column_name, n, present, state FROM s")
def _(spark, sf):
    return _profile(spark, sf)


@query("rec_03_metric_state", f"{_AVAILABLE} SELECT 'm1' AS metric, year, state FROM s WHERE column_name = 'status' UNION ALL SELECT 'm2', year, state FROM s WHERE column_name = 'customer'")
def _(spark, sf):
    return recon.metric_state(_profile(spark, sf), {"m1": ["status", "customer"], "m2": ["customer"]}, "year")


@query("rec_04_value_profile", "SELECT event_type AS value, count(*) AS occurrences, count(*) / (SELECT count(*) FROM events) AS share, min(event_id) AS first_seen, max(event_id) AS last_seen FROM events GROUP BY 1")
def _(spark, sf):
    return recon.value_profile(table(spark, sf, "events"), "event_type", "event_id")


# --- tests as queries ------------------------------------------------------------------------------


@query("dq_02_states_exceed_signin", "SELECT user_id, batch_seq, sum(value)::BIGINT AS states FROM (SELECT user_id, ts::DATE AS batch_seq, round(value)::BIGINT AS value FROM events) GROUP BY 1, 2 HAVING sum(value) > 200")
def _(spark, sf):
    day = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("batch_seq")).agg(F.sum(F.round("value").cast("long")).alias("states"))
    return day.filter("states > 200")


@query("dq_04_agents_without_dimension", f"{BASE} SELECT device_no AS agent_no, count(*) AS n, min(date_key) AS first_day, max(date_key) AS last_day FROM legs WHERE device_type_code = 2 AND device_no % 9 = 0 GROUP BY 1")
def _(spark, sf):
    lost = _agent_legs(spark, sf).join(_links(spark, sf).select("agent_no"), "agent_no", "left_anti")
    return lost.groupBy("agent_no").agg(F.count(F.lit(1)).alias("n"), F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"))


_SESSIONS = "s AS (SELECT user_id, floor(epoch(ts))::BIGINT AS signin, lead(floor(epoch(ts))::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS signout, event_type, event_id FROM events)"


def _sessions(spark, sf):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    e = table(spark, sf, "events").withColumn("signin", at)
    return e.withColumn("signout", F.lead("signin").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).filter("event_type = 'signup'").select("event_id", "user_id", "signin", "signout")


@query("fact_01_sessions", f"WITH {_SESSIONS} SELECT event_id, user_id, signin, signout FROM s WHERE event_type = 'signup'")
def _(spark, sf):
    return _sessions(spark, sf)


_AGENT_VERSIONS = "versions AS (SELECT user_id AS agent_no, user_id * 10 + v AS agent_sk, CASE WHEN v = 1 THEN 0 WHEN user_id % 2 = 0 THEN 1705298400 ELSE 1704888000 END AS f, CASE WHEN v = 1 THEN 1704888000 ELSE 253402214400 END AS t FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 9 <> 0), (SELECT unnest([1, 2]) AS v))"
_STORED_SK = "CASE WHEN user_id % 4 <> 3 THEN user_id * 10 + 1 END"


def _agent_versions(events):
    """Two versions of an agent, cut on 10 January 2024 at noon; every other agent has none until the 15th, 6 o'clock."""
    second = F.when(F.col("agent_no") % 2 == 0, 1705298400).otherwise(1704888000)
    v = F.inline(F.array(F.struct(F.lit(1).alias("v"), F.lit(0).cast("long").alias("valid_from"), F.lit(1704888000).cast("long").alias("valid_to")), F.struct(F.lit(2).alias("v"), second.cast("long").alias("valid_from"), F.lit(253402214400).alias("valid_to"))))
    agents = events.filter("user_id % 9 <> 0").select(F.col("user_id").alias("agent_no")).distinct()
    return agents.select("agent_no", v).withColumn("agent_sk", F.col("agent_no") * 10 + F.col("v"))


@query("dq_03_session_and_day_links", f"""WITH {_SESSIONS}, {_AGENT_VERSIONS},
  d AS (SELECT DISTINCT user_id, (floor(epoch(ts))::BIGINT + 10800) // 86400 AS day FROM events),
  found AS (SELECT 'session' AS model, event_id AS fact, user_id, {_STORED_SK} AS stored_sk, (SELECT max(agent_sk) FROM versions WHERE agent_no = user_id AND signin >= f AND signin < t) AS agent_sk FROM s WHERE event_type = 'signup'
    UNION ALL SELECT 'day', day, user_id, {_STORED_SK}, (SELECT max(agent_sk) FROM versions WHERE agent_no = user_id AND f < (day + 1) * 86400 - 10800 AND t > day * 86400 - 10800) FROM d)
  SELECT model, fact, user_id AS agent_no, stored_sk, agent_sk FROM found WHERE agent_sk IS DISTINCT FROM stored_sk""")
def _(spark, sf):
    from ..operators.intervals import version_at, version_in

    events = table(spark, sf, "events")
    versions = _agent_versions(events)
    stored = F.when(F.col("agent_no") % 4 != 3, F.col("agent_no") * 10 + 1)
    sessions = _sessions(spark, sf).select(F.lit("session").alias("model"), F.col("event_id").alias("fact"), F.col("user_id").alias("agent_no"), "signin")
    day = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) + 10800) / 86400)
    days = events.select(F.lit("day").alias("model"), day.alias("fact"), F.col("user_id").alias("agent_no")).distinct()
    days = days.withColumns({"a": F.col("fact") * 86400 - 10800, "b": F.col("fact") * 86400 + 75600})
    at = version_at(sessions, versions, "agent_no", "signin", ["agent_sk"]).drop("signin")
    on = version_in(days, versions, "agent_no", "a", "b", ["agent_sk"], ["agent_no", "fact"]).drop("a", "b")
    linked = at.unionByName(on).withColumn("stored_sk", stored).select("model", "fact", "agent_no", "stored_sk", "agent_sk")
    return quality.stored_links_differ(linked, "stored_sk", "agent_sk")


@query("dq_05_session_duration", f"WITH {_SESSIONS} SELECT event_id FROM s WHERE event_type = 'signup' AND abs(signin % 4000 - (signout - signin)) > 60")
def _(spark, sf):
    return quality.duration_differs(_sessions(spark, sf).withColumn("duration", F.col("signin") % 4000), "signin", "signout", "duration").select("event_id")


@query("dq_06_batches_reach_core", f"{_EVENTS} SELECT batch_seq FROM batches WHERE batch_seq >= 10 AND batch_seq < 24 AND batch_seq NOT IN (SELECT * FROM held)")
def _(spark, sf):
    loaded = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("batch_seq").cast("int"))
    usable = _batches(spark, sf).join(incremental.held(_quarantine(spark, sf)), ["run_id", "batch_seq"], "left_anti").withColumn("loaded_at", loaded)
    return quality.behind(usable, _registry(spark, sf), "stg_events", F.lit("2024-01-26").cast("timestamp")).select("batch_seq")


@query("dq_07_versions_overlap", "SELECT s_suppkey AS agent_no FROM supplier WHERE s_suppkey % 13 = 0")
def _(spark, sf):
    from ..operators.intervals import overlapping

    v = _links(spark, sf).select("agent_no", "valid_from", "valid_to")
    bad = table(spark, sf, "supplier").filter("s_suppkey % 13 = 0").select(F.col("s_suppkey").alias("agent_no"), F.lit("2000-01-01").cast("timestamp").alias("valid_from"), F.lit("1999-01-01").cast("timestamp").alias("valid_to"))
    return overlapping(v.unionByName(bad), "agent_no").select("agent_no").distinct()


@query("dq_08_call_for_every_call", f"{BASE} SELECT DISTINCT call_id FROM legs WHERE call_id % 97 = 0")
def _(spark, sf):
    return legs(spark, sf).select("call_id").distinct().join(all_calls(spark, sf).filter("call_id % 97 <> 0"), "call_id", "left_anti")


@query("dq_09_stale_date_key", f"{BASE} SELECT call_id, line FROM legs WHERE date_key <> strftime(DATE '1970-01-01' + (wait_begin // 86400)::INTEGER, '%Y%m%d')::INTEGER")
def _(spark, sf):
    utc_day = F.date_format("wait_begin", "yyyyMMdd").cast("int")
    return quality.stored_links_differ(legs(spark, sf).withColumn("stored", utc_day), "stored", "date_key").select(*LEG)


@query("dq_11_last_leg_flag", f"{BASE} SELECT call_id, line FROM legs WHERE (leg_seq = -1) <> (leg_seq = -1 OR line = 6)")
def _(spark, sf):
    return quality.last_leg_flags(legs(spark, sf).withColumn("is_last", (F.col("leg_seq") == -1) | (F.col("line") == 6))).select(*LEG)


@query("dq_12_several_last_legs", f"{BASE} SELECT call_id, count(*) FILTER (WHERE leg_seq = -1 OR line = 2) AS n FROM legs GROUP BY 1 HAVING count(*) FILTER (WHERE leg_seq = -1 OR line = 2) > 1")
def _(spark, sf):
    return quality.several_last_legs(legs(spark, sf).withColumn("leg_seq", F.when(F.col("line") == 2, -1).otherwise(F.col("leg_seq"))))


@query("dq_14_without_first_leg", f"{BASE} SELECT count(*) AS n, min(date_key) AS oldest FROM calls WHERE first_leg_seq > 1 HAVING count(*) > 0")
def _(spark, sf):
    return quality.without_first_leg(all_calls(spark, sf))


@query("dq_15_recompute", f"{BASE} SELECT call_id FROM calls WHERE call_id % 101 = 0 OR (call_id % 103 = 0 AND is_complete) OR (call_id % 107 = 0 AND first_queue IS NOT NULL) OR call_id % 109 = 0")
def _(spark, sf):
    wrong = lambda n, c, value: F.when(F.col("call_id") % n == 0, value).otherwise(F.col(c))
    stored = all_calls(spark, sf).withColumns({
        "answered_legs": wrong(101, "answered_legs", F.col("answered_legs") + 1),
        "ended_at": wrong(103, "ended_at", F.lit(None)),
        "first_queue": wrong(107, "first_queue", F.col("first_queue") + 1),
        "wait_seconds": wrong(109, "wait_seconds", F.col("wait_seconds") + 1),
    })
    return quality.recompute_differs(stored, call_ops.recomputed(legs(spark, sf)), "call_id", list(call_ops.RECOMPUTED))


@query("dq_16_result_rules", f"{BASE} SELECT call_id, 'answer_not_counted' AS rule FROM calls WHERE call_id % 89 = 0 AND is_complete AND answered_legs > 0 UNION ALL SELECT call_id, 'ivr_only_with_queue' FROM calls WHERE call_id % 89 = 0 AND queue_legs + agent_legs > 0 UNION ALL SELECT call_id, 'incomplete_with_result' FROM calls WHERE call_id % 89 = 0 AND NOT is_complete")
def _(spark, sf):
    broken = F.when(F.col("call_id") % 89 == 0, "ivr_only").otherwise(F.col("call_result"))
    return quality.result_rule_violations(all_calls(spark, sf).withColumn("call_result", broken))


_SAME = "SELECT n_regionkey AS scope, 2 AS version FROM nation GROUP BY 1 HAVING n_regionkey % 2 = 0"


@query("dq_18_version_without_change", _SAME)
@query("wn_08_lag_of_fingerprint", _SAME)
@query("ag_10_fingerprint", _SAME)
def _(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_regionkey").alias("scope"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"), "n_name")
    n = n.withColumn("content", F.when((F.col("version") == 2) & (F.col("scope") % 2 == 1), F.concat("n_name", F.lit("!"))).otherwise(F.col("n_name")))
    return quality.version_without_change(n, "scope", "version", "content")


@query("dq_19_mart_matches_record", f"{BASE}, m AS (SELECT {_DAY} AS day, count(*) AS calls FROM calls GROUP BY 1) SELECT DATE '1997-01-03' + i::INTEGER AS day, 1 AS close_version FROM range(10) t(i) LEFT JOIN m ON m.day = DATE '1997-01-03' + i::INTEGER WHERE m.day IS NOT NULL AND day(m.day) % 4 = 0")
def _(spark, sf):
    days, rows = _published(spark, sf)
    record = publication.records(days, rows, "m", 2)
    return quality.publication_mismatch(rows.filter(F.dayofmonth("day") % 4 != 0), record)
