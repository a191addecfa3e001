"""Projections, joins, aggregates, windows and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import casts, codes, content, documents, keys, periods
from ..operators import incremental, intervals
from .adapter import BASE, LEG, all_calls, legs, observed_legs, table
from .registry import query

# --- projections -----------------------------------------------------------------------------------


def _texts(spark, sf):
    """Source-like text values: numbers, numbers with a fraction, times and words."""
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("user_id").cast("string")).alias("number"),
        F.concat(F.col("user_id").cast("string"), F.element_at(F.array(*map(F.lit, ("", ".0", ".5", " ", "x"))), (F.col("event_id") % 5 + 1).cast("int"))).alias("whole"),
        F.when(F.col("event_id") % 4 == 0, "2026-02-30 10:00:00").when(F.col("event_id") % 4 == 1, "2026-2-3 1:00:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("time"),
    )


_TEXTS = """WITH t AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE user_id::VARCHAR END AS number, user_id::VARCHAR || ['', '.0', '.5', ' ', 'x'][event_id % 5 + 1] AS whole,
  CASE event_id % 4 WHEN 0 THEN '2026-02-30 10:00:00' WHEN 1 THEN '2026-2-3 1:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "time" FROM events)"""


@query("prj_01_blank_to_null", f"{_TEXTS} SELECT event_id, nullif(number, '') AS number FROM t")
def _(spark, sf):
    return _texts(spark, sf).select("event_id", casts.blank_to_null(F.col("number")).alias("number"))


@query("prj_02_try_int", f"{_TEXTS} SELECT event_id, CASE WHEN regexp_full_match(number, '-?[0-9]{{1,9}}') THEN number::INTEGER END AS n, CASE WHEN regexp_full_match(whole, '-?[0-9]{{1,9}}') THEN whole::INTEGER END AS m FROM t")
def _(spark, sf):
    return _texts(spark, sf).select("event_id", casts.try_int(F.col("number")).alias("n"), casts.try_int(F.col("whole")).alias("m"))


@query("prj_03_try_timestamp", f"""{_TEXTS} SELECT event_id, epoch(CASE WHEN regexp_full_match("time", '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') THEN try_cast("time" AS TIMESTAMP) END)::BIGINT AS at FROM t""")
def _(spark, sf):
    return _texts(spark, sf).select("event_id", F.unix_timestamp(casts.try_timestamp(F.col("time")).cast("timestamp")).alias("at"))


@query("prj_04_try_whole", f"{_TEXTS} SELECT event_id, CASE WHEN regexp_full_match(whole, '-?[0-9]{{1,9}}(\\.0+)?') THEN split_part(whole, '.', 1)::INTEGER END AS n FROM t")
def _(spark, sf):
    return _texts(spark, sf).select("event_id", casts.try_whole(F.col("whole")).alias("n"))


@query("prj_05_local_to_instant", "SELECT event_id, floor(epoch(ts))::BIGINT - 10800 AS instant, 10800 AS offset_seconds FROM events")
def _(spark, sf):
    local = F.col("ts")
    return table(spark, sf, "events").select("event_id", F.unix_timestamp(casts.to_instant(local, "Asia/Riyadh")).alias("instant"), casts.offset_seconds(local, "Asia/Riyadh").alias("offset_seconds"))


@query("prj_06_typed_ok", f"{_TEXTS} SELECT event_id % 5 AS shape, count(*) AS n FROM t WHERE NOT regexp_full_match(whole, '-?[0-9]{{1,9}}(\\.0+)?') GROUP BY 1")
def _(spark, sf):
    ok = casts.typed_ok([(F.col("whole"), casts.try_whole(F.col("whole"))), (F.col("number"), casts.try_int(F.col("number")))])
    return _texts(spark, sf).filter(~ok).groupBy((F.col("event_id") % 5).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_07_direction_codes", "SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'inbound' WHEN o_orderpriority = '3-MEDIUM' THEN 'outbound' WHEN o_orderpriority = '5-LOW' THEN 'internal' ELSE 'unmapped' END AS direction, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    mapped = codes.direction(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"], ["3-MEDIUM"], ["5-LOW"])
    return table(spark, sf, "orders").groupBy(mapped.alias("direction")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_08_release_source", "SELECT CASE WHEN l_linenumber < 4 THEN NULL WHEN l_returnflag = 'A' THEN 'agent' WHEN l_returnflag = 'R' THEN 'caller' ELSE 'unmapped' END AS source, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, sf):
    source = codes.release_source(F.col("l_returnflag"), F.col("l_linenumber") >= 4, {"agent": ["A"], "caller": ["R"], "system": ["X"]})
    return table(spark, sf, "lineitem").groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_09_index_columns", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'again' ELSE json_extract_string(props, '$.k') END AS talk, CASE WHEN event_id % 2 = 0 THEN event_type END AS state FROM events")
def _(spark, sf):
    entry = lambda i, v: F.struct(F.lit(i).alias("id"), v.alias("val"))
    k = documents.field(F.col("props"), "k")
    listed = F.concat(F.array(entry("T1", k)), F.when(F.col("event_id") % 2 == 0, F.array(entry("S1", F.col("event_type")))).otherwise(F.array().cast(documents.INDEXES)), F.when(F.col("event_id") % 3 == 0, F.array(entry("T1", F.lit("again")))).otherwise(F.array().cast(documents.INDEXES)))
    return table(spark, sf, "events").withColumn("payload", F.to_json(listed)).select("event_id", *documents.index_columns(F.col("payload"), {"T1": "talk", "S1": "state"}))


@query("prj_10_json_field", "SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", documents.field(F.col("props"), "k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_12_row_hash", "SELECT o_orderkey, md5(concat_ws('|', '=' || o_orderkey::VARCHAR, coalesce('=' || nullif(o_orderstatus, 'O'), '~'), '=' || o_custkey::VARCHAR)) AS hash FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O"))).select("o_orderkey", content.row_hash(["o_orderkey", "o_orderstatus", "o_custkey"]).alias("hash"))


@query("prj_13_raw_hash", """SELECT c_custkey, sha256('[["c_custkey","' || c_custkey::VARCHAR || '"],["c_nationkey","' || c_nationkey::VARCHAR || '"]]') AS hash FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", content.raw_hash(["c_custkey", "c_nationkey"]).alias("hash"))


@query("prj_14_record_hash", """SELECT c_custkey, sha256('[["c_custkey","' || c_custkey::VARCHAR || '"],["c_nationkey","' || c_nationkey::VARCHAR || '"]]') AS hash FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", content.record_hash(["c_nationkey", "c_custkey"]).alias("hash"))


@query("prj_15_unlinked_bucket", "SELECT coalesce(s_suppkey::VARCHAR, 'unlinked') AS agent, count(*) AS n FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey % 3 <> 0 GROUP BY 1")
def _(spark, sf):
    known = table(spark, sf, "supplier").filter("s_suppkey % 3 <> 0").select("s_suppkey")
    joined = table(spark, sf, "lineitem").join(known, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.groupBy(F.coalesce(F.col("s_suppkey").cast("string"), F.lit("unlinked")).alias("agent")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_16_member_filter", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey::VARCHAR IN ('1', '7', '22', '100') GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_custkey").cast("string").isin("1", "7", "22", "100")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("prj_18_distinct_from", "SELECT count(*) AS n FROM orders WHERE nullif(o_orderstatus, 'O') IS DISTINCT FROM nullif(o_orderstatus, 'F')")
def _(spark, sf):
    a, b = F.nullif("o_orderstatus", F.lit("O")), F.nullif("o_orderstatus", F.lit("F"))
    return table(spark, sf, "orders").filter(~a.eqNullSafe(b)).agg(F.count(F.lit(1)).alias("n"))


@query("key_01_natural_key", r"SELECT c_custkey, replace(replace(c_name, '\', '\\'), '|', '\|') || '|' || c_custkey::VARCHAR AS nk FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", keys.nk(F.col("c_name"), F.col("c_custkey")).alias("nk"))


_NS = keys.site_namespace("hq").hex
_UUID = """lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || ['8', '9', 'a', 'b'][('0x' || substr(h, 17, 1))::INTEGER % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12))"""


@query("key_02_surrogate_key", f"SELECT c_custkey, {_UUID} AS sk FROM (SELECT c_custkey, sha1(unhex('{_NS}') || encode('crm:' || c_custkey::VARCHAR)) AS h FROM customer)")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", keys.sk("hq", "crm", keys.nk(F.col("c_custkey"))).alias("sk"))


@query("key_03_date_key", "SELECT strftime((ts + INTERVAL 3 HOUR)::DATE, '%Y%m%d')::INTEGER AS date_key, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy(keys.date_key(F.col("ts").cast("timestamp")).alias("date_key")).agg(F.count(F.lit(1)).alias("n"))


# --- joins -----------------------------------------------------------------------------------------

_BATCHES = f"{BASE}, batches AS (SELECT DISTINCT batch_seq FROM obs WHERE batch_seq % 3 = 0)"


def _batches(spark, sf):
    return observed_legs(spark, sf).select(F.lit("r1").alias("run_id"), "batch_seq").distinct()


@query("jn_01_batch_join", f"{_BATCHES} SELECT batch_seq, count(*) AS n FROM obs JOIN batches USING (batch_seq) GROUP BY 1")
@query("src_08_batch_scan", f"{_BATCHES} SELECT batch_seq, count(*) AS n FROM obs SEMI JOIN batches USING (batch_seq) GROUP BY 1")
def _(spark, sf):
    raw = observed_legs(spark, sf).withColumn("run_id", F.lit("r1"))
    return incremental.scan_batches(raw, _batches(spark, sf).filter("batch_seq % 3 = 0")).groupBy("batch_seq").agg(F.count(F.lit(1)).alias("n"))


@query("jn_02_left_to_target", f"{BASE} SELECT (c.first_queue IS NULL) AS absent, count(*) AS n FROM legs l LEFT JOIN (SELECT call_id, first_queue FROM calls WHERE call_id % 2 = 0) c USING (call_id) GROUP BY 1")
def _(spark, sf):
    target = all_calls(spark, sf).filter("call_id % 2 = 0").select("call_id", "first_queue")
    return legs(spark, sf).join(target, "call_id", "left").groupBy(F.col("first_queue").isNull().alias("absent")).agg(F.count(F.lit(1)).alias("n"))


def _versions(spark, sf):
    """Three half-open versions of every agent, cut at 1997-01-01 and 1999-01-01."""
    v = F.posexplode(F.array(*(F.struct(F.lit(a).cast("timestamp").alias("valid_from"), F.lit(b).cast("timestamp").alias("valid_to")) for a, b in (("1970-01-01", "1997-01-01"), ("1997-01-01", "1999-01-01"), ("1999-01-01", "9999-12-31")))))
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("device_no"), v).select("device_no", (F.col("pos") + 1).alias("version"), "col.*")


_VERSIONS = """versions AS (SELECT s_suppkey AS device_no, v AS version, ['1970-01-01', '1997-01-01', '1999-01-01'][v]::TIMESTAMP AS valid_from, ['1997-01-01', '1999-01-01', '9999-12-31'][v]::TIMESTAMP AS valid_to
  FROM supplier, (SELECT unnest([1, 2, 3]) AS v))"""


@query("jn_03_version_at", f"{BASE}, {_VERSIONS} SELECT v.version, count(*) AS n FROM legs l LEFT JOIN versions v ON l.device_type_code = 2 AND v.device_no = l.device_no AND l.wait_begin >= epoch(v.valid_from) AND l.wait_begin < epoch(v.valid_to) GROUP BY 1")
def _(spark, sf):
    joined = intervals.version_at(legs(spark, sf), _versions(spark, sf), "device_no", "wait_begin", ["version"], F.col("device_type_code") == 2)
    return joined.groupBy("version").agg(F.count(F.lit(1)).alias("n"))


@query("jn_04_version_in_day", f"{BASE}, {_VERSIONS} SELECT call_id, line, max(version) AS version FROM legs l LEFT JOIN versions v ON v.device_no = l.device_no AND epoch(v.valid_from) < l.wait_begin + 86400 AND epoch(v.valid_to) > l.wait_begin - 86400 WHERE device_type_code = 2 GROUP BY ALL")
def _(spark, sf):
    agents = legs(spark, sf).filter("device_type_code = 2").select(*LEG, "device_no", (F.col("wait_begin") - F.expr("interval 1 day")).alias("a"), (F.col("wait_begin") + F.expr("interval 1 day")).alias("b"))
    return intervals.version_in(agents, _versions(spark, sf), "device_no", "a", "b", ["version"], LEG).select(*LEG, "version")


@query("jn_05_as_of", "SELECT e.event_id, (SELECT max(s.event_id) FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND (s.ts, s.event_id) <= (e.ts, 9223372036854775807) AND s.ts = (SELECT max(x.ts) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'signup' AND x.ts <= e.ts)) AS state FROM events e WHERE e.event_type = 'purchase'")
def _(spark, sf):
    e = table(spark, sf, "events")
    states = e.filter("event_type = 'signup'").groupBy("user_id", F.col("ts").alias("at")).agg(F.max("event_id").alias("state"))
    points = e.filter("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return intervals.as_of(points, states, "user_id", "ts", "at", ["state"]).select("event_id", "state")


@query("jn_06_contained_or_last_ended", f"{BASE}, {_VERSIONS} SELECT version, count(*) AS n FROM (SELECT l.call_id, l.line, max(v.version) AS version FROM legs l JOIN versions v ON v.device_no = l.device_no AND epoch(v.valid_from) <= l.wait_begin WHERE device_type_code = 2 GROUP BY ALL) GROUP BY 1")
def _(spark, sf):
    points = legs(spark, sf).filter("device_type_code = 2").select("device_no", *LEG, "wait_begin")
    states = _versions(spark, sf).select("device_no", F.col("valid_from").alias("at"), "version")
    return intervals.as_of(points, states, "device_no", "wait_begin", "at", ["version"]).groupBy("version").agg(F.count(F.lit(1)).alias("n"))


@query("jn_07_cross_join", "SELECT r_regionkey, v AS version FROM region, (SELECT unnest([1, 2, 3]) AS v)")
def _(spark, sf):
    # entities (a dimension) with the few pending snapshots: never two facts
    return table(spark, sf, "region").select("r_regionkey").crossJoin(spark.range(1, 4).select(F.col("id").cast("int").alias("version")))


@query("jn_08_full_outer", "SELECT coalesce(a.k, b.k) AS k, a.n AS n_a, b.n AS n_b FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey % 2 <> 0 GROUP BY 1) b ON a.k = b.k")
def _(spark, sf):
    o = table(spark, sf, "orders")
    side = lambda m, name: o.filter(F.col("o_custkey") % m != 0).groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias(name))
    return side(3, "n_a").join(side(2, "n_b"), "k", "full_outer")


@query("jn_09_semi", "SELECT count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40)")
def _(spark, sf):
    big = table(spark, sf, "lineitem").filter("l_quantity > 40").select("l_orderkey")
    return table(spark, sf, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(F.count(F.lit(1)).alias("n"))


@query("jn_10_anti_nested", "SELECT count(*) AS n FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40 AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_suppkey % 4 = 0))")
def _(spark, sf):
    held = table(spark, sf, "supplier").filter("s_suppkey % 4 = 0").select("s_suppkey")
    usable = table(spark, sf, "lineitem").filter("l_quantity > 40").join(held, F.col("l_suppkey") == F.col("s_suppkey"), "left_anti")
    return table(spark, sf, "orders").join(usable, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("n"))


@query("jn_11_not_in", "SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def _(spark, sf):
    out = table(spark, sf, "customer").filter("c_nationkey < 5").select("c_custkey")
    return table(spark, sf, "orders").join(out, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count(F.lit(1)).alias("n"))


@query("jn_12_overlapping_versions", """WITH v AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + (event_id % 7) * 3600 AS b FROM events),
  w AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS u FROM v) SELECT user_id, count(*) AS n FROM w WHERE a < u OR b <= a GROUP BY 1""")
def _(spark, sf):
    a = F.unix_timestamp(F.col("ts").cast("timestamp"))
    v = table(spark, sf, "events").select("user_id", a.alias("valid_from"), (a + F.col("event_id") % 7 * 3600).alias("valid_to"))
    return intervals.overlapping(v, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("jn_13_chosen_publications", f"{BASE} SELECT date_key, count(*) AS n FROM calls WHERE (date_key, direction) IN (VALUES (19970105, 'inbound'), (19970106, 'outbound'), (19980301, 'inbound')) GROUP BY 1")
def _(spark, sf):
    chosen = spark.createDataFrame([(19970105, "inbound"), (19970106, "outbound"), (19980301, "inbound")], "date_key int, direction string")
    return all_calls(spark, sf).join(F.broadcast(chosen), ["date_key", "direction"], "left_semi").groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))


@query("jn_14_star", "SELECT r_name, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey").join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    # nation and region are fixed lists of a few rows
    o = o.join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return o.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))


@query("jn_15_bridge", "SELECT p_brand, count(DISTINCT l_orderkey) AS incidents FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count_distinct("l_orderkey").alias("incidents"))


@query("jn_16_shift_intersection", """WITH i AS (SELECT event_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + 3600 + (event_id % 20) * 3600 AS b FROM events),
  d AS (SELECT *, unnest(range(a // 86400, greatest(a // 86400, (b - 1) // 86400) + 1)) AS day FROM i)
  SELECT shift, sum(least(b, day * 86400 + e) - greatest(a, day * 86400 + s))::BIGINT AS seconds FROM d, (VALUES ('early', 21600, 50400), ('late', 50400, 79200), ('night', 0, 21600)) t(shift, s, e)
  WHERE least(b, day * 86400 + e) > greatest(a, day * 86400 + s) GROUP BY 1""")
def _(spark, sf):
    a = F.unix_timestamp(F.col("ts").cast("timestamp"))
    i = table(spark, sf, "events").select(a.alias("a"), (a + 3600 + F.col("event_id") % 20 * 3600).alias("b"))
    shifts = spark.createDataFrame([("early", 21600, 50400), ("late", 50400, 79200), ("night", 0, 21600)], "shift string, start_second long, end_second long")
    return intervals.intersect_shifts(i, shifts, "a", "b").groupBy("shift").agg(F.sum("seconds").alias("seconds"))


@query("jn_17_point_in_polygon", "SELECT count(*) FILTER (WHERE x + y <= 50) AS inside, count(*) FILTER (WHERE x + y > 50) AS outside FROM (SELECT l_quantity + 0.25 AS x, l_linenumber * 5 + 0.5 AS y FROM lineitem)")
def _(spark, sf):
    p = table(spark, sf, "lineitem").select((F.col("l_quantity") + 0.25).alias("x"), (F.col("l_linenumber") * 5 + 0.5).alias("y"))
    inside = intervals.inside_polygon(F.col("x"), F.col("y"), [(0.0, 0.0), (50.0, 0.0), (0.0, 50.0)])
    return p.agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"))


# --- aggregates ------------------------------------------------------------------------------------


@query("ag_01_group_by", "SELECT l_returnflag, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("ag_02_conditional_count", "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_linestatus = 'O') AS open FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_linestatus") == "O").alias("open"))


@query("ag_03_conditional_sum", "SELECT l_suppkey, coalesce(sum(l_quantity::BIGINT) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 7), 0)::BIGINT AS quantity FROM lineitem GROUP BY 1")
def _(spark, sf):
    hit = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.coalesce(F.sum(F.when(hit, F.col("l_quantity").cast("long"))), F.lit(0)).alias("quantity"))


@query("ag_04_bool_aggregates", "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS some, bool_and(l_linestatus = 'O') AS every FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("some"), F.bool_and(F.col("l_linestatus") == "O").alias("every"))


@query("ag_05_first_by_order", f"{BASE} SELECT call_id, arg_max(device_no, wait_seconds * 100 - line) AS device_no FROM legs GROUP BY 1")
def _(spark, sf):
    return legs(spark, sf).groupBy("call_id").agg(F.max_by("device_no", F.struct("wait_seconds", -F.col("line"))).alias("device_no"))


@query("ag_06_distinct_on", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(spark, sf):
    first = F.min_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("f")
    return table(spark, sf, "events").groupBy("user_id").agg(first).select("user_id", "f.*")


@query("ag_07_count_distinct_having", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 2")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("n")).filter("n > 2")


@query("ag_08_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 12")


@query("ag_12_empty_global", "SELECT sum(o_custkey)::BIGINT AS s FROM orders WHERE o_orderkey < 0 HAVING count(*) > 0")
def _(spark, sf):
    return table(spark, sf, "orders").filter("o_orderkey < 0").agg(F.sum("o_custkey").alias("s"), F.count(F.lit(1)).alias("n")).filter("n > 0").select("s")


@query("ag_13_safe_ratio", "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE / nullif(count(*) FILTER (WHERE l_linenumber = 7), 0) AS ratio FROM lineitem GROUP BY 1")
def _(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("a"), F.count_if(F.col("l_linenumber") == 7).alias("b"))
    return g.select("l_suppkey", F.try_divide(F.col("a").cast("double"), "b").alias("ratio"))


@query("ag_14_median_p90", f"{BASE} SELECT device_no, median(wait_seconds) AS median, quantile_cont(wait_seconds, 0.9) AS p90 FROM legs WHERE device_type_code = 1 GROUP BY 1")
def _(spark, sf):
    return legs(spark, sf).filter("device_type_code = 1").groupBy("device_no").agg(F.median("wait_seconds").alias("median"), F.expr("percentile_cont(0.9) WITHIN GROUP (ORDER BY wait_seconds)").alias("p90"))


@query("ag_15_first_then_average", "SELECT o_custkey % 10 AS site, sum(d)::BIGINT AS days, count(*) AS incidents FROM (SELECT o_orderkey, o_custkey, min(date_diff('day', o_orderdate::DATE, l_shipdate::DATE)) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY 1")
def _(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    first = joined.groupBy("o_orderkey", "o_custkey").agg(F.min(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))).alias("d"))
    return first.groupBy((F.col("o_custkey") % 10).alias("site")).agg(F.sum("d").alias("days"), F.count(F.lit(1)).alias("incidents"))


@query("ag_16_span_guard", "SELECT l_orderkey AS call_id, l_linenumber AS line, (epoch(max(l_shipdate)) - epoch(min(l_shipdate)))::BIGINT AS span_seconds, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING epoch(max(l_shipdate)) - epoch(min(l_shipdate)) > 86400")
@query("inc_09_day_guard", "SELECT l_orderkey AS call_id, l_linenumber AS line, (epoch(max(l_shipdate)) - epoch(min(l_shipdate)))::BIGINT AS span_seconds, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING epoch(max(l_shipdate)) - epoch(min(l_shipdate)) > 86400")
def _(spark, sf):
    return incremental.wide_keys(observed_legs(spark, sf), LEG, "observed_at")


@query("ag_17_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("ag_18_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def _(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


# --- windows ---------------------------------------------------------------------------------------


@query("wn_01_newest_observation", f"{BASE} SELECT call_id, line, content_hash FROM legs")
def _(spark, sf):
    return legs(spark, sf).select(*LEG, "content_hash")


@query("wn_02_is_first", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS is_first FROM events")
def _(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_id", (F.row_number().over(w) == 1).alias("is_first"))


@query("wn_03_lag_column_default", "SELECT event_id, CASE WHEN row_number() OVER w = 1 THEN 'none-' || user_id::VARCHAR ELSE lag(nullif(event_type, 'click')) OVER w END AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def _(spark, sf):
    e = table(spark, sf, "events").withColumns({"kind": F.nullif("event_type", F.lit("click")), "none": F.concat(F.lit("none-"), F.col("user_id").cast("string"))})
    return e.selectExpr("event_id", "lag(kind, 1, none) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before")


@query("wn_04_lead", "SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.lead("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("next"))


@query("wn_05_running_max", "SELECT event_id, max(event_id) OVER (PARTITION BY user_id ORDER BY ts) AS high FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.max("event_id").over(Window.partitionBy("user_id").orderBy("ts")).alias("high"))


@query("wn_07_rank_alternatives", f"{BASE} SELECT call_id, direction, date_key, first_queue, agent_no, answered_legs FROM calls")
def _(spark, sf):
    from ..operators.calls import recomputed

    return recomputed(legs(spark, sf)).select("call_id", "direction", "date_key", "first_queue", "agent_no", "answered_legs")


# --- sorts, limits, sets ---------------------------------------------------------------------------


@query("so_01_order_by", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderstatus")


@query("so_03_top_one", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("o_orderkey"))


@query("so_04_oldest_pending", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 1")
def _(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'P'").orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_custkey")


@query("so_05_numeric_sort", "SELECT user_id::VARCHAR AS id, row_number() OVER (ORDER BY user_id) AS place FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)")
def _(spark, sf):
    from ..operators.ordering import places

    ids = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("id")).distinct().filter("id is not null")
    return places(ids, F.col("id").cast("long"), "place").select("id", "place")


@query("st_01_union_all", "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1")
def _(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.unionByName(b).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("st_02_union_distinct", "SELECT o_orderdate::DATE AS day FROM orders UNION SELECT l_shipdate::DATE FROM lineitem")
def _(spark, sf):
    a, b = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")), table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return a.union(b).distinct()


@query("st_03_multiset_difference", "SELECT 'gone' AS side, * FROM (SELECT l_orderkey, l_suppkey FROM lineitem EXCEPT ALL SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber < 6) UNION ALL SELECT 'come', * FROM (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber < 6 EXCEPT ALL SELECT l_orderkey, l_suppkey FROM lineitem)")
def _(spark, sf):
    from ..operators.recon import multiset_difference

    a = table(spark, sf, "lineitem")
    return multiset_difference(a.select("l_orderkey", "l_suppkey"), a.filter("l_linenumber < 6").select("l_orderkey", "l_suppkey"))


# --- functions -------------------------------------------------------------------------------------


@query("fn_01_periods", "SELECT date_trunc('week', o_orderdate::DATE + 1)::DATE - 1 AS week, date_trunc('month', o_orderdate)::DATE AS month, date_trunc('quarter', o_orderdate)::DATE AS quarter, date_trunc('year', o_orderdate)::DATE AS year, count(*) AS n FROM orders GROUP BY ALL")
@query("qry_05_granularity", "SELECT date_trunc('week', o_orderdate::DATE + 1)::DATE - 1 AS week, date_trunc('month', o_orderdate)::DATE AS month, date_trunc('quarter', o_orderdate)::DATE AS quarter, date_trunc('year', o_orderdate)::DATE AS year, count(*) AS n FROM orders GROUP BY ALL")
def _(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").groupBy(*(periods.period(day, g).alias(g) for g in ("week", "month", "quarter", "year"))).agg(F.count(F.lit(1)).alias("n"))


@query("fn_02_calendar", "SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, dayofweek(d)::INTEGER + 1 AS weekday, dayofweek(d) IN (5, 6) AS is_weekend, (date_trunc('week', d + 1)::DATE - 1) AS week_start FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders)")
def _(spark, sf):
    return periods.calendar(periods.spine_of(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))))
