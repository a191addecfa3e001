"""Batch checks, guards and marks as the source's rules have them, over rows in which every rule bites."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import periods
from ..operators import batch_checks, incremental, intervals, quality
from ..streaming import windows
from . import publication, semantic
from .adapter import BASE, LEG, legs, observed_legs, table
from .registry import query

# --- call records ----------------------------------------------------------------------------------

#: Lines as the source's text: some without key, with odd sequences and times; a line's own key may repeat.
_TEXT = """WITH text AS (SELECT o_orderdate::DATE AS day, l_orderkey AS k, l_linenumber AS line,
  CASE WHEN l_orderkey % 211 = 0 THEN '' ELSE l_orderkey::VARCHAR END AS call,
  CASE WHEN l_orderkey % 223 = 0 THEN 'x' || l_linenumber WHEN l_orderkey % 227 = 0 THEN NULL ELSE l_linenumber::VARCHAR END AS seq,
  CASE WHEN l_orderkey % 229 = 0 THEN '' WHEN l_orderkey % 233 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS begun,
  CASE WHEN l_orderkey % 239 = 0 THEN '1997-02-30 10:00:00' WHEN l_orderkey % 241 = 0 THEN '1990-01-01 00:00:00' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS ended,
  o_orderpriority AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
marked AS (SELECT *, call <> '' AND coalesce(seq, '') <> '' AS keyed, try_strptime(begun, '%Y-%m-%d %H:%M:%S') AS b, try_strptime(ended, '%Y-%m-%d %H:%M:%S') AS e FROM text)"""
_KNOWN = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def _text(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    k, line = F.col("l_orderkey"), F.col("l_linenumber").cast("string")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return j.select(
        F.to_date("o_orderdate").alias("day"),
        F.when(k % 211 == 0, "").otherwise(k.cast("string")).alias("call"),
        F.when(k % 223 == 0, F.concat(F.lit("x"), line)).when(k % 227 == 0, F.lit(None)).otherwise(line).alias("seq"),
        F.when(k % 229 == 0, "").when(k % 233 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(shown("o_orderdate")).alias("begun"),
        F.when(k % 239 == 0, "1997-02-30 10:00:00").when(k % 241 == 0, "1990-01-01 00:00:00").otherwise(shown("l_shipdate")).alias("ended"),
        F.col("o_orderpriority").alias("kind"),
    )


@query("str_07_call_records", f"""{_TEXT}, f AS (SELECT day, count(*) FILTER (WHERE NOT keyed) AS empty_key, count(*) FILTER (WHERE keyed AND seq LIKE 'x%') AS bad_seq, count(*) FILTER (WHERE begun = '') AS empty_start,
  count(*) FILTER (WHERE begun <> '' AND b IS NULL) AS bad_begun, count(*) FILTER (WHERE ended <> '' AND e IS NULL) AS bad_ended, count(*) FILTER (WHERE e < b) AS ended_before_begun, count(*) AS n FROM marked GROUP BY 1),
  r AS (SELECT day, count(*) AS repeated_seq FROM (SELECT day FROM marked WHERE keyed GROUP BY day, call, seq HAVING count(*) > 1) GROUP BY 1)
  SELECT f.*, coalesce(repeated_seq, 0) AS repeated_seq, CASE WHEN empty_key + bad_seq + empty_start + bad_begun + bad_ended + ended_before_begun + coalesce(repeated_seq, 0) > 0 THEN 'pending' ELSE 'accepted' END AS state FROM f LEFT JOIN r USING (day)""")
def _(spark, sf):
    found = batch_checks.leg_findings(_text(spark, sf), ["day"], "call", "seq", "begun", ["begun", "ended"], [("begun", "ended")])
    fatal = [c for c in found.columns if c not in ("day", "n")]
    return quality.verdicts(found, fatal).drop("reason")


@query("str_07_unknown_call_types", f"{_TEXT} SELECT day, kind AS value, count(*) AS rows FROM marked WHERE kind NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 1, 2")
def _(spark, sf):
    return batch_checks.unknown_values(_text(spark, sf), ["day"], "kind", _KNOWN)


# --- agents' sessions and days ---------------------------------------------------------------------

_SEEN = """WITH seen AS (SELECT ts::DATE AS day, event_id AS n, CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id::VARCHAR END AS id, user_id % 50 <> 0 AS asked FROM events),
agents AS (SELECT day, id, count(*) AS n, bool_or(asked) AS asked FROM seen WHERE id IS NOT NULL GROUP BY 1, 2),
a AS (SELECT day, count(*) FILTER (WHERE n > 1) AS repeated_agents, count(*) FILTER (WHERE NOT asked) AS not_asked FROM agents GROUP BY 1)"""


def _seen(spark, sf):
    n = F.col("event_id")
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), n.alias("n"), F.when(n % 97 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("id"), "user_id")
    asked = table(spark, sf, "events").filter("user_id % 50 <> 0").select(F.col("user_id").cast("string").alias("id")).distinct()
    return e, asked


@query("str_09_day_records", f"""{_SEEN} SELECT day, records, without_id, missing, repeated, not_whole, unknown, coalesce(repeated_agents, 0) AS repeated_agents, coalesce(not_asked, 0) AS not_asked
  FROM (SELECT day, count(*) AS records, count(*) FILTER (WHERE id IS NULL) AS without_id, count(*) FILTER (WHERE n % 13 = 0) AS missing, count(*) FILTER (WHERE n % 17 = 0) AS repeated,
    count(*) FILTER (WHERE n % 23 = 0 AND n % 17 <> 0) + count(*) FILTER (WHERE n % 29 = 0 AND n % 13 <> 0) AS not_whole, count(*) FILTER (WHERE n % 19 = 0) AS unknown FROM seen GROUP BY 1) LEFT JOIN a USING (day)""")
def _(spark, sf):
    e, asked = _seen(spark, sf)
    index = lambda name, value: F.struct(F.lit(name).alias("id"), value.cast("string").alias("val"))
    n = F.col("n")
    first = index("I1", F.when(n % 23 == 0, "1.5").otherwise(n.cast("string")))
    second = index("I2", F.when(n % 29 == 0, "x").when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("-"), n % 5)))
    listed = F.array_compact(F.array(first, F.when(n % 17 == 0, first), F.when(n % 13 != 0, second), F.when(n % 19 == 0, index("I9", F.lit(1)))))
    rows = e.select("day", F.to_json(F.struct("id", listed.alias("idxs"))).alias("payload"))
    return batch_checks.day_findings(rows, asked, ["day"], ["I1", "I2"])


@query("str_09_session_records", f"""{_SEEN}, i AS (SELECT day, id, n, CASE WHEN n % 31 = 0 THEN '2024-1-1 00:00:00' ELSE '2024-01-01 00:00:' || lpad((n % 2)::VARCHAR, 2, '0') END AS b, n % 13 = 0 OR n % 17 = 0 AS off FROM seen)
  SELECT r.*, coalesce(repeated_agents, 0) AS repeated_agents, coalesce(not_asked, 0) AS not_asked, coalesce(bad_in_time, 0) AS bad_in_time, coalesce(bad_out_time, 0) AS bad_out_time, coalesce(out_before_in, 0) AS out_before_in, coalesce(bad_duration, 0) AS bad_duration,
    coalesce(intervals, 0) AS intervals, coalesce(repeated_intervals, 0) AS repeated_intervals
  FROM (SELECT day, count(*) FILTER (WHERE id IS NULL) AS without_id, 0::BIGINT AS without_index_list, count(*) FILTER (WHERE n % 13 = 0 OR n % 17 = 0) AS index_missing_or_repeated, count(*) AS records FROM seen GROUP BY 1) r
  LEFT JOIN a USING (day)
  LEFT JOIN (SELECT day, count(*) AS intervals, count(*) FILTER (WHERE n % 31 = 0) AS bad_in_time, count(*) FILTER (WHERE n % 31 <> 0 AND n % 37 = 0) AS bad_out_time, count(*) FILTER (WHERE n % 31 <> 0 AND n % 37 <> 0 AND n % 41 = 0) AS out_before_in,
    count(*) FILTER (WHERE n % 43 = 0) AS bad_duration FROM i WHERE NOT off AND n % 7 <> 0 GROUP BY 1) USING (day)
  LEFT JOIN (SELECT day, count(*) FILTER (WHERE c > 1) AS repeated_intervals FROM (SELECT day, id, b, count(*) AS c FROM i WHERE NOT off AND n % 7 <> 0 GROUP BY ALL) GROUP BY 1) USING (day)""")
def _(spark, sf):
    e, asked = _seen(spark, sf)
    n = F.col("n")
    begin = F.when(n % 31 == 0, "2024-1-1 00:00:00").otherwise(F.concat(F.lit("2024-01-01 00:00:"), F.lpad((n % 2).cast("string"), 2, "0")))
    end = F.when(n % 37 == 0, "later").when(n % 41 == 0, "2023-12-31 23:59:59").when(n % 5 == 0, "").otherwise("2024-01-01 08:00:00")
    spans = F.array(F.struct(begin.alias("inTime"), end.alias("outTime"), F.when(n % 43 == 0, "1h").when(n % 3 == 0, "").otherwise("60").alias("duration")))
    # the value of the index is an array of intervals, or null: no interval that day
    index = F.struct(F.lit("S").alias("id"), F.when(n % 7 != 0, spans).alias("val"))
    listed = F.array_compact(F.array(F.when(n % 13 != 0, index), F.when(n % 17 == 0, index), F.when((n % 13 == 0) & (n % 17 == 0), index)))
    # of records that are off, some have none and some have two
    listed = F.when((n % 13 == 0) & (n % 17 == 0), F.array(index, index)).otherwise(listed)
    rows = e.select("day", F.to_json(F.struct("id", listed.alias("idxs")), {"ignoreNullFields": "false"}).alias("payload"))
    return batch_checks.session_findings(rows, asked, ["day"], "S")


# --- the 24-hour guard -----------------------------------------------------------------------------


@query("inc_09_withheld_keys", f"""{BASE}, stored AS (SELECT * FROM obs WHERE batch_seq % 3 = 0 QUALIFY row_number() OVER (PARTITION BY call_id, line ORDER BY observed_at DESC, content_hash) = 1),
  c AS (SELECT call_id, line, min(observed_at) AS a, max(observed_at) AS b, count(*) AS observations FROM obs WHERE batch_seq % 3 <> 0 GROUP BY 1, 2),
  w AS (SELECT c.call_id, c.line, observations, epoch(greatest(b, s.observed_at)) - epoch(least(a, s.observed_at)) > 86400 AS wide FROM c LEFT JOIN stored s USING (call_id, line))
  SELECT call_id, line, wide AS withheld, observations, wide AND call_id % 10 <> 0 AS raised FROM w""")
def _(spark, sf):
    seen = observed_legs(spark, sf)
    stored = incremental.newest(seen.filter("batch_seq % 3 = 0"), LEG, "observed_at", "content_hash")
    writable, withheld = incremental.guarded(seen.filter("batch_seq % 3 <> 0"), stored, LEG, "observed_at")
    name = F.concat_ws("|", *LEG)
    queue = table(spark, sf, "lineitem").filter("l_orderkey % 10 = 0").select(F.lit("legs").alias("source_id"), F.lit("call_id|line").alias("column_name"), F.concat_ws("|", "l_orderkey", "l_linenumber").alias("value"), F.lit("open").alias("status")).distinct()
    items = incremental.guard_items(withheld, queue, "legs", "call_id|line", name).select("value", F.lit(True).alias("raised"))
    kept = writable.groupBy(*LEG).agg(F.count(F.lit(1)).alias("observations"), F.lit(False).alias("withheld"))
    every = kept.unionByName(withheld.withColumn("withheld", F.lit(True))).withColumn("value", name)
    return every.join(items, "value", "left").select(*LEG, "withheld", "observations", F.coalesce("raised", F.lit(False)).alias("raised"))


# --- marks -----------------------------------------------------------------------------------------

#: Marks of an agent, overlapping and with gaps: [from, to).
_MARKS = ((1, "1995-03-01", "1996-01-01"), (2, "1995-06-01", "1995-09-01"), (3, "1997-01-01", "1999-01-01"), (4, "1998-01-01", "1998-06-01"))
_MARKS_SQL = ", ".join(f"({m}, epoch(TIMESTAMP '{a}')::BIGINT, epoch(TIMESTAMP '{b}')::BIGINT)" for m, a, b in _MARKS)


@query("jn_06_mark_containing_and_last_ended", f"""{BASE}, marks AS (SELECT s_suppkey AS device_no, m AS mark, f, t FROM supplier, (VALUES {_MARKS_SQL}) v(m, f, t) WHERE (s_suppkey + m) % 3 <> 0)
  SELECT call_id, line, (SELECT arg_max(mark, f) FROM marks m WHERE m.device_no = l.device_no AND f <= l.wait_begin AND l.wait_begin < t) AS in_mark,
    (SELECT arg_max(mark, t) FROM marks m WHERE m.device_no = l.device_no AND t <= l.wait_begin) AS ended_mark FROM legs l WHERE device_type_code = 2""")
def _(spark, sf):
    points = legs(spark, sf).filter("device_type_code = 2").select("device_no", "wait_begin", *LEG)
    rows = F.inline(F.array(*(F.struct(F.lit(m).alias("mark"), F.lit(a).cast("timestamp").alias("valid_from"), F.lit(b).cast("timestamp").alias("valid_to")) for m, a, b in _MARKS)))
    marks = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("device_no"), rows).filter("(device_no + mark) % 3 <> 0")
    return intervals.contained_or_last_ended(points, marks, "device_no", "wait_begin", ["mark"], LEG).select(*LEG, "in_mark", "ended_mark")


# --- windows, days and publication from what the tables hold ----------------------------------------


@query("str_01_slices_of_events", """WITH b AS (SELECT floor(epoch(min(ts)))::BIGINT AS a, floor(epoch(max(ts)))::BIGINT AS b FROM events), s AS (SELECT unnest(range(a, b, 1200)) AS s, b FROM b)
  SELECT CASE WHEN least(s + 1200, b) - s >= 600 THEN s ELSE b - 600 END AS slice_from, least(s + 1200, b) AS slice_to FROM s""")
def _(spark, sf):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    first, last = table(spark, sf, "events").agg(F.min(at), F.max(at)).first()
    return spark.createDataFrame(windows.slices(first, last, 1200, 600), "slice_from long, slice_to long")


@query("dq_01_columns_of_orders", """SELECT coalesce(m.name, c.name) AS name, CASE WHEN m.name IS NULL THEN 'missing' ELSE 'extra' END AS finding FROM (SELECT column_name AS name FROM information_schema.columns WHERE table_name = 'orders') m
  FULL JOIN (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_clerk_id', 'o_orderdate']) AS name) c USING (name) WHERE m.name IS NULL OR c.name IS NULL""")
def _(spark, sf):
    names = lambda n: spark.createDataFrame([(x,) for x in n], "name string")
    return quality.columns_match(names(table(spark, sf, "orders").columns), names(["o_orderkey", "o_custkey", "o_orderstatus", "o_clerk_id", "o_orderdate"]), "name")


_TODAY = "2001-07-15"
#: Days of orders are closed while all their orders are finished, versions by how often they were corrected.
_CLOSED = f"WITH days AS (SELECT o_orderdate::DATE AS day, max(o_orderkey % 3) AS top FROM orders GROUP BY 1), closed AS (SELECT day, top FROM days WHERE day < DATE '{_TODAY}' - 12)"


def _closed(spark, sf):
    """A record of the days that have orders: versions 0 up to the largest of o_orderkey % 3."""
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.max(F.col("o_orderkey") % 3).cast("int").alias("top"))
    days = days.filter(F.col("day") < F.date_sub(F.lit(_TODAY).cast("date"), 12))
    return days.select(F.lit("m").alias("mart"), "day", F.explode(F.sequence(F.lit(0), "top")).alias("close_version"), F.lit(1).cast("long").alias("publication_seq"), F.lit(1).cast("long").alias("row_count"))


_OPEN = f"{_CLOSED}, ends AS (SELECT max(day) + 1 AS a FROM closed WHERE top >= 1), open AS (SELECT unnest(generate_series(a, DATE '{_TODAY}', INTERVAL 1 DAY))::DATE AS day FROM ends)"


def _open(spark, sf):
    return publication.open_days(spark, _closed(spark, sf), "m", F.lit("1995-01-01").cast("date"), _TODAY)


@query("pub_01_open_days_after_orders", f"{_OPEN} SELECT day FROM open")
def _(spark, sf):
    return _open(spark, sf)


@query("pub_02_intraday_after_orders", f"{_OPEN} SELECT day, 0 AS close_version FROM open WHERE day > DATE '{_TODAY}' - 7")
def _(spark, sf):
    return publication.intraday(_open(spark, sf), _TODAY)


@query("dq_17_closing_behind_orders", f"{_CLOSED} SELECT max(day) AS last_closed FROM closed WHERE top >= 1")
def _(spark, sf):
    return quality.closing_behind(_closed(spark, sf), "m", F.lit(_TODAY).cast("date"))


#: A source day is swept by the run of its lines: it failed where a line came back in the day, and waits on open ones.
_SWEPT = f"""{_OPEN}, runs AS (SELECT l_shipdate::DATE AS day, bool_or(l_orderkey % 151 = 0) AS failed, bool_and(l_orderkey % 163 <> 0) AS settled FROM lineitem GROUP BY 1),
swept AS (SELECT day FROM runs WHERE NOT failed AND settled),
final AS (SELECT day FROM open o WHERE (day - 1 IN (SELECT day FROM swept)) AND (day IN (SELECT day FROM swept)))"""


def _swept(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("source_day")).agg(F.bool_or(F.col("l_orderkey") % 151 == 0).alias("failed"), F.bool_and(F.col("l_orderkey") % 163 != 0).alias("settled"))
    lines = lines.withColumn("run_id", F.col("source_day").cast("string"))
    sweeps = lines.select("source_day", "run_id", F.when(F.col("failed"), "failed").otherwise("succeeded").alias("outcome"))
    batches = lines.select("run_id", F.lit(1).alias("batch_seq"), "settled")
    days = _open(spark, sf)
    return days, publication.final_days(days, sweeps, batches, F.lit("1990-01-01").cast("date"), "UTC", "Asia/Riyadh")


@query("pub_03_final_days_of_lines", f"{_SWEPT} SELECT day FROM final")
def _(spark, sf):
    return _swept(spark, sf)[1]


@query("pub_04_closable_days_of_lines", f"{_SWEPT} SELECT day, 1 AS close_version FROM final WHERE day < coalesce((SELECT min(day) FROM open WHERE day NOT IN (SELECT day FROM final)), DATE '9999-12-31')")
def _(spark, sf):
    return publication.closable(*_swept(spark, sf))


@query("qry_04_versions_of_orders", f"""{_CLOSED}, asked AS (SELECT unnest(generate_series(DATE '1999-01-01', DATE '2001-07-31', INTERVAL 1 DAY))::DATE AS day)
  SELECT a.day, CASE WHEN top >= 1 THEN 1 END AS close_version, CASE WHEN top IS NULL THEN 'not_built' WHEN top = 0 THEN 'not_closed' ELSE 'published' END AS status FROM asked a LEFT JOIN closed USING (day)""")
def _(spark, sf):
    return semantic.choose_versions(_closed(spark, sf), "m", date(1999, 1, 1), date(2001, 7, 31), "as_closed").select("day", "close_version", "status")


@query("str_13_current_states", "SELECT user_id, event_type AS state, ts AS since FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, sf):
    from ..streaming.live import current

    return current(table(spark, sf, "events").select("user_id", F.col("event_type").alias("state"), F.col("ts").alias("since"), F.col("event_id").alias("seq")), "user_id", "since", "seq").select("user_id", "state", "since")


_CONTRACT = {"classes": {"release_cause": {"agent": [0, 4], "caller": [1, 5], "system": [2]}}}


@query("prj_11_classes_of_the_contract", "SELECT CASE WHEN o_custkey % 6 IN (0, 4) THEN 'agent' WHEN o_custkey % 6 IN (1, 5) THEN 'caller' WHEN o_custkey % 6 = 2 THEN 'system' ELSE 'unmapped' END AS released_by, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    from ..sources.contracts import at

    classes = F.lit("unmapped")
    for name, members in at(_CONTRACT, "classes.release_cause").items():
        classes = F.when((F.col("o_custkey") % 6).isin(members), name).otherwise(classes)
    return table(spark, sf, "orders").groupBy(classes.alias("released_by")).agg(F.count(F.lit(1)).alias("n"))
