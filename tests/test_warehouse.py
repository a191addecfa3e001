from datetime import date

import pytest
from pyspark.sql import functions as F

from dispatchlake.operators import calls, incremental, incidents, intervals, scd2
from dispatchlake.plans import controlled, marts, publication, semantic
from dispatchlake.sources import contracts, files, polled
from dispatchlake.streaming import runner

T = "cast('{}' as timestamp)"


def leg(call, seq, device, no, at, wait=0, talk=None, released=None, direction="inbound"):
    base = 1_700_000_000 + at
    return (call, seq, device, no, base, base + wait, base + wait if talk is not None else None, base + wait + talk if talk is not None else None, wait, talk, released, direction, "c", 20231114)


LEGS = "call_id string, leg_seq int, device_type_code int, device_no long, wait_begin long, wait_end long, call_begin long, call_end long, wait_seconds long, talk_seconds long, release_source string, direction string, caller string, date_key int"


def test_call_results(spark):
    rows = [
        leg("answered", 1, 3, 0, 0), leg("answered", 2, 1, 5, 10, 15), leg("answered", -1, 2, 77, 30, 2, 60, "agent"),
        leg("abandoned", 1, 1, 5, 0, 40), leg("abandoned", -1, 2, 8, 50, 5, None, "caller"),
        leg("timeout", -1, 1, 5, 0, 40, None, "system"),
        leg("ivr", -1, 3, 0, 0, 0, None, "caller"),
        leg("open", 1, 1, 6, 0, 10), leg("open", 2, 2, 9, 20, 1, 5),
        leg("moved", 1, 2, 1, 0, 0, 5), leg("moved", -1, 2, 2, 10, 0, 5, "caller"),
        leg("late", 3, 1, 6, 0), leg("late", -1, 1, 7, 5, 0, None, "caller"),
    ]
    got = {r["call_id"]: r for r in calls.from_legs(spark.createDataFrame(rows, LEGS)).collect()}
    assert {k: r["call_result"] for k, r in got.items()} == {"answered": "answered", "abandoned": "abandoned", "timeout": "unanswered_system", "ivr": "ivr_only", "open": None, "moved": "answered", "late": "abandoned"}
    assert got["answered"]["first_queue"] == 5 and got["answered"]["agent_no"] == 77 and got["answered"]["wait_seconds"] == 15 and got["answered"]["talk_seconds"] == 60
    assert got["moved"]["is_transferred"] and not got["answered"]["is_transferred"] and got["moved"]["agent_no"] == 1
    assert got["open"]["ended_at"] is None and not got["open"]["is_complete"] and got["late"]["first_leg_seq"] == 3
    again = calls.recomputed(spark.createDataFrame(rows, LEGS)).collect()
    assert all(got[r["call_id"]][c] == r[c] for r in again for c in ("direction", "first_queue", "agent_no", "answered_legs"))


def test_upsert_keeps_the_newer_observation(spark):
    shape = "k int, v string, at int"
    stored = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, None, 5), (4, "d", 5)], shape)
    new = spark.createDataFrame([(1, "a", 9), (2, "c", 4), (3, "x", 5), (5, "n", 1)], shape)
    written = incremental.upserts(new, stored, ["k"], ["v"], "at")
    assert sorted(r["k"] for r in written.collect()) == [3, 5]
    assert {r["k"]: r["v"] for r in incremental.merged(stored, written, ["k"]).collect()} == {1: "a", 2: "b", 3: "x", 4: "d", 5: "n"}


def test_a_value_that_returns_is_written_again(spark):
    shape = "k int, content_hash string, at int, run_id string, batch_seq int"
    stored = spark.createDataFrame([(1, "A", 1, "r", 1), (1, "B", 2, "r", 2)], shape)
    come = spark.createDataFrame([(1, "A", 3, "r", 3), (2, "A", 3, "r", 3)], shape)
    assert incremental.changed_since_last(come, stored, ["k"], "at").count() == 2
    assert incremental.new_rows(come, stored, spark.createDataFrame([("r", 1, "pending")], "run_id string, batch_seq int, state string"), ["k"]).count() == 2
    assert incremental.new_rows(come, stored, spark.createDataFrame([], "run_id string, batch_seq int, state string"), ["k"]).count() == 1


def test_timeline_on_an_existing_dimension(spark):
    ts = lambda s: F.lit(s).cast("timestamp")
    current = spark.createDataFrame([("a", "Ann", None), ("b", "Bob", None), ("c", "Cid", None)], "k string, name string, role string").withColumns({"valid_from": ts("2026-01-01"), "valid_to": ts(scd2.OPEN)})
    snaps = spark.createDataFrame([("a", "Ann", "2026-02-01"), ("b", "Rob", "2026-02-01"), ("d", "Dan", "2026-02-01"), ("a", "Ann", "2026-03-01"), ("b", "Rob", "2026-03-01"), ("c", "Cid", "2026-03-01")], "k string, name string, t string").select("k", "name", F.col("t").cast("timestamp").alias("snapshot_at"))
    marks = spark.createDataFrame([("a", "2026-02-10", "2026-02-20", "lead"), ("a", "2026-12-01", "2026-12-02", "later")], "k string, s string, e string, role string").select("k", F.col("s").cast("timestamp").alias("starts_at"), F.col("e").cast("timestamp").alias("ends_at"), "role")
    changes = scd2.timeline(snaps, snaps.select("snapshot_at"), marks, current, "k", ["name"], ts("2026-06-01"))
    got = sorted((r["k"], str(r["at"])[:10], r["present"], r["name"], r["role"], str(r["next_at"])[:10]) for r in changes.collect())
    assert got == [
        ("a", "2026-02-10", True, "Ann", "lead", "2026-02-20"), ("a", "2026-02-20", True, "Ann", None, "None"),
        ("b", "2026-02-01", True, "Rob", None, "None"),
        ("c", "2026-02-01", False, None, None, "2026-03-01"), ("c", "2026-03-01", True, "Cid", None, "None"),
        ("d", "2026-02-01", True, "Dan", None, "2026-03-01"), ("d", "2026-03-01", False, None, None, "None"),
    ]
    versions = scd2.closed(current, changes, "k").unionByName(scd2.new_versions(changes, "k", ["name"], ts("2026-01-01")))
    assert intervals.overlapping(versions, "k").count() == 0
    assert {r["k"] for r in scd2.to_reconfirm(changes, "k", "name").collect()} == {"b"}


def test_publisher_closes_and_corrects(spark, tmp_path):
    p = publication.Publisher(spark, str(tmp_path), "m")
    rows = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "d string, n int").select(F.col("d").cast("date").alias("day"), "n")
    days = publication.days_of(spark, "2026-01-01", "2026-01-03").withColumn("close_version", F.lit(1))
    assert p.publish(rows, days) == 1
    changed = rows.withColumn("n", F.when(F.dayofmonth("day") == 2, 9).otherwise(F.col("n")))
    fixes = publication.corrections(p.record(), "m", p.rows(), changed)
    assert [(str(r["day"]), r["close_version"]) for r in fixes.collect()] == [("2026-01-02", 2)]
    assert p.publish(changed, fixes) == 2
    assert p.record().count() == 4 and p.rows().count() == 3
    gone = publication.corrections(p.record(), "m", p.rows(), changed.filter("n <> 9"))
    p.publish(changed.filter("n <> 9"), gone)
    last = p.record().filter("close_version = 3").first()
    assert (str(last["day"]), last["row_count"]) == ("2026-01-02", 0)
    # the newest version is chosen before anything is filtered: the day has no rows, and none come back
    chosen = semantic.choose_versions(p.record(), "m", date(2026, 1, 1), date(2026, 1, 4))
    assert {str(r["day"])[-2:]: (r["close_version"], r["status"]) for r in chosen.collect()} == {"01": (1, "published"), "02": (3, "published"), "03": (1, "published"), "04": (None, "not_built")}


ADMIN = semantic.Principal("u", ("admin",))


@pytest.mark.parametrize(
    ("code", "request_", "principal"),
    [
        ("no_role", {}, semantic.Principal("u", ())),
        ("several_roles", {}, semantic.Principal("u", ("admin", "agent"))),
        ("unknown_metric", {"metrics": ("M-X",)}, ADMIN),
        ("not_implemented", {"metrics": ("M-C08",)}, ADMIN),
        ("incompatible_grain", {"metrics": ("M-C01", "M-C05")}, ADMIN),
        ("range_too_long", {"last": date(2030, 1, 1)}, ADMIN),
        ("invalid_range", {"last": date(2020, 1, 1)}, ADMIN),
        ("duplicate_item", {"metrics": ("M-C01", "M-C01")}, ADMIN),
        ("unknown_dimension", {"dimensions": ("date",)}, ADMIN),
        ("unknown_dimension", {"granularity": "hour"}, ADMIN),
        ("empty_filter", {"metrics": ("M-C05",), "filters": {"queue": ()}}, ADMIN),
        ("metric_forbidden", {"metrics": ("M-C09",)}, semantic.Principal("u", ("analyst",))),
        ("scope_unresolved", {"metrics": ("M-C09",)}, semantic.Principal("u", ("agent",))),
    ],
)
def test_refusals(code, request_, principal):
    base = {"metrics": ("M-C01",), "first": date(2026, 1, 1), "last": date(2026, 1, 31)}
    with pytest.raises(semantic.ERRORS[code]):
        semantic.plan(semantic.Request(**(base | request_)), principal)


def test_metric_versions_by_day_only():
    two = (semantic.Metric("M", 1, "calls_day_volume", "offered"), semantic.Metric("M", 2, "calls_day_volume", "answered", effective_from=date(2026, 1, 10)))
    base = {"metrics": ("M",), "first": date(2026, 1, 1), "last": date(2026, 1, 31)}
    with pytest.raises(semantic.ERRORS["version_boundary"]):
        semantic.plan(semantic.Request(**base), ADMIN, two)
    p = semantic.plan(semantic.Request(**base, granularity="day"), ADMIN, two)
    assert [(a.day, b.day, m.version) for a, b, m in p.segments["M"]] == [(1, 9, 1), (10, 31, 2)]


def test_answer_is_audited_first(spark):
    day = F.col("d").cast("date").alias("day")
    rows = spark.createDataFrame([("2026-01-01", 1, 4, 3), ("2026-01-02", 1, 0, 0)], "d string, close_version int, offered long, answered long").select(day, "close_version", "offered", "answered")
    record = spark.createDataFrame([("calls_day_volume", "2026-01-01", 1, 1), ("calls_day_volume", "2026-01-02", 1, 1)], "mart string, d string, close_version int, publication_seq long").select("mart", day, "close_version", "publication_seq")
    log = []
    request = semantic.Request(("M-C04",), date(2026, 1, 1), date(2026, 1, 3), granularity="day")
    found, meta = semantic.answer(request, ADMIN, lambda m: rows, record, log.append)
    assert [r["M-C04"] for r in found] == [0.75, None] and meta["states"]["not_built"] == 1 and len(log) == 1 and len(meta["cache_key"]) == 64

    def broken(entry):
        raise OSError

    with pytest.raises(semantic.ERRORS["audit_failed"]):
        semantic.answer(request, ADMIN, lambda m: rows, record, broken)
    with pytest.raises(semantic.ERRORS["unknown_metric"]):
        semantic.answer(semantic.Request(("X",), date(2026, 1, 1), date(2026, 1, 3)), ADMIN, lambda m: rows, record, log.append)
    assert log[-1]["outcome"] == "unknown_metric"


def test_row_filter_reaches_the_scan_before_the_aggregate(spark):
    rows = spark.createDataFrame([("7", 1), ("8", 1)], "agent string, presented long").withColumns({"day": F.lit(date(2026, 1, 1)), "close_version": F.lit(1)})
    record = spark.createDataFrame([("legs_day_agent_handling", date(2026, 1, 1), 1, 1)], "mart string, day date, close_version int, publication_seq long")
    p = semantic.plan(semantic.Request(("M-C09",), date(2026, 1, 1), date(2026, 1, 1), ("agent",)), semantic.Principal("u", ("agent",), "7"))
    out, _ = semantic.execute(p, rows, record)
    assert [tuple(r)[:2] for r in out.collect()] == [("7", 1.0)]


RAW = {"source_id": "cdr", "version": 2, "connector": "file_drop", "columns": ["ID", "SEQ", "AT"], "key": ["ID", "SEQ"]}


def test_contracts():
    c = contracts.contract(RAW)
    assert c.schema().names == ["ID", "SEQ", "AT"] and contracts.overridden(c, 60).lookback_minutes == 60
    wrong = contracts.problems(RAW | {"connector": "ftp", "key": ["X"], "lookback_minutes": 5000, "columns": ["ID", "ID"]})
    assert [w.split()[0] for w in wrong] == ["connector", "window.lookback_minutes", "columns[].src", "idempotent_key[]"]
    for f in (lambda: contracts.overridden(c, 5), lambda: contracts.load("a: 1\na: 2\n"), lambda: contracts.sync({"cdr": (2, "other")}, c), lambda: contracts.sync({"cdr": (3, "x")}, c)):
        with pytest.raises(ValueError):
            f()
    assert [contracts.sync(s, c) for s in ({}, {"cdr": (2, c.digest())}, {"cdr": (1, "x")})] == ["insert", "unchanged", "update"]
    m = semantic.CATALOG[0]
    assert contracts.sync_metrics({("M-C01", 1): (m.definition_hash(), None)}, [m], True) == {("M-C01", 1): "unchanged"}
    with pytest.raises(ValueError):
        contracts.sync_metrics({("M-C01", 1): ("x", None)}, [m], True)


def test_csv_batches_are_whole_or_refused(spark, tmp_path):
    c = contracts.contract(RAW)
    write = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8") and str(tmp_path / name)
    good = files.read_csv(spark, write("good.csv", 'ID,SEQ,AT\n1,-1,"a,b"\n2,,""\n'), c)
    assert [tuple(r) for r in good.collect()] == [("1", "-1", "a,b"), ("2", "", "")]
    for name, text in (("ragged.csv", "ID,SEQ,AT\n1,2\n"), ("more.csv", "ID,SEQ,AT\n1,2,3,4\n"), ("missing.csv", "ID,SEQ\n1,2\n"), ("extra.csv", "ID,SEQ,AT,NEW\n1,2,3,4\n"), ("other order.csv", "SEQ,ID,AT\n1,2,3\n"), ("blank.csv", "ID,SEQ,AT\n\n1,2,3\n"), ("twice.csv", "ID,SEQ,AT,ID\n1,2,3,4\n"), ("bom.csv", "﻿ID,SEQ,AT\n1,2,3\n")):
        with pytest.raises(files.Rejected):
            files.read_csv(spark, write(name, text), c)
    (tmp_path / "empty.csv").touch()
    with pytest.raises(files.Rejected):
        files.read_csv(spark, str(tmp_path / "empty.csv"), c)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    files.overwrite_partitions(rows, str(tmp_path / "t"), ["p"])
    files.overwrite_partitions(spark.createDataFrame([(9, "b")], "n int, p string"), str(tmp_path / "t"), ["p"])
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 9]
    files.append_raw(rows.withColumn("ingest_month", F.lit("2026-01")), str(tmp_path / "raw"))
    files.append_raw(rows.withColumn("ingest_month", F.lit("2026-02")), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 4
    files.export(rows, str(tmp_path / "out"), "csv")
    with pytest.raises(ValueError):
        files.export(rows, str(tmp_path / "out2"), "xml")


def test_polled_sources(spark):
    decision, rows = polled.snapshot(spark, "r", 1, "agents", 3, {"version": 4}, lambda: [{"a": 1}, {"a": 2}])
    assert decision == "take" and rows.count() == 2
    assert polled.snapshot(spark, "r", 1, "agents", 4, {"version": 4}, lambda: [{}])[0] == "same"
    assert polled.chunks(["10", "9", "2", "9"], 2) == [["2", "9"], ["10"]]
    assert polled.observations(spark, "r", ["1", "2", "3"], 2, lambda ids: [{"id": i} for i in ids]).select("batch_seq").distinct().count() == 2
    sent = []

    def send(request, token):
        sent.append(token)
        return {"header": {"retcode": polled.EXPIRED if token == "old" else "0"}}

    polled.call(send, lambda: "new", "q", "old")
    assert sent == ["old", "new"]
    with pytest.raises(RuntimeError):
        polled.call(lambda r, t: {"retcode": "7"}, lambda: "t", "q")
    a, b = (polled.synthetic(spark, 1, 0, 60, now) for now in (60, 60))
    assert a.exceptAll(b).count() == 0 and polled.synthetic(spark, 1, 0, 60, 30).filter("is_complete").count() < a.filter("is_complete").count()


def test_stream_equals_batch(spark, tmp_path):
    shape = "k int, v string, at int"
    batches = [[(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (2, "b", 1)], [(3, None, 3)], [(4, "x", -1)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        loader = runner.Loader(spark, str(tmp_path / "out"), ["k"], "at", ["v", "at"], {"bad_time": F.col("at") < 0})
        loader.run(spark.readStream.schema(shape).parquet(str(tmp_path / "in")), str(tmp_path / "cp"))
    assert sorted((r["k"], r["v"]) for r in loader.core().collect()) == [(1, "c"), (2, "b"), (3, None)]
    assert spark.read.parquet(str(tmp_path / "out/raw")).count() == 4 and spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 1
    loader.epoch(spark.createDataFrame([(9, "z", 9)], shape), 0)
    assert spark.read.parquet(str(tmp_path / "out/raw")).count() == 4


def test_three_arrival_metrics(spark):
    dispatches = spark.createDataFrame([(1, 1, 0, True), (1, 2, 0, False), (2, 1, 0, True)], "incident int, agency int, dispatched_at int, is_initial boolean")
    turnouts = spark.createDataFrame([(1, 1, 1, 10), (1, 1, 2, 20), (1, 2, 3, 6), (2, 1, 4, 30)], "incident int, agency int, officer int, arrived_at int")
    r = incidents.arrival_times(dispatches, turnouts).first()
    assert (r["turnout_mean"], round(r["dispatch_mean"], 4), r["incident_mean"]) == (16.5, 15.3333, 18.0)


def test_projection_to_metres(spark):
    east, north = incidents.utm(F.col("x"), F.col("y"))
    got = spark.createDataFrame([(39.0, 0.0), (39.8262, 21.4225)], "x double, y double").select(east, north).collect()
    assert abs(got[0][0] - 500000) < 1e-6 and abs(got[0][1]) < 1e-6
    assert abs(got[1][0] - 585_640) < 200 and abs(got[1][1] - 2_369_070) < 400


def test_closing_is_blocked_by_one_day(spark):
    days = publication.days_of(spark, "2030-01-14", "2030-01-16")
    sweeps = spark.createDataFrame([(f"2030-01-{d}", f"r{d}", "succeeded") for d in (13, 14, 15, 16)], "d string, run_id string, outcome string").select(F.col("d").cast("date").alias("source_day"), "run_id", "outcome")
    batches = lambda settled: spark.createDataFrame([(f"r{d}", 1, d != 15 or settled) for d in (13, 14, 15, 16)], "run_id string, batch_seq int, settled boolean")
    final = lambda s: publication.final_days(days, sweeps, batches(s), F.lit("2030-01-01").cast("date"), "UTC", "Asia/Riyadh")
    assert [str(r["day"]) for r in final(False).collect()] == ["2030-01-14"]
    assert final(True).count() == 3 and publication.closable(days, final(True)).count() == 3


def test_marts_zero_fill(spark):
    c = spark.createDataFrame([(20260101, "inbound", True, "abandoned", "x"), (20260101, "inbound", True, "abandoned", "x"), (20260102, "inbound", True, "answered", "y")], "date_key int, direction string, is_complete boolean, call_result string, caller_number string")
    assert sorted(map(tuple, marts.repeat_failed(c).collect())) == [(20260101, 1, 2), (20260102, 0, 0)]


def test_survey_items_have_rows_of_their_own():
    """Each job under a name with SQL that no other query has."""
    from collections import Counter

    from dispatchlake.plans import catalog

    used = Counter(catalog.ORACLE_SQL.values())
    for name in ("dq_03_session_and_day_links", "dq_13_unlinked_agent_and_queue_legs", "inc_12_upsert_sessions", "inc_12_upsert_days", "inc_03_core_batches_with_empty"):
        assert used[catalog.ORACLE_SQL[name]] == 1


def test_legs_of_a_type_without_dimension_are_silent(spark):
    from dispatchlake.operators import quality

    rows = spark.sql("select * from values (1, 5L, timestamp'2024-01-01'), (1, 6L, timestamp'2024-01-02'), (2, 5L, timestamp'2024-01-03'), (2, 7L, timestamp'2024-01-04') t(device_type_code, device_no, wait_begin)")
    queues = spark.sql("select 5L device_no, timestamp'2020-01-01' valid_from, timestamp'2030-01-01' valid_to")
    found = lambda dimensions: sorted((r[0], r[1], r[2]) for r in quality.legs_without_dimension(rows, dimensions).collect())
    assert found({1: queues, 2: queues}) == [(1, 6, 1), (2, 7, 1)]
    assert found({1: queues, 2: queues.filter("false")}) == [(1, 6, 1)]
    assert found({1: queues.filter("false")}) == []


def test_controlled_sql_never_cuts(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    views = frozenset({"three_rows"})
    assert controlled.controlled_sql(spark, "SELECT * FROM three_rows", views, 3).count() == 3
    assert controlled.controlled_sql(spark, "SELECT * FROM three_rows WHERE id > 7", views, 3).columns == ["id"]
    with pytest.raises(semantic.ERRORS["result_too_large"]):
        controlled.controlled_sql(spark, "SELECT * FROM three_rows", views, 2)
    with pytest.raises(semantic.ERRORS["metric_forbidden"]):
        controlled.controlled_sql(spark, "SELECT * FROM three_rows", views, principal=semantic.Principal("robot", ("admin",), natural=False))
    spark.range(200_000).createOrReplaceTempView("many_rows")
    slow = "SELECT count(*) AS n FROM many_rows a JOIN many_rows b ON a.id * b.id % 7 = 3 JOIN three_rows c ON c.id < a.id + b.id"
    with pytest.raises(semantic.ERRORS["result_too_large"], match="seconds"):
        controlled.controlled_sql(spark, slow, frozenset({"many_rows", "three_rows"}), seconds=1.5)
    assert controlled.controlled_sql(spark, "SELECT * FROM three_rows", views).count() == 3


def test_files_of_a_drop(spark, tmp_path):
    c = contracts.Contract("s", 1, "file_drop", ("id", "name"), ("id",))

    def drop(name, parts, rows=None, checksum=None):
        import json
        import zlib

        folder = tmp_path / name
        folder.mkdir()
        for file, text in parts.items():
            (folder / file).write_bytes(text if isinstance(text, bytes) else text.encode())
        lines = [line for text in parts.values() for line in (text if isinstance(text, bytes) else text.encode()).split(b"\n") if line]
        manifest = {"files": rows or {f: (t if isinstance(t, bytes) else t.encode()).count(b"\n") - 1 for f, t in parts.items()}, "checksum": checksum or sum(map(zlib.crc32, lines))}
        (folder / "manifest.json").write_text(json.dumps(manifest))
        return str(folder)

    # a valid replacement character, a record over two lines, a file without rows
    good = drop("good", {"a b.csv": "id,name\n1,x\n2,�\n", "b.csv": 'id,name\n3,"y\nz"\n', "c.csv": "id,name\n"}, rows={"a b.csv": 2, "b.csv": 1, "c.csv": 0})
    got = files.read_drop(spark, good, c)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [("1", "x"), ("2", "�"), ("3", "y\nz")]
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name\n1,x\n")
    (folder / "b.csv").write_text("id,name\n2,y\n")
    assert sorted(map(tuple, files.read_csv(spark, str(folder), c).select("id", "name").collect())) == [("1", "x"), ("2", "y")]
    for bad in (
        drop("marked", {"a.csv": "id,name\n1,x\n", "b.csv": "﻿id,name\n2,y\n"}),
        drop("missing", {"a.csv": "id,name\n1,x\n", "b.csv": "id,other\n2,y\n"}),
        drop("order", {"a.csv": "id,name\n1,x\n", "b.csv": "name,id\ny,2\n"}),
        drop("ragged", {"a.csv": "id,name\n1,x\n", "b.csv": "id,name\n2,y,z\n"}),
        drop("bytes", {"a.csv": b"id,name\n1,\xff\n"}),
        drop("rows", {"a.csv": "id,name\n1,x\n"}, rows={"a.csv": 2}),
        drop("sum", {"a.csv": "id,name\n1,x\n"}, checksum=1),
    ):
        with pytest.raises(files.Rejected):
            files.read_drop(spark, bad, c)
    (folder / "empty.csv").write_text("")
    with pytest.raises(files.Rejected):
        files.read_csv(spark, str(folder), c)


def test_migration_commits_and_reconciles_each_batch(spark, tmp_path):
    from dispatchlake.sources.files import Differs, migrate

    rows = {(e, y): spark.createDataFrame([(i, f"{e}{y}{i}") for i in range(5)], "id long, v string") for e in ("calls", "legs") for y in (2020, 2021)}
    asked = []

    def read(entity, year):
        asked.append((entity, year))
        return rows[entity, year]

    years = {"calls": [2020, 2021], "legs": [2020, 2021]}
    told = migrate(read, years, str(tmp_path / "m"), "id")
    assert [(b["entity"], b["year"], b["rows"], b["keys"]) for b in told] == [(e, y, 5, 5) for e, y in rows] and len(asked) == 4
    assert spark.read.parquet(str(tmp_path / "m" / "calls")).groupBy("year").count().count() == 2
    # what was committed is not written again
    before = sorted(p.name for p in (tmp_path / "m" / "calls" / "year=2020").iterdir())
    assert migrate(read, years, str(tmp_path / "m"), "id") == told and sorted(p.name for p in (tmp_path / "m" / "calls" / "year=2020").iterdir()) == before
    # a source that gives other rows each time it is read cannot be reconciled
    def drawn(batches):
        import uuid

        for b in batches:
            yield b.assign(v=[str(uuid.uuid4()) for _ in range(len(b))])

    unsteady = lambda e, y: spark.range(5).mapInPandas(drawn, "id long, v string")
    with pytest.raises(Differs):
        migrate(unsteady, {"other": [2020]}, str(tmp_path / "m"), "id")


def test_observations_are_fetched_by_tasks(spark):
    found = polled.observations(spark, "r", [str(i) for i in range(25)], 10, lambda ids: [{"id": i} for i in ids])
    got = found.collect()
    assert len(got) == 25 and {r["batch_seq"] for r in got} == {0, 1, 2} and found.rdd.getNumPartitions() > 1


def test_places_without_one_task(spark):
    from dispatchlake.operators.ordering import places

    values = [7, 7, None, -3, *range(100, 1100), 5, None]
    got = places(spark.createDataFrame([(v,) for v in values], "v long").repartition(5), F.col("v"), "at", ranges=20).collect()
    assert sorted(r["at"] for r in got) == list(range(1, len(values) + 1))
    assert [r["v"] for r in sorted(got, key=lambda r: r["at"])] == [*sorted(v for v in values if v is not None), None, None]


def test_recomputed_calls_have_every_column(spark):
    rows = [leg("a", 1, 3, 0, 0), leg("a", 2, 1, 5, 10, 15), leg("a", -1, 2, 77, 30, 2, 60, "agent"), leg("b", 1, 1, 5, 0, 40), leg("b", -1, 2, 8, 50, 5, None, "caller"), leg("c", 1, 1, 6, 0, 10), leg("d", -1, 3, 0, 0, 0, None, "caller"), leg("e", -1, 1, 5, 0, 40, None, "system")]
    legs_ = spark.createDataFrame(rows, LEGS)
    one, two = calls.from_legs(legs_), calls.recomputed(legs_)
    assert set(calls.RECOMPUTED) == set(one.columns) - {"call_id"} == set(two.columns) - {"call_id"}
    order = ["call_id", *calls.RECOMPUTED]
    assert sorted(map(tuple, one.select(order).collect())) == sorted(map(tuple, two.select(order).collect()))


def test_metadata_says_what_limits_a_result(spark):
    d = date(2026, 1, 1)
    rows = spark.createDataFrame([(d, 0, "unlinked", 5, 2), (d, 0, "7", 4, 1)], "day date, close_version int, agent string, presented long, answered long")
    record = spark.createDataFrame([("legs_day_agent_handling", d, 0, 3)], "mart string, day date, close_version int, publication_seq long")
    limits = (semantic.Availability("M-C09", 2026, "partial", "at"), semantic.Availability("M-C09", 2020, "none"), semantic.Availability("M-C10", 2026, "available"))
    ask = lambda **more: semantic.answer(semantic.Request(("M-C09",), d, date(2026, 1, 2), **more), semantic.Principal("u", ("admin",)), lambda m: rows, record, lambda entry: None, availability=limits)
    found, meta = ask()
    assert [r["M-C09"] for r in found] == [9.0] and meta["has_unlinked"] is True and meta["in_progress"] is None and meta["publication_seq"] == 3
    assert meta["availability"] == [{"metric": "M-C09", "year": 2026, "state": "partial", "limiting_column": "at"}] and meta["row_scope"] == {} and meta["table"] == "legs_day_agent_handling"
    assert [x["status"] for x in meta["days"]] == ["published", "not_built"] and meta["metrics"]["M-C09"][0]["version"] == 1
    found, meta = ask(dimensions=("agent",), filters={"agent": ("8",)})
    assert not found and meta["empty_reason"] == "out_of_availability" and meta["has_unlinked"] is False
    volume = spark.createDataFrame([(d, 0, 10, 3)], "day date, close_version int, offered long, in_progress long")
    record = record.withColumn("mart", F.lit("calls_day_volume"))
    _, meta = semantic.answer(semantic.Request(("M-C01",), d, d), semantic.Principal("u", ("admin",)), lambda m: volume, record, lambda entry: None)
    assert meta["in_progress"] == 3 and meta["has_unlinked"] is None and meta["unclosed_dates"] == []


def test_live_counts_by_window(spark, tmp_path):
    schema = "at timestamp, kind string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    counts = runner.live_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "at", "kind")
    query = counts.writeStream.outputMode("update").format("memory").queryName("live_counts").start()
    try:
        for part in ([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "a"), ("2024-01-01 00:07:00", "b")], [("2024-01-01 00:03:00", "a")]):
            spark.createDataFrame([(a, k) for a, k in part], "at string, kind string").select(F.col("at").cast("timestamp").alias("at"), "kind").write.mode("append").parquet(str(tmp_path / "in"))
            query.processAllAvailable()
        got = spark.table("live_counts").groupBy("window", "kind").agg(F.max("n").alias("n")).collect()
    finally:
        query.stop()
    assert sorted((r["kind"], r["n"]) for r in got) == [("a", 3), ("b", 1)]


def test_the_dictionary_says_what_a_role_may_ask(spark):
    told = {d["code"]: d for d in semantic.dictionary(semantic.CATALOG, "agent")}
    assert told["M-C09"]["allowed"] and not told["M-C01"]["allowed"] and not told["M-C08"]["implemented"]


def test_paths_readers_and_bulk_loads(spark, tmp_path):
    raw = {"connector": "pg_read", "endpoint": {"url": "jdbc:postgresql://h/d", "table": "calls", "parts": [{"name": "a"}]}, "auth": {"obtain": {"credential_ref": "calls_user"}}}
    assert contracts.at(raw, "endpoint.parts[0].name") == "a" and contracts.at(raw, "endpoint.parts[1].name") is None and contracts.at(raw, "gone.too") is None
    secret = lambda ref: (ref, "pw")
    kind, stream, options = contracts.options_of(raw, secret)
    assert (kind, stream, options["user"], options["driver"]) == ("jdbc", False, "calls_user", "org.postgresql.Driver")
    kind, stream, options = contracts.options_of({"connector": "kafka_consume", "endpoint": {"servers": "k:9092", "topic": "t"}}, secret)
    assert (kind, stream, options["subscribe"]) == ("kafka", True, "t")
    with pytest.raises(ValueError):
        contracts.options_of({"connector": "rest_api"}, secret)
    (tmp_path / "a.txt").write_text("x\ny\n")
    assert contracts.reader(spark, {"connector": "file_drop"}, secret).load(str(tmp_path / "a.txt")).count() == 2
    c = contracts.Contract("s", 1, "file_drop", ("id", "name"), ("id",))
    (tmp_path / "b.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "bad.csv").write_text("name\nx\n")
    target = str(tmp_path / "raw")
    assert files.load_batch(spark, str(tmp_path / "b.csv"), c, target, "r", 1, "2026-01") == 2
    assert files.load_batch(spark, str(tmp_path / "b.csv"), c, target, "r", 2, "2026-01") == 2
    with pytest.raises(files.Rejected):
        files.load_batch(spark, str(tmp_path / "bad.csv"), c, target, "r", 3, "2026-01")
    got = spark.read.parquet(target)
    assert got.count() == 4 and {(r["id"], r["name"]) for r in got.collect()} == {("1", "x"), ("2", "y")}
