import json
import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dispatchlake.functions import casts, codes, content, documents, keys, periods
from dispatchlake.streaming import windows


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_casts_keep_to_their_shapes(spark):
    texts = ["1", "-5", "007", "", None, " 1", "1 ", "1\n", "+1", "1234567890", "-999999999", "1.0", "1.00", "1.5", "x"]
    rows = column(spark, texts).select(casts.try_int(F.col("x")), casts.try_whole(F.col("x"))).collect()
    assert [r[0] for r in rows] == [1, -5, 7, None, None, None, None, None, None, None, -999999999, None, None, None, None]
    assert [r[1] for r in rows] == [1, -5, 7, None, None, None, None, None, None, None, -999999999, 1, 1, None, None]
    times = ["2026-02-28 10:00:00", "2026-02-30 10:00:00", "2026-2-3 1:00:00", "2026-02-28 10:00:00\n", "", None, "2024-02-29 23:59:59"]
    got = [r[0] for r in column(spark, times).select(casts.try_timestamp(F.col("x"))).collect()]
    assert got == [datetime(2026, 2, 28, 10), None, None, None, None, None, datetime(2024, 2, 29, 23, 59, 59)]


def test_zones_with_and_without_daylight_saving(spark):
    local = F.col("x").cast("timestamp_ntz")
    for zone, offsets in (("Asia/Riyadh", [10800, 10800]), ("Europe/Berlin", [3600, 7200])):
        got = column(spark, ["2026-01-15 12:00:00", "2026-07-15 12:00:00"]).select(casts.offset_seconds(local, zone)).collect()
        assert [r[0] for r in got] == offsets


def test_natural_and_surrogate_keys(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("\\", "é")], "p string, q string")
    got = rows.select(keys.nk(F.col("p"), F.col("q")).alias("nk"), keys.sk("hq", "src", F.col("p")).alias("sk")).collect()
    assert [r["nk"] for r in got] == ["a\\|b|c", "a|b\\|c", "\\\\|é"]
    assert [r["sk"] for r in got] == [str(uuid.uuid5(keys.site_namespace("hq"), "src:" + p)) for p in ("a|b", "a", "\\")]
    with pytest.raises(Exception, match="NULL"):
        spark.createDataFrame([(None,)], "p string").select(keys.nk(F.col("p"))).collect()
    with pytest.raises(ValueError):
        keys.nk()
    at = F.lit("2026-01-02 03:04:05").cast("timestamp")
    scd = spark.range(1).select(keys.sk_scd("hq", "src", F.lit("k"), at)).first()[0]
    assert scd == str(uuid.uuid5(keys.site_namespace("hq"), "src:k@20260102030405"))


def test_day_keys_follow_the_report_zone(spark):
    got = column(spark, ["2026-01-01 20:59:59", "2026-01-01 21:00:00"]).select(keys.date_key(F.col("x").cast("timestamp"))).collect()
    assert [r[0] for r in got] == [20260101, 20260102]


def test_hashes_tell_null_from_empty(spark):
    rows = spark.createDataFrame([(None, "x"), ("", "x"), ("x", None), ("=", "~")], "a string, b string")
    assert len({r[0] for r in rows.select(content.row_hash(["a", "b"])).collect()}) == 4
    one = spark.createDataFrame([("1", "é\"")], "b string, a string")
    raw = one.select(content.raw_hash(["b", "a"]), content.record_hash(["b", "a"])).first()
    dumped = lambda pairs: hashlib.sha256(json.dumps(pairs, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert raw[0] == dumped([["b", "1"], ["a", "é\""]]) and raw[1] == dumped([["a", "é\""], ["b", "1"]])
    assert [r[0] for r in column(spark, ["7fffffff", "80000000", "ffffffff"]).select(content.signed32(F.col("x"))).collect()] == [2147483647, -2147483648, -1]


def test_codes(spark):
    got = column(spark, [None, "1", "2", "3", "9999"]).select(codes.direction(F.col("x"), ["1"], ["2"], ["3"])).collect()
    assert [r[0] for r in got] == ["unmapped", "inbound", "outbound", "internal", "unmapped"]


def test_index_columns_take_the_last_of_a_repeated_id(spark):
    payload = json.dumps([{"id": "A", "val": "1"}, {"id": "B", "val": None}, {"id": "A", "val": "2"}])
    got = column(spark, [payload, "[]", None]).select(*documents.index_columns(F.col("x"), {"A": "a", "B": "b", "C": "c"})).collect()
    assert [tuple(r) for r in got] == [("2", None, None), (None, None, None), (None, None, None)]


def test_weeks_begin_on_sunday(spark):
    got = column(spark, ["2026-11-28", "2026-11-29"]).select(periods.period(F.col("x").cast("date"), "week").cast("string")).collect()
    assert [r[0] for r in got] == ["2026-11-22", "2026-11-29"]
    with pytest.raises(ValueError):
        periods.period(F.lit(None), "hour")


def test_slices():
    assert windows.slices(0, 3600, 1200, 60) == [(0, 1200), (1200, 2400), (2400, 3600)]
    assert windows.slices(0, 1230, 1200, 60) == [(0, 1200), (1170, 1230)]
    for bad in ((0, 30, 1200, 60), (0, 100, 10, 60)):
        with pytest.raises(ValueError):
            windows.slices(*bad)
    assert windows.advanced(None, 5) == 5 and windows.advanced(9, 5) == 9
    assert windows.window_from(10_000) == 9100
    with pytest.raises(ValueError):
        windows.window_from(0, 1441)
    assert [windows.version_gate(*a) for a in ((None, 1), (1, 2), (2, 2), (3, 2), (1, 9, 1))] == ["take", "take", "same", "backwards", "not_ready"]
    assert windows.request("from={{ window_from }}&to={{ window_to }}", ("a", "b")) == "from=a&to=b"
