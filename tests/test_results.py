"""Kept results and the audit dataset."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from dispatchlake.plans import controlled, results, semantic

ADMIN = semantic.Principal("u", ("admin",))


def test_a_second_answer_reads_no_mart_until_a_correction(spark, tmp_path):
    day = F.col("d").cast("date").alias("day")
    mart = spark.createDataFrame([("2026-01-01", 1, 4, 3), ("2026-01-02", 1, 2, 1)], "d string, close_version int, offered long, answered long").select(day, "close_version", "offered", "answered")
    record = lambda *more: spark.createDataFrame([("calls_day_volume", "2026-01-01", 1, 1), ("calls_day_volume", "2026-01-02", 1, 1), *more], "mart string, d string, close_version int, publication_seq long").select("mart", day, "close_version", "publication_seq")
    cache, log, reads, held = results.ResultCache(spark, str(tmp_path / "kept")), results.AuditLog(spark, str(tmp_path / "audit")), [], [mart]

    def rows(name):
        reads.append(name)
        return held[0]

    request = semantic.Request(("M-C04",), date(2026, 1, 1), date(2026, 1, 3), granularity="day")
    ask = lambda r=record(), principal=ADMIN, asked=request, **more: semantic.answer(asked, principal, rows, r, log, cache=cache, **more)
    assert log.rows().count() == 0
    first, meta = ask()
    n = len(reads)
    assert n > 0 and [r["M-C04"] for r in first] == [0.75, 0.5]
    again, told = ask()
    assert len(reads) == n and list(map(tuple, again)) == list(map(tuple, first)) and again[0].asDict() == first[0].asDict() and told == meta
    # another range, another role's fields or limits are other answers
    ask(asked=semantic.Request(("M-C04",), date(2026, 1, 1), date(2026, 1, 1), granularity="day"))
    assert len(reads) > n
    n = len(reads)
    ask(availability=(semantic.Availability("M-C04", 2026, "partial"),))
    assert len(reads) > n
    # a correction has a new number: the mart is read, and what it says is kept under a key of its own
    held[0] = mart.unionByName(mart.filter("offered = 4").withColumns({"close_version": F.lit(2), "answered": F.lit(1).cast("long")}))
    corrected = record(("calls_day_volume", "2026-01-01", 2, 2))
    n = len(reads)
    assert [r["M-C04"] for r in ask(corrected)[0]] == [0.25, 0.5] and len(reads) > n
    n = len(reads)
    assert [r["M-C04"] for r in ask(corrected)[0]] == [0.25, 0.5] and [r["M-C04"] for r in ask()[0]] == [0.75, 0.5] and len(reads) == n
    # an empty answer is kept too
    none = semantic.Request(("M-C04",), date(2025, 1, 1), date(2025, 1, 2), granularity="day")
    assert ask(asked=none)[0] == [] and ask(asked=none)[1]["empty_reason"] == "not_built"
    # every answer is in the audit, hits as well, and so are refusals
    with pytest.raises(semantic.ERRORS["unknown_metric"]):
        ask(asked=semantic.Request(("X",), date(2026, 1, 1), date(2026, 1, 3)))
    told = log.rows().groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in told} == {"ok": 9, "unknown_metric": 1} and log.asked("u", datetime.now(UTC).date()) == 9


def test_a_daily_quota_counts_the_audit(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("quota_view")
    log, me = results.AuditLog(spark, str(tmp_path / "audit")), semantic.Principal("p", ("analyst",))
    grant = controlled.Grant("p", True, "operations", "why", daily=2)
    ask = lambda: controlled.controlled_sql(spark, "SELECT * FROM quota_view", frozenset({"quota_view"}), principal=me, grant=grant, asked_today=log.asked("p", datetime.now(UTC).date()), audit=log)
    assert ask().count() == ask().count() == 3
    with pytest.raises(semantic.ERRORS["metric_forbidden"]):
        ask()
    assert [r["outcome"] for r in log.rows().orderBy("at").collect()] == ["ok", "ok", "metric_forbidden"]
