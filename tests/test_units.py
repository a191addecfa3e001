"""Functions whose cases need no table, each against SQL that derives the same rows."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from dispatchlake.functions import periods
from dispatchlake.operators import quality
from dispatchlake.plans import publication, semantic
from dispatchlake.sources import polled
from dispatchlake.streaming import windows

CASES = {}


def case(name, sql):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


def _record(spark):
    closed = periods.spine(spark, "1997-01-01", "1997-01-10")
    return closed.select(F.lit("m").alias("mart"), "day", F.lit(1).alias("close_version"), F.lit(1).cast("long").alias("publication_seq"), F.lit(1).cast("long").alias("row_count"))


def _final(spark):
    """Runs sweep every source day but every 6th; the run of day 17 has an open batch."""
    days = publication.open_days(spark, _record(spark), "m", F.lit("1995-01-01").cast("date"), "1997-01-20")
    swept = periods.spine(spark, "1997-01-01", "1997-01-20").withColumn("n", F.dayofmonth("day"))
    sweeps = swept.select(F.col("day").alias("source_day"), F.concat(F.lit("r"), F.col("n")).alias("run_id"), F.when(F.col("n") % 15 == 0, "failed").otherwise("succeeded").alias("outcome"))
    batches = swept.select(F.concat(F.lit("r"), F.col("n")).alias("run_id"), F.lit(1).alias("batch_seq"), (F.col("n") != 17).alias("settled"))
    return days, publication.final_days(days, sweeps, batches, F.lit("1996-12-31").cast("date"), "UTC", "Asia/Riyadh")


_FINAL = "SELECT DATE '1997-01-11' + i::INTEGER AS day FROM range(10) t(i) WHERE i + 11 NOT IN (15, 16, 17, 18)"


@case("str_01_slices", "SELECT s AS slice_from, least(s + 1200, 10000) AS slice_to FROM (SELECT unnest([0, 1200, 2400, 3600, 4800, 6000, 7200, 8400, 9600]) AS s) WHERE s < 9600 UNION ALL SELECT 9400, 10000")
def _(spark):
    return spark.createDataFrame(windows.slices(0, 10000, 1200, 600), "slice_from int, slice_to int")


@case("pub_01_open_days", "SELECT DATE '1997-01-11' + i::INTEGER AS day FROM range(10) t(i)")
def _(spark):
    return publication.open_days(spark, _record(spark), "m", F.lit("1995-01-01").cast("date"), "1997-01-20")


@case("pub_02_intraday", "SELECT DATE '1997-01-14' + i::INTEGER AS day, 0 AS close_version FROM range(7) t(i)")
def _(spark):
    days = publication.open_days(spark, _record(spark), "m", F.lit("1995-01-01").cast("date"), "1997-01-20")
    return publication.intraday(days, "1997-01-20")


@case("pub_03_final_days", _FINAL)
def _(spark):
    return _final(spark)[1]


@case("pub_04_closable", f"SELECT day, 1 AS close_version FROM ({_FINAL}) WHERE day < DATE '1997-01-15'")
def _(spark):
    return publication.closable(*_final(spark))


@case("qry_04_version_choice", "SELECT DATE '1997-01-01' + i::INTEGER AS day, CASE WHEN i < 5 THEN 2 WHEN i < 10 THEN 1 WHEN i < 12 THEN 0 END AS close_version, CASE WHEN i < 12 THEN 'published' ELSE 'not_built' END AS status FROM range(15) t(i)")
def _(spark):
    v = periods.spine(spark, "1997-01-01", "1997-01-12").withColumn("n", F.dayofmonth("day"))
    record = v.select(F.lit("m").alias("mart"), "day", F.explode(F.when(F.col("n") <= 5, F.array(F.lit(0), F.lit(1), F.lit(2))).when(F.col("n") <= 10, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("close_version"), F.lit(1).cast("long").alias("publication_seq"))
    return semantic.choose_versions(record, "m", date(1997, 1, 1), date(1997, 1, 15)).select("day", "close_version", "status")


@case("dq_01_columns_match", "SELECT 'talk' AS name, 'missing' AS finding UNION ALL SELECT 'extra_column', 'extra'")
def _(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    return quality.columns_match(names("wait", "extra_column"), names("wait", "talk"), "name")


@case("dq_17_closing_behind", "SELECT DATE '1997-01-10' AS last_closed")
def _(spark):
    return quality.closing_behind(_record(spark), "m", F.lit("1997-01-20").cast("date"))


_DRAW = "('0x' || substr(md5('7-{}-' || minute || '-' || n), 1, 13))::BIGINT"


@case("src_17_synthetic_calls", f"""SELECT '7-' || minute || '-' || n AS call_id, minute, {_DRAW.format("queue")} % 5 AS queue, {_DRAW.format("length")} % 30 + 1 AS length, minute + {_DRAW.format("length")} % 30 + 1 <= 1100 AS is_complete
  FROM (SELECT 1000 + i AS minute, j AS n FROM range(120) a(i), range(3) b(j)) WHERE minute <= 1100""")
def _(spark):
    return polled.synthetic(spark, 7, 1000, 120, 1100)


@pytest.mark.parametrize("name", sorted(CASES))
def test_case(spark, name):
    f, sql = CASES[name]
    got, want = f(spark), duckdb.sql(sql)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    rows = want.project(", ".join(f'"{n}"' for n in names)).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, rows))
