"""The loader: newest observations by key, months that an epoch touches, and what an epoch reads."""

import random

import pytest
from pyspark.sql import functions as F

from dispatchlake.streaming import runner

SHAPE = "k int, v string, at int"


def month(column):
    return F.concat(F.lit("m"), F.floor(F.col(column) / 100).cast("string"))


def loader(spark, path, **more):
    return runner.Loader(spark, str(path), ["k"], "at", ["v", "at"], {}, month=month("at"), **more)


def test_epochs_give_the_newest_observation_of_each_key(spark, tmp_path):
    rng, model, seen = random.Random(3), {}, set()
    one = loader(spark, tmp_path, compact=3, slot_keys=10)
    for epoch in range(8):
        rows = [(rng.randrange(60), rng.choice("abc"), 100 * (epoch // 2) + rng.randrange(100)) for _ in range(25)]
        rows = list({(k, at): (k, v, at) for k, v, at in rows}.values())
        one.epoch(spark.createDataFrame(rows, SHAPE), epoch)
        for k, v, at in rows:
            if (k, v, at) not in seen and (k not in model or at > model[k][1]):
                model[k] = (v, at)
        seen |= set(rows)
        assert {r["k"]: (r["v"], r["at"]) for r in one.core().collect()} == model
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted((r["k"], r["v"], r["at"]) for r in raw.collect()) == sorted(seen)
    # a key lies in one month, that of its first observation
    core = spark.read.parquet(str(tmp_path / "core"))
    assert core.count() == core.select("k").distinct().count() and core.select("month").distinct().count() > 2
    assert one._registered(6)["slots"] > 1


def test_a_repeated_epoch_changes_nothing(spark, tmp_path):
    one = loader(spark, tmp_path)
    parts = [[(1, "a", 5), (2, "b", 150)], [(1, "c", 160), (3, "d", 10), (2, "old", 120)]]
    for epoch, rows in enumerate(parts):
        one.epoch(spark.createDataFrame(rows, SHAPE), epoch)
    want = [(1, "c", 160), (2, "b", 150), (3, "d", 10)]
    state = lambda: (sorted((r["k"], r["v"], r["at"]) for r in one.core().collect()), spark.read.parquet(str(tmp_path / "raw")).count())
    assert state() == (want, 5)
    one.epoch(spark.createDataFrame(parts[1], SHAPE), 1)
    assert state() == (want, 5)


@pytest.mark.parametrize("crash", ["registry", "core"])
def test_a_crash_repeats_the_epoch(spark, tmp_path, crash):
    """What an epoch had written before it was lost is written again to the same end."""
    one = loader(spark, tmp_path, compact=2)
    parts = [[(1, "a", 5), (2, "b", 150)], [(1, "c", 160)], [(1, "d", 170), (3, "d", 10), (2, "old", 120)]]
    for epoch, rows in enumerate(parts):
        one.epoch(spark.createDataFrame(rows, SHAPE), epoch)
    import shutil

    shutil.rmtree(tmp_path / "registry" / "core" / "2")
    if crash != "registry":
        shutil.rmtree(tmp_path / "index" / "2")
    if crash == "core":
        shutil.rmtree(tmp_path / "index" / "base-2")
    one.epoch(spark.createDataFrame(parts[2], SHAPE), 2)
    assert sorted((r["k"], r["v"], r["at"]) for r in one.core().collect()) == [(1, "d", 170), (2, "b", 150), (3, "d", 10)]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 6


def test_what_an_epoch_reads_does_not_grow_with_history(spark, tmp_path, monkeypatch):
    files, plain = {}, runner._read

    def counting(session, schema, *paths, **more):
        out = plain(session, schema, *paths, **more)
        files[now] = files.get(now, 0) + len(out.inputFiles())
        return out

    monkeypatch.setattr(runner, "_read", counting)
    one, keys = loader(spark, tmp_path, compact=4, files=2), 5000
    for now in range(14):
        # most keys are new, some were seen in the epoch before
        rows = spark.range(now * keys - 500 * (now > 0), (now + 1) * keys).select(F.col("id").cast("int").alias("k"), F.lit(f"v{now}").alias("v"), (F.lit(50 * now) + F.col("id") % 40).cast("int").alias("at"))
        one.epoch(rows, now)
    assert files[13] <= files[5] + 1 and files[12] <= files[8] + 1 and max(files[e] for e in range(9, 14)) <= max(files[e] for e in range(4, 9))
    assert one.core().count() == 14 * keys
    assert len(plain(spark, runner.REGISTRY, f"{tmp_path}/registry/core/13").first()["months"]) <= 2


def test_quarantined_epochs_leave_the_tables_alone(spark, tmp_path):
    one = runner.Loader(spark, str(tmp_path), ["k"], "at", ["v", "at"], {"bad": F.col("at") < 0}, month=month("at"), compact=2)
    for epoch, rows in enumerate([[(1, "a", 5)], [(1, "b", -1)], [(2, "c", 7), (1, "e", 9)], [(1, "f", 3)]]):
        one.epoch(spark.createDataFrame(rows, SHAPE), epoch)
    assert sorted((r["k"], r["v"], r["at"]) for r in one.core().collect()) == [(1, "e", 9), (2, "c", 7)]
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1
