"""The polled source: what a stream fetches is what one window fetches, whatever is interrupted."""

import json

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from dispatchlake.sources import polling
from dispatchlake.streaming import runner


@pytest.fixture
def site(spark, tmp_path):
    spark.dataSource.register(polling.PolledSource)
    folder = tmp_path / "site"
    folder.mkdir()

    class Site:
        path = folder

        def at(self, now):
            (folder / "now").write_text(str(now))

        def put(self, name, value):
            (folder / name).write_text(json.dumps(value))

        def log(self):
            return [tuple(json.loads(line)[:-1]) for line in (folder / "log").read_text().splitlines()] if (folder / "log").exists() else []

        def pids(self):
            return {json.loads(line)[-1] for line in (folder / "log").read_text().splitlines()}

        def options(self, **more):
            return {"transport": "tests.fakes:Transport", "folder": str(folder), **{k: str(v) for k, v in more.items()}}

        def stream(self, **more):
            return spark.readStream.format("polled").options(**self.options(watermark=folder / "watermark", **more)).load()

        def window(self, **more):
            return spark.read.format("polled").options(**self.options(**more)).load()

    site = Site()
    site.put("calls.json", [{"id": i, "at": 10_000 + 37 * i, "v": f"v{i}"} for i in range(200)])
    site.at(12_000)
    return site


CALL = "id int, at int, v string"


def calls(df):
    return df.select(F.from_json("payload", CALL).alias("c")).select("c.*")


def run(stream, tmp_path, each):
    """Until nothing is left to fetch."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_a_stream_gives_what_one_window_gives(spark, site, tmp_path):
    loader = runner.Loader(spark, str(tmp_path / "out"), ["id"], "at", ["at", "v"], {}, month=F.lit("m"))
    each = lambda df, epoch: loader.epoch(calls(df), epoch)
    for now in (12_000, 13_000, 13_050, 18_000):
        site.at(now)
        run(site.stream(start=9_900, lookback_minutes=5, max_span_seconds=700, min_span_seconds=60, concurrency=3), tmp_path, each)
    assert len(site.pids()) > 1
    want = sorted(map(tuple, calls(site.window(**{"from": 9_900, "to": 18_000}, max_span_seconds=10**6)).collect()))
    assert len(want) == 200 and sorted((r["id"], r["at"], r["v"]) for r in loader.core().collect()) == want
    # the lookback fetched records again; raw has them once
    assert spark.read.parquet(str(tmp_path / "out/raw")).count() == 200
    fetched = [x[1:] for x in site.log()]
    assert all(b - a <= 700 for a, b in fetched if (a, b) != (9_900, 18_000)) and (12_000 - 300, 12_400) in fetched


def test_a_crash_before_the_commit_repeats_the_slices(spark, site, tmp_path):
    got, broken = [], [True]

    def each(df, epoch):
        rows = sorted(r["id"] for r in calls(df).collect())
        if broken and epoch == 1:
            broken.clear()
            raise RuntimeError("the writer dies")
        got.append((epoch, rows))

    options = {"start": 10_000, "lookback_minutes": 0, "max_span_seconds": 500}
    run(site.stream(**options), tmp_path, each)
    site.at(14_000)
    with pytest.raises(StreamingQueryException):
        run(site.stream(**options), tmp_path, each)
    before = [x for x in site.log() if x[1] >= 12_000]
    site.at(15_000)  # time has gone on when the query starts again
    run(site.stream(**options), tmp_path, each)
    after = [x for x in site.log() if x[1] >= 12_000][len(before) :]
    assert before == [("fetch", a, a + 500) for a in range(12_000, 14_000, 500)] and after[: len(before)] == before
    assert [e for e, _ in got] == [0, 1, 2] and sorted(i for _, ids in got for i in ids) == [i for i in range(200) if 10_000 + 37 * i < 15_000]


def test_a_source_that_is_down_leaves_the_watermark(spark, site, tmp_path):
    got = []
    each = lambda df, epoch: got.extend(r["id"] for r in calls(df).collect())
    (site.path / "fail").touch()
    with pytest.raises(StreamingQueryException):
        run(site.stream(start=10_000, lookback_minutes=0), tmp_path, each)
    assert got == []
    (site.path / "fail").unlink()
    run(site.stream(start=10_000, lookback_minutes=0), tmp_path, each)
    assert sorted(got) == [i for i in range(200) if 10_000 + 37 * i < 12_000]


def test_a_sweep_of_a_past_day_leaves_the_watermark(spark, site, tmp_path):
    got = []
    each = lambda df, epoch: got.append(sorted(r["id"] for r in calls(df).collect()))
    site.put("calls.json", [{"id": i, "at": 86_400 * i // 10, "v": "x"} for i in range(40)])
    site.at(2 * 86_400 + 10)
    options = {"start": 2 * 86_400, "lookback_minutes": 0}
    run(site.stream(**options), tmp_path, each)
    swept = calls(site.window(mode="resweep", day=1, lookback_minutes=180)).collect()
    assert sorted(r["id"] for r in swept) == list(range(9, 20))
    assert sorted(r["id"] for r in calls(site.window(mode="resweep", day=1, lookback_minutes=0, offset_seconds=10_800)).collect()) == list(range(9, 19))
    with pytest.raises(PySparkException, match="has ended"):
        site.window(mode="resweep", day=2).collect()
    site.at(2 * 86_400 + 20_000)
    run(site.stream(**options), tmp_path, each)
    assert got == [[20], [21, 22]]


def test_the_clock_may_not_run_backwards(spark, site, tmp_path):
    run(site.stream(start=10_000, lookback_minutes=0), tmp_path, lambda df, epoch: df.count())
    site.at(11_000)
    with pytest.raises(StreamingQueryException, match="later than the source's clock"):
        run(site.stream(start=10_000, lookback_minutes=0), tmp_path, lambda df, epoch: df.count())


def test_snapshots_are_taken_when_the_version_is_newer(spark, site, tmp_path):
    got = []
    each = lambda df, epoch: got.append(sorted((r["batch_to"], json.loads(r["payload"])["id"]) for r in df.collect()))
    site.put("agents.json", [{"id": "1"}, {"id": "2"}])
    for version, status in ((5, 2), (5, 2), (4, 2), (6, 1), (7, 2)):
        site.put("version.json", {"version": version, "status": status})
        run(site.stream(kind="snapshot", dataset="agents"), tmp_path, each)
    assert got == [[(5, "1"), (5, "2")], [(7, "1"), (7, "2")]] and len(site.log()) == 2
    assert {r["batch_to"] for r in site.window(kind="snapshot", dataset="agents").collect()} == {7}


def test_observations_ask_for_chunks_of_ids(spark, site, tmp_path):
    got = []
    each = lambda df, epoch: got.append(sorted((json.loads(r["payload"])["id"], r["part"], r["batch_to"]) for r in df.collect()))
    site.put("agents.json", [{"id": str(i)} for i in range(10, 0, -1)])
    for now in (100, 110, 130):
        site.at(now)
        run(site.stream(kind="observations", batch_size=4, concurrency=2, every_seconds=20), tmp_path, each)
    assert [len(x) for x in got] == [10, 10] and {p for x in got for _, p, _ in x} == {0, 1, 2} and {t for x in got for *_, t in x} == {100, 130}
    assert sorted(x[1] for x in site.log())[::2] == [["1", "2", "3", "4"], ["5", "6", "7", "8"], ["9", "10"]]


@pytest.mark.parametrize("wrong", [{"kind": "x"}, {"lookback_minutes": "2000"}, {"mode": "x"}, {"from": "5", "to": "5"}, {"transport": ""}])
def test_wrong_options(spark, site, wrong):
    with pytest.raises((PySparkException, ValueError)):
        site.window(**({"from": "0", "to": "10"} | wrong)).collect()


def test_a_stream_needs_a_start(spark, site, tmp_path):
    with pytest.raises(StreamingQueryException, match="needs start"):
        run(site.stream(), tmp_path, lambda df, epoch: None)
