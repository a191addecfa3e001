"""The live view: its states are those of the batch form, pushes hold changes only, and states run out."""

import random
import time

from dispatchlake.streaming import live

SCHEMA = "agent long, state string, at long, seq long"


class View:
    def __init__(self, spark, path, **more):
        self.spark, self.path, self.pushes = spark, path, []
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(str(path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(path / "in"))
        self.query = live.view(stream, "agent", "at", "seq", str(path / "checkpoint"), self.push, "200 milliseconds", **more)

    def push(self, rows, number):
        self.pushes.append((number, sorted(map(tuple, rows.collect()))))

    def send(self, rows):
        """Rows, waited for until the query has read them."""
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(self.path / "in"))
        self.wait(lambda: sum(p["numInputRows"] for p in self.seen()) >= len(rows))

    def seen(self):
        return [p for p in self.query.recentProgress if p["batchId"] > self.mark]

    def wait(self, holds, seconds=60):
        until = time.monotonic() + seconds
        while not holds():
            assert self.query.isActive and time.monotonic() < until, self.query.exception()
            time.sleep(0.1)
        self.mark = max((p["batchId"] for p in self.query.recentProgress), default=-1)

    mark = -1

    def snapshot(self):
        return sorted(map(tuple, live.snapshot(self.spark, str(self.path / "checkpoint")).collect()), key=str)


def test_states_are_those_of_the_batch_form(spark, tmp_path):
    rng, sent = random.Random(1), []
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    view = View(spark, tmp_path)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    try:
        for push in range(4):  # late ones, repeated ones, several of a key, times that are null
            rows = [(rng.randrange(8), rng.choice(["ready", "busy", None]), rng.choice([None, *range(10 * push - 8, 10 * push + 5)]), 100 * push + i) for i in range(12)]
            sent += rows
            view.send(rows + rows[:3])
        sent.append((99, "new", 1, 1))
        view.send([(99, "new", 1, 1)])
        view.send([(99, "new", 1, 1), (99, "late", 0, 7)])
        want = sorted(map(tuple, live.current(spark.createDataFrame(sent, SCHEMA), "agent", "at", "seq").collect()), key=str)
        assert view.snapshot() == want
        # what is newest came last among a key's pushes, and nothing was pushed that changed nothing
        last = {r[0]: r for _, rows in view.pushes for r in rows}
        assert sorted(last.values(), key=str) == want and view.pushes[-1][1] == [(99, "new", 1, 1)] and sum(r[0] == 99 for _, rows in view.pushes for r in rows) == 1
    finally:
        view.query.stop()
    # started again, it goes on from its states
    again = View(spark, tmp_path)
    try:
        again.send([(99, "old", 0, 3), (98, "first", 5, 5)])
        assert [rows for _, rows in again.pushes] == [[(98, "first", 5, 5)]]
        assert again.snapshot() == sorted([*want, (98, "first", 5, 5)], key=str)
    finally:
        again.query.stop()


def test_states_run_out(spark, tmp_path):
    view = View(spark, tmp_path, ttl_ms=3000)
    try:
        view.send([(1, "ready", 10, 1)])
        time.sleep(3.5)
        assert view.snapshot() == []
        view.send([(1, "old", 5, 2)])  # nothing is known of the key any more
        assert view.pushes[-1][1] == [(1, "old", 5, 2)] and view.snapshot() == [(1, "old", 5, 2)]
    finally:
        view.query.stop()
