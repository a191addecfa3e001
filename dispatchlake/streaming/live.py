"""A live view of current states: the newest change of each key, pushed as it comes in.

The state is one row for each key in the state store, with a time to live; a push is a batch of keys whose state
changed and goes to a callback, so nothing gathers on the driver. A consumer that connects, or connects again, takes
a snapshot out of the state store and goes on with the pushes that come in after it. The batch form of the view
is `current`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: What transformWithState needs; the session's setting is left as it is.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


def current(changes: DataFrame, key: str, at: str, seq: str) -> DataFrame:
    """The newest change of each key, by time, then by sequence; changes that come late change nothing."""
    others = [c for c in changes.columns if c not in (key, at, seq)]
    newest = F.max_by(F.struct(*others, F.col(at).alias(at), F.col(seq).alias(seq)), F.struct(at, seq))
    return changes.groupBy(key).agg(newest.alias("_newest")).select(key, "_newest.*")


class Newest(StatefulProcessor):
    """Keeps the newest change of a key; gives it where it is newer than what was kept."""

    def __init__(self, key: str, at: str, seq: str, fields: list[str], schema: T.StructType, ttl_ms: int):
        self.key, self.at, self.seq, self.fields, self.schema, self.ttl_ms = key, at, seq, fields, schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("newest", self.schema, self.ttl_ms)

    def _age(self, row) -> tuple:
        """Nulls are older than anything."""
        return tuple((row[c] is not None, row[c]) if row[c] is not None else (False, 0) for c in (self.at, self.seq))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max(rows, key=self._age)
        kept = Row(*self.fields)(*self.kept.get()) if self.kept.exists() else None
        if kept is None or self._age(newest) > self._age(kept):
            values = tuple(newest[c] for c in self.fields)
            self.kept.update(values)
            yield Row(self.key, *self.fields)(*key, *values)

    def close(self) -> None:
        pass


def view(
    stream: DataFrame, key: str, at: str, seq: str, checkpoint: str, push: Callable[[DataFrame, int], None], every: str = "5 seconds", ttl_ms: int = DAY_MS,
) -> StreamingQuery:
    """Starts the view: `push(rows, number)` gets the keys whose newest change is new. A push that a crash interrupts comes
    again, and nothing is pushed while nothing changes. A key without changes for `ttl_ms` is forgotten.

    As states run out with time, a batch is planned at every trigger, with new rows or without."""
    spark = stream.sparkSession
    fields = [c for c in stream.columns if c != key]
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema if f.name != key])
    out = T.StructType([T.StructField(key, stream.schema[key].dataType), *kept])
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)

    def pushed(rows: DataFrame, number: int) -> None:
        rows.persist()  # the state is computed once
        try:
            if not rows.isEmpty():
                push(rows, number)
        finally:
            rows.unpersist()

    try:  # a query keeps the settings that it was started with
        states = stream.groupBy(key).transformWithState(Newest(key, at, seq, fields, kept, ttl_ms), out, "Update", "ProcessingTime")
        return states.writeStream.foreachBatch(pushed).outputMode("update").option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def snapshot(spark: SparkSession, checkpoint: str, push: int | None = None) -> DataFrame:
    """The states after a push, the last one if none is named, out of the view's state store; those that have run out by
    now are left out."""
    reader = spark.read.format("statestore").option("stateVarName", "newest")
    rows = (reader if push is None else reader.option("batchId", push)).load(checkpoint)
    return rows.filter(F.col("value.ttlExpirationMs") > F.unix_millis(F.current_timestamp())).select("key.*", "value.value.*")
