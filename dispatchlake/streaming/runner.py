"""Micro-batches over Structured Streaming that call the batch operators.

Files that arrive are checked as whole batches, deduplicated by key and content against what is stored,
and upserted, newest observation first; control tables say which batches were processed, so that a
repeated epoch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, quality


def _read(spark: SparkSession, schema, *paths: str, base: str | None = None) -> DataFrame:
    """The files under paths that exist, and under no others: nothing else is listed."""
    out = None
    for path in paths:
        reader = spark.read.schema(schema)
        try:
            one = (reader if base is None else reader.option("basePath", base)).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], schema) if out is None else out


REGISTRY = "model string, run_id string, batch_seq long, months array<string>, slots int"


@dataclass
class Loader:
    """Raw and core tables under `path`. Every epoch of the stream is one batch; epochs count from 0.

    Core lies in months, and a key stays in the month of its first observation. An index from key to month is
    joined first; then the months that it names are read and overwritten, no others. Core rows carry the content
    hashes that were seen of their key, so raw, which is only ever appended, is not read at all. The index is a base in
    slots of the key's hash, about `slot_keys` keys each, and a small file for each epoch since; every `compact`
    epochs these are merged into a new base, so an epoch reads the slots of its keys, at most `compact` files more,
    and its months: none of them grows with history.

    Everything that an epoch writes is written again, to the same end, if it is repeated: it is registered last."""

    spark: SparkSession
    path: str
    key: list[str]
    observed: str
    content: list[str]
    rules: dict[str, Column]
    #: The month that a row belongs to, from its own columns.
    month: Column | None = None
    model: str = "core"
    compact: int = 16
    slot_keys: int = 1_000_000
    #: Files that a month is written in.
    files: int = 8

    def _registered(self, epoch: int):
        return _read(self.spark, REGISTRY, f"{self.path}/registry/{self.model}/{epoch}").first()

    def _fields(self, rows: DataFrame, *names: str) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    # --- the index ---------------------------------------------------------------------------------

    def _since(self, epoch: int) -> int:
        return epoch - epoch % self.compact

    def _deltas(self, schema: str, first: int, last: int) -> DataFrame:
        return _read(self.spark, schema, *(f"{self.path}/index/{e}" for e in range(first, last)))

    def _base(self, schema: str, epoch: int) -> tuple[DataFrame, int]:
        """The base that was made at an epoch, and its number of slots."""
        made = self._registered(epoch) if epoch else None
        slots = made["slots"] if made else 1
        path = f"{self.path}/index/base-{epoch}"
        return _read(self.spark, f"{schema}, slot int", path, base=path), slots

    def _merge(self, schema: str, epoch: int) -> int:
        """Makes the base of an epoch at which one is due; its number of slots."""
        old, _ = self._base(schema, epoch - self.compact)
        every = old.drop("slot").unionByName(self._deltas(schema, epoch - self.compact, epoch)).dropDuplicates(self.key)
        slots = max(1, every.count() // self.slot_keys)
        slotted = every.withColumn("slot", self._slot(slots)).repartition("slot").sortWithinPartitions("slot", *self.key)
        slotted.write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/index/base-{epoch}")
        return slots

    def _slot(self, slots: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(slots)).cast("int")

    def _placed(self, batch: DataFrame, schema: str, epoch: int, slots: int | None) -> DataFrame:
        """The batch's keys with their month, and whether the index has it."""
        keys = batch.groupBy(*self.key).agg(F.min("_month").alias("_first"))
        base, known = self._base(schema, self._since(epoch))
        slots = slots or known
        if slots > 1:  # at most as many as the batch has keys
            base = base.filter(F.col("slot").isin([r[0] for r in keys.select(self._slot(slots)).distinct().collect()]))
        index = base.drop("slot").unionByName(self._deltas(schema, self._since(epoch), epoch)).join(keys, self.key, "left_semi").dropDuplicates(self.key)
        placed = keys.join(index.withColumn("_known", F.lit(True)), self.key, "left")
        return placed.select(*self.key, F.coalesce("_key_month", "_first").alias("month"), F.coalesce("_known", F.lit(False)).alias("_known"))

    # --- epochs ------------------------------------------------------------------------------------

    def epoch(self, rows: DataFrame, epoch: int) -> None:
        if self._registered(epoch) is not None:
            return
        month = self.month if self.month is not None else F.date_format(F.col(self.observed).cast("timestamp"), "yyyy-MM")
        batch = rows.withColumns({
            "run_id": F.lit("stream"), "batch_seq": F.lit(epoch).cast("long"),
            "content_hash": F.xxhash64(F.to_json(F.struct(*self.content), {"ignoreNullFields": "false"})),
            "_month": F.coalesce(month, F.lit("none")),
        }).persist()
        try:
            found = quality.verdicts(quality.batch_findings(batch, self.rules), list(self.rules)) if self.rules else None
            state = "accepted" if found is None or found.isEmpty() else found.first()["state"]
            schema = f"{self._fields(batch, *self.key)}, `_key_month` string"
            slots = self._merge(schema, epoch) if epoch and epoch % self.compact == 0 else None
            months: list[str] = []
            if state == "accepted":
                months = self._upsert(batch, schema, epoch, slots)
            else:
                found.select("run_id", "batch_seq", "reason").write.mode("append").parquet(f"{self.path}/quarantine")
            # registered last: a crash before this repeats the epoch
            told = self.spark.createDataFrame([(self.model, "stream", epoch, months, slots)], REGISTRY)
            told.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/registry/{self.model}/{epoch}")
        finally:
            batch.unpersist()

    def _upsert(self, batch: DataFrame, schema: str, epoch: int, slots: int | None) -> list[str]:
        placed = self._placed(batch, schema, epoch, slots).persist()
        try:
            months = sorted(r[0] for r in placed.select("month").distinct().collect())
            columns = [c for c in batch.columns if c != "_month"]
            kept = f"{self._fields(batch, *columns)}, `_seen` array<bigint>, `month` string"
            stored = _read(self.spark, kept, *(f"{self.path}/core/month={m}" for m in months), base=f"{self.path}/core")
            own = stored.join(placed.select(*self.key), self.key, "left_semi")
            fresh = batch.drop("_month").join(own.select(*self.key, "_seen"), self.key, "left").filter(~F.coalesce(F.array_contains("_seen", F.col("content_hash")), F.lit(False))).drop("_seen")
            fresh = fresh.join(placed.drop("_known"), self.key)
            # dynamic: a repeated epoch overwrites its own raw rows
            fresh.drop("month").withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(f"{self.path}/raw")

            every = own.unionByName(fresh.withColumn("_seen", F.array("content_hash")))
            seen = every.groupBy(*self.key).agg(F.array_distinct(F.flatten(F.collect_list("_seen"))).alias("_seen"))
            newest = incremental.newest(every.drop("_seen"), self.key, self.observed, "batch_seq").join(seen, self.key)
            rest = stored.join(placed.select(*self.key), self.key, "left_anti")
            after = rest.unionByName(newest).repartition("month", F.pmod(F.xxhash64(*self.key), F.lit(self.files)))
            after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/core")
            new = placed.filter(~F.col("_known")).select(*self.key, F.col("month").alias("_key_month"))
            new.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/{epoch}")
            return months
        finally:
            placed.unpersist()

    def core(self) -> DataFrame:
        """The newest observation of each key of what was accepted."""
        return self.spark.read.parquet(f"{self.path}/core").drop("month", "content_hash", "_seen")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Everything that is there now, then stop."""
        query = stream.writeStream.foreachBatch(self.epoch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def live_counts(stream: DataFrame, at: str, by: str, delay: str = "15 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by event-time window for a live view; late rows within `delay` still count."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))
