"""Batch-incremental transformation: which batches to read, which rows to write, what was processed.

What is processed is a registry of (model, run_id, batch_seq), not a time watermark: a batch that is
released from quarantine late is picked up then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.content import differs

BATCH = ["run_id", "batch_seq"]


def held(quarantine: DataFrame) -> DataFrame:
    """Batches whose latest state keeps them out: pending or discarded."""
    return quarantine.filter(F.col("state").isin("pending", "discarded")).select(*BATCH)


def latest_state(events: DataFrame) -> DataFrame:
    """Current quarantine state from append-only events; a decision, once made, stays."""
    decided = F.min_by("state", F.when(F.col("state") != "pending", F.col("event_seq")))
    return events.groupBy(*BATCH).agg(F.coalesce(decided, F.lit("pending")).alias("state"))


def processable(batches: DataFrame, quarantine: DataFrame, registry: DataFrame, model: str) -> DataFrame:
    """Batches that are not held and not yet registered for the model."""
    done = registry.filter(F.col("model") == model).select(*BATCH)
    return batches.join(held(quarantine), BATCH, "left_anti").join(done, BATCH, "left_anti")


def scan_batches(raw: DataFrame, batches: DataFrame) -> DataFrame:
    return raw.join(batches.select(*BATCH), BATCH, "left_semi")


def registrations(batches: DataFrame, model: str) -> DataFrame:
    """Registry rows, batches without rows included; append them after the data is committed."""
    return batches.select(F.lit(model).alias("model"), *BATCH).distinct()


def core_registrations(staged: DataFrame, ingested: DataFrame, registry: DataFrame, staging: str, core: str) -> DataFrame:
    """Registry rows a core model adds: batches of the staged rows, and staged batches that wrote no row."""
    at = registry.filter(F.col("model") == staging).select(*BATCH)
    empty = ingested.filter("rows_written = 0").select(*BATCH).join(at, BATCH, "left_semi")
    done = registry.filter(F.col("model") == core).select(*BATCH)
    return registrations(staged.select(*BATCH).union(empty).join(done, BATCH, "left_anti"), core)


def forget(registry: DataFrame, model: str) -> DataFrame:
    """The registry for a rebuild of the model."""
    return registry.filter(F.col("model") != model)


def new_rows(incoming: DataFrame, raw: DataFrame, quarantine: DataFrame, key: list[str], content: str = "content_hash") -> DataFrame:
    """Incoming rows whose key and content no usable row has. Incoming rows are not compared with each other."""
    usable = raw.join(held(quarantine), BATCH, "left_anti")
    return incoming.join(usable.select(*key, content), [*key, content], "left_anti")


def newest(rows: DataFrame, key: list[str], observed: str, tie: str) -> DataFrame:
    """The newest observation of each key; ties go to the smaller content hash."""
    order = Window.partitionBy(*key).orderBy(F.desc(observed), F.asc_nulls_last(tie))
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def changed_since_last(incoming: DataFrame, stored: DataFrame, key: list[str], observed: str, content: str = "content_hash") -> DataFrame:
    """Observations that differ from the latest usable one of their key: A, B, A are three rows."""
    last = newest(stored, key, observed, content).select(*key, F.col(content).alias("_last"))
    return incoming.join(last, key, "left").filter(~F.col(content).eqNullSafe(F.col("_last"))).drop("_last")


def placeable(rows: DataFrame, required: list[str]) -> DataFrame:
    """Rows that can be placed; the others stay in staging."""
    return rows.dropna(subset=required)


def wide_keys(rows: DataFrame, key: list[str], start: str, existing: DataFrame | None = None, hours: int = 24) -> DataFrame:
    """Keys whose starts, those stored included, lie more than `hours` apart: they are not one thing."""
    starts = rows.select(*key, start)
    if existing is not None:
        starts = starts.unionByName(existing.select(*key, start).join(rows.select(*key).distinct(), key, "left_semi"))
    span = F.unix_timestamp(F.max(start).cast("timestamp")) - F.unix_timestamp(F.min(start).cast("timestamp"))
    return starts.groupBy(*key).agg(span.alias("span_seconds"), F.count(F.lit(1)).alias("n")).filter(F.col("span_seconds") > hours * 3600)


def guarded(rows: DataFrame, stored: DataFrame, key: list[str], start: str, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """(rows that may be written, keys that are withheld with how many observations they have): a key whose starts lie
    too far apart may be two things, and none of its rows is written."""
    wide = wide_keys(rows, key, start, stored).select(*key)
    return rows.join(wide, key, "left_anti"), rows.join(wide, key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("observations"))


def guard_items(withheld: DataFrame, queue: DataFrame, source_id: str, column: str, value: Column) -> DataFrame:
    """One open question for each withheld key that none is open for yet, with its observations when first raised."""
    item = ["source_id", "column_name", "value"]
    waiting = queue.filter(F.col("status").isin("open", "asked")).select(*item)
    raised = withheld.select(F.lit(source_id).alias("source_id"), F.lit(column).alias("column_name"), value.alias("value"), F.col("observations").alias("occurrences"))
    return raised.join(waiting, item, "left_anti").withColumn("status", F.lit("open"))


def upserts(candidates: DataFrame, stored: DataFrame, key: list[str], content: list[str], observed: str) -> DataFrame:
    """Candidates to write: the key is new, or the content differs and the observation is not older."""
    c, s = candidates.alias("c"), stored.withColumn("_there", F.lit(True)).alias("s")
    same_key = [F.col(f"c.{k}") == F.col(f"s.{k}") for k in key]
    write = F.col("s._there").isNull() | (differs(content, "c", "s") & (F.col(f"c.{observed}") >= F.col(f"s.{observed}")))
    return c.join(s, same_key, "left").filter(write).select("c.*")


def merged(stored: DataFrame, written: DataFrame, key: list[str]) -> DataFrame:
    """The table after the upsert."""
    return stored.join(written.select(*key), key, "left_anti").unionByName(written)


def changed_rows(candidates: DataFrame, stored: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Change-only writes for recomputed rows: new keys and differing content."""
    c, s = candidates.alias("c"), stored.withColumn("_there", F.lit(True)).alias("s")
    return c.join(s, [F.col(f"c.{k}") == F.col(f"s.{k}") for k in key], "left").filter(F.col("s._there").isNull() | differs(content, "c", "s")).select("c.*")


def to_rebuild(legs: DataFrame, key: str, changed_at: str, since: Column, margin_days: int = 1) -> DataFrame:
    """Keys with a change since the last build, less a margin; what is written is still decided by comparison."""
    return legs.filter(F.col(changed_at) >= since - F.expr(f"interval {margin_days} days")).select(key).distinct()


def clarifications(raised: DataFrame, queue: DataFrame) -> DataFrame:
    """New questions: one open item for each source, column and value, with the count when first raised."""
    item = ["source_id", "column_name", "value"]
    waiting = queue.filter(F.col("status").isin("open", "asked")).select(*item)
    return raised.groupBy(*item).agg(F.count(F.lit(1)).alias("occurrences")).join(waiting, item, "left_anti").withColumn("status", F.lit("open"))
