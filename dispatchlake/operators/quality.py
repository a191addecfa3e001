"""Checks of whole batches, and tests that return the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.content import differs
from .incremental import BATCH
from .intervals import version_at


def batch_findings(rows: DataFrame, rules: dict[str, Column], batch: list[str] = BATCH) -> DataFrame:
    """For each batch, how many rows break each rule, in one aggregation."""
    return rows.groupBy(*batch).agg(*(F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()), F.count(F.lit(1)).alias("n"))


def repeats(rows: DataFrame, key: list[str], batch: list[str] = BATCH) -> DataFrame:
    """Rows whose key occurs again in their batch, by batch."""
    counted = rows.groupBy(*batch, *key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*batch).agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("repeated"))


def verdicts(findings: DataFrame, fatal: list[str]) -> DataFrame:
    """quarantined if any fatal rule is broken: the whole batch, never single rows."""
    broken = F.concat_ws(",", *(F.when(F.col(c) > 0, F.lit(c)) for c in fatal))
    return findings.withColumn("reason", broken).withColumn("state", F.when(broken == "", "accepted").otherwise("pending"))


def snapshot_findings(snapshot: DataFrame, key: str, trusted: DataFrame, batch: list[str] = BATCH) -> DataFrame:
    """Repeated keys, rows without a key, and whether the snapshot shrank to nothing against the trusted ones."""
    per_key = snapshot.groupBy(*batch, key).agg(F.count(F.lit(1)).alias("_n"))
    had = trusted.agg(F.count(F.lit(1)).alias("_trusted"))
    found = per_key.groupBy(*batch).agg(F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("repeated_keys"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("without_key"), F.sum("_n").alias("n"))
    return found.crossJoin(F.broadcast(had)).withColumn("emptied", (F.col("n") - F.col("without_key") == 0) & (F.col("_trusted") > 0)).drop("_trusted")


def stored_links_differ(facts: DataFrame, link: str, rule: str) -> DataFrame:
    return facts.filter(~F.col(link).eqNullSafe(F.col(rule)))


def legs_without_dimension(legs: DataFrame, dimensions: dict[int, DataFrame]) -> DataFrame:
    """Legs that no version of their device covers, by device: how many, the first and the last.

    dimensions: versions by device type; a type is silent while its dimension is empty."""
    covered = {code: versions.withColumn("_sk", F.lit(True)) for code, versions in dimensions.items() if not versions.isEmpty()}
    own = legs.filter(F.col("device_type_code").isin(list(covered)))
    versions = None
    for code, v in covered.items():
        part = v.select(F.struct(F.lit(code).alias("device_type_code"), "device_no").alias("_device"), "valid_from", "valid_to", "_sk")
        versions = part if versions is None else versions.unionByName(part)
    if versions is not None:
        own = version_at(own.withColumn("_device", F.struct("device_type_code", "device_no")), versions, "_device", "wait_begin", ["_sk"]).filter("_sk is null")
    return own.groupBy("device_type_code", "device_no").agg(F.count(F.lit(1)).alias("legs"), F.min("wait_begin").alias("first_leg"), F.max("wait_begin").alias("last_leg"))


def duration_differs(sessions: DataFrame, start: str, end: str, duration: str, seconds: int = 60) -> DataFrame:
    return sessions.filter(F.abs(F.col(duration) - (F.col(end) - F.col(start))) > seconds)


def columns_match(model: DataFrame, contract: DataFrame, name: str) -> DataFrame:
    """Names that only one side has."""
    a, b = model.select(name, F.lit(True).alias("_m")), contract.select(name, F.lit(True).alias("_c"))
    return a.join(b, name, "full_outer").filter("_m is null or _c is null").select(name, F.when(F.col("_m").isNull(), "missing").otherwise("extra").alias("finding"))


def recompute_differs(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose columns differ between two derivations, or that only one of them has."""
    joined = a.withColumn("_a", F.lit(True)).alias("a").join(b.withColumn("_b", F.lit(True)).alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    return joined.filter(F.col("_a").isNull() | F.col("_b").isNull() | differs(columns, "a", "b")).select(F.coalesce(f"a.{key}", f"b.{key}").alias(key))


def result_rule_violations(calls: DataFrame) -> DataFrame:
    """Calls whose result contradicts their legs: one row for each rule and call."""
    reached = F.col("queue_legs") + F.col("agent_legs") > 0
    result = F.col("call_result")
    rules = {
        "complete_without_result": F.col("is_complete") & result.isNull(),
        "incomplete_with_result": ~F.col("is_complete") & result.isNotNull(),
        "answered_without_answer": (result == "answered") & (F.col("answered_legs") == 0),
        "answer_not_counted": F.col("is_complete") & (F.col("answered_legs") > 0) & (result != "answered"),
        "abandoned_not_by_caller": (result == "abandoned") & ~F.col("released_by").eqNullSafe(F.lit("caller")),
        "ivr_only_with_queue": (result == "ivr_only") & reached,
        "ended_while_open": ~F.col("is_complete") & F.col("ended_at").isNotNull(),
    }
    broken = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return calls.select("call_id", F.explode(broken).alias("rule"))


def last_leg_flags(legs: DataFrame) -> DataFrame:
    """Legs whose flag contradicts the sequence, or that are released before the last leg."""
    last = F.col("leg_seq") == -1
    return legs.filter((F.col("is_last") != last) | (~last & F.col("release_source").isNotNull()))


def several_last_legs(legs: DataFrame, key: str = "call_id") -> DataFrame:
    return legs.groupBy(key).agg(F.count_if(F.col("leg_seq") == -1).alias("n")).filter("n > 1")


def without_first_leg(calls: DataFrame) -> DataFrame:
    """How many calls start after their first leg, and the oldest; no row if there are none."""
    late = calls.filter(F.col("first_leg_seq") > 1)
    return late.agg(F.count(F.lit(1)).alias("n"), F.min("date_key").alias("oldest")).filter("n > 0")


def behind(batches: DataFrame, registry: DataFrame, model: str, as_of: Column, days: int = 1) -> DataFrame:
    """Batches older than `days` that a model has not registered."""
    done = registry.filter(F.col("model") == model).select(*BATCH)
    return batches.filter(F.col("loaded_at") < as_of - F.expr(f"interval {days} days")).join(done, BATCH, "left_anti")


def closing_behind(publications: DataFrame, mart: str, today: Column, days: int = 3) -> DataFrame:
    """A row if the last closed day is more than `days` behind, or there is none."""
    closed = publications.filter((F.col("mart") == mart) & (F.col("close_version") >= 1)).agg(F.max("day").alias("last_closed"))
    return closed.filter(F.col("last_closed").isNull() | (F.datediff(today, "last_closed") > days))


def version_without_change(snapshots: DataFrame, scope: str, version: str, content: str) -> DataFrame:
    """Scopes whose newest version has the content of the one before: as many rows, with equal sums of two hashes
    each, so a scope of any size is summed in parts."""
    hashes = (F.xxhash64(content).cast("decimal(38,0)"), F.xxhash64(F.lit(1), content).cast("decimal(38,0)"))
    prints = snapshots.groupBy(scope, version).agg(F.struct(F.count(F.lit(1)), *map(F.sum, hashes)).alias("print"))
    order = Window.partitionBy(scope).orderBy(version)
    seen = prints.withColumns({"before": F.lag("print").over(order), "left": F.lead(version).over(order)})
    return seen.filter(F.col("left").isNull() & (F.col("print") == F.col("before"))).select(scope, version)


def publication_mismatch(rows: DataFrame, publications: DataFrame) -> DataFrame:
    """Days and versions whose rows are not as many as the publication record says."""
    key = ["day", "close_version"]
    there = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    joined = publications.join(there, key, "full_outer")
    return joined.filter(F.col("row_count").isNull() | (F.col("row_count") != F.coalesce("_rows", F.lit(0)))).select(*key)
