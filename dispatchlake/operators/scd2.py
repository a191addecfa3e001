"""Dimensions with versions [valid_from, valid_to), cut at every point at which an entity's state changes.

A table of versions has the key, its attributes, role, valid_from and valid_to; the open version ends at
OPEN. All functions take the time as an argument: nothing depends on the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import as_of, version_at

OPEN = "9999-12-31 00:00:00"
SENTINEL = "1970-01-01 00:00:00"


def pending_snapshots(snapshots: DataFrame, applied: DataFrame, usable: DataFrame) -> DataFrame:
    """Usable snapshots newer than the newest that was applied; older ones that are released late never are."""
    newest = applied.groupBy("dataset").agg(F.max("version").alias("_applied"))
    return snapshots.join(usable, ["run_id", "batch_seq"], "left_semi").join(newest, "dataset", "left").filter(F.col("_applied").isNull() | (F.col("version") > F.col("_applied"))).drop("_applied")


def snapshot_in_force(pending: DataFrame, applied: DataFrame) -> DataFrame:
    """The oldest pending snapshot of each dataset, or else the newest applied."""
    first = pending.groupBy("dataset").agg(F.min("version").alias("pending"))
    last = applied.groupBy("dataset").agg(F.max("version").alias("applied"))
    return first.join(last, "dataset", "full_outer").select("dataset", F.coalesce("pending", "applied").alias("version"), F.col("pending").isNotNull().alias("is_pending"))


def in_scope(rows: DataFrame, site: Column, sites: list[str]) -> DataFrame:
    return rows.filter(site.isin(sites))


def timeline(snapshots: DataFrame, times: DataFrame, marks: DataFrame, current: DataFrame, key: str, attributes: list[str], now: Column) -> DataFrame:
    """Change points of every entity: key, at, present, attributes, role, next_at, is_new.

    snapshots: key, snapshot_at, attributes; times: snapshot_at of every pending snapshot (few); marks: key,
    starts_at, ends_at, role; current: open versions. An entity that a snapshot lacks is closed by it. Nothing
    before the current version is rewritten."""
    entities = snapshots.select(key).union(current.select(key)).distinct()
    # an entity meets each pending snapshot once: those are a handful
    grid = entities.crossJoin(F.broadcast(times.select("snapshot_at").distinct()))
    there = snapshots.select(key, "snapshot_at", F.lit(True).alias("present"), *attributes)
    states = grid.join(there, [key, "snapshot_at"], "left").select(key, F.col("snapshot_at").alias("state_at"), F.coalesce("present", F.lit(False)).alias("present"), *attributes)
    base = current.select(key, F.col("valid_from").alias("state_at"), F.lit(True).alias("present"), *attributes)
    floor = current.select(key, F.col("valid_from").alias("_floor"), F.struct(F.lit(True).alias("present"), *attributes, "role").alias("_base"))
    ends = marks.select(key, F.explode(F.array("starts_at", "ends_at")).alias("at"))
    points = grid.select(key, F.col("snapshot_at").alias("at")).union(ends).union(current.select(key, F.col("valid_from") + F.expr("interval 1 second"))).distinct()
    points = points.filter(F.col("at") <= now).join(entities, key, "left_semi").join(floor, key, "left").filter(F.col("_floor").isNull() | (F.col("at") > F.col("_floor")))
    dated = as_of(points, states.unionByName(base), key, "at", "state_at", ["present", *attributes])
    marked = as_of(dated, marks.select(key, "starts_at", "ends_at", "role"), key, "at", "starts_at", ["ends_at", "role"])
    role = F.when(F.col("at") < F.col("ends_at"), F.col("role"))
    state = F.struct(F.coalesce("present", F.lit(False)).alias("present"), *attributes, role.alias("role"))
    nothing = F.struct(F.lit(False).alias("present"), *(F.lit(None).cast(snapshots.schema[a].dataType).alias(a) for a in attributes), F.lit(None).cast("string").alias("role"))
    order = Window.partitionBy(key).orderBy("at")
    # absent entities have one state, whatever marks say
    shown = marked.withColumn("_state", F.when(state["present"], state).otherwise(nothing)).withColumn("_default", F.coalesce("_base", nothing))
    before = F.when(F.row_number().over(order) == 1, F.col("_default")).otherwise(F.lag("_state").over(order))
    kept = shown.withColumn("_before", before).filter(~F.col("_state").eqNullSafe(F.col("_before")))
    return kept.select(key, "at", "_state.*", F.lead("at").over(order).alias("next_at"), F.col("_floor").isNull().alias("is_new"), F.col("_before").alias("before"))


def new_versions(changes: DataFrame, key: str, attributes: list[str], first: Column) -> DataFrame:
    """Versions to insert. An entity that the very first snapshot has is in force since the sentinel."""
    start = F.when(F.col("is_new") & (F.col("at") == first), F.lit(SENTINEL).cast("timestamp")).otherwise(F.col("at"))
    return changes.filter("present").select(key, *attributes, "role", start.alias("valid_from"), F.coalesce("next_at", F.lit(OPEN).cast("timestamp")).alias("valid_to"))


def closed(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Current versions with their end moved to the entity's first change point."""
    first = changes.groupBy(key).agg(F.min("at").alias("_end"))
    return current.join(first, key, "left").withColumn("valid_to", F.coalesce("_end", "valid_to")).drop("_end")


def change_log(changes: DataFrame, key: str, fields: list[str], marks: DataFrame | None = None) -> DataFrame:
    """One row for each field that changed: key, at, field, before, after, author (`sync`, or a mark's)."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"before.{f}").cast("string").alias("before"), F.col(f).cast("string").alias("after")) for f in fields))
    rows = changes.select(key, "at", F.inline(pairs)).filter(~F.col("before").eqNullSafe(F.col("after")))
    if marks is None:
        return rows.withColumn("author", F.lit("sync"))
    by = marks.select(key, F.explode(F.array("starts_at", "ends_at")).alias("at"), F.lit("role").alias("field"), "author").dropDuplicates([key, "at"])
    return rows.join(by, [key, "at", "field"], "left").withColumn("author", F.coalesce("author", F.lit("sync")))


def relinked(facts: DataFrame, versions: DataFrame, key: str, at: str, link: str, stored: str, touched: DataFrame | None = None) -> DataFrame:
    """Facts of touched entities (all of them for a repair) whose link by the rule differs from the stored one."""
    own = facts if touched is None else facts.join(touched.select(key).distinct(), key, "left_semi")
    return version_at(own, versions, key, at, [link]).filter(~F.col(link).eqNullSafe(F.col(stored)))


def unlinked(facts: DataFrame, versions: DataFrame, key: str, link: str) -> DataFrame:
    """Members without a version, and how many facts have them; silent while the dimension is empty."""
    if versions.isEmpty():
        return facts.filter("false").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return facts.filter(F.col(link).isNull() & F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def reference_codes(old: DataFrame, new: DataFrame, domains: list[str]) -> DataFrame:
    """A code table after new snapshots of `domains`: domain, code, label, is_current, action."""
    o = old.select("domain", "code", F.col("label").alias("_old"), F.col("is_current").alias("_was"))
    n = new.select("domain", "code", F.col("label").alias("_new"))
    both = o.join(n, ["domain", "code"], "full_outer")
    fresh = F.col("domain").isin(domains)
    action = (
        F.when(~fresh, "untouched").when(F.col("_was").isNull(), "inserted").when(F.col("_new").isNull(), F.when(F.col("_was"), "retired").otherwise("untouched"))
        .when(~F.col("_was"), "returned").when(~F.col("_old").eqNullSafe(F.col("_new")), "relabelled").otherwise("untouched")
    )
    current = F.when(fresh, F.col("_new").isNotNull()).otherwise(F.col("_was"))
    return both.filter(fresh | F.col("_was").isNotNull()).select("domain", "code", F.when(fresh, F.coalesce("_new", "_old")).otherwise(F.col("_old")).alias("label"), current.alias("is_current"), action.alias("action"))


def to_reconfirm(changes: DataFrame, key: str, label: str) -> DataFrame:
    """Entities whose label changed while present: links made by the old label want a look."""
    renamed = F.col("present") & F.col("before.present") & ~F.col(label).eqNullSafe(F.col(f"before.{label}"))
    return changes.filter(renamed).select(key, F.col(f"before.{label}").alias("was"), F.col(label).alias("is"), F.lit("pending_reconfirm").alias("status"))
