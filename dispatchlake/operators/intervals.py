"""Joins on time intervals [valid_from, valid_to). Every join has an equi key; the interval is a residual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_at(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: list[str], guard: Column | None = None) -> DataFrame:
    """`facts` with `columns` of the version of its key that holds at `at`, or NULLs. Versions of a key don't overlap."""
    v = versions.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *columns)
    inside = (facts[key] == v["_key"]) & (facts[at] >= v["_from"]) & (facts[at] < v["_to"])
    return facts.join(v, inside if guard is None else inside & guard, "left").drop("_key", "_from", "_to")


def version_in(facts: DataFrame, versions: DataFrame, key: str, start: str, end: str, columns: list[str], row: list[str]) -> DataFrame:
    """`facts` with `columns` of the latest version that overlaps [start, end); `row` identifies a fact."""
    v = versions.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *columns)
    overlap = (facts[key] == v["_key"]) & (v["_from"] < facts[end]) & (v["_to"] > facts[start])
    order = Window.partitionBy(*row).orderBy(F.col("_from").desc_nulls_last())
    return facts.join(v, overlap, "left").withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank", "_key", "_from", "_to")


def as_of(points: DataFrame, states: DataFrame, key: str, at: str, effective: str, columns: list[str]) -> DataFrame:
    """`points` with `columns` of the newest state of its key effective at or before `at`.

    Both sides are put in one order by key and time, so nothing is paired: one shuffle, one sort. A key's rows lie in
    one task; for facts with keys of any size there is `as_of_sliced`."""
    order = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    filled = _union(points, states, key, at, effective, columns).withColumn("_state", F.last("_state", ignorenulls=True).over(order)).filter("_side = 1")
    return filled.select(*points.columns, *(F.col(f"_state.{c}").alias(c) for c in columns))


#: A key with more than 1 / HOT of all rows is cut into about SLICES slices of time.
HOT = 1000
SLICES = 64


def _union(points: DataFrame, states: DataFrame, key: str, at: str, effective: str, columns: list[str]) -> DataFrame:
    """Both sides in one order: key, _at, _side (0 for states), the points' columns, _state."""
    own = [c for c in points.columns if c != key]
    state = states.select(F.col(key), F.col(effective).alias("_at"), F.lit(0).alias("_side"), *(F.lit(None).cast(points.schema[c].dataType).alias(c) for c in own), F.struct(*columns).alias("_state"))
    return state.unionByName(points.select(key, F.col(at).alias("_at"), F.lit(1).alias("_side"), *own, F.lit(None).cast(state.schema["_state"].dataType).alias("_state")))


def time_slices(rows: DataFrame, key: str, slices: int = SLICES, hot: int = HOT) -> DataFrame:
    """`rows` (key, _at) with _slice: 0, or for keys with more than 1 / hot of all rows the number of a slice of time;
    equal times lie in one slice. Fewer than `hot` keys and their bounds are broadcast, whatever the size."""
    total = rows.count()
    frequent = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > total / hot).select(key)
    quantiles = F.array(*(F.lit(i / slices) for i in range(1, slices)))
    bounds = rows.join(F.broadcast(frequent), key).groupBy(key).agg(F.array_distinct(F.percentile_approx("_at", quantiles, 100 * slices)).alias("_bounds"))
    # a null time is before all others
    number = F.size(F.filter("_bounds", lambda b: b <= F.col("_at")))
    return rows.join(F.broadcast(bounds), key, "left").withColumn("_slice", F.when(F.col("_bounds").isNull() | F.col("_at").isNull(), 0).otherwise(number)).drop("_bounds")


def as_of_sliced(points: DataFrame, states: DataFrame, key: str, at: str, effective: str, columns: list[str], slices: int = SLICES, hot: int = HOT) -> DataFrame:
    """What `as_of` gives, for facts whose keys may hold any share of all rows: two passes over slices of time.

    Within its slice a point finds the newest state as in `as_of`. The last state of each slice, one row for each, is
    carried forward over the slices of its key; a point before the first state of its slice takes what was carried."""
    rows = time_slices(_union(points, states, key, at, effective, columns), key, slices, hot)
    order = Window.partitionBy(key, "_slice").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_state", ignorenulls=True).over(order)).filter("_side = 1")
    last = rows.groupBy(key, "_slice").agg(F.max_by("_state", F.when(F.col("_side") == 0, F.struct(F.col("_at").isNotNull().alias("known"), "_at"))).alias("_last"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter("_slice > 0").select(F.col(key), "_slice", "_carried")
    both = found.join(carried, [key, "_slice"], "left").withColumn("_newest", F.coalesce("_found", "_carried"))
    return both.select(*points.columns, *(F.col(f"_newest.{c}").alias(c) for c in columns))


def contained_or_last_ended(points: DataFrame, marks: DataFrame, key: str, at: str, columns: list[str], row: list[str]) -> DataFrame:
    """`points` with `columns` of two marks of their key: in_... of the one that began last of those that hold at `at`,
    and ended_... of the one that ended last by then. `row` identifies a point."""
    inside = version_at(points, marks.select(key, "valid_from", "valid_to", F.struct("valid_from", *columns).alias("_in")), key, at, ["_in"])
    latest = inside.groupBy(*row).agg(F.max("_in").alias("_in"))
    ended = as_of(points.select(key, at, *row), marks, key, at, "valid_to", columns)
    joined = ended.join(latest, row)
    return joined.select(key, at, *row, *(F.col(f"_in.{c}").alias(f"in_{c}") for c in columns), *(F.col(c).alias(f"ended_{c}") for c in columns))


def overlapping(versions: DataFrame, key: str) -> DataFrame:
    """Versions that overlap an earlier one of their key, or are inverted. One pass over each key in order."""
    order = Window.partitionBy(key).orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    seen = versions.withColumn("_until", F.max("valid_to").over(order))
    return seen.filter((F.col("valid_from") < F.col("_until")) | (F.col("valid_to") <= F.col("valid_from"))).drop("_until")


def intersect_shifts(intervals: DataFrame, shifts: DataFrame, start: str, end: str) -> DataFrame:
    """Seconds of each interval that fall into each daily shift window (start_second, end_second of the day).

    The interval is cut into its days first, so shifts (a handful) are the only thing that is broadcast."""
    day0 = F.floor(F.col(start) / 86400)
    days = intervals.withColumn("_day", F.explode(F.sequence(day0, F.greatest(day0, F.floor((F.col(end) - 1) / 86400)))))
    begin = F.greatest(F.col(start), F.col("_day") * 86400 + F.col("start_second"))
    until = F.least(F.col(end), F.col("_day") * 86400 + F.col("end_second"))
    return days.join(F.broadcast(shifts), until > begin).withColumn("seconds", until - begin).drop("_day")


def inside_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Ray casting; a polygon of few corners becomes one expression."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if y1 != y2:
            crossings = crossings + F.when(((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1), 1).otherwise(0)
    return crossings % 2 == 1
