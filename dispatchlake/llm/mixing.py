"""Mixing sources to target weights with hash-threshold histograms, without sorting rows.

Every source has a weight; all sources together give as many words as there are. A target stops at
`most` times its source's size and the excess is shared anew by weight until none is above.

A source's target is a number of whole passes over it and a budget below one pass. For the budget, a
row's id, text and source give it a hash; sizes are summed by source and the hash's first 12 bits, the
bucket in which the running sum passes the budget is found, and only that bucket is refined by the next
12 bits, and once more. What is left is one threshold for each source: a row is taken once more if its
hash is below. The last bucket is taken or left, whichever comes nearer to the target.

Rows equal in id, text and source are numbered, and the number is part of their hashes, so they are
taken one by one. They are numbered within the partitions of a written table, whose counts are then
added up: no group of equal rows meets in one task.

Sizes: words between ASCII white space; null texts have size 0 and are taken 0 times. The null source
is a source of its own, last. Null ids are ids like others. Very long texts are taken whole or not. An
empty table stays empty. Nothing depends on the order of rows: reruns agree (which of several rows equal
in id, text and source is taken, that differ in other columns, is open). Other columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

BITS = 12
LEVELS = 3
MOST = 3
WEIGHTS = (1, 2, 3)
HASH_BITS = 60


def size_of(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(doc_id, text, source) -> F.Column:
    """Equal for rows equal in id, text and source, nulls told from all values."""
    marked = lambda c: F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("\x1f", marked(doc_id), F.coalesce(F.md5(text), F.lit("-")), marked(source)))


def hash_of(key, number) -> F.Column:
    """60 bits for the row that stands at this place among those of its key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key, number.cast("string"))), 1, 15), 16, 10).cast("long")


def repeated(rows: DataFrame) -> DataFrame | None:
    """The keys that several of `rows` have; None where there is none."""
    found = saved(rows.groupBy("key").count().filter("count > 1").select("key"), "mix-repeated")
    return None if found.isEmpty() else found


def placed(df: DataFrame) -> DataFrame:
    """`df` written, with the partition and the row in which each of its rows lies."""
    return saved(df.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "mix-rows")


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` (key, part, row) with their number among the rows of their key, from 1."""
    own = F.row_number().over(Window.partitionBy("key", "part").orderBy("row"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("key", "part").count()
    before = counts.select("key", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return rows.withColumn("own", own).join(before, ["key", "part"]).withColumn("number", F.col("own") + F.col("before")).drop("own", "before")


def _prefix(levels: int) -> F.Column:
    return F.shiftright("hash", HASH_BITS - BITS * levels)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target (double) from one row for each source: source, source_size.

    Sources are numbered in their order by what each sorted partition holds, and sources fill up round by
    round from two sums, so any number of sources will do."""
    wide = "decimal(38,0)"
    ordered = sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ordered = saved(ordered.withColumn("part", F.shiftrightunsigned("at", 33)), "mix-sources")
    # one row for each partition of the sort
    parts = ordered.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    position = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (position % len(weights) + 1).cast("int")).alias("weight")
    weighed = saved(ordered.join(F.broadcast(parts.drop("count")), "part").select("source", "source_size", weight), "mix-weights")
    total, open_weight = weighed.agg(F.sum(F.col("source_size").cast(wide)), F.sum("weight")).first()
    left = total = int(total or 0)
    open_weight = int(open_weight or 0)
    while True:  # sources that are full at a share stay so at a larger one
        full = F.col("source_size").cast(wide) * most * F.lit(open_weight).cast(wide) <= F.col("weight").cast(wide) * F.lit(str(left)).cast(wide)
        held, still = weighed.agg(F.sum(F.when(full, F.col("source_size").cast(wide) * most)), F.sum(F.when(~full, F.col("weight")))).first()
        before, (left, open_weight) = (left, open_weight), (total - int(held or 0), int(still or 0))
        if (left, open_weight) == before or not open_weight:
            break
    open_target = F.lit(float(left)) * F.col("weight") / F.lit(float(max(1, open_weight)))
    return weighed.select("source", "source_size", F.when(full, (most * F.col("source_size")).cast("double")).otherwise(open_target).alias("target"))


def _boundary(sized: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """`wanted` (source, budget, prefix so far) narrowed by one level: the bucket in which the running sum
    passes the budget, what of the budget is left for it, and its size."""
    if level > 1:
        before = wanted.select(F.col("source").alias("of"), F.col("prefix").alias("was"))
        sized = sized.join(before, F.col("source").eqNullSafe(F.col("of")) & (_prefix(level - 1) == F.col("was")), "left_semi")
    buckets = sized.groupBy("source", _prefix(level).alias("bucket")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.withColumn("until", F.sum("words").over(running)).withColumnRenamed("source", "of")
    joined = wanted.drop("prefix", "words").join(buckets, F.col("source").eqNullSafe(F.col("of")) & (F.col("until") > F.col("budget")), "left")
    first = F.min(F.struct("bucket", "until", "words")).alias("b")
    found = joined.groupBy("source", "source_size", "target", "passes", "budget").agg(first)
    # no bucket passes the budget where it is the whole source, or nothing
    left = F.col("budget") - F.coalesce(F.col("b.until") - F.col("b.words"), F.lit(0))
    return found.select("source", "source_size", "target", "passes", left.alias("budget"), F.col("b.bucket").alias("prefix"), F.col("b.words").alias("words"))


def thresholds(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target, passes and threshold from rows with source, size and hash: a row is taken
    `passes` times, and once more if the first bits of its hash are below the threshold."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(sizes, weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    wanted = wanted.withColumn("passes", passes).withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    for level in range(1, LEVELS + 1):
        wanted = saved(_boundary(sized, wanted, level), "mix-level")
    nearer = F.when(2 * F.col("budget") > F.col("words"), 1).otherwise(0)
    return wanted.select("source", "source_size", "target", "passes", (F.coalesce("prefix", F.lit(0)) + F.coalesce(nearer, F.lit(0))).alias("threshold"))


def times(hash_: F.Column) -> F.Column:
    """How often a row of this hash is taken, from its source's passes and threshold."""
    return F.col("passes") + F.when(F.shiftright(hash_, HASH_BITS - BITS * LEVELS) < F.col("threshold"), 1).otherwise(0)


def measured(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, source, size and hash of every row, written once: the histograms read no text; the keys of
    repeated rows)."""
    columns = [F.col(c) for c in ("doc_id", "text", "source")]
    rows = placed(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key_of(*columns).alias("key")))
    many = repeated(rows)
    if many is None:
        rows = rows.withColumn("number", F.lit(1))
    else:
        rows = rows.join(many, "key", "left_anti").withColumn("number", F.lit(1)).unionByName(saved(numbered(rows.join(many, "key", "left_semi")), "mix-numbers"))
    return rows.select("doc_id", "source", "size", hash_of(F.col("key"), F.col("number")).alias("hash")), many


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every row of `docs`."""
    sized, _ = measured(docs)
    found = thresholds(sized, weights, most).withColumnRenamed("source", "of")
    joined = sized.join(found, F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * times(F.col("hash"))).alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it (rows of no words never)."""
    sized, many = measured(docs)
    found = thresholds(sized, weights, most).select(F.col("source").alias("of"), "passes", "threshold")
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    packed = docs.select(own.alias("doc"), key_of(F.col("doc_id"), F.col("text"), F.col("source")).alias("key")).filter(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"))
    if many is None:
        packed = packed.withColumn("number", F.lit(1))
    else:
        again = numbered(placed(packed.join(many, "key", "left_semi"))).drop("part", "row")
        packed = packed.join(many, "key", "left_anti").withColumn("number", F.lit(1)).unionByName(again)
    met = packed.join(found, F.col("doc.source").eqNullSafe(F.col("of")))
    met = met.withColumn("times", times(hash_of(F.col("key"), F.col("number")))).filter("times > 0")
    return met.select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every row of documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
