"""What the operators of this subpackage share: the cluster's folder and sizes taken from the input."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only where the session names none and has one machine (master local[...]) a temporary folder is set;
    a cluster without a shared folder is an error, as its executors could not read each other's files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(named)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def saved(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: computed once, whoever reads it,
    and not lost with an executor."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Removes the files of frames that `saved` has written and that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or where `df` has such a column, a name that it lacks."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name = f"_{name}"
    return name


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The keys of `counts` (a row for each key, with its rows in `n`) that hold more than a thousandth of
    all rows: fewer than a thousand, whatever the input's size, so they may be broadcast."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) > total / 1000).select(key)


def join_many(big: DataFrame, small: DataFrame, key: str, n: str = "n") -> DataFrame:
    """`big` joined with `small`, which has one row for each key and in `n` the key's rows in `big`. Rows of
    hot keys meet a broadcast of fewer than a thousand rows, the others a shuffle."""
    hot = small.join(F.broadcast(hot_keys(small, key, n)), key, "left_semi")
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti")
    return big.join(F.broadcast(hot), key).unionByName(rest.join(small, key)).drop(n)


#: Texts come to Python tasks in batches of at most so many rows and bytes; a longer text is a batch of its own.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to the bounds above: both sides of the pipe hold a batch at a time."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; sizes of sketches and numbers of blocks follow it."""
    return int(docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts(spark: SparkSession, size: float, most: int = 64 << 20, least: int = 4) -> int:
    """How many pieces `size` bytes are cut into: of `most` bytes at most, and `least` for each shuffle partition."""
    return max(least * partitions(spark), int(-(-size // most)), 1)
