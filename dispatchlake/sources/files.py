"""Files as sources and sinks: CSV attachments, drops with a manifest, partitioned Parquet, exports."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import Contract
from .delimited import parse_csv


class Rejected(ValueError):
    """A whole batch is refused: nothing of it is read."""


def read_csv(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """The contract's columns as text, of one file or several. A batch that cannot be read, or whose header is not the
    contract's, is rejected whole; `stage_batch` keeps the rows of the latter for a later release."""
    batch = parse_csv(spark, path, contract)
    if batch.quarantine:
        raise Rejected("; ".join(batch.quarantine))
    return batch.rows


def read_drop(spark: SparkSession, folder: str, contract: Contract) -> DataFrame:
    """A drop of files with manifest.json ({files: {name: rows}, checksum}): all of it, or nothing.

    The checksum is the sum of the CRC-32 of every line, so it does not depend on the order of lines."""
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(f"{folder}/manifest.json").collect()))
    paths = [f"{folder}/{name}" for name in manifest["files"]]
    checksum = spark.read.option("lineSep", "\n").text(paths).agg(F.sum(F.crc32(F.col("value").cast("binary")))).first()[0]
    if checksum != manifest["checksum"]:
        raise Rejected("the checksum differs from the manifest")
    batch = parse_csv(spark, paths, contract, ("file",))
    if batch.quarantine:
        raise Rejected("; ".join(batch.quarantine))
    told = {unquote(r["file"].rpartition("/")[2]): r["count"] for r in batch.rows.groupBy("file").count().collect()}
    if dict.fromkeys(manifest["files"], 0) | told != manifest["files"]:
        raise Rejected("row counts differ from the manifest")
    return batch.rows.drop("file")


def append_raw(rows: DataFrame, path: str) -> None:
    """Raw data is only ever appended, by month of ingestion."""
    rows.write.mode("append").partitionBy("ingest_month").parquet(path)


class Staged(NamedTuple):
    """What became of a batch: rows appended to raw, and why they wait for a release."""

    rows: int
    quarantine: tuple[str, ...]
    unknown: tuple[str, ...]


def stage_batch(spark: SparkSession, path: str | list[str], contract: Contract, target: str, run_id: str, batch_seq: int, month: str) -> Staged:
    """One batch of files appended to raw in a single job, with its run and number and all that was received (payload). A
    batch whose header is not the contract's is appended too, and to be quarantined; one that cannot be read leaves no rows."""
    batch = parse_csv(spark, path, contract, ("payload",))
    if batch.rows is None:
        return Staged(0, batch.quarantine, batch.unknown)
    append_raw(batch.rows.withColumns({"run_id": F.lit(run_id), "batch_seq": F.lit(batch_seq).cast("long"), "ingest_month": F.lit(month)}), target)
    n = spark.read.parquet(target).filter((F.col("ingest_month") == month) & (F.col("run_id") == run_id) & (F.col("batch_seq") == batch_seq)).count()
    return Staged(n, batch.quarantine, batch.unknown)


def load_batch(spark: SparkSession, path: str | list[str], contract: Contract, target: str, run_id: str, batch_seq: int, month: str) -> int:
    """One batch of files appended to raw in a single job, with its run and number; returns its rows. A rejected batch
    writes nothing."""
    tagged = read_csv(spark, path, contract).withColumns({"run_id": F.lit(run_id), "batch_seq": F.lit(batch_seq).cast("long"), "ingest_month": F.lit(month)})
    append_raw(tagged, target)
    return spark.read.parquet(target).filter((F.col("ingest_month") == month) & (F.col("run_id") == run_id) & (F.col("batch_seq") == batch_seq)).count()


def overwrite_partitions(rows: DataFrame, path: str, partitions: list[str]) -> None:
    """Replaces the partitions that `rows` has rows for and leaves the others; `rows` must not read `path`."""
    rows.repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def export(rows: DataFrame, path: str, kind: str) -> None:
    if kind not in ("parquet", "csv"):
        raise ValueError("only parquet and csv")
    (rows.write.mode("errorifexists").option("header", True)).format(kind).save(path)


class Differs(RuntimeError):
    """What was written is not what the source has."""


def migrate(read: Callable[[str, int], DataFrame], entities: dict[str, list[int]], path: str, key: str) -> list[dict]:
    """An archive, entity by entity and year by year: each batch is read, written to its own folder, and reconciled
    by rows, distinct keys and a sum of row hashes before the next one begins. A batch that was committed is not
    read again; one that differs stops the migration with its folder left to be overwritten.

    `read(entity, year)` gives a batch, over JDBC for one (see `jdbc_year`)."""
    out = []
    for entity, years in entities.items():
        for year in years:
            source = read(entity, year)
            spark, folder = source.sparkSession, f"{path}/{entity}/year={year}"
            done = f"{path}/_migrated/{entity}/year={year}"
            try:
                out.append(spark.read.json(done).first().asDict())
                continue
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
            source.write.mode("overwrite").parquet(folder)
            told, stored = (_totals(df, key) for df in (source, spark.read.schema(source.schema).parquet(folder)))
            if told != stored:
                raise Differs(f"{entity} {year}: the source has {told}, the target {stored}")
            batch = {"entity": entity, "year": year, **told}
            spark.createDataFrame([batch]).write.json(done)
            out.append(batch)
    return out


def _totals(df: DataFrame, key: str) -> dict[str, int]:
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hashes")).first()
    return {"rows": row["rows"], "keys": row["keys"], "hashes": str(row["hashes"])}


def jdbc_year(spark: SparkSession, url: str, year_column: str, properties: dict[str, str]) -> Callable[[str, int], DataFrame]:
    """Reads one year of an entity over JDBC, a partition for each month."""

    def read(entity: str, year: int) -> DataFrame:
        months = [f"{year_column} >= '{year}-{m:02d}-01' AND {year_column} < '{year + m // 12}-{m % 12 + 1:02d}-01'" for m in range(1, 13)]
        return spark.read.jdbc(url, entity, predicates=months, properties=properties)

    return read
