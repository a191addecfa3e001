"""What was answered: results kept by their cache key, and the audit of requests as a dataset.

A key holds everything that can change an answer, the publication's number among it, so a correction or a day that is
closed leads to another key and what was kept is simply not asked for any more. A hit reads the control table and the
kept result, at most MAX_ROWS rows, and no mart.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT = "at timestamp, day date, user string, request string, outcome string, rows long"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


@dataclass
class ResultCache:
    """Results under `path`, a folder for each key. What is kept is whole: its metadata is written last."""

    spark: SparkSession
    path: str

    def _folder(self, key: str, more: object) -> str:
        return f"{self.path}/{hashlib.sha256(f'{key} {more!r}'.encode()).hexdigest()}"

    def get(self, key: str, more: object = ()) -> tuple[list, dict] | None:
        """(rows, metadata) of a key, and of what else the answer depends on; None where nothing is kept."""
        folder = self._folder(key, more)
        try:
            told = self.spark.read.text(f"{folder}/meta").first()
        except AnalysisException as error:
            if _missing(error):
                return None
            raise
        if told is None:
            return None
        meta = json.loads(told[0])
        if meta["data_as_of"] is not None:
            meta["data_as_of"] = dt.date.fromisoformat(meta["data_as_of"])
        rows = self.spark.read.parquet(f"{folder}/rows").orderBy("_at").drop("_at").collect()
        return rows, meta

    def put(self, key: str, rows: list, schema, meta: dict, more: object = ()) -> None:
        folder = self._folder(key, more)
        numbered = self.spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema=schema.add("_at", "long") if "_at" not in schema.names else schema)
        numbered.coalesce(1).write.mode("overwrite").parquet(f"{folder}/rows")
        self.spark.createDataFrame([(json.dumps(meta, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/meta")


@dataclass
class AuditLog:
    """Requests as rows under `path`, a folder for each day; an entry is written before an answer is returned."""

    spark: SparkSession
    path: str

    def __call__(self, entry: dict) -> None:
        now = dt.datetime.now(dt.UTC)
        row = (now, now.date(), entry["user"], entry.get("request", entry.get("statement")), entry["outcome"], entry["rows"])
        self.spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").partitionBy("day").parquet(self.path)

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(AUDIT).parquet(self.path)
        except AnalysisException as error:
            if _missing(error):
                return self.spark.createDataFrame([], AUDIT)
            raise

    def asked(self, user: str, day: dt.date) -> int:
        """How many requests of a user were answered on a day: what a daily quota counts."""
        return self.rows().filter((F.col("day") == day) & (F.col("user") == user) & (F.col("outcome") == "ok")).count()
