"""Drops of files as they arrive: a stream over the files, and a control table of drops that are not whole yet.

A drop is a folder with a manifest (see `sources.files.read_drop`). Its files and its manifest may come in any order
and at any time. Every file that arrives makes its drop a candidate, together with those that wait; a candidate is
loaded if all that its manifest names is there and agrees, and waits otherwise. A drop whose files are all there but
do not agree waits too, as a file may still be written, and is rejected once nothing of it has changed for `patience`
batches. What is loaded lies in a folder for each drop and is written before it is told, so a batch that a crash
interrupts loads it again to the same end, and no drop is loaded twice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import Contract
from ..sources.files import Rejected, overwrite_partitions, read_drop

CONTROL = "drop string, epoch long, state string, reason string, files long, bytes long"
MANIFEST = "manifest.json"


@dataclass
class Drops:
    """Drops under `inbox`, one folder each, loaded into `target`/rows; the control table is `target`/control."""

    spark: SparkSession
    inbox: str
    target: str
    contract: Contract
    patience: int = 3

    def events(self) -> DataFrame:
        """Every decision on every drop, in order of epoch."""
        try:
            return self.spark.read.schema(CONTROL).parquet(f"{self.target}/control")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], CONTROL)

    def states(self) -> DataFrame:
        """The last decision on each drop, and since when nothing of it has changed."""
        last = F.max_by(F.struct("epoch", "state", "reason", "files", "bytes"), "epoch").alias("last")
        same = self.events().groupBy("drop", "files", "bytes").agg(F.count(F.lit(1)).alias("seen"))
        return self.events().groupBy("drop").agg(last).select("drop", "last.*").join(same, ["drop", "files", "bytes"])

    def stream(self) -> DataFrame:
        """The files as they arrive: names and sizes, not what they hold."""
        schema = "path string, modificationTime timestamp, length long, content binary"
        return self.spark.readStream.schema(schema).format("binaryFile").option("recursiveFileLookup", True).load(self.inbox).select("path", "length")

    def epoch(self, files: DataFrame, epoch: int) -> None:
        if not self.events().filter(F.col("epoch") == epoch).isEmpty():
            return
        new = {r[0] for r in files.select(F.element_at(F.split("path", "/"), -2).alias("drop")).distinct().collect()}
        known = {r["drop"]: r for r in self.states().collect()}
        waiting = {d for d, r in known.items() if r["state"] == "waiting"}
        settled = set(known) - waiting
        told = [self._try(unquote(d), known.get(d), epoch) for d in sorted((new | waiting) - settled)]
        if told:  # all at once, after everything is loaded
            self.spark.createDataFrame(told, CONTROL).coalesce(1).write.mode("append").parquet(f"{self.target}/control")

    def _there(self, drop: str) -> dict[str, int]:
        listed = self.spark.read.format("binaryFile").load(f"{self.inbox}/{drop}").select("path", "length").collect()
        return {unquote(r["path"].rpartition("/")[2]): r["length"] for r in listed}

    def _try(self, drop: str, before, epoch: int) -> tuple:
        there = self._there(drop)
        size = (len(there), sum(there.values()))
        decided = lambda state, reason: (drop, epoch, state, reason, *size)
        if MANIFEST not in there:
            return decided("waiting", "no manifest")
        folder = f"{self.inbox}/{drop}"
        try:
            named = json.loads("\n".join(r[0] for r in self.spark.read.text(f"{folder}/{MANIFEST}").collect()))["files"]
            if missing := sorted(set(named) - set(there)):
                return decided("waiting", f"missing: {', '.join(missing)}")
            rows = read_drop(self.spark, folder, self.contract)
        except (Rejected, ValueError, KeyError, TypeError) as error:
            unchanged = before is not None and (before["files"], before["bytes"]) == size and before["seen"] + 1 >= self.patience
            return decided("rejected" if unchanged else "waiting", str(error)[:200])
        overwrite_partitions(rows.withColumn("drop", F.lit(drop)), f"{self.target}/rows", ["drop"])
        return decided("loaded", None)

    def run(self, checkpoint: str) -> None:
        """Everything that is there now, then stop."""
        query = self.stream().writeStream.foreachBatch(self.epoch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
