"""Polled sources: snapshots behind a version probe, observations in chunks of ids. The transport is given."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.windows import version_gate

RAW = "run_id string, batch_seq long, dataset string, version long, payload string"
EXPIRED = "300-008"


def call(send: Callable[[str, str], dict], login: Callable[[], str], request: str, token: str | None = None) -> dict:
    """One request with a token; once, a new token is fetched if the source says that it has expired."""
    answer = send(request, token or login())
    if code(answer) == EXPIRED:
        answer = send(request, login())
    if code(answer) not in (None, "0", "0000"):
        raise RuntimeError(f"the source refuses: {code(answer)}")
    return answer


def code(answer: dict) -> str | None:
    """The return code, from the header or the body."""
    for part in (answer.get("header") or {}, answer.get("body") or {}, answer):
        if isinstance(part, dict) and part.get("retcode") is not None:
            return str(part["retcode"])
    return None


def snapshot(spark: SparkSession, run_id: str, batch_seq: int, dataset: str, known: int | None, probe: dict, fetch: Callable[[], list[dict]]) -> tuple[str, DataFrame]:
    """(decision, rows): the dataset is only fetched if the probe offers a newer version."""
    decision = version_gate(known, int(probe["version"]), int(probe.get("status", 2)))
    records = fetch() if decision == "take" else []
    rows = [(run_id, batch_seq, dataset, int(probe["version"]), json.dumps(r, ensure_ascii=False)) for r in records]
    return decision, spark.createDataFrame(rows, RAW)


def chunks(ids: Iterable[str], size: int) -> list[list[str]]:
    """Ids, in numeric order, in lists of at most `size`."""
    ordered = sorted(set(ids), key=int)
    return [ordered[i : i + size] for i in range(0, len(ordered), size)]


def observations(spark: SparkSession, run_id: str, ids: Iterable[str], size: int, fetch: Callable[[list[str]], list[dict]], parallel: int = 8) -> DataFrame:
    """One batch for each chunk, fetched by tasks (at most `parallel` at once, as many as the source bears); ids that
    were not asked for are kept for the batch check to find."""
    asked = spark.createDataFrame([(seq, part) for seq, part in enumerate(chunks(ids, size))], "batch_seq long, ids array<string>").repartition(parallel)

    def fetched(batches):
        import pandas as pd

        for batch in batches:
            found = [(run_id, seq, "index", 0, json.dumps(r, ensure_ascii=False)) for seq, part in zip(batch["batch_seq"], batch["ids"], strict=True) for r in fetch(list(part))]
            yield pd.DataFrame(found, columns=["run_id", "batch_seq", "dataset", "version", "payload"])

    return asked.mapInPandas(fetched, RAW)


def synthetic(spark: SparkSession, seed: int, first_minute: int, minutes: int, now_minute: int, per_minute: int = 3) -> DataFrame:
    """Calls as a pure function of (seed, minute); what has ended by `now_minute` is complete."""
    rows = spark.range(first_minute, first_minute + minutes).withColumnRenamed("id", "minute")
    rows = rows.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(per_minute - 1))))
    draw = lambda salt: F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), F.lit(salt), "minute", "n")), 1, 13), 16, 10).cast("long")
    length = draw("length") % 30 + 1
    rows = rows.select(F.concat_ws("-", F.lit(seed), "minute", "n").alias("call_id"), "minute", (draw("queue") % 5).alias("queue"), length.alias("length"), (F.col("minute") + length <= now_minute).alias("is_complete"))
    return rows.filter(F.col("minute") <= now_minute)
