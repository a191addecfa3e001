"""Session settings that the library's operators rely on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configured(builder: SparkSession.Builder | None = None) -> SparkSession:
    """A session with SETTINGS; whatever the builder sets besides is kept."""
    session = (builder or SparkSession.builder).config(map=SETTINGS).getOrCreate()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


#: What a task is given to join, sort or group. Its memory is some thirty times what it reads of a shuffle, as keys
#: are packed there: with Spark's 64 MB a task of 4 cores and 10 GB has no room, and the number of tasks does not grow
#: until all cores have that much.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20, "spark.sql.files.maxPartitionBytes": 32 << 20}
#: Parts that a shuffle is first cut into; those that are small are put together again.
PARTS = 400


def in_bytes(text: str) -> int:
    """A size as Spark's settings have it: 64MB, 16k, 134217728b, 1024."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bound_tasks(session: SparkSession) -> None:
    """Tasks whose memory does not follow the input. Settings that are tighter already are kept."""
    for key, size in TASK_BYTES.items():
        if in_bytes(session.conf.get(key)) > size:
            session.conf.set(key, f"{size}b")
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    parts = max(PARTS, int(session.conf.get("spark.sql.shuffle.partitions")))
    if int(session.conf.get(first, None) or 0) < parts:
        session.conf.set(first, str(parts))
