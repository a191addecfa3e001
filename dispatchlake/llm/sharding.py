"""Sharding with a permutation-filled lookup table.

A table has a prime number of slots. Every shard has its own order of preference over all slots: from
an offset onwards in equal steps, both hashed from its name. The shards take turns; in its turn a shard
claims the first slot of its preference that is free, until the table is full. A row's slot is the hash
of its key modulo the number of slots, and one lookup gives its shard. Adding or removing a shard moves
few keys besides its own.

The table has SLOTS rows whatever the input's size, so it is broadcast; rows are not shuffled.

Null keys are placed as the empty string. Repeated rows go to one shard. Extra columns are kept; the
names slot and shard are the result's. An empty table stays empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, some 250 times the number of shards: their shares then differ by less than 1 %.
SLOTS = 16381
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The index of the shard of each slot."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names must differ")
    if slots < len(shards) or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    table = [-1] * slots
    at = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    free = slots
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """slot, shard (index) of every slot."""
    packed = b"".join(i.to_bytes(2, "big") for i in fill(shards, slots))
    entry = F.substring(F.lit(packed), (F.col("id") * 2 + 1).cast("int"), F.lit(2))
    return spark.range(slots).select(F.col("id").cast("int").alias("slot"), F.conv(F.hex(entry), 16, 10).cast("int").alias("shard"))


def slot_of(key, slots: int = SLOTS) -> F.Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % slots).cast("int")


def place(rows: DataFrame, key_column: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """`rows` with slot and shard."""
    kept = rows.drop("slot", "shard")
    return kept.withColumn("slot", slot_of(rows[key_column], slots)).join(F.broadcast(table(rows.sparkSession, shards, slots)), "slot").select(*(kept[c] for c in kept.columns), "slot", "shard")


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """doc_id, slot and shard of every row of documents."""
    return place(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id"))
