"""Content hashes and NULL-safe comparison of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def raw_hash(names: list[str]) -> Column:
    """SHA-256 of [[name, value], ...] in the order received: unknown columns and their order count."""
    pairs = F.array(*(F.array(F.lit(n), F.coalesce(F.col(n).cast("string"), F.lit(""))) for n in names))
    return F.sha2(F.to_json(pairs), 256)


def record_hash(names: list[str]) -> Column:
    """The same whatever order the fields came in."""
    return raw_hash(sorted(names))


def row_hash(names: list[str]) -> Column:
    """MD5 in which NULL and empty differ; NULLs are written out, since concat_ws would drop them."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("~")) for n in names)))


def differs(names: list[str], a: str, b: str) -> Column:
    """IS DISTINCT FROM, column by column."""
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return ~same


def signed32(hex8: Column) -> Column:
    """Eight hex digits as a signed 32-bit number."""
    n = F.conv(hex8, 16, 10).cast("long")
    return F.when(n >= 1 << 31, n - (1 << 32)).otherwise(n)
