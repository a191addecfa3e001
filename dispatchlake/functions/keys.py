"""Natural keys, surrogate keys (name-based UUIDs) and day keys as Column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the UUID namespace for DNS names of RFC 4122, from which site namespaces derive.
_ROOT = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
PREFIX = "dispatchlake"
REPORT_ZONE = "Asia/Riyadh"


def nk(*parts: Column) -> Column:
    """Parts joined by `|`, with `\\` and `|` inside parts escaped. Raises for NULL parts."""
    if not parts:
        raise ValueError("a natural key needs a part")
    out = []
    for p in parts:
        text = p.cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        out.append(F.when(text.isNull(), F.raise_error(F.lit("natural key part is NULL")).cast("string")).otherwise(escaped))
    return F.concat_ws("|", *out)


def site_namespace(site: str, prefix: str = PREFIX) -> uuid.UUID:
    return uuid.uuid5(uuid.UUID(_ROOT), f"{prefix}:site:{site}")


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 4122 version 5, from SHA-1, without a UDF."""
    digest = F.sha1(F.concat(F.lit(namespace.bytes), F.encode(name, "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F).bitwiseOR(0x80)))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(19, 2), F.lit("-"), part(21, 12))


def sk(site: str, source: str, natural: Column) -> Column:
    return uuid5(site_namespace(site), F.concat(F.lit(source + ":"), natural))


def sk_scd(site: str, source: str, natural: Column, valid_from: Column) -> Column:
    return uuid5(site_namespace(site), F.concat(F.lit(source + ":"), natural, F.lit("@"), F.date_format(valid_from, "yyyyMMddHHmmss")))


def date_key(instant: Column, zone: str = REPORT_ZONE) -> Column:
    """YYYYMMDD of the instant's day in the report zone."""
    return F.date_format(F.from_utc_timestamp(instant, zone), "yyyyMMdd").cast("int")


def key_to_date(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def date_to_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")
