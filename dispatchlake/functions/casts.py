"""Typed readings of source text. A value that does not have the expected shape is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def try_int(text: Column) -> Column:
    """Whole numbers of at most nine digits; no blanks, no plus sign, no trailing newline."""
    return F.when(text.rlike(r"^-?[0-9]{1,9}\z"), text.cast("int"))


def try_timestamp(text: Column) -> Column:
    """`YYYY-MM-DD HH:MM:SS`, zero-padded, a date that exists; without a zone."""
    shaped = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"), text)
    return F.try_to_timestamp(shaped, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def try_whole(text: Column) -> Column:
    """`n` or `n.0...`."""
    return F.when(text.rlike(r"^-?[0-9]{1,9}(\.0+)?\z"), F.split_part(text, F.lit("."), F.lit(1)).cast("int"))


def typed_ok(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether no value of the (text, typed) pairs is there but could not be read."""
    bad = F.lit(False)
    for text, typed in pairs:
        bad = bad | (blank_to_null(text).isNotNull() & typed.isNull())
    return ~bad


def to_instant(local: Column, zone: str) -> Column:
    """The instant at which clocks in `zone` show `local`."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def offset_seconds(local: Column, zone: str) -> Column:
    return (F.unix_timestamp(local.cast("timestamp")) - F.unix_timestamp(to_instant(local, zone))).cast("int")
