"""Source codes mapped by the sets that a contract declares; what is in no set is `unmapped`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED = "unmapped"


def direction(code: Column, inbound: list[str], outbound: list[str], known: list[str]) -> Column:
    return F.when(code.isNull(), UNMAPPED).when(code.isin(inbound), "inbound").when(code.isin(outbound), "outbound").when(code.isin(known), "internal").otherwise(UNMAPPED)


def release_source(code: Column, is_last: Column, classes: dict[str, list[str]]) -> Column:
    """agent, caller or system, on a call's last leg only."""
    found = F.lit(UNMAPPED)
    for name, codes in classes.items():
        found = F.when(code.isin(codes), name).otherwise(found)
    return F.when(is_last, found)
