"""Fields of JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INDEXES = "array<struct<id: string, val: string>>"


def field(payload: Column, path: str) -> Column:
    return F.get_json_object(payload, f"$.{path}")


def index_columns(payload: Column, wanted: dict[str, str]) -> list[Column]:
    """[{id, val}, ...] turned into one column for each wanted id (id: column name); of a repeated id the last counts."""
    parsed = F.from_json(payload, INDEXES)

    def last(i: str) -> Column:
        return F.element_at(F.filter(parsed, lambda x: x["id"] == i), -1)["val"]

    def there(i: str) -> Column:
        return F.exists(parsed, lambda x: x["id"] == i)

    return [F.when(there(i), last(i)).alias(name) for i, name in wanted.items()]
