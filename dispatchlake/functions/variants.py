"""JSON documents as variant columns: paths, types, containment, and a row for each element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The document, or null where the text is none."""
    return F.try_parse_json(text)


def at(document: Column, path: str, kind: str) -> Column:
    """The value at a path like $.a[0].b; null where it is not there or of another kind."""
    return F.try_variant_get(document, path, kind)


def type_of(document: Column) -> Column:
    """object, array, string, number, boolean or null; of no document null."""
    told = F.schema_of_variant(document)
    number = told.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")
    return (
        F.when(document.isNull(), F.lit(None).cast("string")).when(told.startswith("OBJECT"), "object").when(told.startswith("ARRAY"), "array")
        .when(told == "STRING", "string").when(told == "BOOLEAN", "boolean").when(told == "VOID", "null").when(number, "number").otherwise(F.lower(told))
    )


def has(document: Column, key: str) -> Column:
    """Whether an object has a key, whatever its value."""
    return at(document, f"$.{key}", "variant").isNotNull()


def contains(document: Column, path: str, value: Column, kind: str) -> Column:
    """Whether the array at a path has a value, or is it; false where there is none. Elements of other kinds are no match."""
    element = F.transform(at(document, path, "array<variant>"), lambda v: F.try_variant_get(v, "$", kind))
    return F.coalesce(F.exists(element, lambda e: e == value), at(document, path, kind) == value, F.lit(False))


def each(rows: DataFrame, document: str, keep: list[str]) -> DataFrame:
    """A row for each member of an object or element of an array: `keep`, pos, key (null for arrays) and value."""
    spark = rows.sparkSession
    own = ", ".join(f"r.`{c}`" for c in keep)
    return spark.sql(f"SELECT {own}, e.pos, e.key, e.value FROM {{rows}} r, LATERAL variant_explode(r.`{document}`) e", rows=rows)
