"""Typed new columns (S9): fields that messages bring beyond the known ones become columns of the raw table.

Landing keeps an unknown field's value as a VARIANT, with the type that the message gave it. ``promote_fields``
looks at what has landed, finds each field's common type, and writes it into the table's next version;
``read_typed`` gives every promoted field as a column of that type, null in rows landed before
the field was known or whose value does not fit. No data is rewritten, and a field whose values
change their type is widened, never narrowed.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.sources import versions
from stationlake.sources.tables import RAW_TABLE_SCHEMA, read_days, read_raw

EXACT = ("BIGINT", "DOUBLE", "BOOLEAN", "STRING")


def column_type(found: str) -> str:
    """The column type for what ``schema_of_variant`` says of a value; nested values are kept as VARIANT."""
    name = found.split("(")[0].split("<")[0].strip().upper()
    if name in ("TINYINT", "SMALLINT", "INT", "BIGINT"):
        return "BIGINT"
    if name in ("DECIMAL", "FLOAT", "DOUBLE"):
        return "DOUBLE"
    return name if name in EXACT else "VOID" if name == "VOID" else "VARIANT"


def widen(a: str, b: str) -> str:
    """The narrowest type that holds both; scalars of different kinds meet in STRING."""
    if a == b or b == "VOID":
        return a
    if a == "VOID":
        return b
    if {a, b} == {"BIGINT", "DOUBLE"}:
        return "DOUBLE"
    return "VARIANT" if "VARIANT" in (a, b) else "STRING"


def promote_fields(spark: SparkSession, path: str, days: list | None = None, min_rows: int = 1) -> dict[str, str]:
    """Make every unknown field that at least ``min_rows`` rows (of some ``days``) have a typed column; field → type.

    Types only widen from version to version. Field names that differ in nothing but case share a column's
    name up to a number (``read_typed``).
    """
    path = path.rstrip("/")
    raw = read_raw(spark, path) if days is None else read_days(spark, path, days, RAW_TABLE_SCHEMA)
    values = raw.where("extra_values IS NOT NULL").select(F.explode("extra_values").alias("field", "v")).where(~F.is_variant_null("v"))
    found = values.groupBy("field", F.schema_of_variant("v").alias("type")).agg(F.count("*").alias("n"))
    base = versions.current(spark, path) or versions.Version()
    fields = dict(base.fields)
    rows: dict[str, int] = {}
    kinds: dict[str, str] = {}
    for r in found.collect():  # one row per field and type
        rows[r["field"]] = rows.get(r["field"], 0) + r["n"]
        kinds[r["field"]] = widen(kinds.get(r["field"], "VOID"), column_type(r["type"]))
    for name, kind in kinds.items():
        if rows[name] >= min_rows or name in fields:
            fields[name] = widen(fields.get(name, "VOID"), kind)
    if fields != base.fields:
        versions.commit(spark, path, replace(base, number=base.number + 1, fields=fields))
    return fields


def column_names(fields: dict[str, str], taken: list[str]) -> dict[str, str]:
    """field → column name, unlike any column there is (case ignored)."""
    used, out = {c.lower() for c in taken}, {}
    for name in sorted(fields):
        column, n = name, 1
        while column.lower() in used:
            n += 1
            column = f"{name}_{n}"
        used.add(column.lower())
        out[name] = column
    return out


def read_typed(spark: SparkSession, path: str, days: list | None = None) -> DataFrame:
    """The raw table with a column for each promoted field."""
    path = path.rstrip("/")
    raw = read_raw(spark, path) if days is None else read_days(spark, path, days, RAW_TABLE_SCHEMA)
    version = versions.current(spark, path)
    fields = version.fields if version is not None else {}
    names = column_names(fields, raw.columns)
    value = lambda f: F.col("extra_values")[F.lit(f)]
    typed = [value(f).alias(names[f]) if kind == "VARIANT" else F.try_variant_get(value(f), "$", kind.lower()).alias(names[f])
             for f, kind in sorted(fields.items()) if kind != "VOID"]
    return raw.select("*", *typed)
