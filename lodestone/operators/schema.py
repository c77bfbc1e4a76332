"""Declared metadata fields: casting, quarantine and schema evolution.

A declared schema is an ordered list of (name, type). Declared fields are columns of their
own; everything else stays in the variant column ``metadata``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metadata field types and the Spark types that hold them.
FIELD_TYPES = {
    "string": "string",
    "u32": "bigint",
    "i32": "int",
    "i64": "bigint",
    "f32": "float",
    "f64": "double",
}
U32_MAX = 4_294_967_295


@dataclass(frozen=True)
class MetadataSchema:
    """Ordered declared fields and the version of the declaration."""

    fields: tuple[tuple[str, str], ...] = field(default=())
    version: int = 1

    def __post_init__(self) -> None:
        names = [n for n, _ in self.fields]
        if len(set(names)) != len(names):
            raise ValueError("a field is declared twice")
        for name, kind in self.fields:
            if kind not in FIELD_TYPES:
                raise ValueError(f"field {name!r} has unknown type {kind!r}")

    def merge(self, changes: list[tuple[str, str]]) -> "MetadataSchema":
        """Retype the named fields, append new ones, keep the rest."""
        merged = dict(self.fields) | dict(changes)
        return MetadataSchema(tuple(merged.items()), self.version + 1)

    def replace(self, fields: list[tuple[str, str]]) -> "MetadataSchema":
        """Exactly these fields; an empty list removes them all."""
        return MetadataSchema(tuple(fields), self.version + 1)


def cast_field(raw: Column, kind: str) -> Column:
    """Value of a declared type from text; null where it does not fit."""
    value = raw.try_cast(FIELD_TYPES[kind])
    if kind == "u32":
        return F.when(value.between(0, U32_MAX), value)
    if kind in ("f32", "f64"):
        infinite = F.abs(value) == F.lit(float("inf")).cast(FIELD_TYPES[kind])
        return F.when(~infinite & ~F.isnan(value), value)
    return value


def retyped(name: str, old: str, kind: str) -> Column:
    """A declared column under another type; null where the value does not fit.

    A fraction does not fit a whole-number type.
    """
    value = F.col(name)
    if old in ("f32", "f64") and kind in ("u32", "i32", "i64"):
        return cast_field(F.when(F.rint(value) == value, value), kind)
    return cast_field(value.cast("string"), kind)


def _raw(name: str, variant: str) -> Column:
    return F.try_variant_get(F.col(variant), "$['" + name.replace("'", "\\'") + "']", "string")


def check_metadata_schema(df: DataFrame, schema: MetadataSchema, variant: str = "metadata") -> DataFrame:
    """Promote declared fields out of the variant column, in one pass over all rows.

    Adds one typed column per field, null where its value does not fit, and ``errors``, the
    names of those fields. Undeclared keys stay in the variant; a missing or null field is a
    null, not an error. A field may not be named like another column of the rows.
    """
    clash = sorted({n for n, _ in schema.fields} & set(df.columns))
    if clash:
        raise ValueError(f"declared fields {clash} are named like columns of the rows")
    # Text, value and verdict in projections of their own, so that each is computed once.
    staged = df
    if schema.fields:
        staged = df.withColumns({f"__raw_{n}": _raw(n, variant) for n, _ in schema.fields})
        staged = staged.withColumns({f"__val_{n}": cast_field(F.col(f"__raw_{n}"), k) for n, k in schema.fields})
    checks = [
        F.when(F.col(f"__raw_{n}").isNotNull() & F.col(f"__val_{n}").isNull(), F.lit(n)) for n, _ in schema.fields
    ]
    errors = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    values = [F.col(f"__val_{n}").alias(n) for n, _ in schema.fields]
    return staged.select(*df.columns, *values, errors.alias("errors"))


def enforce_metadata_schema(
    df: DataFrame, schema: MetadataSchema, variant: str = "metadata"
) -> tuple[DataFrame, DataFrame]:
    """The accepted rows with their typed columns, and the quarantined rows with ``errors``."""
    checked = check_metadata_schema(df, schema, variant)
    names = dict(schema.fields)
    quarantined = checked.where(F.size("errors") > 0)
    return checked.where(F.size("errors") == 0).drop("errors"), quarantined.drop(*names)


def schema_merge(
    df: DataFrame, current: MetadataSchema, changes: list[tuple[str, str]], variant: str = "metadata"
) -> tuple[DataFrame, MetadataSchema]:
    """Apply ``current.merge(changes)`` to a table with the current fields promoted.

    A retyped field is cast from its column, a new one is read from the variant.
    """
    merged = current.merge(changes)
    old = dict(current.fields)
    out = {}
    for name, kind in merged.fields:
        if old.get(name) == kind:
            continue
        out[name] = retyped(name, old[name], kind) if name in old else cast_field(_raw_or_null(df, name, variant), kind)
    others = [c for c in df.columns if c not in dict(merged.fields)]
    return (df.withColumns(out) if out else df).select(*others, *[n for n, _ in merged.fields]), merged


def schema_replace(
    df: DataFrame, current: MetadataSchema, fields: list[tuple[str, str]], variant: str = "metadata"
) -> tuple[DataFrame, MetadataSchema]:
    """Apply ``current.replace(fields)``: declared columns not listed are removed."""
    replaced = current.replace(fields)
    old = dict(current.fields)
    others = [F.col(c) for c in df.columns if c not in old]
    kept = []
    for name, kind in replaced.fields:
        if old.get(name) == kind:
            kept.append(F.col(name))
        else:
            value = retyped(name, old[name], kind) if name in old else cast_field(_raw_or_null(df, name, variant), kind)
            kept.append(value.alias(name))
    return df.select(*others, *kept), replaced


def _raw_or_null(df: DataFrame, name: str, variant: str) -> Column:
    return _raw(name, variant) if variant in df.columns else F.lit(None).cast("string")


def misfits(df: DataFrame, keys: list[str], values: dict[str, Column], schema: MetadataSchema) -> DataFrame:
    """``keys, field, value, kind`` for each text in ``values`` that does not fit its field's declared type.

    One pass over the rows; a row with several misfits gives one row for each.
    """
    checks = [
        F.when(
            values[n].isNotNull() & cast_field(values[n], k).isNull(),
            F.struct(F.lit(n).alias("field"), values[n].alias("value"), F.lit(k).alias("kind")),
        )
        for n, k in schema.fields
    ]
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<struct<field:string,value:string,kind:string>>")
    return df.select(*keys, F.inline(found))


def union_versions(tables: list[DataFrame]) -> DataFrame:
    """Files written under several schema versions as one table; missing fields are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
