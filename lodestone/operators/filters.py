"""Metadata filters compiled to a column predicate, applied before any ranking.

A declared field is its own typed column, so its comparison reaches the Parquet scan. Any
other field is read from the variant column and compared as a string, or as a number where the
literals are numbers. A null field fails every operator except ``not_exists``, ``ne`` and ``not_in``;
text that is no number counts as null there. Names that clash with other columns are told apart by
``fields``: the declared fields with their types, read from the variant column unless ``columns`` names
the typed column that stores one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.schema import FIELD_TYPES, cast_field

OPS = (
    "eq", "ne", "gt", "gte", "lt", "lte", "in", "not_in", "between",
    "exists", "not_exists", "prefix", "contains",
)


@dataclass(frozen=True)
class Filter:
    field: str
    op: str
    value: object = None
    values: tuple = ()


def _text(df: DataFrame, name: str, variant: str) -> Column:
    if variant not in df.columns:
        return F.lit(None).cast("string")
    if df.schema[variant].dataType.simpleString() == "variant":
        path = "$['" + name.replace("'", "\\'") + "']"
        return F.try_variant_get(F.col(variant), path, "string")
    return F.try_element_at(F.col(variant), F.lit(name))


def _field(
    df: DataFrame, f: Filter, variant: str, fields: Mapping[str, str] | None, columns: Mapping[str, str] | None
) -> tuple[Column, str]:
    """The column a filter looks at and the type in which it compares."""
    if fields is None and f.field in df.columns:
        return F.col(f.field), df.schema[f.field].dataType.simpleString()
    if fields and f.field in fields:
        kind = fields[f.field]
        if columns and f.field in columns:
            return F.col(columns[f.field]), FIELD_TYPES[kind]
        return cast_field(_text(df, f.field, variant), kind), FIELD_TYPES[kind]
    text = _text(df, f.field, variant)
    given = [*f.values, *([] if f.value is None else [f.value])]
    if f.op in ("prefix", "contains") or not given or not all(type(v) in (int, float) for v in given):
        return text, "string"
    if any(type(v) is float for v in given):
        return cast_field(text, "f64"), "double"  # NaN and infinities are no numbers
    return text.try_cast("decimal(38,9)"), "decimal(38,9)"


def _literal(value: object, kind: str) -> Column:
    if kind == "string" and isinstance(value, bool):
        value = str(value).lower()
    if isinstance(value, float) and kind in ("tinyint", "smallint", "int", "bigint"):
        kind = "double"  # a fraction is not cut off
    return F.lit(value).cast(kind)


def _predicate(
    df: DataFrame, f: Filter, variant: str, fields: Mapping[str, str] | None, columns: Mapping[str, str] | None
) -> Column:
    if f.op not in OPS:
        raise ValueError(f"unknown filter op {f.op!r}, expected one of {OPS}")
    col, kind = _field(df, f, variant, fields, columns)
    many = [_literal(v, kind) for v in f.values]
    if f.op == "exists":
        return col.isNotNull()
    if f.op == "not_exists":
        return col.isNull()
    if f.op == "in":
        return col.isin(*many) if many else F.lit(False)
    if f.op == "not_in":
        return col.isNull() | ~col.isin(*many) if many else F.lit(True)
    if f.op == "between":
        if len(many) != 2:
            raise ValueError("between takes two values")
        return col.between(*many)
    if f.value is None:
        raise ValueError(f"filter op {f.op!r} takes a value")
    one = _literal(f.value, kind)
    if f.op == "prefix":
        return F.startswith(col.cast("string"), F.lit(str(f.value)))
    if f.op == "contains":
        return F.contains(col.cast("string"), F.lit(str(f.value)))
    if f.op == "ne":
        return col.isNull() | (col != one)
    compare = {"eq": col == one, "gt": col > one, "gte": col >= one, "lt": col < one, "lte": col <= one}
    return compare[f.op]


def compile_filters(
    df: DataFrame,
    filters: Iterable[Filter | Mapping],
    variant: str = "metadata",
    fields: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
) -> Column:
    """Conjunction of the filters; bad filters raise before any job runs."""
    built = [f if isinstance(f, Filter) else Filter(**{**f, "values": tuple(f.get("values") or ())}) for f in filters]
    return reduce(lambda a, b: a & b, [_predicate(df, f, variant, fields, columns) for f in built], F.lit(True))


def filter_advanced(
    df: DataFrame,
    filters: Iterable[Filter | Mapping],
    variant: str = "metadata",
    fields: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows that satisfy every (field, op, value, values)."""
    return df.where(compile_filters(df, filters, variant, fields, columns))


def filter_equality(
    df: DataFrame,
    wanted: Mapping[str, object],
    variant: str = "metadata",
    fields: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows whose metadata equals every (field, value); a missing field does not match."""
    return filter_advanced(df, [Filter(k, "eq", v) for k, v in wanted.items()], variant, fields, columns)
