"""Typed record ids.

An id is ``STRUCT<kind, s, i>``: ``int`` ids live in ``i``, ``str`` ids in ``s``, and numbers
that do not fit a BIGINT keep their text in ``s`` under kind ``num``. A null struct is an
unset id; the empty string is a set one. Compare whole structs: integer 42 and string "42"
differ, and struct equality treats null inner fields as equal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_TYPE = "struct<kind:string,s:string,i:bigint>"


def _typed(kind: str, s: Column, i: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), s.cast("string").alias("s"), i.cast("bigint").alias("i"))


def unset_id() -> Column:
    return F.lit(None).cast(ID_TYPE)


def int_id(value: Column) -> Column:
    return F.when(value.isNotNull(), _typed("int", F.lit(None), value))


def string_id(value: Column) -> Column:
    return F.when(value.isNotNull(), _typed("str", value, F.lit(None)))


def number_id(text: Column) -> Column:
    return F.when(text.isNotNull(), _typed("num", text, F.lit(None)))


def id_from_json(literal: Column) -> Column:
    """Typed id of one JSON literal; ``null`` (or SQL null) is unset."""
    text = F.trim(literal)
    as_long = text.try_cast("bigint")
    unquoted = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")
    return (
        F.when(text.isNull() | (text == "null"), unset_id())
        .when(text.startswith('"'), string_id(unquoted))
        .when(as_long.isNotNull(), int_id(as_long))
        .otherwise(number_id(text))
    )


def id_to_json(id_col: Column) -> Column:
    """JSON literal of a typed id: numbers bare, strings quoted, unset as ``null``."""
    quoted = F.regexp_extract(F.to_json(F.struct(id_col["s"].alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return (
        F.when(id_col.isNull(), F.lit("null"))
        .when(id_col["kind"] == "int", id_col["i"].cast("string"))
        .when(id_col["kind"] == "num", id_col["s"])
        .otherwise(quoted)
    )


def id_text(id_col: Column) -> Column:
    """Text of an id whatever its kind; the empty string when unset."""
    return F.coalesce(id_col["s"], id_col["i"].cast("string"), F.lit(""))
