"""Scoping, sampling, profiling and thread assembly of source records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DataType

from lodestone.operators.ordering import row_position

PART_MESSAGES = 4_096


def scope_filter(records: DataFrame, field: str, scope: Sequence | DataFrame | None) -> DataFrame:
    """Records whose ``field`` is listed; null or an empty list means no restriction.

    A list of values becomes a predicate of the scan. A DataFrame of values (first column) is
    a semi join, its values made distinct first.
    """
    if scope is None:
        return records
    if isinstance(scope, DataFrame):
        values = scope.select(F.col(scope.columns[0]).alias(field)).distinct()
        return records.join(values, field, "left_semi")
    return records.where(F.col(field).isin(list(scope))) if len(scope) else records


def sample_source(records: DataFrame, id_col: str, limit: int = 0, enabled: bool = True) -> DataFrame:
    """At most ``limit`` records, the same on every run: those with the smallest hashed unique id."""
    if not enabled or limit <= 0:
        return records
    key = F.md5(F.col(id_col).cast("string"))
    return records.orderBy(key, F.col(id_col)).limit(limit)


def profile_source(records: DataFrame, id_col: str, text_col: str, max_bytes: int) -> DataFrame:
    """``check_name, n, passed, message``: findings about input data, one row per check.

    One pass over the records counts per id; the ids are then folded into the totals.
    """
    per_id = records.groupBy(F.col(id_col).alias("__id")).agg(
        F.count("*").alias("__n"),
        F.count_if(F.col(text_col).isNull() | (F.trim(text_col) == "")).alias("__empty"),
        F.count_if(F.octet_length(text_col) > max_bytes).alias("__big"),
    )
    has_id = F.col("__id").isNotNull()
    totals = per_id.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.when(~has_id, F.col("__n"))), F.lit(0)).alias("null_id"),
        F.coalesce(F.sum("__empty"), F.lit(0)).alias("empty_text"),
        F.coalesce(F.sum(F.when(has_id, F.col("__n") - 1)), F.lit(0)).alias("duplicate_id"),
        F.coalesce(F.sum("__big"), F.lit(0)).alias("oversize"),
    )
    checks = ["records", "null_id", "empty_text", "duplicate_id", "oversize"]
    rows = totals.unpivot([], checks, "check_name", "n")
    ok = F.when(F.col("check_name") == "records", F.col("n") > 0).otherwise(F.col("n") == 0)
    message = F.when(ok, F.lit("")).otherwise(F.concat(F.col("check_name"), F.lit(": "), F.col("n").cast("string")))
    return rows.withColumn("passed", ok).withColumn("message", message)


def profile_columns(records: DataFrame) -> list[tuple[str, str]]:
    """Normalised column list of an input: (lower-case name, Spark type)."""
    return [(f.name.strip().lower(), f.dataType.simpleString()) for f in records.schema.fields]


# Kinds a text may have, the first that fits; a declared type accepts its kinds.
KINDS = {
    "whole": r"[+-]?[0-9]{1,18}",
    "number": r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?",
    "boolean": r"[tT][rR][uU][eE]|[fF][aA][lL][sS][eE]",
    "time": r"[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?",
}
ACCEPTS = {
    "integer": ("whole",),
    "float": ("whole", "number"),
    "boolean": ("boolean",),
    "datetime": ("time",),
    "string": ("whole", "number", "boolean", "time", "text"),
}


def profile_values(records: DataFrame, declared: Mapping[str, str] | None = None, samples: int = 3) -> DataFrame:
    """One row per column of ``records`` that has single values: what its values look like.

    ``column_name`` (normalised), ``data_type``, ``n``, ``n_null``, counts of values by kind
    (``n_whole``, ``n_number``, ``n_boolean``, ``n_time``, ``n_text``; every value has one),
    ``approx_distinct``, ``min_value`` and ``max_value`` in the column's own order, ``longest`` in
    characters, ``samples``, ``declared``, ``n_misfit`` (values that are not of the declared type),
    ``passed`` and ``message``. Samples are those with the smallest salted hashes: the same on
    every run and in any partitioning. All come from one pass whose partial results are one row per
    task. Arrays, maps, structs and variants have no profile; an empty table has counts of 0.
    """
    wanted = {k.strip().lower(): v for k, v in (declared or {}).items()}
    unknown = sorted({v for v in wanted.values()} - set(ACCEPTS))
    absent = sorted(set(wanted) - {name for name, _ in profile_columns(records)})
    if unknown or absent:
        raise ValueError(f"unknown types {unknown}, columns that the input lacks {absent}")
    fields = [(i, f) for i, f in enumerate(records.schema.fields) if isinstance(f.dataType, AtomicType)]
    fields = [(i, f) for i, f in fields if f.dataType.simpleString() != "variant"]
    bare = records.toDF(*[f"c{i}" for i in range(len(records.columns))])
    texts = {f"t{i}": _as_text(F.col(f"c{i}"), f.dataType) for i, f in fields}
    kinds = {f"k{i}": _kind(F.col(f"t{i}")) for i, _ in fields}
    rows = bare.select(*[f"c{i}" for i, _ in fields], *[c.alias(n) for n, c in texts.items()])
    rows = rows.select("*", *[c.alias(n) for n, c in kinds.items()])

    def profile(i: int, kind: DataType) -> Column:
        value, text, found = F.col(f"c{i}"), F.col(f"t{i}"), F.col(f"k{i}")
        picks = [F.min_by(text, F.when(text.isNotNull(), F.md5(F.concat(F.lit(f"{s}:"), text)))) for s in range(samples)]
        extremes = [_as_text(f(value), kind) for f in (F.min, F.max)]
        return F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(value.isNull()).alias("n_null"),
            *[F.count_if(found == k).alias(f"n_{k}") for k in (*KINDS, "text")],
            F.approx_count_distinct(value).alias("approx_distinct"),
            extremes[0].alias("min_value"),
            extremes[1].alias("max_value"),
            F.coalesce(F.max(F.length(text)), F.lit(0)).alias("longest"),
            F.array_distinct(F.array_compact(F.array(*picks))).alias("samples"),
        )

    made = rows.agg(*[profile(i, f.dataType).alias(f"p{i}") for i, f in fields])
    out = []
    for i, f in fields:
        name = f.name.strip().lower()
        misfits = [k for k in (*KINDS, "text") if k not in ACCEPTS[wanted.get(name, "string")]]
        bad = sum((F.col(f"p{i}.n_{k}") for k in misfits), F.lit(0).cast("bigint"))
        message = F.when(bad > 0, F.concat(F.lit(f"{name}: "), bad.cast("string"), F.lit(f" not {wanted.get(name)}")))
        out.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(wanted.get(name)).cast("string").alias("declared"),
                F.col(f"p{i}").alias("p"),
                bad.alias("n_misfit"),
                (bad == 0).alias("passed"),
                F.coalesce(message, F.lit("")).alias("message"),
            )
        )
    if not out:
        raise ValueError("no column with single values")
    return made.select(F.inline(F.array(*out))).select(
        "column_name", "data_type", "p.*", "declared", "n_misfit", "passed", "message"
    )


def _as_text(value: Column, kind: DataType) -> Column:
    return F.hex(value) if isinstance(kind, BinaryType) else value.cast("string")


def _kind(text: Column) -> Column:
    found = F.when(text.isNull(), F.lit(None).cast("string"))
    for kind, pattern in KINDS.items():
        found = found.when(text.rlike(rf"\A(?:{pattern})\z"), kind)
    return found.otherwise("text")


def thread_documents(
    messages: DataFrame,
    thread: str,
    order: str,
    line: Column,
    include_comments: bool = True,
    part_size: int = PART_MESSAGES,
) -> DataFrame:
    """One document per thread: its messages in order, a line each.

    Without comments only the head of the thread stays. A thread of more than ``part_size``
    messages becomes several documents numbered by ``part``, so nothing is dropped and no task
    collects an unbounded thread.
    """
    if not include_comments:
        heads = messages.groupBy(thread).agg(F.min(order).alias(order))
        messages = messages.join(heads, [thread, order], "left_semi")
    placed = row_position(messages, [thread], order, "__n").withColumn("__line", line)
    part = F.floor(F.col("__n") / F.lit(part_size)).cast("int")
    grouped = placed.groupBy(F.col(thread), part.alias("part")).agg(
        F.count("*").alias("messages"),
        F.sort_array(F.collect_list(F.struct("__n", "__line"))).alias("__lines"),
    )
    text = F.array_join(F.transform("__lines", lambda x: x["__line"]), "\n")
    return grouped.select(thread, "part", "messages", text.alias("text"))
