"""Run metrics, references to sources, and cleanup of unused ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ingest_run_metrics(log: DataFrame, dataset: Column | None = None) -> DataFrame:
    """Per source: documents, vectors, failures, seconds, progress and status of its runs.

    ``log`` is ``source_id, ts, outcome, vectors, expected``: one row per document handled, with
    outcome ``ok`` or ``failed``. ``dataset`` optionally restricts the log.
    """
    rows = log if dataset is None else log.where(dataset)
    grouped = rows.groupBy("source_id").agg(
        F.count_if(F.col("outcome") == "ok").alias("documents_processed"),
        F.count_if(F.col("outcome") == "failed").alias("failures"),
        F.sum(F.when(F.col("outcome") == "ok", F.col("vectors")).otherwise(0)).alias("vectors_inserted"),
        ((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6).alias(
            "processing_seconds"
        ),
        F.max("expected").alias("expected"),
        F.min("ts").alias("started_at"),
    )
    done = F.col("documents_processed") + F.col("failures")
    ratio = F.when(F.col("expected") > 0, F.lit(100.0) * done / F.col("expected")).otherwise(F.lit(100.0))
    progress = F.round(F.least(F.lit(100.0), ratio), 6)
    status = (
        F.when(F.col("progress_percentage") < 100.0, "processing")
        .when(F.col("documents_processed") == 0, "failed")
        .otherwise("completed")
    )
    return (
        grouped.withColumn("progress_percentage", progress).withColumn("status", status).drop("expected")
    )


def newest_runs(metrics: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` runs started last."""
    return metrics.orderBy(F.col("started_at").desc(), F.col("source_id").asc()).limit(limit)


def source_references(sources: DataFrame, schedules: DataFrame, jobs: DataFrame) -> DataFrame:
    """Per source the number of active schedules and in-flight jobs, and whether it is in use.

    ``schedules`` is ``source_id, schedule_id, name, active`` and ``jobs`` is
    ``source_id, job_id, in_flight``. Each is counted before the join, so a source with very
    many references costs one row there. The schedules themselves: ``schedule_references``.
    """
    by_schedule = schedules.where("active").groupBy("source_id").agg(F.count("*").alias("schedule_count"))
    by_job = jobs.where("in_flight").groupBy("source_id").agg(F.count("*").alias("active_job_count"))
    return (
        sources.select("source_id")
        .join(by_schedule, "source_id", "left")
        .join(by_job, "source_id", "left")
        .fillna(0, ["schedule_count", "active_job_count"])
        .withColumn("in_use", (F.col("schedule_count") > 0) | (F.col("active_job_count") > 0))
    )


def schedule_references(sources: DataFrame, schedules: DataFrame) -> DataFrame:
    """The active schedules of each source, one row each: ``source_id, schedule_id, name``."""
    active = schedules.where("active").select("source_id", "schedule_id", "name")
    return active.join(sources.select("source_id"), "source_id", "left_semi")


def unused_sources(sources: DataFrame, *referencing: DataFrame) -> DataFrame:
    """Sources no row of any referencing table names, finished and inactive rows included.

    The keys are reduced to distinct values first, partially before the shuffle.
    """
    rest = sources
    for table in referencing:
        rest = rest.join(table.select("source_id").distinct(), "source_id", "left_anti")
    return rest


def cleanup_unused(
    sources: DataFrame, *referencing: DataFrame, force: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split sources into those kept and the report of those deleted.

    Unused sources go; ``force`` (``source_id``) names more that go even if referenced.
    """
    doomed = unused_sources(sources, *referencing).select("source_id")
    if force is not None:
        doomed = doomed.unionByName(force.select("source_id")).distinct()
    deleted = sources.join(doomed, "source_id", "left_semi").select("source_id", "name", "type")
    return sources.join(doomed, "source_id", "left_anti"), deleted


def delete_source(
    sources: DataFrame, references: DataFrame, ids: DataFrame, force: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Delete the listed sources: what remains, and the listed ones refused as in use."""
    wanted = ids.select("source_id").distinct()
    used = references.where("in_use").select("source_id")
    refused = wanted.join(used, "source_id", "left_semi") if not force else wanted.limit(0)
    allowed = wanted if force else wanted.join(used, "source_id", "left_anti")
    return sources.join(allowed, "source_id", "left_anti"), refused
