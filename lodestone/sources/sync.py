"""Comparing a snapshot of a source with the catalog of what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("incremental", "full")


def latest_version(catalog: DataFrame) -> DataFrame:
    """The newest row of each external id of a catalog that is only ever appended to."""
    newest = catalog.groupBy("external_id").agg(F.max("version").alias("version"))
    return catalog.join(newest, ["external_id", "version"], "left_semi")


def content_hash(snapshot: DataFrame) -> DataFrame:
    """Replace ``content`` by its hash, so that the comparison moves no content."""
    return snapshot.select("external_id", F.sha2(F.col("content").cast("binary"), 256).alias("content_hash"))


def _compare(snapshot: DataFrame, catalog: DataFrame, how: str) -> DataFrame:
    new = content_hash(snapshot).select("external_id", F.col("content_hash").alias("__new"))
    old = catalog.select("external_id", F.col("content_hash").alias("__old"), F.col("version").alias("__v"))
    action = (
        F.when(F.col("__v").isNull(), "new")
        .when(F.col("__seen").isNull(), "deleted")
        .when(F.col("__new").eqNullSafe(F.col("__old")), "unchanged")
        .otherwise("changed")
    )
    version = F.when(F.col("action") == "new", 1).when(F.col("action") == "changed", F.col("__v") + 1).otherwise(
        F.col("__v")
    )
    return (
        new.withColumn("__seen", F.lit(True))
        .join(old, "external_id", how)
        .withColumn("action", action)
        .select(
            "external_id",
            "action",
            version.cast("int").alias("version"),
            F.coalesce("__new", "__old").alias("content_hash"),
        )
    )


def sync_incremental(snapshot: DataFrame, catalog: DataFrame) -> DataFrame:
    """``external_id, action, version, content_hash``: new, changed and unchanged records.

    Records missing from the snapshot are left alone.
    """
    return _compare(snapshot, catalog, "left")


def sync_full(snapshot: DataFrame, catalog: DataFrame) -> DataFrame:
    """Like ``sync_incremental``, and catalog rows missing from the snapshot are ``deleted``."""
    return _compare(snapshot, catalog, "full_outer")


def to_load(snapshot: DataFrame, diff: DataFrame) -> DataFrame:
    """The records to load: content of the new and changed ones with their version."""
    due = diff.where(F.col("action").isin("new", "changed")).select("external_id", "version", "content_hash")
    return snapshot.join(due, "external_id")


def apply_sync(catalog: DataFrame, diff: DataFrame) -> DataFrame:
    """The catalog after the sync."""
    columns = ["external_id", "version", "content_hash"]
    live = diff.where(F.col("action") != "deleted").select(*columns)
    untouched = catalog.join(diff.select("external_id"), "external_id", "left_anti").select(*columns)
    return untouched.unionByName(live)
