"""Source descriptions: what to read and how, as rows of a table.

Only options that are set are stored. Extra options are merged last and win over everything,
the type included. A null and an empty list both mean "no restriction".
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.scalars import default_source_name, first_nonempty_id

# Options each type of source starts from.
DEFAULT_OPTIONS = {
    "s3": {"sync_mode": "incremental"},
    "gcs": {"sync_mode": "incremental"},
    "gdrive": {"sync_mode": "incremental"},
    "jira": {"sync_mode": "incremental", "include_comments": True},
    "confluence": {"sync_mode": "incremental", "auth_mode": "basic"},
    "file_upload": {"sync_mode": "full", "storage_provider": "s3"},
    "web": {},
}


@dataclass(frozen=True)
class SourceSpec:
    """One source; ``options`` of any type of source, known or not."""

    type: str
    name: str = ""
    description: str = ""
    options: Mapping[str, object] = field(default_factory=dict)
    extra: Mapping[str, object] = field(default_factory=dict)
    metadata: Mapping[str, str] = field(default_factory=dict)

    def config(self) -> dict[str, object]:
        given = {k: v for k, v in self.options.items() if v is not None and v != "" and v != [] and not _zero(v)}
        return {"type": self.type} | DEFAULT_OPTIONS.get(self.type, {}) | given | dict(self.extra)


def _zero(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value == 0


def sources_table(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    """``name, type, description, config, metadata``; config values are JSON text."""
    rows = [
        (
            s.name,
            s.type,
            s.description,
            {k: v if isinstance(v, str) else json.dumps(v) for k, v in s.config().items()},
            dict(s.metadata),
        )
        for s in specs
    ]
    kind = "name string, type string, description string, config map<string,string>, metadata map<string,string>"
    table = spark.createDataFrame(rows, kind)
    return table.withColumn("name", name_from_config(F.col("type"), F.col("name"), F.col("config")))


def name_from_config(source_type: Column, name: Column, config: Column) -> Column:
    """Default name of a source from its stored options."""

    def option(key: str) -> Column:
        return F.try_element_at(config, F.lit(key))

    def first(key: str) -> Column:
        return F.get_json_object(option(key), "$[0]")

    return default_source_name(
        source_type,
        name,
        url=F.coalesce(first("start_urls"), option("base_url")),
        bucket=option("bucket"),
        project=first("project_keys"),
        cloud=option("cloud_id"),
        space=first("spaces"),
        drive=option("drive_id"),
        folder=first("folder_ids"),
    )


def resolve_source_ids(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``resolved_id``, the first filled of id, source_id and uuid; and rows without any."""
    resolved = sources.withColumn("resolved_id", first_nonempty_id(F.col("id"), F.col("source_id"), F.col("uuid")))
    return resolved.where(F.col("resolved_id").isNotNull()), resolved.where(F.col("resolved_id").isNull())
