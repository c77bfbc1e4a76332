"""From a source to a searchable dataset in one job.

A run takes a snapshot of a source, compares it with what the dataset holds of that source, cuts
and embeds the new and changed documents, and records deletions, catalog entries and its own metrics.
Three tables below one path, each with a folder per run: ``vectors``, ``catalog`` and ``runs``. The row
in ``runs`` is written last and a reader sees only runs that have one, so the tables change together;
a run that failed before, or is repeated, overwrites its folders and sees earlier runs only.

A catalog row holds the state of a document after a run that touched it; the newest one counts. A
deleted document keeps its version, and one that returns continues from it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.chunk import chunk_text
from lodestone.operators.embed import DEFAULT_DIM, embed_texts
from lodestone.operators.topk import join_counted, rows_of
from lodestone.session import cut_lineage
from lodestone.sources.sync import MODES
from lodestone.streaming.ingest import _table, one_per_id

CATALOG = (
    "id string, source_id string, external_id string, version int, content_hash string, size_bytes bigint, metadata map<string,string>,"
    " chunk_count bigint, embeddings_count bigint, status string, created_at timestamp, updated_at timestamp, run bigint"
)
VECTORS = (
    "document_id string, source_id string, external_id string, version int, chunk_index int, text string, values array<float>,"
    " metadata map<string,string>, run bigint"
)
RUNS = (
    "source_id string, mode string, started_at timestamp, finished_at timestamp, documents_new bigint, documents_changed bigint,"
    " documents_deleted bigint, documents_unchanged bigint, failures bigint, vectors_inserted bigint, status string, run bigint"
)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The metrics of every run that is complete."""
    return _table(spark, f"{path}/runs", RUNS)


def _seen(spark: SparkSession, path: str, name: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of complete runs, of those before a run if one is given."""
    done = runs(spark, path).select("run")
    if before is not None:
        done = done.where(F.col("run") < before)
    return join_counted(_table(spark, f"{path}/{name}", schema), done, "run", "left_semi")


def _newest(catalog: DataFrame) -> DataFrame:
    last = catalog.groupBy("id").agg(F.max("run").alias("run"))
    return catalog.join(last, ["id", "run"], "left_semi")


def source_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The documents of all sources as they are now; ``list_documents_keyset`` pages through them."""
    return _newest(_seen(spark, path, "catalog", CATALOG)).where("status <> 'deleted'")


def source_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vectors of the documents as they are now."""
    now = source_catalog(spark, path).select(F.col("id").alias("document_id"), "version", "run")
    return join_counted(_seen(spark, path, "vectors", VECTORS), now, ["document_id", "version", "run"], "left_semi")


def ingest_source(
    snapshot: DataFrame,
    path: str,
    source_id: str,
    mode: str = "incremental",
    run: int | None = None,
    at: datetime | None = None,
    dim: int = DEFAULT_DIM,
    order: str | None = None,
) -> int:
    """Bring the dataset at ``path`` up to a snapshot ``external_id, content [, metadata]``; returns the run's number.

    ``full`` deletes the source's documents that the snapshot lacks, ``incremental`` leaves them.
    Other sources are never touched. A document whose text gives no words has failed: it is in the
    catalog, without vectors. ``run`` repeats or names a run; by default it is the one after the last.
    ``at`` is the time of the run.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark = snapshot.sparkSession
    started = at or datetime.now(timezone.utc)
    if run is None:
        last = runs(spark, path).agg(F.max("run")).first()[0]
        run = 0 if last is None else last + 1
    metadata = F.col("metadata") if "metadata" in snapshot.columns else F.lit(None).cast("map<string,string>")
    content = F.col("content").cast("string")
    rows = snapshot.withColumns({"content": content, "metadata": metadata}).where("external_id IS NOT NULL")
    rows = cut_lineage(one_per_id(rows, order).select("external_id", "content", "metadata"))  # compared and loaded
    known = _newest(_seen(spark, path, "catalog", CATALOG, run).where(F.col("source_id") == source_id))
    if mode == "incremental":
        known = rows_of(known, rows, "external_id")
    due = cut_lineage(_actions(rows, known, mode, source_id, started))
    loaded = join_counted(rows, due.where("action IN ('new', 'changed')").select("external_id", F.col("id").alias("document_id"), "version"), "external_id", "inner")
    chunks = chunk_text(loaded.withColumnRenamed("content", "text")).where("text <> ''")
    vectors = embed_texts(chunks, dim=dim).withColumn("source_id", F.lit(source_id))
    fields = ["document_id", "source_id", "external_id", "version", "chunk_index", "text", "values", "metadata"]
    vectors.select(*fields).write.mode("overwrite").parquet(f"{path}/vectors/run={run}")
    counts = spark.read.schema(VECTORS).parquet(f"{path}/vectors").where(F.col("run") == run)
    counts = counts.groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("chunks"))
    status = F.when(F.col("action") == "deleted", "deleted").when(F.col("chunks") > 0, "ready").otherwise("failed")
    entries = due.where("action <> 'unchanged'").join(counts, "id", "left").fillna(0, ["chunks"]).withColumn("status", status)
    entries = entries.withColumns({"chunk_count": F.col("chunks"), "embeddings_count": F.col("chunks")})
    columns = [c.split()[0] for c in CATALOG.split(", ") if c != "run bigint"]
    entries.select(*columns).write.mode("overwrite").parquet(f"{path}/catalog/run={run}")
    written = spark.read.schema(CATALOG).parquet(f"{path}/catalog").where(F.col("run") == run)
    tally = {r[0]: r[1] for r in due.groupBy("action").count().collect()}  # four rows at most
    totals = written.agg(F.count_if(F.col("status") == "failed").alias("f"), F.sum("embeddings_count").alias("v")).first()
    finished = at or datetime.now(timezone.utc)
    numbers = [tally.get(a, 0) for a in ("new", "changed", "deleted", "unchanged")]
    state = "failed" if totals["f"] and totals["f"] == numbers[0] + numbers[1] else "completed"
    row = (source_id, mode, started, finished, *numbers, totals["f"], totals["v"] or 0, state)
    # the run counts from here on
    spark.createDataFrame([row], RUNS.removesuffix(", run bigint")).coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run={run}")
    return run


def _actions(rows: DataFrame, known: DataFrame, mode: str, source_id: str, at: datetime) -> DataFrame:
    """What happens to each document of the snapshot, and with ``full`` to those it lacks, as catalog fields."""
    digest = F.sha2(F.coalesce("content", F.lit("")).cast("binary"), 256)
    new = rows.select(
        "external_id", digest.alias("__hash"), F.octet_length(F.coalesce("content", F.lit(""))).cast("bigint").alias("__size"),
        F.col("metadata").alias("__metadata"), F.lit(True).alias("__here"),
    )
    old = known.select("external_id", *[F.col(c).alias(f"__{c}_old") for c in ("version", "content_hash", "status", "created_at", "metadata", "size_bytes")])
    both = new.join(old, "external_id", "full_outer" if mode == "full" else "left")
    alive = F.col("__version_old").isNotNull() & (F.col("__status_old") != "deleted")
    same = (F.col("__hash") == F.col("__content_hash_old")) & F.to_json("__metadata").eqNullSafe(F.to_json("__metadata_old"))
    action = (
        F.when(F.col("__here").isNull(), F.when(alive, "deleted"))
        .when(~F.coalesce(alive, F.lit(False)), "new")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    version = F.when(F.col("action").isin("new", "changed"), F.coalesce("__version_old", F.lit(0)) + 1).otherwise(F.col("__version_old"))
    created = F.when(F.col("action") == "new", F.lit(at)).otherwise(F.col("__created_at_old")).cast("timestamp")
    kept = F.col("action") == "deleted"
    return both.withColumn("action", action).where("action IS NOT NULL").select(
        F.md5(F.concat(F.lit(source_id), F.lit("|"), F.col("external_id"))).alias("id"),
        F.lit(source_id).alias("source_id"),
        "external_id",
        "action",
        version.cast("int").alias("version"),
        F.when(kept, F.col("__content_hash_old")).otherwise(F.col("__hash")).alias("content_hash"),
        F.when(kept, F.col("__size_bytes_old")).otherwise(F.col("__size")).alias("size_bytes"),
        F.when(kept, F.col("__metadata_old")).otherwise(F.col("__metadata")).alias("metadata"),
        created.alias("created_at"),
        F.lit(at).cast("timestamp").alias("updated_at"),
    )


def stream_source(stream: DataFrame, path: str, source_id: str, dim: int = DEFAULT_DIM, order: str | None = None, **trigger: object) -> StreamingQuery:
    """Ingest a stream of snapshots' rows incrementally; each micro-batch is a run, so one dataset takes one stream.

    By default all there is, then stop.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        ingest_source(batch, path, source_id, run=batch_id, dim=dim, order=order)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{path}/checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
