"""Continuous ingestion: new or changed documents to chunks to vectors.

Every micro-batch writes its own folder ``batch=<id>`` in overwrite mode and compares with the
batches before it only, so a replayed batch rewrites the same rows: one result per document
version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.chunk import chunk_text
from lodestone.operators.embed import DEFAULT_DIM, embed_texts
from lodestone.operators.topk import join_counted, rows_of
from lodestone.session import cut_lineage
from lodestone.sources.sync import latest_version, sync_incremental

CATALOG = "external_id string, version int, content_hash string, batch bigint"
VECTORS = "external_id string, version int, chunk_index int, text string, values array<float>, batch bigint"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty before the first write."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def one_per_id(batch: DataFrame, order: str | None) -> DataFrame:
    """One row per external id of a batch: the last by ``order``, ties by content.

    Without an order, an id with several contents fails the batch: none of them is known to be newer.
    """
    hashed = batch.withColumn("__h", F.coalesce(F.sha2(F.col("content").cast("binary"), 256), F.lit("")))
    place = F.struct(*([order] if order else []), "__h")
    last = F.max(place)
    if not order:
        several = F.concat(F.lit("several contents and no order: "), F.col("external_id").cast("string"))
        last = F.when(F.min("__h") == F.max("__h"), last).otherwise(F.raise_error(several))
    last = hashed.groupBy("external_id").agg(last.alias("__w"))
    kept = hashed.withColumn("__w", place).join(last, ["external_id", "__w"], "left_semi")
    return kept.dropDuplicates(["external_id", "__w"]).drop("__h", "__w")


def ingest_batch(
    batch: DataFrame, batch_id: int, path: str, dim: int = DEFAULT_DIM, order: str | None = None
) -> None:
    """Load the new and changed documents ``external_id, content`` of one batch."""
    spark = batch.sparkSession
    # Materialised once: the batch is compared, counted and loaded.
    snapshot = cut_lineage(
        one_per_id(batch, order).select("external_id", F.col("content").cast("string").alias("content"))
    )
    before = _table(spark, f"{path}/catalog", CATALOG).where(F.col("batch") < batch_id)
    known = latest_version(rows_of(before, snapshot, "external_id"))
    diff = sync_incremental(snapshot, known)
    due = diff.where(F.col("action").isin("new", "changed")).select("external_id", "version", "content_hash")
    due = cut_lineage(due)
    loaded = join_counted(snapshot, due.select("external_id", "version"), "external_id", "inner")
    chunks = chunk_text(loaded.withColumnRenamed("content", "text"))
    vectors = embed_texts(chunks, dim=dim).select("external_id", "version", "chunk_index", "text", "values")
    # Vectors first: a version counts once its catalog row is there.
    vectors.write.mode("overwrite").parquet(f"{path}/vectors/batch={batch_id}")
    due.write.mode("overwrite").parquet(f"{path}/catalog/batch={batch_id}")


def stream_ingest(
    stream: DataFrame, path: str, dim: int = DEFAULT_DIM, order: str | None = None, **trigger: object
) -> StreamingQuery:
    """Ingest a stream ``external_id, content`` into ``path``; by default all there is, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda df, batch_id: ingest_batch(df, batch_id, path, dim, order))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def ingested_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every ingested document."""
    return latest_version(_table(spark, f"{path}/catalog", CATALOG))


def ingested_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vectors of the newest version of every document."""
    newest = ingested_catalog(spark, path).select("external_id", "version", "batch")
    vectors = _table(spark, f"{path}/vectors", VECTORS)
    return join_counted(vectors, newest, ["external_id", "version", "batch"], "left_semi")
