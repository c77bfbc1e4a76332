"""The document catalog: building it, paging through it, fetching originals."""

from __future__ import annotations

import base64
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.scalars import mime_from_extension
from lodestone.operators.topk import join_counted, rows_of

DEFAULT_PAGE = 50


def document_catalog(docs: DataFrame, chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per document of ``doc_id, source, file_name, content, version``.

    ``chunks`` and ``vectors`` carry one ``doc_id`` per chunk and per vector. A document
    without chunks has failed; it is ready when every chunk has a vector.
    """
    chunk_counts = chunks.groupBy("doc_id").agg(F.count("*").alias("chunk_count"))
    vector_counts = vectors.groupBy("doc_id").agg(F.count("*").alias("embeddings_count"))
    status = (
        F.when(F.col("chunk_count") == 0, "failed")
        .when(F.col("chunk_count") == F.col("embeddings_count"), "ready")
        .otherwise("processing")
    )
    described = docs.select(
        "doc_id",
        "source",
        "file_name",
        mime_from_extension(F.col("file_name")).alias("mime_type"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.sha2("content", 256).alias("content_hash"),
        "version",
        F.col("content").isNotNull().alias("download_available"),
    )
    return (
        described.join(chunk_counts, "doc_id", "left")
        .join(vector_counts, "doc_id", "left")
        .fillna(0, ["chunk_count", "embeddings_count"])
        .withColumn("status", status)
    )


def _cursor_column(created: Column, id_col: Column) -> Column:
    return F.base64(F.concat_ws("|", F.coalesce(F.unix_micros(created).cast("string"), F.lit("")), id_col.cast("string")).cast("binary"))


def encode_cursor(created: datetime | None, doc_id: object) -> str:
    micros = "" if created is None else round((created - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    return base64.b64encode(f"{micros}|{doc_id}".encode()).decode()


def decode_cursor(cursor: str) -> tuple[int | None, str]:
    micros, _, doc_id = base64.b64decode(cursor).decode().partition("|")
    return int(micros) if micros else None, doc_id


def list_documents_keyset(
    catalog: DataFrame,
    limit: int = 0,
    cursor: str = "",
    status: str = "",
    created: str = "created_at",
    id_col: str = "id",
) -> DataFrame:
    """The page after ``cursor`` in order of creation, with ``next_cursor`` on its rows.

    ``next_cursor`` is empty on the last page. Rows are found by key, never by offset. Rows without a
    time come first.
    """
    size = limit if limit > 0 else DEFAULT_PAGE
    rows = catalog.where(F.col("status") == status) if status else catalog
    if cursor:
        micros, last = decode_cursor(cursor)
        last_id = F.lit(last).cast(catalog.schema[id_col].dataType)
        if micros is None:
            rows = rows.where(F.col(created).isNotNull() | (F.col(id_col) > last_id))
        else:
            at = F.timestamp_micros(F.lit(micros))
            if catalog.schema[created].dataType.typeName() == "timestamp_ntz":
                at = at.cast("timestamp_ntz")
            rows = rows.where((F.col(created) > at) | ((F.col(created) == at) & (F.col(id_col) > last_id)))
    page = rows.orderBy(created, id_col).limit(size + 1)
    # The window runs over one page, at most size + 1 rows.
    whole = W.partitionBy(F.lit(0)).orderBy(created, id_col)
    page = page.withColumn("__n", F.row_number().over(whole))
    more = F.max("__n").over(W.partitionBy(F.lit(0))) > size
    last_cursor = F.max(
        F.when(F.col("__n") == size, _cursor_column(F.col(created).cast("timestamp"), F.col(id_col)))
    ).over(W.partitionBy(F.lit(0)))
    page = page.withColumn("next_cursor", F.when(more, last_cursor).otherwise(F.lit("")))
    return page.where(F.col("__n") <= size).drop("__n")


def paged_listing(entities: DataFrame, id_col: str, limit: int = 0, offset: int = 0) -> DataFrame:
    """A page of entities by id with ``total`` on each row; zero or less leaves a bound unset."""
    size = limit if limit > 0 else DEFAULT_PAGE
    total = entities.agg(F.count("*").alias("n")).scalar()
    page = entities.orderBy(id_col)
    page = page.offset(offset).limit(size) if offset > 0 else page.limit(size)
    return page.withColumn("total", total)


def get_originals(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """Original bytes ``doc_id, content`` of the listed documents that kept them."""
    kept = catalog.where(F.col("content").isNotNull()).select("doc_id", "content")
    return rows_of(kept, ids, "doc_id")


def get_original_files(spark: SparkSession, catalog: DataFrame, ids: DataFrame, root: str) -> DataFrame:
    """Original bytes of listed documents read from their files below ``root``.

    Content is read only for the files whose path is listed.
    """
    paths = rows_of(catalog.select("doc_id", "path"), ids, "doc_id")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return join_counted(files.select("path", "content"), paths, "path", "inner").select("doc_id", "content")
