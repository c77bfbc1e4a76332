"""The write path: id assignment, upsert, delete, text documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.ids import string_id
from lodestone.functions.maps import set_if_absent
from lodestone.operators.embed import DEFAULT_DIM, HASHING, embed_texts
from lodestone.operators.ordering import row_position
from lodestone.operators.topk import rows_of, without_rows_of
from lodestone.session import cut_lineage


def assign_text_ids(batch: DataFrame, position: str = "position") -> DataFrame:
    """Give unset ids ``text-<n>``, n the 1-based place in the whole ordered batch."""
    placed = row_position(batch, [], position, "__n")
    generated = string_id(F.concat(F.lit("text-"), (F.col("__n") + 1).cast("string")))
    return placed.withColumn("id", F.coalesce(F.col("id"), generated)).drop("__n")


def assign_record_ids(batch: DataFrame, batch_id: Column, position: str = "position") -> DataFrame:
    """Give unset ids a stable one, made of the batch and the place in it."""
    generated = string_id(F.md5(F.concat_ws("|", batch_id.cast("string"), F.col(position).cast("string"))))
    return batch.withColumn("id", F.coalesce(F.col("id"), generated))


def split_by_dim(batch: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector has ``dim`` values, and the rejected others."""
    fits = F.coalesce(F.size("values") == dim, F.lit(False))
    return batch.where(fits), batch.where(~fits)


def latest_per_id(rows: DataFrame, seq: str = "seq", position: str = "position") -> DataFrame:
    """The row of each id with the highest (batch, place in batch).

    Only the narrow keys are aggregated, partially before the shuffle; the vectors are then
    matched on the whole (id, batch, place), so an id repeated very often skews nothing. A row
    without a place comes before the others of its batch.
    """
    place = F.struct(F.col(seq), F.col(position))
    winners = rows.groupBy("id").agg(F.max(place).alias("__w"))
    return rows.withColumn("__w", place).join(winners, ["id", "__w"], "left_semi").drop("__w")


def insert_vectors(existing: DataFrame, batch: DataFrame, dim: int, batch_id: int) -> DataFrame:
    """Upsert a batch: ``id, values, metadata, seq, position``.

    Rows of another length than ``dim`` are left out (see ``split_by_dim``). A later batch
    replaces an id of an earlier one; within a batch the last place wins. Replaying a batch
    under the same ``batch_id`` changes nothing.
    """
    valid, _ = split_by_dim(batch, dim)
    valid = assign_record_ids(valid, F.lit(batch_id)).withColumn("seq", F.lit(batch_id).cast("bigint"))
    columns = ["id", "values", "metadata", "seq", "position"]
    others = existing.where(F.col("seq") != batch_id).select(*columns)
    return latest_per_id(others.unionByName(valid.select(*columns)))


def delete_vectors(existing: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose typed id is not listed; unknown ids are ignored."""
    return without_rows_of(existing, ids, "id")


def deleted_count(existing: DataFrame, ids: DataFrame) -> DataFrame:
    """One row, ``deleted``: how many records the list removes."""
    return rows_of(existing, ids, "id").agg(F.count("*").alias("deleted"))


def prepare_texts(
    documents: DataFrame,
    provider: str = HASHING[0],
    model: str = HASHING[1],
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Text documents ``id, text, metadata map, position`` as records ready for insertion.

    The text is copied to ``metadata.text`` unless that key is present, unset ids become
    ``text-<n>``, and each row keeps its own vector.
    """
    # Embedding comes first: it keeps the input's partitions, the numbering shuffles.
    with_text = documents.withColumn("metadata", set_if_absent(F.col("metadata"), "text", F.col("text")))
    embedded = embed_texts(with_text, "text", "values", provider, model, dim)
    return assign_text_ids(embedded.select("id", "values", "metadata", "position"))


def add_texts(existing: DataFrame, documents: DataFrame, batch_id: int, dim: int = DEFAULT_DIM) -> DataFrame:
    """Embed text documents and upsert them.

    The embedded batch is materialised once, since the upsert reads it twice.
    """
    return insert_vectors(existing, cut_lineage(prepare_texts(documents, dim=dim)), dim, batch_id)


def write_collection(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: str | None = None,
    files_per_partition: int = 8,
) -> None:
    """Persist records as Parquet, in one folder per cell where ``partition_by`` is given.

    Rows of one cell go to up to ``files_per_partition`` tasks by id, which bounds the number
    of files and keeps a hot cell off a single task.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    salt = F.pmod(F.xxhash64("id"), F.lit(files_per_partition))
    spread = df.withColumn("__s", salt).repartition(partition_by, "__s").drop("__s")
    spread.write.mode(mode).partitionBy(partition_by).parquet(path)
