"""Chat sessions and their messages: ``conv_id, turn, role, text``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.ordering import preceding_rows, row_position
from lodestone.operators.topk import LIMIT_THRESHOLD

TITLE_CHARS = 80
DEFAULT_LIMIT = 100


def conversation_history(messages: DataFrame, n: int) -> DataFrame:
    """For every user message the ``n`` messages before it, oldest first, as role and content."""
    item = F.struct(F.col("role"), F.col("text").alias("content"))
    framed = preceding_rows(messages, ["conv_id"], "turn", n, item, "history")
    return framed.where(F.col("role") == "user").select("conv_id", "turn", "text", "history")


def session_rollup(messages: DataFrame, limit: int = 0, time: str | None = None) -> DataFrame:
    """Per session its title, size and turns; with a limit, the newest sessions only.

    The title is the first user message, cut to 80 characters. The newest sessions are those with the
    latest ``time``, whose bounds are added as ``created_at`` and ``updated_at``; without that column
    their last turn stands in for it.
    """
    is_user = F.col("role") == "user"
    bounds = [F.min(time).alias("created_at"), F.max(time).alias("updated_at")] if time else []
    rolled = messages.groupBy("conv_id").agg(
        F.min_by(F.when(is_user, F.substring("text", 1, TITLE_CHARS)), F.when(is_user, F.col("turn"))).alias("title"),
        F.count("*").alias("message_count"),
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
        *bounds,
    )
    if limit > 0:
        rolled = rolled.orderBy(F.col("updated_at" if time else "last_turn").desc(), F.col("conv_id").desc()).limit(limit)
    return rolled


def list_messages(messages: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` messages of every session in order; zero or less means 100."""
    size = limit if limit > 0 else DEFAULT_LIMIT
    if size > LIMIT_THRESHOLD:  # too many rows for Spark to cut them before the shuffle
        placed = row_position(messages, ["conv_id"], "turn", "place").withColumn("place", F.col("place") + 1)
        return placed.where(F.col("place") <= size)
    order = W.partitionBy("conv_id").orderBy("turn")
    return messages.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)


def append_messages(messages: DataFrame, new: DataFrame) -> DataFrame:
    """All messages, the new ones (``conv_id, position, role, text``) after each session's last.

    A session without messages starts at turn 0.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("__last"))
    placed = row_position(new, ["conv_id"], "position", "__n")
    turned = placed.join(last, "conv_id", "left").withColumn(
        "turn", F.coalesce(F.col("__last") + 1, F.lit(0)) + F.col("__n")
    )
    columns = ["conv_id", "turn", "role", "text"]
    return messages.select(*columns).unionByName(turned.select(*columns))


def delete_sessions(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """The messages of all sessions but the listed ones."""
    return messages.join(ids.select("conv_id").distinct(), "conv_id", "left_anti")
