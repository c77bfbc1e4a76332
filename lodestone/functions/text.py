"""Tokens, words and hash buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words; empty text gives one empty word."""
    return F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")


def hash_bucket(token: Column, buckets: int) -> Column:
    """Bucket of a token from the first 32 bits of its MD5."""
    head = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once, however often ``body`` refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(token_list: Column) -> Column:
    """``ARRAY<STRUCT<term, tf>>`` of a token array.

    The tokens are sorted and the lengths of equal runs taken, all within the row: counting the
    terms of a document needs no shuffle.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        first = F.filter(
            F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return _bind(
            first,
            lambda starts: F.transform(
                starts,
                lambda at, j: F.struct(
                    F.get(ordered, at).alias("term"),
                    (F.coalesce(F.get(starts, j + 1), size) - at).cast("bigint").alias("tf"),
                ),
            ),
        )

    return F.when(F.size(token_list) > 0, _bind(F.sort_array(token_list), runs))
