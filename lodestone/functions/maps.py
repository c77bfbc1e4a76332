"""Merging of metadata maps without depending on the session's duplicate-key policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_maps(base: Column, extra: Column) -> Column:
    """Union of two maps; ``extra`` wins on a key clash; a null map counts as empty."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k))
    return F.when(base.isNull(), extra).when(extra.isNull(), base).otherwise(F.map_concat(kept, extra))


def set_if_absent(base: Column, key: str, value: Column) -> Column:
    """Add ``key`` only where it is not present; a present null or empty value stays."""
    single = F.create_map(F.lit(key), value)
    return (
        F.when(base.isNull(), single)
        .when(F.map_contains_key(base, F.lit(key)), base)
        .otherwise(F.map_concat(base, single))
    )
