"""The memory of the Python workers that run tasks."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, so that very long texts do not pile up in one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Give the worker's free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, a function of a task's batches, after which the worker gives its free memory back.

    Workers outlive their tasks, and what one allocator keeps for reuse is lacking to the others.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        gc.collect()
        give_back()

    return run
