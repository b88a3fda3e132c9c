"""Python workers live on between tasks; what a task no longer needs goes back to the system."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def freeing(fn: Callable) -> Callable:
    """The same function of one, two or three tables or keys for a grouped apply, with a release after each group."""

    def run(*args):
        try:
            return fn(*args)
        finally:
            release()

    # Spark counts parameters to tell whether a function wants the group's key
    return {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[len(inspect.signature(fn).parameters)]


#: Rows of an Arrow batch: of long texts, Spark's default of 10,000 would fill hundreds of MB.
BATCH_ROWS, SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """df, in whose session batches of rows sent to Python are no larger than BATCH_ROWS from now on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(SETTING, "10000")) <= BATCH_ROWS:
        conf.set(SETTING, str(BATCH_ROWS))
    return df


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same generator of batches, with a release at its end."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            release()

    return wrapped
