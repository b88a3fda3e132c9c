"""Append-only runs: attempts, terminal states, costs, idempotent planning, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Attempts of a title; multiplier of cache writes, of a batch; margin of a worst case; seconds of the first and longest wait.
ATTEMPTS, CACHE_WRITE, BATCH, MARGIN, WAIT, LONGEST_WAIT = 3, 1.25, 0.5, 1.25, 5, 120


def attempts(log: DataFrame, key: str, order: str) -> DataFrame:
    """Numbers each title's rows; what comes after the last allowed attempt or after an end is not an attempt. outcome: done, retry or refused."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    ended = F.max((F.col("outcome") != "retry").cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    numbered = log.withColumn("attempt", n).withColumn("_ended", F.coalesce(ended, F.lit(0)))
    return numbered.where((F.col("attempt") <= ATTEMPTS) & (F.col("_ended") == 0)).drop("_ended")


def states(tried: DataFrame, key: str) -> DataFrame:
    """The state of each title after its last attempt."""
    s = tried.groupBy(key).agg(F.max("attempt").alias("attempts"), F.max_by("outcome", "attempt").alias("last"))
    return s.withColumn("state", F.when(F.col("last") == "done", "record").when(F.col("last") == "refused", "failed").when(F.col("attempts") >= ATTEMPTS, "exhausted").otherwise("open"))


def price(tokens_in: Column, tokens_out: Column, cache_write: Column, cache_read: Column, usd_in: Column, usd_out: Column, usd_read: Column, batch: bool = False) -> Column:
    """Dollars of four token counts at prices per million."""
    out = (tokens_in * usd_in + tokens_out * usd_out + cache_write * usd_in * CACHE_WRITE + cache_read * usd_read) / 1_000_000
    return out * BATCH if batch else out


def planned(wanted: DataFrame, done: DataFrame, keys: list[str], order: list, limit: int) -> DataFrame:
    """What is still to do, the first so many: the limit counts after the skip."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti").orderBy(*order).limit(limit)


def backoff(attempt: Column) -> Column:
    """Seconds before the next attempt."""
    return F.least(F.lit(WAIT) * F.pow(F.lit(2), attempt - 1), F.lit(LONGEST_WAIT)).cast("int")
