"""A cache of responses with ages, read under a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, url string, fetched_at timestamp, body string"


def is_fresh(fetched: Column, as_of: Column, ttl: int | None) -> Column:
    """No limit: always; 0: never; else while no older than so many seconds."""
    if ttl is None:
        return F.lit(True)
    if ttl == 0:
        return F.lit(False)
    return (F.unix_micros(as_of) - F.unix_micros(fetched.cast("timestamp"))).between(0, ttl * 1_000_000)


def cache_key(method: Column, url: Column, body: Column) -> Column:
    return F.sha2(F.concat_ws("\n", method, url, F.coalesce(body, F.lit(""))), 256)


def read_cache(spark: SparkSession, path: str, as_of: str, ttl: int | None) -> DataFrame:
    """Entries of a JSON-lines cache that may be used at a given time; the youngest of each key."""
    rows = spark.read.schema(SCHEMA).json(path).where(is_fresh(F.col("fetched_at"), F.lit(as_of).cast("timestamp"), ttl))
    return rows.groupBy("key").agg(F.max_by(F.struct("url", "fetched_at", "body"), "fetched_at").alias("r")).select("key", "r.*")
