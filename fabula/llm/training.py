"""Bounded samples of labelled documents, from which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabula.llm.memory import small_batches
from fabula.llm.scratch import written

#: Most labelled rows that a classifier is fitted on. They are the first by a hash of doc_id.
SAMPLE_ROWS = 8192


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3. Rows of fold 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, y of at most ``rows`` labelled documents outside fold 1, as a written table. Rows without label or id are left out."""
    y = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most SAMPLE_ROWS pairs of numbers: small enough to broadcast by that bound
    texts = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return written(texts, f"sample-{label}")
