"""Attempts as a stream: states of titles kept by key, exactly once per event."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fabula.operators.ledger import ATTEMPTS

OUT = "title long, attempts int, state string"
STATE = "ids array<bigint>, outcomes array<string>"


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps the ATTEMPTS smallest events of a title, whatever order they come in, and tells the state from them."""
    known = dict(zip(*state.get, strict=True)) if state.exists else {}
    for f in frames:
        known.update(zip(f["event_id"].tolist(), f["outcome"].tolist(), strict=True))  # an event that comes twice is one
    kept = sorted(known)[:ATTEMPTS]
    outcomes = [known[k] for k in kept]
    state.update((kept, outcomes))
    ended = next((k for k, o in enumerate(outcomes) if o != "retry"), len(outcomes) - 1)
    name = {"done": "record", "refused": "failed"}.get(outcomes[ended]) or ("exhausted" if len(outcomes) >= ATTEMPTS else "open")
    yield pd.DataFrame({"title": [key[0]], "attempts": [ended + 1], "state": [name]})


def title_states(log: DataFrame) -> DataFrame:
    """log (streaming): title, event_id, outcome. Emits a title's state whenever it gets attempts. At most ATTEMPTS ids are remembered for a title."""
    return log.groupBy("title").applyInPandasWithState(_fold, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def run_available(spark: SparkSession, path: str, schema: str, checkpoint: str, sink: str) -> None:
    """Reads what is there, in files, once; states go to a Parquet table by batch."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    outcome = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "refused").otherwise("retry")
    log = events.select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("title"), "event_id", outcome.alias("outcome"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite" if epoch == 0 else "append").parquet(sink)

    q = title_states(log).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
