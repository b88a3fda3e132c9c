"""Stratified selection: quotas, reserves, round robin, slots and backfill.

Rank order is fame descending, then id ascending. All steps are windows; an ordinal window over
a whole table is only taken after rows are cut to what the quotas can use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quota_pick(items: DataFrame, quotas: DataFrame, cell: str = "cell", genre: str = "genre", fame: str = "fame", key: str = "id", must: str = "must", reserve: float = 0.3) -> DataFrame:
    """items: cell, genre, fame, id, must (boolean). quotas: cell, quota. Adds role, phase and bucket_rank to what is picked.

    By cell: forced items in rank order up to the quota; then by fame until half the quota; then the
    genre with fewest picks first, ties by fame of its best item left. Reserves are the next by
    fame, quota * reserve of them, rounded up. The third phase is an order: an item's turn is the
    picks its genre has plus its place among the genre's items left."""
    rank = [F.desc(fame), F.col(key)]
    by_cell = Window.partitionBy(cell)
    x = items.join(quotas, cell)
    # every phase takes at most 2 * quota of a cell's genre: more can't matter
    x = x.withColumn("_g", F.row_number().over(Window.partitionBy(cell, genre, must).orderBy(*rank))).where(F.col("_g") <= F.col("quota") * 2 + 1).drop("_g")
    x = x.withColumn("_m", F.when(F.col(must), F.row_number().over(Window.partitionBy(cell, must).orderBy(*rank))))
    x = x.withColumn("_forced", F.coalesce(F.col("_m") <= F.col("quota"), F.lit(False)))
    x = x.withColumn("_n", F.sum(F.col("_forced").cast("int")).over(by_cell))
    share = F.greatest(F.lit(0), F.ceil(F.col("quota") / 2) - F.col("_n"))
    x = x.withColumn("_f", F.row_number().over(Window.partitionBy(cell, "_forced").orderBy(*rank)))
    x = x.withColumn("_famous", ~F.col("_forced") & (F.col("_f") <= share))
    x = x.withColumn("_have", F.sum((F.col("_forced") | F.col("_famous")).cast("int")).over(Window.partitionBy(cell, genre)))
    x = x.withColumn("_left", ~(F.col("_forced") | F.col("_famous")))
    x = x.withColumn("_turn", F.col("_have") + F.row_number().over(Window.partitionBy(cell, genre, "_left").orderBy(*rank)) - 1)
    x = x.withColumn("_t", F.row_number().over(Window.partitionBy(cell, "_left").orderBy("_turn", *rank)))
    rest = F.col("quota") - F.col("_n") - F.sum(F.col("_famous").cast("int")).over(by_cell)
    x = x.withColumn("_rest", rest).withColumn("_even", F.col("_left") & (F.col("_t") <= F.col("_rest")))
    phase = F.when(F.col("_forced"), "forced").when(F.col("_famous"), "famous").when(F.col("_even"), "even")
    x = x.withColumn("phase", phase).withColumn("role", F.when(phase.isNotNull(), "pilot").otherwise("reserve"))
    x = x.withColumn("bucket_rank", F.row_number().over(Window.partitionBy(cell, "role").orderBy(*rank)))
    kept = (F.col("role") == "pilot") | (F.col("bucket_rank") <= F.ceil(F.col("quota") * reserve))
    return x.where(kept).select(*items.columns, "quota", "role", "phase", F.col("bucket_rank").cast("long").alias("bucket_rank"))


def round_robin(items: DataFrame, bucket: str, order: list, bucket_order: Column, n: int) -> DataFrame:
    """The first n rows, taken from each bucket in turn. No bucket gives more than n, which the window's group limit uses before the shuffle."""
    turns = items.withColumn("turn", F.row_number().over(Window.partitionBy(bucket).orderBy(*order))).where(F.col("turn") <= n)
    return turns.orderBy("turn", bucket_order).limit(n)


def effective(items: DataFrame, slots: DataFrame, bucket: str, order: list) -> DataFrame:
    """By bucket the first ok rows, as many as it has slots."""
    ok = items.where("ok").join(slots, bucket)
    return ok.withColumn("place", F.row_number().over(Window.partitionBy(bucket).orderBy(*order))).where(F.col("place") <= F.col("slots"))


def backfill(items: DataFrame, slots: DataFrame, bucket: str, order: list) -> DataFrame:
    """Reserves that are tried: those before which fewer ok rows stand than there are slots."""
    before = F.coalesce(F.sum(F.col("ok").cast("int")).over(Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return items.join(slots, bucket).withColumn("ok_before", before).where(F.col("ok_before") < F.col("slots"))
