"""Matching titles to items: by name and kind, within a window of years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def year_window(seeds: DataFrame, items: DataFrame, keys: list[str], by: str, year: str, item_year: str, window: int = 1) -> DataFrame:
    """Equi join on keys, at most ``window`` years apart; adds gap. by: the seeds' key (for callers' windows)."""
    return seeds.join(items, keys).where(F.abs(F.col(year) - F.col(item_year)) <= window).withColumn("gap", F.abs(F.col(year) - F.col(item_year)))


def best(hits: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first hit of each key."""
    return hits.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_k = 1").drop("_k")


def unless_tied(hits: DataFrame, key: str, gap: str, item: str) -> DataFrame:
    """By key: the item of the smallest gap, null where several share it; and how many do."""
    by = Window.partitionBy(key)
    near = hits.withColumn("_least", F.min(gap).over(by)).where(F.col(gap) == F.col("_least"))
    out = near.groupBy(key).agg(F.count_distinct(item).alias("tied"), F.min(item).alias("_item"))
    return out.select(key, F.when(F.col("tied") == 1, F.col("_item")).alias(item), "tied")


def cascade(keys: DataFrame, key: str, tiers: list[DataFrame], item: str) -> DataFrame:
    """The match of the first tier that has any; tiers: key, item, tied."""
    out = keys.select(key)
    for k, t in enumerate(tiers):
        out = out.join(t.select(key, F.col(item).alias(f"_i{k}"), F.col("tied").alias(f"_t{k}")), key, "left")
    status = F.coalesce(*[F.when(F.col(f"_t{k}") == 1, F.lit(f"tier{k}")).when(F.col(f"_t{k}") > 1, F.lit("ambiguous")) for k in range(len(tiers))], F.lit("unmatched"))
    picked = F.coalesce(*[F.when(F.col(f"_t{k}").isNotNull(), F.struct(F.col(f"_i{k}").alias("i"))) for k in range(len(tiers))])["i"]
    return out.select(key, picked.alias(item), status.alias("status"))
