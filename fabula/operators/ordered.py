"""Ordered operators: capped prefixes, restarts, running budgets and streaks, as windows and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(key: str, *order: str) -> Window:
    return Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def before(key: str, *order: str) -> Window:
    return Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def capped_prefix(items: DataFrame, key: str, order: str, words: str, cap: int, most: int) -> DataFrame:
    """The longest start of each key's items within a word cap and a number of items; empty items are skipped.
    Adds place and upto; by key also why it stopped: word_cap, count_cap or null."""
    x = items.where(F.col(words) > 0).withColumn("upto", F.sum(words).over(running(key, order))).withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    # sums only grow, so what is over the cap stays over: the first row over it stops the rest
    first_over = F.min(F.when((F.col("upto") > cap) | (F.col("place") > most), F.col("place"))).over(Window.partitionBy(key))
    stop = F.min(F.when(F.col("upto") > cap, F.col("place"))).over(Window.partitionBy(key))
    x = x.withColumn("stopped_at", first_over).withColumn("reason", F.when(first_over.isNull(), F.lit(None)).when(stop == first_over, "word_cap").otherwise("count_cap"))
    return x.where(F.col("stopped_at").isNull() | (F.col("place") < F.col("stopped_at")))


def rising_until_restart(items: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The start of each key's sequence up to the first value below the highest so far; equal values go on."""
    high = F.max(value).over(before(key, order))
    x = items.withColumn("_high", high).withColumn("_bad", F.when(F.col(value) < F.col("_high"), F.col(order)))
    x = x.withColumn("_stop", F.min("_bad").over(Window.partitionBy(key)))
    return x.where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_high", "_bad", "_stop")


def budget_stop(items: DataFrame, key: str, order: str, cost: str, budget: float) -> DataFrame:
    """By key: the first item that no longer fits the running budget (null if all fit), and what was spent before it."""
    x = items.withColumn("_sum", F.sum(cost).over(running(key, order)))
    over = F.col("_sum") > budget + 1e-9
    return x.groupBy(key).agg(F.min(F.when(over, F.col(order))).alias("refused"), F.coalesce(F.max(F.when(~over, F.col("_sum"))), F.lit(0.0)).alias("spent"))


def streaks(items: DataFrame, key: str, order: str, flag: Column) -> DataFrame:
    """Runs of flagged rows: key, first, last, n. A row's run is the number of unflagged rows before it."""
    x = items.withColumn("_f", flag).withColumn("_run", F.sum((~F.col("_f")).cast("int")).over(running(key, order)))
    return x.where("_f").groupBy(key, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("_run")


def lead_block(words: Column, stub: int, ceiling: int, cap: int) -> Column:
    """How many leading items are joined: stubs (fewer words than ``stub``) and the first full item up to the ceiling,
    or, where that is over it, what fits; then more items up to the cap."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("words"), F.lit(False).alias("full"), F.lit(False).alias("stop"))

    def add(s: Column, w: Column) -> Column:
        limit = F.when(s["full"], cap).otherwise(ceiling)
        fits = ~s["stop"] & (s["words"] + w <= limit)
        return F.struct(
            (s["n"] + fits.cast("int")).alias("n"), (s["words"] + F.when(fits, w).otherwise(0)).alias("words"),
            (s["full"] | (w >= stub)).alias("full"), (s["stop"] | ~fits).alias("stop"),
        )

    return F.aggregate(words, zero, add)


# Headings of a section of episodes itself, of its parts, and those that name a season.
UNHEADED = ("", "episodes", "episode list", "list of episodes")
PART_HEADING, SEASON_HEADING = r"^part\s+([0-9]{1,2}|[ivx]{1,5})\b", r"^(season|series)\s+[0-9]{1,3}\b"


def unheaded_season(tables: DataFrame, page: str, place: str, heading: str, seasons: str) -> DataFrame:
    """Tables of pages without any heading that names a season, as season 1 in their order: those under the section's own heading
    or under parts of it. Only where the series is known to have one season, or no number is known: else they may span several.
    A null heading is an empty one. Pages are decided by a count per page, so only their tables that stay are numbered."""
    h = F.lower(F.trim(F.coalesce(F.col(heading), F.lit(""))))
    named = tables.where(h.rlike(SEASON_HEADING)).select(page).distinct()
    kept = tables.where((h.isin(*UNHEADED) | h.rlike(PART_HEADING)) & (F.coalesce(F.col(seasons), F.lit(1)) == 1)).join(named, page, "left_anti")
    order = Window.partitionBy(page).orderBy(place)
    return kept.withColumn("season", F.lit(1)).withColumn("place", F.row_number().over(order).cast("long"))
