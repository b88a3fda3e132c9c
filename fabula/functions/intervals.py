"""Runs of numbers and what is covered of a whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def runs(numbers: Column) -> Column:
    """Maximal runs of consecutive numbers of a sorted distinct array, as structs low, high."""

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["low"].alias("low"), x.alias("high"))))
        fresh = F.concat(acc, F.array(F.struct(x.alias("low"), x.alias("high"))))
        return F.when(F.size(acc) == 0, F.array(F.struct(x.alias("low"), x.alias("high")))).when(last["high"] + 1 == x, grown).otherwise(fresh)

    return F.aggregate(numbers, F.lit(None).cast("array<struct<low:bigint,high:bigint>>"), lambda a, x: add(F.coalesce(a, F.array().cast("array<struct<low:bigint,high:bigint>>")), x))


def listed(numbers: Column, word: str) -> Column:
    """Numbers as words: "season 3", "seasons 1–2 and 4"."""
    parts = F.transform(runs(numbers), lambda r: F.when(r["low"] == r["high"], r["low"].cast("string")).otherwise(F.concat(r["low"].cast("string"), F.lit("–"), r["high"].cast("string"))))
    text = F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(F.concat(F.array_join(F.slice(parts, 1, F.size(parts) - 1), ", "), F.lit(" and "), F.element_at(parts, -1)))
    return F.concat(F.when(F.size(numbers) == 1, word).otherwise(word + "s"), F.lit(" "), text)


def total(stated: Column, numbers: Column) -> Column:
    """The stated total where it is no less than the highest number seen, else that; null if neither."""
    high = F.array_max(numbers)
    return F.when(stated >= F.coalesce(high, F.lit(0)), stated).otherwise(high)


def is_partial(numbers: Column, whole: Column) -> Column:
    """Whether some number from 1 to the total is missing."""
    return F.when(whole.isNotNull(), numbers != F.sequence(F.lit(1).cast("long"), whole.cast("long")))
