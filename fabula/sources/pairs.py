"""Pair files: which titles should be alike, as CSV with an exact header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions.gates import reasons

# Columns of a pair file, columns that may follow, and what may stand in them.
COLUMNS = ("pair_id", "expect", "title_a", "year_a", "type_a", "title_b", "year_b", "type_b", "shared_shape", "why", "status")
PINS = ("qid_a", "qid_b")
EXPECT, STATUSES, TYPES = ("match", "no_match"), ("seed", "proposed", "approved", "rejected"), ("movie", "tv_series")
EXPECTATIONS = ("should_match", "should_not_match")


def _blank(name: str):
    return F.trim(F.coalesce(F.col(name), F.lit(""))) == ""


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: row (in the file, the header is 1), the columns, and problems. A pin that differs from that of an
    earlier sound line for the same title, year and type is a problem as well. Raises on another header. The file is small by nature and read in one task, as its order counts."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if tuple(raw.columns) not in (COLUMNS, COLUMNS + PINS):
        raise ValueError(f"columns must be {COLUMNS}, or those and {PINS}, not {raw.columns}")
    for pin in PINS:
        if pin not in raw.columns:
            raw = raw.withColumn(pin, F.lit(None).cast("string"))
    x = raw.coalesce(1).withColumn("row", F.monotonically_increasing_id() + 2)
    x = x.withColumn("before", F.row_number().over(Window.partitionBy("pair_id").orderBy("row")))
    within = lambda name, values: ~F.coalesce(F.col(name).isin(*values), F.lit(False))
    rules = [("duplicate", F.col("before") > 1), ("expect", within("expect", EXPECT)), ("status", within("status", STATUSES))]
    for side in "ab":
        rules += [
            (f"type_{side}", within(f"type_{side}", TYPES)), (f"year_{side}", ~F.coalesce(F.col(f"year_{side}").rlike("^[0-9]+$"), F.lit(False))), (f"title_{side}", _blank(f"title_{side}")),
        ]
    rules += [("why", _blank("shared_shape") | _blank("why"))]
    rules += [(pin, ~_blank(pin) & ~F.trim(F.col(pin)).rlike("^Q[1-9][0-9]*$")) for pin in PINS]
    x = x.withColumn("problems", reasons(rules)).drop("before")
    # pins of sound lines, both sides of one below the other
    side = lambda s, k: F.struct(F.lit(k).alias("side"), *[F.col(f"{c}_{s}").alias(c) for c in ("title", "year", "type")], F.trim(F.col(f"qid_{s}")).alias("qid"))
    pins = x.where(F.size("problems") == 0).select("row", F.inline(F.array(side("a", 0), side("b", 1)))).where("qid <> ''")
    first = pins.groupBy("title", "year", "type").agg(F.min_by("qid", F.struct("row", "side")).alias("known"))
    clash = pins.join(first, ["title", "year", "type"]).where("qid <> known")
    clash = clash.groupBy("row").agg(F.array_sort(F.collect_list(F.concat(F.lit("pin_"), F.when(F.col("side") == 0, "a").otherwise("b")))).alias("clash"))
    return x.join(clash, "row", "left").withColumn("problems", F.concat("problems", F.coalesce("clash", F.array().cast("array<string>")))).drop("clash")


def load_expectations(spark: SparkSession, path: str) -> DataFrame:
    """row, title_a, title_b, expectation, note of an expectation file, trimmed. Raises on the first line whose expectation is unknown or that lacks a title, when it is read."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) if c in raw.columns else F.lit("")
    x = raw.coalesce(1).withColumn("row", F.monotonically_increasing_id() + 2).select("row", *[text(c).alias(c) for c in ("title_a", "title_b", "expectation", "note")])
    why = F.when(~F.col("expectation").isin(*EXPECTATIONS), F.concat(F.lit("unknown expectation in line "), F.col("row").cast("string"))).when((F.col("title_a") == "") | (F.col("title_b") == ""), F.concat(F.lit("no title in line "), F.col("row").cast("string")))
    return x.withColumn("expectation", F.when(why.isNotNull(), F.raise_error(why)).otherwise(F.col("expectation")))
