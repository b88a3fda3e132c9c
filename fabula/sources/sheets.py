"""Seeds, pairs, gold sheets and plot files as sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.functions.gates import reasons
from fabula.vocabulary import PLOTS, TONES

SEEDS = "title string, year string, type string, note string"
SHEET = "qid string, slot string, labeler string, plot string, arc string, confidence string, tones string"
PLOT = "qid string, status string, text string, word_count int, content_sha256 string, sources array<struct<ref:string,license:string>>, _corrupt string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows of text files with file and ordinal: a file is read as one piece, so ordinals are those of its lines."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("ordinal", "line"))


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """Gold seeds: blank titles and those that begin with # are left out; a byte-order mark is dropped."""
    df = spark.read.schema(SEEDS).option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    title = F.trim(F.regexp_replace("title", "^﻿", ""))
    return df.withColumn("title", title).withColumn("year", F.col("year").try_cast("int")).where((F.col("title") != "") & ~F.col("title").startswith("#"))


def _yes(c: Column) -> Column:
    return F.when(F.lower(F.trim(c)).isin("y", "yes", "true", "1"), True).when(F.lower(F.trim(c)).isin("n", "no", "false", "0"), False)


def key(c: Column) -> Column:
    """A display name as a key: lower case, white space and hyphens as underscores."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")


# Words of confidence and what they stand for.
CONFIDENCE = {"high": 0.95, "medium": 0.8, "low": 0.6, "weak": 0.4}


def gold_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a labelling sheet with their errors; blank and help rows are left out, but row numbers count them.
    The arc is eleven numbers joined by |, with decimal commas allowed, or nothing; the second slot needs a valid first one."""
    raw = spark.read.schema(SHEET).option("header", True).option("multiLine", True).csv(path).coalesce(1)
    raw = raw.withColumn("row", F.monotonically_increasing_id() + 2)
    cells = F.concat_ws("", *[c.split()[0] for c in SHEET.split(", ")])
    x = raw.where((F.trim(cells) != "") & ~F.coalesce(F.col("qid").startswith("#"), F.lit(False)))
    points = F.transform(F.split(F.replace("arc", F.lit(","), F.lit(".")), r"\|"), lambda p: F.trim(p).try_cast("double"))
    words = F.map_from_arrays(F.array(*map(F.lit, CONFIDENCE)), F.array(*map(F.lit, CONFIDENCE.values())))
    x = x.withColumn("slot", F.col("slot").try_cast("int")).withColumn("plot", key(F.col("plot"))).withColumn("points", F.when(F.trim("arc") != "", points))
    x = x.withColumn("sure", F.try_element_at(words, key(F.col("confidence")))).withColumn("tone_list", F.transform(F.split(F.coalesce("tones", F.lit("")), r"\|"), key))
    tones = F.filter("tone_list", lambda t: t != "")
    bad = F.coalesce(F.size("points") != 11, F.lit(False)) | F.coalesce(F.exists("points", lambda p: p.isNull() | (F.abs(p) > 1)), F.lit(False))
    rules = [
        ("qid", ~F.coalesce(F.col("qid").rlike(r"^Q\d+$"), F.lit(False))), ("slot", ~F.coalesce(F.col("slot").isin(1, 2), F.lit(False))), ("labeler", F.coalesce(F.trim("labeler"), F.lit("")) == ""),
        ("plot", ~F.coalesce(F.col("plot").isin(*PLOTS), F.lit(False))), ("arc", bad), ("confidence", F.col("sure").isNull()),
        ("tones", (F.size(tones) > 3) | (F.size(tones) != F.size(F.array_distinct(tones))) | F.exists(tones, lambda t: ~t.isin(*TONES))),
    ]
    x = x.withColumn("errors", reasons(rules))
    first = x.where("slot = 1 and size(errors) = 0").select("qid", F.lit(True).alias("has_first")).distinct()
    x = x.join(first, "qid", "left")
    orphan = (F.col("slot") == 2) & F.col("has_first").isNull()
    return x.select("row", "qid", "slot", "labeler", "plot", "points", F.col("sure").alias("confidence"), F.when(orphan, F.concat("errors", F.array(F.lit("orphan_slot")))).otherwise(F.col("errors")).alias("errors"))


def plots(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(usable, unusable) plot files: what does not parse, has no text, or whose hash differs is unusable; a key that
    two usable files share is an error when it is read."""
    df = spark.read.schema(PLOT).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    reason = F.coalesce(F.when(F.col("_corrupt").isNotNull(), "corrupt"), F.when(F.col("qid").isNull(), "no_key"), F.when(F.col("status") != "ok", F.col("status")), F.when(F.coalesce("text", F.lit("")) == "", "no_text"), F.when(sha != F.col("content_sha256"), "hash"))
    df = df.withColumn("reason", reason)
    twice = df.where("reason is null").groupBy("qid").agg(F.count("*").alias("n"))
    usable = df.where("reason is null").join(twice, "qid")
    usable = usable.withColumn("qid", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate key "), "qid"))).otherwise(F.col("qid")))
    return usable.drop("n", "reason", "_corrupt"), df.where("reason is not null").select("qid", "reason")


def write_dropdowns(names: DataFrame, path: str) -> None:
    """Lists of allowed values as columns of one CSV file."""
    names.coalesce(1).write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)


def dropdowns(spark: SparkSession, lists: dict[str, tuple[str, ...]]) -> DataFrame:
    """Lists side by side, padded by nulls."""
    rows = spark.createDataFrame([(k, i, v) for k, vs in lists.items() for i, v in enumerate(vs)], "list string, place int, value string")
    return rows.groupBy("place").pivot("list", list(lists)).agg(F.first("value"))


