"""What a user asks for, one function per verb, over DataFrames of their own.

Items: qid, title, year, media_type, genres, bucket, sitelinks, enwiki_title, tmdb_id, tmdb_id_ambiguous.
Plots: qid, status, text, bucket. Records: as ``fabula.sources.records.RECORD``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula import vocabulary as V
from fabula.functions import classify
from fabula.functions.text import sha256, word_count
from fabula.operators import ledger, metrics, selection


def buckets(spark: SparkSession) -> DataFrame:
    """Cells and quotas: a bucket, or its decades where it has quotas by decade."""
    decades = {"film:english": V.FILM_DECADES, "tv:english": V.SERIES_DECADES}
    return spark.createDataFrame([(f"{b}:{d}", b, n) for b, _, q, _ in V.BUCKETS for d, n in decades.get(b, {"all": q}).items()], "cell string, bucket string, quota int")


def excluded(items: DataFrame) -> DataFrame:
    """items with the first reason for which each is left out, or null."""
    labels = F.lower(F.array_join("genres", " | "))
    rest = [("no_enwiki_article", F.coalesce("enwiki_title", F.lit("")) == ""), ("no_year", F.coalesce("year", F.lit(0)) == 0), ("tmdb_id_ambiguous", F.coalesce("tmdb_id_ambiguous", F.lit(False))), ("no_tmdb_id", F.coalesce("tmdb_id", F.lit(0)) == 0)]
    reason = F.coalesce(F.when(F.col("qid").isin(*V.NON_NARRATIVE), "non_narrative:listed"), classify.first_word(labels, V.EXCLUDED_GENRES, "genre:"), classify.first_reason(rest))
    return items.withColumn("excluded", reason)


def candidates(items: DataFrame, forced: DataFrame) -> DataFrame:
    """The pilot and its reserves: what is not excluded, by bucket and decade, forced titles (qid) first."""
    x = excluded(items).where("excluded is null").join(forced.select("qid", F.lit(True).alias("must")).distinct(), "qid", "left")
    by_decade = F.col("bucket").isin("film:english", "tv:english")
    decade = F.when(F.col("media_type") == "movie", classify.decade(F.col("year"), V.DECADE_FLOOR["movie"])).otherwise(classify.decade(F.col("year"), V.DECADE_FLOOR["tv_series"]))
    x = x.withColumn("cell", F.concat_ws(":", "bucket", F.when(by_decade, decade).otherwise("all"))).withColumn("genre", classify.first_group(F.col("genres"), V.GENRES))
    x = x.withColumn("must", F.coalesce("must", F.lit(False))).withColumn("id", F.substring("qid", 2, 20).cast("long"))
    return selection.quota_pick(x, buckets(items.sparkSession).select("cell", "quota"), fame="sitelinks")


def plot_report(plots: DataFrame, *keys: str) -> DataFrame:
    """Pass rates by each key on its own, and in all."""
    ok = plots.withColumn("ok", (F.col("status") == "ok") & (word_count(F.col("text")) >= 150))
    sets = ok.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.count_if("ok").alias("ok"), F.count("*").alias("total"))
    return sets.withColumn("rate", metrics.ratio(F.col("ok"), F.col("total")))


def gate(plots: DataFrame, licenses: tuple[str, ...] = ("CC-BY-SA-4.0", "CC-BY-SA-3.0"), most: int = 6000) -> DataFrame:
    """plots (with license, content_sha256, word_count) and the first rule that keeps each from being annotated."""
    w = word_count(F.col("text"))
    rules = [
        ("license", ~F.coalesce(F.col("license").isin(*licenses), F.lit(False))), ("no_text", F.coalesce("text", F.lit("")) == ""), ("hash", ~F.coalesce(sha256(F.col("text")) == F.col("content_sha256"), F.lit(False))),
        ("word_count", ~F.coalesce(w == F.col("word_count"), F.lit(False))), ("too_short", w < 150), ("over_limit", w > most),
    ]
    return plots.withColumn("gate", classify.first_reason(rules))


def plan_run(gated: DataFrame, done: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Titles to annotate: what passed the gate and is not done, the first so many by key."""
    return ledger.planned(gated.where("gate is null"), done, keys, [F.col(k) for k in keys], limit)


def evaluate(gold: DataFrame, model: DataFrame) -> dict[str, DataFrame]:
    """gold, model: title_key, outcome, primary_plot, confidence. Headline, confusion, kappa, calibration and what of it passes the gates."""
    g = gold.where("outcome = 'annotated'").select("title_key", F.col("primary_plot").alias("gold"))
    m = model.select("title_key", F.when(F.col("outcome") == "annotated", F.col("primary_plot")).otherwise("(abstained)").alias("label"), "confidence")
    s = g.join(m, "title_key", "left").withColumn("label", F.coalesce("label", F.lit("(no model record)"))).withColumn("right", F.col("gold") == F.col("label"))
    total = s.agg(F.count("*").alias("total"), F.count_if("right").alias("correct"))
    return {
        "headline": total.withColumn("accuracy", metrics.ratio(F.col("correct"), F.col("total"))).withColumn("meets_target", metrics.at_least(F.col("correct"), F.col("total"), metrics.OVERALL)),
        "confusion": s.groupBy("gold", "label").agg(F.count("*").alias("n")),
        "kappa": metrics.kappa(s.where(~F.col("label").startswith("(")), "gold", "label"),
        "calibration": metrics.calibration(s.where("confidence is not null"), "confidence", "right"),
    }
