"""Pass rates, counts and distributions over plot texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions import classify
from fabula.functions.text import WORD, sha256, token_estimate, word_count
from fabula.registry import query
from fabula.sources.tables import table

#: Fewest words of a usable plot text.
MIN_WORDS = 150
_WORD = WORD.replace("'", "''")
#: Words of a text, in the SQL of the oracle.
W = f"len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT"


@query(f"""
    SELECT lang, count(*) FILTER (w >= {MIN_WORDS}) AS ok, count(*) AS total, count(*) FILTER (w >= {MIN_WORDS}) / count(*) AS rate
    FROM (SELECT lang, {W} AS w FROM documents) GROUP BY lang""")
def plot_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By language: texts of enough words, all texts, and their ratio."""
    docs = table(spark, sf_dir, "documents").select("lang", (word_count(F.col("text")) >= MIN_WORDS).alias("ok"))
    return docs.groupBy("lang").agg(F.count_if("ok").alias("ok"), F.count("*").alias("total")).withColumn("rate", F.col("ok") / F.col("total"))


@query(f"""
    SELECT lang, source, count(*) FILTER (w >= {MIN_WORDS}) AS ok, count(*) AS total, count(*) FILTER (w >= {MIN_WORDS}) / count(*) AS rate
    FROM (SELECT lang, source, {W} AS w FROM documents) GROUP BY GROUPING SETS ((lang), (source), ())""")
def pass_rate_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "source", (word_count(F.col("text")) >= MIN_WORDS).alias("ok"))
    out = docs.groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count_if("ok").alias("ok"), F.count("*").alias("total"))
    return out.withColumn("rate", F.col("ok") / F.col("total"))


@query(f"SELECT doc_id, {W} AS words FROM documents")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("words"))


@query("SELECT conv_id, turn, ceil(length(text) / 3.5)::BIGINT AS prose_tokens, ceil(length(text) / 2.0)::BIGINT AS schema_tokens FROM conversations")
def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", token_estimate(F.col("text"), 3.5).alias("prose_tokens"), token_estimate(F.col("text"), 2.0).alias("schema_tokens"))


@query("SELECT sha256(text) AS content_sha256, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents that more than one document has."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", sha256(F.col("text")).alias("content_sha256"))
    return docs.groupBy("content_sha256").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query(f"""
    SELECT lang, min(w) AS low, max(w) FILTER (k = n // 2 + 1) AS upper_median, max(w) AS high
    FROM (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY w) AS k, count(*) OVER (PARTITION BY lang) AS n FROM (SELECT lang, {W} AS w FROM documents)) GROUP BY lang""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle value, the upper one of two, not interpolated. Counted by distinct value, so no group's rows meet in one task."""
    counts = table(spark, sf_dir, "documents").select("lang", word_count(F.col("text")).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    by = Window.partitionBy("lang")
    ranked = counts.withColumn("upto", F.sum("n").over(by.orderBy("w").rowsBetween(Window.unboundedPreceding, 0))).withColumn("half", F.floor(F.sum("n").over(by) / 2) + 1)
    return ranked.groupBy("lang").agg(F.min("w").alias("low"), F.min(F.when(F.col("upto") >= F.col("half"), F.col("w"))).alias("upper_median"), F.max("w").alias("high"))


@query("""
    SELECT 'status' AS dimension, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
    UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'year', year(o_orderdate)::VARCHAR, count(*) FROM orders GROUP BY 2""")
def multi_dim_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent counts by several keys, keys as text, in one pass."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("string").alias("year"))
    names = ["status", "priority", "year"]
    sets = orders.groupingSets([[n] for n in names], *names).agg(F.count("*").alias("n"), *[F.grouping(n).alias(f"g_{n}") for n in names])
    pick = lambda value: F.coalesce(*[F.when(F.col(f"g_{n}") == 0, value(n)) for n in names])
    return sets.select(pick(F.lit).alias("dimension"), pick(F.col).alias("value"), "n")


ALLOWED = ("en", "fr", "de")


@query(f"""
    SELECT reason, count(*) AS n, min(doc_id) AS first_id FROM (
        SELECT doc_id, CASE WHEN coalesce(trim(text), '') = '' THEN 'no_text' WHEN lang NOT IN {ALLOWED} THEN 'lang:' || lang WHEN {W} < {MIN_WORDS} THEN 'too_short' END AS reason FROM documents)
    WHERE reason IS NOT NULL GROUP BY reason""")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First failing rule of each document, with the first document that shows it (the order of equal counts)."""
    text = F.col("text")
    reason = F.coalesce(F.when(F.coalesce(F.trim(text), F.lit("")) == "", "no_text"), F.when(~F.col("lang").isin(*ALLOWED), F.concat(F.lit("lang:"), "lang")), F.when(word_count(text) < MIN_WORDS, "too_short"))
    return table(spark, sf_dir, "documents").select("doc_id", reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


FLOOR = 1997


@query(f"""
    SELECT CASE WHEN year(o_orderdate) < {FLOOR} THEN 'pre-{FLOOR}' ELSE (year(o_orderdate) // 10 * 10)::VARCHAR || 's' END AS decade, count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) AS total,
        count(*) FILTER (o_orderstatus = 'F') / count(*) AS rate FROM orders GROUP BY 1""")
def decade_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(classify.decade(F.year("o_orderdate"), FLOOR).alias("decade"), (F.col("o_orderstatus") == "F").alias("ok"))
    return orders.groupBy("decade").agg(F.count_if("ok").alias("ok"), F.count("*").alias("total")).withColumn("rate", F.col("ok") / F.col("total"))
