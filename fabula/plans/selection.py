"""Selection by quota over the documents: cell = source, genre = language, fame = length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions.text import word_count
from fabula.operators import gold, selection
from fabula.plans.rates import W
from fabula.registry import query
from fabula.sources.tables import table


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("cell"), F.col("lang").alias("genre"), F.col("n_chars").alias("fame"))
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 1").select("doc_id", F.lit(True).alias("must"))
    return d.join(good, "doc_id", "left").select(F.col("doc_id").alias("id"), "cell", "genre", "fame", F.coalesce("must", F.lit(False)).alias("must"))


def _quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 for even source numbers, 7 for odd ones."""
    s = table(spark, sf_dir, "documents").select(F.col("source").alias("cell")).distinct()
    return s.withColumn("quota", F.when(F.regexp_extract("cell", r"(\d+)$", 1).cast("int") % 2 == 0, 10).otherwise(7))


_PICK = """
    WITH i AS (SELECT d.doc_id AS id, d.source AS cell, lang AS genre, n_chars AS fame, coalesce(l.must, false) AS must, CASE WHEN regexp_extract(d.source, '([0-9]+)$', 1)::INT % 2 = 0 THEN 10 ELSE 7 END AS quota
        FROM documents d LEFT JOIN (SELECT doc_id, true AS must FROM labels WHERE quality = 1 AND toxic = 1) l USING (doc_id)),
    a AS (SELECT *, CASE WHEN must THEN row_number() OVER (PARTITION BY cell, must ORDER BY fame DESC, id) END AS m FROM i),
    b AS (SELECT *, coalesce(m <= quota, false) AS forced FROM a),
    c AS (SELECT *, count(*) FILTER (forced) OVER (PARTITION BY cell) AS n, row_number() OVER (PARTITION BY cell, forced ORDER BY fame DESC, id) AS f FROM b),
    d AS (SELECT *, NOT forced AND f <= greatest(0, ceil(quota / 2) - n) AS famous FROM c),
    e AS (SELECT *, count(*) FILTER (forced OR famous) OVER (PARTITION BY cell, genre) AS have, NOT (forced OR famous) AS rest FROM d),
    g AS (SELECT *, have + row_number() OVER (PARTITION BY cell, genre, rest ORDER BY fame DESC, id) - 1 AS turn FROM e),
    h AS (SELECT *, row_number() OVER (PARTITION BY cell, rest ORDER BY turn, fame DESC, id) AS t, quota - n - count(*) FILTER (famous) OVER (PARTITION BY cell) AS more FROM g),
    p AS (SELECT *, CASE WHEN forced THEN 'forced' WHEN famous THEN 'famous' WHEN rest AND t <= more THEN 'even' END AS phase FROM h),
    r AS (SELECT *, CASE WHEN phase IS NULL THEN 'reserve' ELSE 'pilot' END AS role FROM p),
    s AS (SELECT *, row_number() OVER (PARTITION BY cell, role ORDER BY fame DESC, id) AS bucket_rank FROM r)"""


@query(_PICK + " SELECT id, cell, genre, phase, bucket_rank FROM s WHERE role = 'pilot'")
def quota_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.quota_pick(_items(spark, sf_dir), _quotas(spark, sf_dir)).where("role = 'pilot'").select("id", "cell", "genre", "phase", "bucket_rank")


@query(_PICK + " SELECT id, cell, bucket_rank FROM s WHERE role = 'reserve' AND bucket_rank <= ceil(quota * 0.3)")
def reserve_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.quota_pick(_items(spark, sf_dir), _quotas(spark, sf_dir)).where("role = 'reserve'").select("id", "cell", "bucket_rank")


@query("""
    SELECT doc_id, source, turn FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS turn FROM documents)
    ORDER BY turn, source LIMIT 100""")
def round_robin_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    out = selection.round_robin(d, "source", [F.desc("n_chars"), F.col("doc_id")], F.col("source"), 100)
    return out.select("doc_id", "source", F.col("turn").cast("long").alias("turn"))


def _ok(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", (word_count(F.col("text")) >= 150).alias("ok"))
    slots = d.groupBy("source").agg(F.count("*").alias("all")).select("source", (5 + F.col("all") % 7).alias("slots"))
    return d, slots


_OK = f"SELECT doc_id, source, n_chars, {W} >= 150 AS ok, 5 + count(*) OVER (PARTITION BY source) % 7 AS slots FROM documents"


@query(f"SELECT doc_id, source, place FROM (SELECT doc_id, source, slots, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS place FROM ({_OK}) WHERE ok) WHERE place <= slots")
def effective_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, slots = _ok(spark, sf_dir)
    return selection.effective(d, slots, "source", [F.desc("n_chars"), F.col("doc_id")]).select("doc_id", "source", F.col("place").cast("long").alias("place"))


@query(f"""
    SELECT doc_id, source, ok, ok_before FROM (
        SELECT doc_id, source, ok, slots, coalesce(sum(ok::INT) OVER (PARTITION BY source ORDER BY n_chars, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ok_before FROM ({_OK}))
    WHERE ok_before < slots""")
def backfill_until_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, slots = _ok(spark, sf_dir)
    return selection.backfill(d, slots, "source", [F.col("n_chars"), F.col("doc_id")]).select("doc_id", "source", "ok", "ok_before")


@query()
def gold_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balanced gold set from all titles; some forced to be labelled twice."""
    items = _items(spark, sf_dir).join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic"), "id", "left")
    media = F.when(F.col("id") % 4 == 0, "tv_series").otherwise("movie")
    region = F.when(F.col("genre") == "en", "english").otherwise(F.col("genre"))
    rows = items.select("id", F.concat(F.lit("Q"), F.col("id").cast("string")).alias("qid"), media.alias("media_type"), region.alias("region"), F.col("quality").isNotNull().alias("seed"), F.col("cell").alias("plot"), F.col("genre").alias("arc"), "fame")
    pool = gold.choosable(rows, [F.desc("fame"), F.col("id")]).drop("id")
    return gold.select(pool, forced=frozenset({"Q5", "Q17", "Q100"}))


@query("""
    WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS i FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100)
    SELECT doc_id, i, i IN (SELECT k * 100 // 25 FROM range(25) AS t(k)) AS double FROM p""")
def even_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place i * n // k of a ranking of n is labelled twice."""
    top = table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(100)
    top = top.withColumn("i", (F.row_number().over(Window.orderBy(F.desc("n_chars"), "doc_id")) - 1).cast("long"))
    spots = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda k: F.floor(k * 100 / 25))
    return top.select("doc_id", "i", F.array_contains(spots, F.col("i")).alias("double"))
