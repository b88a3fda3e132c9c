"""Pair files, shared ids, guesses by title."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.plans.sources import folder
from fabula.registry import query
from fabula.sources import pairs
from fabula.sources.tables import table

# A pair file of the parts: some lines break a rule each.
_PAIR = {
    "pair_id": "'P' || CAST(CASE WHEN p_partkey % 50 = 0 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR(20))",
    "expect": "CASE WHEN p_partkey % 11 = 3 THEN 'maybe' WHEN p_partkey % 2 = 0 THEN 'match' ELSE 'no_match' END",
    "title_a": "CASE WHEN p_partkey % 17 = 4 THEN ' ' ELSE p_name END",
    "year_a": "CASE WHEN p_partkey % 13 = 5 THEN '19x0' ELSE CAST(1950 + p_size AS VARCHAR(20)) END",
    "type_a": "CASE WHEN p_size % 9 = 0 THEN 'film' WHEN p_size % 2 = 0 THEN 'movie' ELSE 'tv_series' END",
    "title_b": "p_brand", "year_b": "CAST(1970 + p_size AS VARCHAR(20))", "type_b": "'movie'", "shared_shape": "'a shape, \"quoted\"'",
    "why": "CASE WHEN p_partkey % 19 = 6 THEN '' ELSE 'because' END", "status": "CASE WHEN p_partkey % 23 = 7 THEN 'done' ELSE 'approved' END",
    "qid_a": "CASE WHEN p_partkey % 7 = 0 THEN 'Q0' WHEN p_partkey % 3 = 0 THEN 'Q' || CAST(p_partkey % 4 + 1 AS VARCHAR(20)) ELSE '' END",
    "qid_b": "CASE WHEN p_partkey % 5 = 0 THEN 'Q' || CAST(p_partkey % 2 + 1 AS VARCHAR(20)) ELSE '' END",
}
_PAIR_ROWS = "SELECT p_partkey, " + ", ".join(f"{v} AS {k}" for k, v in _PAIR.items()) + " FROM part"


@query(rf"""
    WITH x AS (SELECT *, row_number() OVER (ORDER BY p_partkey) + 1 AS row, row_number() OVER (PARTITION BY pair_id ORDER BY p_partkey) AS before FROM ({_PAIR_ROWS})),
    y AS (SELECT *, list_filter([CASE WHEN before > 1 THEN 'duplicate' END, CASE WHEN expect NOT IN {pairs.EXPECT} THEN 'expect' END, CASE WHEN status NOT IN {pairs.STATUSES} THEN 'status' END,
        CASE WHEN type_a NOT IN {pairs.TYPES} THEN 'type_a' END, CASE WHEN NOT regexp_full_match(year_a, '[0-9]+') THEN 'year_a' END, CASE WHEN trim(title_a) = '' THEN 'title_a' END,
        CASE WHEN why = '' THEN 'why' END, CASE WHEN qid_a = 'Q0' THEN 'qid_a' END], lambda v: v IS NOT NULL) AS found FROM x),
    pins AS (SELECT row, 0 AS side, title_a AS title, year_a AS yr, type_a AS type, qid_a AS qid FROM y WHERE len(found) = 0 AND qid_a <> ''
        UNION ALL SELECT row, 1, title_b, year_b, type_b, qid_b FROM y WHERE len(found) = 0 AND qid_b <> ''),
    clash AS (SELECT row, list(CASE side WHEN 0 THEN 'pin_a' ELSE 'pin_b' END ORDER BY side) AS clash FROM
        (SELECT *, first_value(qid) OVER (PARTITION BY title, yr, type ORDER BY row, side) AS known FROM pins) WHERE qid <> known GROUP BY row)
    SELECT row, pair_id, array_to_string(list_concat(found, coalesce(clash, [])), ' ') AS problems FROM y LEFT JOIN clash USING (row)""")
def pair_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair file as it is read: all problems of each line."""
    table(spark, sf_dir, "part").createOrReplaceTempView("pair_parts")
    rows = spark.sql(_PAIR_ROWS.replace(" FROM part", " FROM pair_parts"))
    path = folder(spark, "pairs")
    rows.orderBy("p_partkey").select(*pairs.COLUMNS, *pairs.PINS).coalesce(1).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return pairs.load_pairs(spark, path).select("row", "pair_id", F.array_join("problems", " ").alias("problems"))


@query("""
    SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey > first THEN 'same id as ' || first END AS note
    FROM (SELECT s_suppkey, s_nationkey, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS first FROM supplier WHERE s_nationkey IS NOT NULL)""")
def shared_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that resolve to one id: all but the first name the first."""
    s = table(spark, sf_dir, "supplier").where("s_nationkey is not null").select("s_suppkey", "s_nationkey")
    first = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first"))
    return s.join(first, "s_nationkey").select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") > F.col("first"), F.concat(F.lit("same id as "), F.col("first").cast("string"))).alias("note"))


@query("""
    SELECT p_name, count(*) AS items, min(p_partkey) AS guess, count(DISTINCT p_brand) = 1 AS sure FROM part GROUP BY p_name""")
def title_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guess for a title that has no id: the first item of its name, sure where all of them agree."""
    p = table(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("items"), F.min("p_partkey").alias("guess"), (F.min("p_brand") == F.max("p_brand")).alias("sure"))
    return p


@query("""
    SELECT 'total' AS part, '' AS name, count(*) AS n FROM documents UNION ALL SELECT 'seeds', '', count(*) FILTER (l.doc_id IS NOT NULL) FROM documents d LEFT JOIN labels l USING (doc_id)
    UNION ALL SELECT 'double', '', count(*) FILTER (quality = 1 AND toxic = 1) FROM labels
    UNION ALL SELECT 'double by media', CASE WHEN n_chars > 2000 THEN 'tv_series' ELSE 'movie' END, count(*) FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 1 GROUP BY 2
    UNION ALL SELECT 'media', CASE WHEN n_chars > 2000 THEN 'tv_series' ELSE 'movie' END, count(*) FROM documents GROUP BY 2
    UNION ALL SELECT 'region', lang, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'plot', source, count(*) FROM documents GROUP BY 2""")
def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a gold set by several keys, in one pass over its rows."""
    label = table(spark, sf_dir, "labels").select("doc_id", (F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 1), F.lit(False))).alias("double"), F.lit(True).alias("seed"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 2000, "tv_series").otherwise("movie").alias("media"), "lang", "source").join(label, "doc_id", "left")
    entry = lambda part, name: F.struct(F.lit(part).alias("part"), name.alias("name"))
    none, twice = F.lit(""), F.coalesce("double", F.lit(False))
    rows = [entry("total", none), F.when(F.coalesce("seed", F.lit(False)), entry("seeds", none)), F.when(twice, entry("double", none)), F.when(twice, entry("double by media", F.col("media")))]
    rows += [entry("media", F.col("media")), entry("region", F.col("lang")), entry("plot", F.col("source"))]
    got = d.select(F.inline(F.array_compact(F.array(*rows)))).groupBy("part", "name").agg(F.count("*").alias("n"))
    return got


@query("""
    SELECT user_id AS run, round(sum(value), 5) AS usd_total, round(sum(value) / nullif(count(DISTINCT ts::DATE), 0), 5) AS usd_per_title_attempted, round(sum(value) / nullif(count(*) FILTER (event_type = 'purchase'), 0), 5) AS usd_per_record_stored
    FROM (SELECT user_id, ts, event_type, floor(value * 1000) / 1024 AS value FROM events) GROUP BY user_id""")
def cost_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of each run: in all, by title attempted, by record stored; null where there is none. Amounts are binary fractions, so that sums don't depend on the order."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("title"), (F.floor(F.col("value") * 1000) / 1024).alias("usd"), (F.col("event_type") == "purchase").alias("stored"))
    by_title = e.groupBy("user_id", "title").agg(F.sum("usd").alias("usd"), F.count_if("stored").alias("stored"))
    run = by_title.groupBy(F.col("user_id").alias("run")).agg(F.sum("usd").alias("usd"), F.count("title").alias("titles"), F.sum("stored").alias("stored"))
    per = lambda n: F.round(F.col("usd") / F.nullif(F.col(n), F.lit(0)), 5)
    return run.select("run", F.round("usd", 5).alias("usd_total"), per("titles").alias("usd_per_title_attempted"), per("stored").alias("usd_per_record_stored"))
