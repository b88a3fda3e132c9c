"""Queries over records, names and addresses, and the ladder of text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.functions import records as R
from fabula.functions.text import word_count
from fabula.plans.ordered import _ARCS, _points
from fabula.plans.rates import W
from fabula.registry import query
from fabula.sources.tables import table


@query(r"SELECT p_partkey, 'https://en.wikipedia.org/wiki/' || replace(p_name, ' ', '_') || '_(' || p_type || ')' AS url FROM part")
def article_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", R.article_url(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("url"))


@query("""
    SELECT c_custkey, CASE WHEN w THEN coalesce(list_filter(l, lambda x: x NOT IN ('L0', 'L1'))[1], l[1]) ELSE l[1] END AS language
    FROM (SELECT c_custkey, c_custkey % 3 = 0 AS w, list_sort(['L' || c_nationkey % 4, 'L' || c_custkey % 5]) AS l FROM customer)""")
def primary_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = F.array_sort(F.array(F.concat(F.lit("L"), (F.col("c_nationkey") % 4).cast("string")), F.concat(F.lit("L"), (F.col("c_custkey") % 5).cast("string"))))  # noqa: E741
    return table(spark, sf_dir, "customer").select("c_custkey", R.primary_language(l, ("L0", "L1"), F.col("c_custkey") % 3 == 0).alias("language"))


@query(_ARCS + " SELECT user_id, pts AS points, label, CASE WHEN fallback OR reduced THEN least(0.9, 0.49) ELSE 0.9 END::DOUBLE AS confidence FROM a")
def record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as the model's flat fields, and back into a stored record with its derived arc."""
    unsigned = F.transform("pts", lambda x: x + 0.0)  # as SQL's any_value over lists, which makes -0.0 to 0.0
    flat = _points(spark, sf_dir).select("user_id", R.flat_points(unsigned).alias("flat"))
    s = flat.select("user_id", R.stored_arc(R.points_of(F.col("flat")), F.lit(0.9)).alias("a"))
    return s.select("user_id", "a.points", "a.label", "a.confidence")


_RUNGS = f"SELECT conv_id, CASE role WHEN 'system' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS rung, turn, {W} AS w FROM conversations"


@query(f"""
    SELECT conv_id, rung, words, richer FROM (SELECT conv_id, rung, words, row_number() OVER (PARTITION BY conv_id ORDER BY (words < 100)::INT, rung) AS k, max(words) OVER (PARTITION BY conv_id) > words AS richer
        FROM (SELECT conv_id, rung, sum(w)::BIGINT AS words FROM ({_RUNGS}) GROUP BY conv_id, rung)) WHERE k = 1 AND words >= 100""")
def source_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rung with enough words (main article, season articles, episode tables), and whether a later one is richer."""
    rung = F.when(F.col("role") == "system", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    r = table(spark, sf_dir, "conversations").groupBy("conv_id", rung.alias("rung")).agg(F.sum(word_count(F.col("text"))).alias("words"))
    g = r.groupBy("conv_id").agg(F.min(F.when(F.col("words") >= 100, F.struct("rung", "words"))).alias("s"), F.max("words").alias("most"))
    return g.where("s is not null").select("conv_id", "s.rung", "s.words", (F.col("most") > F.col("s.words")).alias("richer"))


# Paragraphs by kind, with {} for a name: text, plot sentences, rule, and remark.
_PARAGRAPHS = (
    ("Anna leaves. Note: the {} was filmed in May.", 1, "note", "Note: the {} was filmed in May."), ("Timeline: the {} is set in 1999. Bob waits.", 0, "timeline", "Timeline: the {} is set in 1999. Bob waits."),
    ("Carol stays. The {} won a BAFTA award. Dan sings.", 1, "award", "The {} won a BAFTA award. Dan sings."), ("Guest star Eve Foe. The {} ends.", 0, "guest_star", "Guest star Eve Foe. The {} ends."),
    ("Gil Hart (in his first appearance of note) runs with a {}.", 1, None, None), ("Music: a theme of the {}. Jo ends it.", 0, "music", "Music: a theme of the {}. Jo ends it."),
    ("Kim Day and Lee Fox also appear as a {}.", 0, "also_appears", "Kim Day and Lee Fox also appear as a {}."), ("Max has a {}. Ned Orr has a small role as a guard.", 1, "small_role", "Ned Orr has a small role as a guard."),
    ("A comedian guest stars as an annoying {}.", 1, None, None), ("Toby Jones guest stars as Captain {}.", 0, "guest_star", "Toby Jones guest stars as Captain {}."),
    ("Dr. Fay and J. R. Doe makes her first appearance by a {}.", 0, "first_appearance", "Dr. Fay and J. R. Doe makes her first appearance by a {}."),
)
_WANTED = ", ".join(f"({k}, {plot}, " + (f"'{rule}', '{remark}')" if rule else "NULL, NULL)") for k, (_, plot, rule, remark) in enumerate(_PARAGRAPHS))


@query(f"SELECT p_partkey, plot, rule, replace(remark, '{{}}', p_name) AS remark FROM part JOIN (VALUES {_WANTED}) AS t(k, plot, rule, remark) ON k = p_partkey % {len(_PARAGRAPHS)}")
def trivia_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of eleven kinds about all parts, split into plot and remark."""
    from fabula.functions.text import sentences

    kind = F.get(F.array(*[F.lit(p[0]) for p in _PARAGRAPHS]), (F.col("p_partkey") % len(_PARAGRAPHS)).cast("int"))
    s = table(spark, sf_dir, "part").select("p_partkey", R.split_trivia(sentences(F.replace(kind, F.lit("{}"), F.col("p_name")))).alias("s"))
    return s.select("p_partkey", F.size("s.plot").alias("plot"), "s.rule", "s.remark")


@query("SELECT p_partkey, 'Q' || p_partkey AS qid, CASE WHEN p_partkey % 3 = 1 THEN 1950 + p_size END AS year FROM part UNION ALL SELECT p_partkey, NULL, 2000 FROM part")
def sparql_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in JSON, one for each part: years that are missing or no numbers, items that are empty."""
    value = lambda c: F.when(c.isNotNull(), F.struct(c.alias("value")))
    year = F.when(F.col("p_partkey") % 3 == 1, (F.lit(1950) + F.col("p_size")).cast("string")).when(F.col("p_partkey") % 3 == 2, "abc")
    item = F.concat(F.lit("http://x/Q"), F.col("p_partkey").cast("string"))
    rows = F.array(F.struct(value(item).alias("item"), value(year).alias("year")), F.struct(value(F.lit("")).alias("item"), value(F.lit("2000")).alias("year")))
    body = F.to_json(F.struct(F.struct(rows.alias("bindings")).alias("results")))
    a = table(spark, sf_dir, "part").select("p_partkey", body.alias("body")).select("p_partkey", F.inline(R.bindings(F.col("body"), "item", "year")))
    return a.select("p_partkey", F.substring_index("item", "/", -1).alias("qid"), F.col("year").try_cast("double").cast("int").alias("year"))


@query("""
    SELECT doc_id, list_filter([CASE WHEN quality = 1 AND c >= 0.7 THEN 'comedy' END, CASE WHEN toxic = 1 AND c >= 0.7 THEN 'tragedy' END], lambda x: x IS NOT NULL) AS terms FROM (SELECT doc_id, quality, toxic, (50 + doc_id % 50) / 100 AS c FROM labels)""")
def present_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms present with enough confidence, out of a map with a judgement for every term."""
    judge = lambda c: F.struct((F.col(c) == 1).alias("present"), ((F.lit(50) + F.col("doc_id") % 50) / 100).alias("confidence"))
    m = F.create_map(F.lit("comedy"), judge("quality"), F.lit("tragedy"), judge("toxic"))
    return table(spark, sf_dir, "labels").select("doc_id", R.present_terms(m, 0.7).alias("terms"))
