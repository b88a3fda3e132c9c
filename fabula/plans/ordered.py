"""Ordered queries over conversations, events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions import arc
from fabula.functions.text import word_count
from fabula.operators import ordered
from fabula.plans.rates import W
from fabula.registry import query
from fabula.sources.tables import table


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", word_count(F.col("text")).alias("w"))


@query(f"""
    WITH x AS (SELECT conv_id, turn, w, sum(w) OVER (PARTITION BY conv_id ORDER BY turn) AS upto, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM (SELECT conv_id, turn, {W} AS w FROM conversations) WHERE w > 0),
    s AS (SELECT *, min(place) FILTER (upto > 400 OR place > 4) OVER (PARTITION BY conv_id) AS stop, min(place) FILTER (upto > 400) OVER (PARTITION BY conv_id) AS over FROM x)
    SELECT conv_id, count(*) AS items, max(upto)::BIGINT AS words, CASE WHEN min(stop) IS NULL THEN NULL WHEN min(over) = min(stop) THEN 'word_cap' ELSE 'count_cap' END AS reason FROM s WHERE stop IS NULL OR place < stop GROUP BY conv_id""")
def capped_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = ordered.capped_prefix(_turns(spark, sf_dir), "conv_id", "turn", "w", 400, 4)
    return x.groupBy("conv_id").agg(F.count("*").alias("items"), F.max("upto").alias("words"), F.first("reason").alias("reason"))


@query(f"""
    SELECT conv_id, s.n::INT AS items, s.words::BIGINT AS words, s.has_full AS has_full FROM (
        SELECT conv_id, list_reduce(list_transform(list(w ORDER BY turn), lambda v: {{'n': 0::BIGINT, 'words': v, 'has_full': false, 'stop': false}}),
            lambda s, v: {{'n': s.n + (NOT s.stop AND s.words + v.words <= CASE WHEN s.has_full THEN 300 ELSE 600 END)::BIGINT,
                'words': s.words + CASE WHEN NOT s.stop AND s.words + v.words <= CASE WHEN s.has_full THEN 300 ELSE 600 END THEN v.words ELSE 0 END,
                'has_full': s.has_full OR v.words >= 60, 'stop': s.stop OR NOT (s.words + v.words <= CASE WHEN s.has_full THEN 300 ELSE 600 END)}},
            {{'n': 0::BIGINT, 'words': 0::BIGINT, 'has_full': false, 'stop': false}}) AS s
        FROM (SELECT conv_id, turn, {W} AS w FROM conversations) GROUP BY conv_id)""")
def lead_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _turns(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "w"))).alias("t"))
    s = c.select("conv_id", ordered.lead_block(F.transform("t", lambda x: x["w"]), 60, 600, 300).alias("s"))
    return s.select("conv_id", F.col("s.n").alias("items"), "s.words", F.col("s.full").alias("has_full"))


_K = "SELECT user_id, event_id, ts, event_type, value, (props::JSON ->> '$.k')::BIGINT AS k FROM events"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))


@query(f"""
    WITH x AS (SELECT user_id, event_id, k // 25 AS season, max(k // 25) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM ({_K}) WHERE event_type = 'view'),
    y AS (SELECT *, min(event_id) FILTER (season < high) OVER (PARTITION BY user_id) AS stop FROM x)
    SELECT user_id, count(*) AS kept, max(season) AS high FROM y WHERE stop IS NULL OR event_id < stop GROUP BY user_id""")
def rising_until_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).where("event_type = 'view'").select("user_id", "event_id", F.floor(F.col("k") / 25).alias("season"))
    return ordered.rising_until_restart(e, "user_id", "event_id", "season").groupBy("user_id").agg(F.count("*").alias("kept"), F.max("season").alias("high"))


@query("""
    SELECT user_id, first, last, n FROM (SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM (
        SELECT user_id, event_id, event_type IN ('error', 'signup') AS f, sum((event_type NOT IN ('error', 'signup'))::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE f GROUP BY user_id, r) WHERE n >= 3""")
def error_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least three transient errors."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return ordered.streaks(e, "user_id", "event_id", F.col("event_type").isin("error", "signup")).where("n >= 3")


@query("""
    SELECT user_id, min(event_id) FILTER (s > 1000 + 1e-9) AS refused, round(coalesce(max(s) FILTER (s <= 1000 + 1e-9), 0), 6) AS spent
    FROM (SELECT user_id, event_id, sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS s FROM events) GROUP BY user_id""")
def budget_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = ordered.budget_stop(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 1000.0)
    return b.withColumn("spent", F.round("spent", 6))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, ordinal, sum(CASE WHEN special THEN 0 WHEN two THEN 2 ELSE 1 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING)::BIGINT AS episode
    FROM (SELECT *, l_quantity = 1 AS special, l_quantity::INT % 2 = 0 AS two, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS ordinal FROM lineitem)""")
def episode_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running numbers: a two-part row counts twice, a special not at all."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    step = F.when(F.col("l_quantity") == 1, 0).when(F.col("l_quantity").cast("int") % 2 == 0, 2).otherwise(1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(w).cast("long").alias("ordinal"), F.sum(step).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("episode"))


_POINTS = """
    SELECT user_id, list(round(p, 2) ORDER BY g) AS pts FROM (
        SELECT user_id, g, least(1.0, greatest(-1.0, round(avg(value), 6) / 60 - 1)) AS p FROM (SELECT user_id, value, ntile(11) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events) GROUP BY user_id, g)
    GROUP BY user_id HAVING count(*) = 11"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven points for each user with enough events: mean values of eleven equal parts, scaled to -1 to 1."""
    e = table(spark, sf_dir, "events").select("user_id", "value", F.ntile(11).over(Window.partitionBy("user_id").orderBy("event_id")).alias("g"))
    p = e.groupBy("user_id", "g").agg(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), arc.half_away(F.avg("value"), 6) / 60 - 1)).alias("p"))
    pts = p.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("g", arc.half_away(F.col("p"), 2).alias("p")))).alias("s"))
    return pts.where(F.size("s") == 11).select("user_id", F.transform("s", lambda x: x["p"]).alias("pts"))


def _moves_sql(k: str) -> str:
    """The fold over a list of points at a threshold of k tenths."""
    big = lambda d: f"round({d}, 6) >= round({k} / 10.0, 6)"
    lo, hi, last = "least(s.lo, v.lo)", "greatest(s.hi, v.lo)", "right(s.legs, 1)"
    up = f"((s.legs = '' AND {big(f'v.lo - {lo}')}) OR ({last} = 'd' AND v.lo >= s.ext AND {big('v.lo - s.ext')}))"
    down = f"(NOT {up} AND ((s.legs = '' AND {big(f'{hi} - v.lo')}) OR ({last} = 'u' AND v.lo <= s.ext AND {big('s.ext - v.lo')})))"
    more = f"(({last} = 'u' AND v.lo > s.ext) OR ({last} = 'd' AND v.lo < s.ext))"
    return f"""list_reduce(list_transform(pts, lambda x: {{'lo': x::DOUBLE, 'hi': x::DOUBLE, 'ext': x::DOUBLE, 'legs': ''}}),
        lambda s, v: {{'lo': {lo}, 'hi': {hi}, 'ext': CASE WHEN {up} OR {down} OR {more} THEN v.lo ELSE s.ext END, 'legs': s.legs || CASE WHEN {up} THEN 'u' WHEN {down} THEN 'd' ELSE '' END}}).legs"""


@query(f"SELECT user_id, {_moves_sql('3')} AS legs FROM ({_POINTS})")
def arc_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("user_id", arc.moves(F.col("pts"), F.lit(arc.FIRST)).alias("legs"))


_LABEL = "CASE legs " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in arc.LABELS.items()) + " END"
_ARCS = f"""
    WITH t AS (SELECT user_id, pts, k, {_moves_sql('k')} AS legs FROM ({_POINTS}), range({arc.FIRST}, {arc.LAST + 1}) AS r(k)),
    h AS (SELECT user_id, arg_min(legs, k) AS legs, min(k)::INT AS tenths, any_value(pts) AS pts FROM t WHERE length(legs) <= 3 OR k = {arc.LAST} GROUP BY user_id),
    a AS (SELECT user_id, pts, tenths, NOT (length(legs) BETWEEN 1 AND 3) AS fallback, tenths >= {arc.REDUCED} AS reduced,
        CASE WHEN length(legs) BETWEEN 1 AND 3 THEN {_LABEL} WHEN round(pts[11] - pts[1], 6) > 0 THEN 'rags_to_riches' ELSE 'riches_to_rags' END AS label FROM h)"""


@query(_ARCS + " SELECT user_id, label, tenths, fallback, reduced FROM a")
def arc_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("user_id", arc.derive(F.col("pts")).alias("a")).select("user_id", "a.*")


@query(_ARCS + f" SELECT user_id, CASE WHEN fallback OR reduced THEN least((50 + user_id % 50) / 100, {arc.CAP}) ELSE (50 + user_id % 50) / 100 END AS confidence FROM a")
def arc_confidence_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = (F.lit(50) + F.col("user_id") % 50) / 100
    return _points(spark, sf_dir).select("user_id", arc.confidence(stated, arc.derive(F.col("pts"))).alias("confidence"))


@query(_ARCS + """,
    p AS (SELECT x.label = y.label AS same, CASE WHEN x.fallback OR y.fallback THEN 'fallback' WHEN x.reduced OR y.reduced THEN 'reduced' ELSE 'unflagged' END AS flag,
        list_sum(list_transform(range(1, 12), lambda i: abs(x.pts[i] - y.pts[i]))) / 11 AS mad FROM a x JOIN a y ON y.user_id = x.user_id + 1)
    SELECT flag, count(*) AS n, count(*) FILTER (same) AS agree, round(avg(mad), 6) AS mad FROM p GROUP BY flag""")
def arc_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring users' arcs as two labellers': agreement and mean distance of points, by the worse flag of the two."""
    a = _points(spark, sf_dir).select("user_id", "pts", arc.derive(F.col("pts")).alias("a"))
    b = a.select((F.col("user_id") - 1).alias("user_id"), F.col("pts").alias("pts2"), F.col("a").alias("b"))
    far = F.aggregate(F.zip_with("pts", "pts2", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / 11
    flag = F.when(F.col("a.fallback") | F.col("b.fallback"), "fallback").when(F.col("a.reduced") | F.col("b.reduced"), "reduced").otherwise("unflagged")
    p = a.join(b, "user_id").select(flag.alias("flag"), (F.col("a.label") == F.col("b.label")).alias("same"), far.alias("mad"))
    return p.groupBy("flag").agg(F.count("*").alias("n"), F.count_if("same").alias("agree"), arc.half_away(F.avg("mad"), 6).alias("mad"))
