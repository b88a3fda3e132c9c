"""Classification, gates and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions import classify, gates, intervals
from fabula.functions.text import word_count
from fabula.plans.rates import W
from fabula import vocabulary as V
from fabula.registry import query
from fabula.sources.tables import table

# Fixed values for this catalogue's words: groups in order, and words that exclude.
GROUPS = (("fastener", ("bolt", "screw", "nut")), ("ring", ("ring",)), ("machine", ("gear", "widget", "motor")), ("small", ("small", "economy")), ("large", ("large", "promo")))
EXCLUDED = ("promo", "nut", "screw")
_GROUP = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(l, '{w}')" for w in ws) + f" THEN '{n}'" for n, ws in GROUPS) + " ELSE 'other' END"


@query(f"SELECT grp, count(*) AS n, min(p_partkey) AS first_key FROM (SELECT p_partkey, {_GROUP} AS grp FROM (SELECT p_partkey, lower(p_type) || '|' || lower(p_name) AS l FROM part)) GROUP BY grp")
def coarse_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", classify.first_group(F.array("p_type", "p_name"), GROUPS).alias("grp"))
    return p.groupBy("grp").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_key"))


@query(f"""
    SELECT reason, count(*) AS n, min(p_partkey) AS first_key FROM (
        SELECT p_partkey, CASE WHEN p_partkey % 97 = 13 THEN 'listed' {' '.join(f"WHEN contains(lower(p_type) || ' | ' || lower(p_name), '{w}') THEN 'genre:{w}'" for w in EXCLUDED)}
            WHEN p_size > 48 THEN 'no_article' WHEN p_size = 0 THEN 'no_year' WHEN p_partkey % 10 = 3 THEN 'id_ambiguous' WHEN p_partkey % 11 = 0 THEN 'no_id' END AS reason FROM part)
    WHERE reason IS NOT NULL GROUP BY reason""")
def exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that excludes an item: listed, a word among its labels, no article, no year, an id that is ambiguous or missing."""
    labels = F.concat_ws(" | ", F.lower("p_type"), F.lower("p_name"))
    key, size = F.col("p_partkey"), F.col("p_size")
    rest = [("no_article", size > 48), ("no_year", size == 0), ("id_ambiguous", key % 10 == 3), ("no_id", key % 11 == 0)]
    reason = F.coalesce(classify.first_reason([("listed", key % 97 == 13)]), classify.first_word(labels, EXCLUDED, "genre:"), classify.first_reason(rest))
    p = table(spark, sf_dir, "part").select("p_partkey", reason.alias("reason")).where("reason is not null")
    return p.groupBy("reason").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_key"))


NAMES = {"L0": "english", "L1": "hindi", "L2": "tamil", "L3": "korean", "L4": "japanese"}
HOME = {"english": ("C0", "C1", "C2"), "hindi": ("C3", "C5"), "tamil": ("C3",), "korean": ("C4",), "japanese": ("C6", "C7")}
ORDER = ("tamil", "hindi", "korean", "japanese")


def _home_sql(n: str) -> str:
    return "CASE " + " ".join(f"WHEN {n} = '{k}' THEN list_has_any(countries, {list(v)})" for k, v in HOME.items()) + " ELSE false END"


@query(f"""
    WITH i AS (
        SELECT c_custkey, c_custkey % 2 = 0 AS tv, CASE c_custkey % 5 WHEN 0 THEN [] WHEN 1 THEN ['L' || c_nationkey % 5] ELSE ['L' || c_nationkey % 7, 'L' || c_custkey % 6] END AS languages,
            CASE c_custkey % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['C' || c_nationkey % 8] ELSE ['C' || c_nationkey % 8, 'C' || c_custkey % 8] END AS countries FROM customer),
    n AS (SELECT *, list_filter(list_transform({list(NAMES)}, lambda k: CASE WHEN list_contains(languages, k) THEN map({list(NAMES)}, {list(NAMES.values())})[k] END), lambda x: x IS NOT NULL) AS named,
            len(list_filter(languages, lambda x: NOT list_contains({list(NAMES)}, x))) > 0 AS other FROM i),
    h AS (SELECT *, list_filter(named, lambda x: {_home_sql('x')}) AS home FROM n),
    r AS (SELECT *, CASE WHEN len(languages) = 0 THEN (CASE WHEN list_contains(countries, 'C3') AND tv THEN ['hindi', 'no_language_country_only'] ELSE [NULL, 'no_language'] END)
            WHEN len(named) = 0 THEN [NULL, 'no_named_language'] WHEN len(named) = 1 AND NOT other THEN [named[1], 'only_language'] WHEN len(home) = 1 THEN [home[1], 'country_of_origin']
            WHEN list_contains(home, 'english') THEN ['english', 'co_production_english'] WHEN len(home) > 0 THEN [list_filter({list(ORDER)}, lambda x: list_contains(home, x))[1], 'country_of_origin_fixed_order']
            WHEN len(countries) > 0 THEN [NULL, 'no_language_matches_country'] WHEN list_contains(named, 'english') THEN ['english', 'no_country_english_listed']
            ELSE [list_filter({list(ORDER)}, lambda x: list_contains(named, x))[1], 'no_country_fixed_order'] END AS r FROM h)
    SELECT r[1] AS language, r[2] AS basis, coalesce(CASE WHEN c_custkey % 331 = 7 THEN 'film:override' END, (CASE WHEN tv THEN 'tv:' ELSE 'film:' END) || coalesce(r[1], 'world')) AS bucket, count(*) AS n FROM r
    JOIN (SELECT c_custkey FROM customer) USING (c_custkey) GROUP BY 1, 2, 3""")
def language_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by deciding language, rule and bucket; a small table overrides some."""
    c = table(spark, sf_dir, "customer")
    name = lambda p, k, m: F.concat(F.lit(p), (F.col(k) % m).cast("string"))
    none = F.array().cast("array<string>")
    kind = F.col("c_custkey") % 5
    languages = F.when(kind == 0, none).when(kind == 1, F.array(name("L", "c_nationkey", 5))).otherwise(F.array(name("L", "c_nationkey", 7), name("L", "c_custkey", 6)))
    place = F.col("c_custkey") % 3
    countries = F.when(place == 0, none).when(place == 1, F.array(name("C", "c_nationkey", 8))).otherwise(F.array(name("C", "c_nationkey", 8), name("C", "c_custkey", 8)))
    items = c.select("c_custkey", (F.col("c_custkey") % 2 == 0).alias("tv"), languages.alias("languages"), countries.alias("countries"))
    items = items.withColumn("r", classify.language_basis(F.col("languages"), F.col("countries"), F.col("tv"), NAMES, HOME, ORDER, ("C3", "hindi")))
    override = c.where(F.col("c_custkey") % 331 == 7).select("c_custkey", F.lit("film:override").alias("forced"))
    bucket = F.coalesce("forced", F.concat(F.when(F.col("tv"), "tv:").otherwise("film:"), F.coalesce("r.language", F.lit("world"))))
    return items.join(override, "c_custkey", "left").groupBy(F.col("r.language").alias("language"), F.col("r.basis").alias("basis"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("""
    SELECT status, basis, count(*) AS n FROM (
        SELECT CASE WHEN tv THEN (CASE WHEN e AND o THEN 'unknown' WHEN e THEN 'ended' WHEN o THEN 'ongoing' ELSE 'unknown' END) END AS status,
            CASE WHEN tv THEN (CASE WHEN e AND o THEN 'conflict' WHEN e THEN 'P582' WHEN o THEN 'P582_novalue' ELSE 'none' END) END AS basis
        FROM (SELECT o_orderpriority <> '5-LOW' AS tv, o_orderstatus = 'F' AND o_orderkey % 3 > 0 AS e, o_orderkey % 5 = 0 AS o FROM orders)) GROUP BY 1, 2""")
def series_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 > 0), F.year("o_orderdate"))
    s = classify.series_status(F.col("o_orderpriority") != "5-LOW", end, F.col("o_orderkey") % 5 == 0)
    return table(spark, sf_dir, "orders").select(s.alias("s")).groupBy("s.status", "s.basis").agg(F.count("*").alias("n"))


@query("""
    SELECT p_brand, CASE WHEN len(ids) = 1 THEN ids[1] END AS id, len(ids) > 1 AS ambiguous FROM (
        SELECT p_brand, list_sort(list_distinct(list_filter(list_transform(v, lambda x: try_cast(floor(try_cast(x AS DOUBLE)) AS BIGINT)), lambda x: x > 0))) AS ids
        FROM (SELECT p_brand, list(CASE WHEN p_size = 17 THEN (p_partkey % 3)::VARCHAR || '.0' WHEN p_size = 18 THEN 'x' ELSE '0' END) AS v FROM part GROUP BY p_brand))""")
def single_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one positive id among a brand's values, or null; and whether there are several."""
    value = F.when(F.col("p_size") == 17, F.concat((F.col("p_partkey") % 3).cast("string"), F.lit(".0"))).when(F.col("p_size") == 18, "x").otherwise("0")
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set(value).alias("v"))
    return brands.select("p_brand", classify.single_id(F.col("v")).alias("s")).select("p_brand", "s.id", "s.ambiguous")


@query("SELECT license, count(*) AS n FROM (SELECT CASE WHEN strftime(ts - INTERVAL 200 DAY, '%Y-%m-%dT%H:%M:%SZ') >= '2023-06-29T00:00:00Z' THEN 'CC-BY-SA-4.0' ELSE 'CC-BY-SA-3.0' END AS license FROM events) GROUP BY license")
def license_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format(F.expr("ts - INTERVAL 200 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "events").select(classify.license_for(stamp).alias("license")).groupBy("license").agg(F.count("*").alias("n"))


@query("""
    SELECT event_id, major < 1 OR (major = 1 AND minor < 4) OR event_type = 'error' AS stale FROM (
        SELECT event_id, event_type, k // 50 AS major, k % 10 AS minor FROM (SELECT event_id, event_type, (props::JSON ->> '$.k')::BIGINT AS k FROM events))""")
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a record is fetched again: an old version, compared part by part, or an error."""
    k = F.get_json_object("props", "$.k").cast("long")
    v = F.concat_ws(".", F.floor(k / 50).cast("string"), (k % 10).cast("string"), F.lit("0"))
    e = table(spark, sf_dir, "events").withColumn("v", v)
    return e.select("event_id", ((classify.version(F.col("v")) < classify.version(F.lit("1.4.0"))) | (F.col("event_type") == "error")).alias("stale"))


@query(f"""
    SELECT reason, count(*) AS n, min(page_id) AS first_page FROM (
        SELECT page_id, CASE WHEN NOT starts_with(url, 'https://') THEN 'scheme' WHEN regexp_matches(url, '^https://[^/]*pills') THEN 'host' WHEN contains(url, '?') THEN 'query' WHEN contains(url, '#') THEN 'fragment'
            WHEN title = '' THEN 'no_title' WHEN lower(regexp_extract(title, '^([^:]*):', 1)) IN {gates.NAMESPACES} THEN 'namespace:' || lower(regexp_extract(title, '^([^:]*):', 1)) ELSE 'ok' END AS reason
        FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*/[^/?#]*/([^?#]*)', 1) AS title FROM (
            SELECT page_id, CASE WHEN page_id % 9 = 0 THEN replace(url, '/en/', '/en/Talk:') ELSE url END AS url FROM pages))) GROUP BY reason""")
def url_title_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("page_id") % 9 == 0, F.replace("url", F.lit("/en/"), F.lit("/en/Talk:"))).otherwise(F.col("url"))
    p = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    p = p.select("page_id", F.coalesce(gates.url_reason(F.col("url"), ~F.col("url").rlike("^https://[^/]*pills")), F.lit("ok")).alias("reason"))
    return p.groupBy("reason").agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


_GATE = f"CASE WHEN source = 'src3' THEN 'license' WHEN text IS NULL OR text = '' THEN 'no_text' WHEN n_chars <> length(text) THEN 'length' WHEN {W} < 150 THEN 'too_short' WHEN {W} > 3000 THEN 'over_limit' END"


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fail-closed chain: license, text, stored length, fewest and most words."""
    text, words = F.col("text"), word_count(F.col("text"))
    chain = [("license", F.col("source") == "src3"), ("no_text", text.isNull() | (text == "")), ("length", F.col("n_chars") != F.length("text")), ("too_short", words < 150), ("over_limit", words > 3000)]
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", classify.first_reason(chain).alias("reason"))


@query(f"SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM (SELECT {_GATE} AS reason FROM documents) GROUP BY 1")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""
    SELECT source, count(*) AS labelled, count(*) FILTER (reason IS NULL AND quality = 1) AS usable, count(*) FILTER (reason IS NULL AND quality = 1) / count(*) AS rate
    FROM (SELECT doc_id, source, {_GATE} AS reason FROM documents) JOIN labels USING (doc_id) GROUP BY source""")
def annotatable_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _gated(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy("source").agg(F.count("*").alias("labelled"), F.count_if(F.expr("reason is null and quality = 1")).alias("usable")).withColumn("rate", F.col("usable") / F.col("labelled"))


_TURNS = "SELECT conv_id, list_sort(list(turn + 1) FILTER (turn % 4 <> 2)) AS t, max(turn) + 1 AS stated FROM conversations GROUP BY conv_id"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("turn") % 4 != 2, F.col("turn") + 1))).alias("t"), (F.max("turn") + 1).alias("stated"))
    return c.where(F.size("t") > 0)


@query(f"SELECT conv_id, list_sort(list_distinct(t)) = t AS rising, list_max(t) <= stated AS in_range, len(t) = stated AS complete FROM ({_TURNS}) WHERE len(t) > 0")
def coverage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("conv_id", gates.rising(F.col("t")).alias("rising"), (F.array_max("t") <= F.col("stated")).alias("in_range"), (F.size("t") == F.col("stated")).alias("complete"))


@query(f"SELECT conv_id, whole, t <> range(1, whole + 1) AS partial FROM (SELECT conv_id, t, CASE WHEN s >= list_max(t) THEN s ELSE list_max(t) END AS whole FROM (SELECT conv_id, t, stated - conv_id % 3 AS s FROM ({_TURNS}) WHERE len(t) > 0))")
def coverage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total: as stated, unless more was seen; partial where a number is missing."""
    c = _turns(spark, sf_dir).select("conv_id", "t", intervals.total(F.col("stated") - F.col("conv_id") % 3, F.col("t")).alias("whole"))
    return c.select("conv_id", "whole", intervals.is_partial(F.col("t"), F.col("whole")).alias("partial"))


_ISLANDS = """
    SELECT l_orderkey, count(*) AS parts, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '–' || hi END, '|' ORDER BY lo) AS runs, sum(hi - lo + 1)::BIGINT AS n
    FROM (SELECT l_orderkey, min(k) AS lo, max(k) AS hi FROM (SELECT l_orderkey, k, k - row_number() OVER (PARTITION BY l_orderkey ORDER BY k) AS g FROM (SELECT DISTINCT l_orderkey, l_linenumber AS k FROM lineitem)) GROUP BY l_orderkey, g) GROUP BY l_orderkey"""


def _islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and islands by a window: a number less its place is the same along a run."""
    k = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("k")).distinct()
    g = k.withColumn("g", F.col("k") - F.row_number().over(Window.partitionBy("l_orderkey").orderBy("k")))
    return g.groupBy("l_orderkey", "g").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))


@query(_ISLANDS)
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _islands(spark, sf_dir).groupBy("l_orderkey").agg(F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("r"))
    text = F.transform("r", lambda x: F.when(x["lo"] == x["hi"], x["lo"].cast("string")).otherwise(F.concat(x["lo"].cast("string"), F.lit("–"), x["hi"].cast("string"))))
    n = F.aggregate("r", F.lit(0).cast("long"), lambda s, x: s + x["hi"] - x["lo"] + 1)
    return r.select("l_orderkey", "parts", F.array_join(text, "|").alias("runs"), n.alias("n"))


@query(f"""
    SELECT l_orderkey, CASE WHEN n = 1 THEN 'season ' ELSE 'seasons ' END || CASE WHEN parts = 1 THEN runs ELSE regexp_replace(replace(runs, '|', ', '), ', ([^,]*)$', ' and \\1') END AS sentence
    FROM ({_ISLANDS})""")
def coverage_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of an order as words."""
    k = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_linenumber").cast("long"))).alias("k"))
    return k.select("l_orderkey", intervals.listed(F.col("k"), "season").alias("sentence"))


@query("""
    SELECT o_orderkey, list_filter([CASE WHEN n IS NULL THEN 'no_lines' END, CASE WHEN o_totalprice < 0 THEN 'negative' END, CASE WHEN n > 7 THEN 'too_many' END, CASE WHEN twice THEN 'line_twice' END,
        CASE WHEN early THEN 'shipped_before_order' END], lambda x: x IS NOT NULL) AS errors
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) > count(DISTINCT l_linenumber) AS twice, min(l_shipdate) AS low FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey,
        LATERAL (SELECT low < o_orderdate AS early)""")
def record_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All errors of a record; none is an empty list."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), (F.count("*") > F.count_distinct("l_linenumber")).alias("twice"), F.min("l_shipdate").alias("low"))  # noqa: E741
    o = table(spark, sf_dir, "orders").join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rules = [("no_lines", F.col("n").isNull()), ("negative", F.col("o_totalprice") < 0), ("too_many", F.col("n") > 7), ("line_twice", F.col("twice")), ("shipped_before_order", F.col("low") < F.col("o_orderdate"))]
    return o.select("o_orderkey", gates.reasons(rules).alias("errors"))


_STAMPS = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%SZ') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 4 THEN strftime(ts, '%Y-13-%dT%H:%M:%SZ') END AS stamp FROM events"


@query(rf"SELECT event_id, stamp, coalesce(regexp_full_match(stamp, '{gates.RFC3339[1:-1]}'), false) AS ok FROM ({_STAMPS})")
def rfc3339_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = lambda p: F.date_format("ts", p)
    k = F.col("event_id") % 6
    stamp = F.when(k == 0, form("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, form("yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(k == 2, form("yyyy-MM-dd HH:mm:ss'Z'")).when(k == 3, form("yyyy-MM-dd'T'HH:mm:ss")).when(k == 4, form("yyyy-'13'-dd'T'HH:mm:ss'Z'"))
    e = table(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"))
    return e.select("event_id", "stamp", gates.is_rfc3339(F.col("stamp")).alias("ok"))


#: Turns of a conversation stand for the headings of a series, by role and turn.
_HEADINGS = list(V.SERIES_HEADINGS)
_AS_HEADING = f"{_HEADINGS}[(turn * 5 + length(role)) % {len(_HEADINGS) + 3} + 1]"


@query(f"""
    SELECT conv_id, heading, turn, row_number() OVER (PARTITION BY conv_id ORDER BY list_position({_HEADINGS}, heading)) AS place
    FROM (SELECT conv_id, heading, min(turn) AS turn FROM (SELECT conv_id, turn, {_AS_HEADING} AS heading FROM conversations) WHERE heading IS NOT NULL GROUP BY conv_id, heading)""")
def heading_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrence of each heading, in order of priority rather than of place."""
    known = F.array(*map(F.lit, _HEADINGS))
    heading = F.get(known, ((F.col("turn") * 5 + F.length("role")) % (len(_HEADINGS) + 3)).cast("int"))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", heading.alias("heading")).where("heading is not null").groupBy("conv_id", "heading").agg(F.min("turn").alias("turn"))
    priority = F.array_position(known, F.col("heading"))
    return c.select("conv_id", "heading", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy(priority)).cast("long").alias("place"))


@query(f"""
    SELECT conv_id, min(turn) FILTER (w >= 150) AS first_ok, arg_max(turn, (w, -turn)) AS longest, max(w) AS most, coalesce(min(turn) FILTER (w >= 150), arg_max(turn, (w, -turn))) AS chosen
    FROM (SELECT conv_id, turn, {W} AS w FROM conversations) GROUP BY conv_id""")
def first_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first section of enough words; else the longest, the earlier on a tie."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", word_count(F.col("text")).alias("w"))
    longest = F.max_by("turn", F.struct(F.col("w"), -F.col("turn")))
    c = c.groupBy("conv_id").agg(F.min(F.when(F.col("w") >= 150, F.col("turn"))).alias("first_ok"), longest.alias("longest"), F.max("w").alias("most"))
    return c.withColumn("chosen", F.coalesce("first_ok", "longest"))
