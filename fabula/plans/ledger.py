"""Run ledger over the events: a user is a title, an event an attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula import vocabulary as V
from fabula.operators import ledger as L
from fabula.registry import query
from fabula.sources.tables import table

_LOG = "SELECT user_id * 100 + day(ts) AS title, event_id, value, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'refused' ELSE 'retry' END AS outcome FROM events"
_TRIED = f"""
    SELECT x.title, x.event_id, x.outcome, x.attempt FROM (SELECT title, event_id, outcome, row_number() OVER (PARTITION BY title ORDER BY event_id) AS attempt,
        max((outcome <> 'retry')::INT) OVER (PARTITION BY title ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ({_LOG})) x
    WHERE x.attempt <= 3 AND coalesce(x.before, 0) = 0"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "refused").otherwise("retry")
    return table(spark, sf_dir, "events").select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("title"), "event_id", "value", outcome.alias("outcome"))


@query(f"SELECT title, event_id, attempt, outcome, least(5 * pow(2, attempt - 1), 120)::INT AS wait FROM ({_TRIED})")
def attempt_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = L.attempts(_log(spark, sf_dir), "title", "event_id")
    return t.select("title", "event_id", F.col("attempt").cast("long").alias("attempt"), "outcome", L.backoff(F.col("attempt")).alias("wait"))


_STATE = f"""
    SELECT title, attempts, CASE WHEN last = 'done' THEN 'record' WHEN last = 'refused' THEN 'failed' WHEN attempts >= 3 THEN 'exhausted' ELSE 'open' END AS state
    FROM (SELECT title, max(attempt) AS attempts, arg_max(outcome, attempt) AS last FROM ({_TRIED}) GROUP BY title)"""


@query(_STATE)
def title_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = L.states(L.attempts(_log(spark, sf_dir), "title", "event_id"), "title")
    return s.select("title", F.col("attempts").cast("long").alias("attempts"), "state")


@query(f"SELECT title FROM ({_STATE}) WHERE state = 'open'")
def unfinished_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return title_state(spark, sf_dir).where("state = 'open'").select("title")


@query("""
    SELECT kind, retry, billed, count(*) AS n FROM (SELECT CASE WHEN c >= 500 OR c = 408 THEN 'transient' WHEN c IN (429, 409) THEN 'transient' WHEN c IN (401, 403, 404) THEN 'fatal' WHEN c >= 400 THEN 'rejected' WHEN c = 0 THEN 'transient' ELSE 'ok' END AS kind,
        c >= 500 OR c IN (408, 429, 409, 0) AS retry, c >= 500 OR c IN (408, 0) OR c BETWEEN 200 AND 299 AS billed
        FROM (SELECT [0, 200, 400, 401, 403, 404, 408, 409, 422, 429, 500, 503, 529][(event_id % 13 + 1)::INT] AS c FROM events)) GROUP BY ALL""")
def api_error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers by class: whether to try again, and whether the call may be billed."""
    codes = (0, 200, 400, 401, 403, 404, 408, 409, 422, 429, 500, 503, 529)
    c = F.element_at(F.array(*map(F.lit, codes)), (F.col("event_id") % 13 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select(c.alias("c"))
    c = F.col("c")
    maybe = (c >= 500) | c.isin(408, 0)
    kind = F.when(maybe | c.isin(429, 409), "transient").when(c.isin(401, 403, 404), "fatal").when(c >= 400, "rejected").otherwise("ok")
    return e.select(kind.alias("kind"), (maybe | c.isin(429, 409)).alias("retry"), (maybe | c.between(200, 299)).alias("billed")).groupBy("kind", "retry", "billed").agg(F.count("*").alias("n"))


@query("""
    SELECT verdict, final, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'refusal' WHEN event_id % 17 = 0 THEN 'wrong_model' WHEN value > 150 THEN 'max_tokens' WHEN event_id % 11 = 0 THEN 'other_stop' WHEN k IS NULL OR k > 95 THEN 'schema' ELSE 'record' END AS verdict,
        event_type = 'error' OR event_id % 17 = 0 OR value > 150 AS final FROM (SELECT *, (props::JSON ->> '$.k')::INT AS k FROM events)) GROUP BY ALL""")
def response_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules on a response; the body is parsed with an explicit schema."""
    k = F.from_json("props", "k int")["k"]
    refusal, wrong, cut = F.col("event_type") == "error", F.col("event_id") % 17 == 0, F.col("value") > 150
    verdict = F.when(refusal, "refusal").when(wrong, "wrong_model").when(cut, "max_tokens").when(F.col("event_id") % 11 == 0, "other_stop").when(k.isNull() | (k > 95), "schema").otherwise("record")
    return table(spark, sf_dir, "events").select(verdict.alias("verdict"), (refusal | wrong | cut).alias("final")).groupBy("verdict", "final").agg(F.count("*").alias("n"))


# Models by kind of event, and their prices.
PRICES = {kind: V.PRICES[model] for kind, model in {"view": "small", "click": "medium", "purchase": "large", "signup": "small", "error": "medium"}.items()}
_PRICES = "(VALUES " + ", ".join(f"('{k}', {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for k, (a, b, c) in PRICES.items()) + ") AS p(event_type, usd_in, usd_out, usd_read)"


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = spark.createDataFrame([(k, *v) for k, v in PRICES.items()], "event_type string, usd_in double, usd_out double, usd_read double")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.floor(F.col("value") * 100).alias("t"), F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.join(F.broadcast(prices), "event_type")  # a row per kind


_COST = "(t * usd_in + k * 100 * usd_out + k * 10 * usd_in * 1.25 + t * 0.5 * usd_read) / 1000000"
_PRICED = f"SELECT *, {_COST} AS cost FROM (SELECT event_id, event_type, user_id, floor(value * 100) AS t, (props::JSON ->> '$.k')::BIGINT AS k FROM events) JOIN {_PRICES} USING (event_type)"


def _cost():
    return L.price(F.col("t"), F.col("k") * 100, F.col("k") * 10, F.col("t") * 0.5, F.col("usd_in"), F.col("usd_out"), F.col("usd_read"))


def _nano(usd):
    """Billionths of a dollar, whole: their sums don't depend on the order."""
    return F.round(usd * 1e9).cast("long")


@query(f"SELECT event_type, count(*) AS n, sum(round(cost * 1e9)::BIGINT)::BIGINT AS nano_usd, sum(round(cost * 0.5 * 1e9)::BIGINT)::BIGINT AS batch_nano_usd FROM ({_PRICED}) GROUP BY event_type")
def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _priced(spark, sf_dir).withColumn("cost", _cost())
    return c.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(_nano(F.col("cost"))).alias("nano_usd"), F.sum(_nano(F.col("cost") * L.BATCH)).alias("batch_nano_usd"))


@query(f"""
    SELECT user_id, (sum(round(cost * 1e9)::BIGINT) FILTER (event_type <> 'error'))::BIGINT AS measured, coalesce(sum(round(cost * 1.25 * 1e9)::BIGINT) FILTER (event_type = 'error'), 0)::BIGINT AS reserved, count(*) AS attempts FROM ({_PRICED}) GROUP BY user_id""")
def cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By title: measured costs, and worst cases held for attempts that may have been billed."""
    c = _priced(spark, sf_dir).withColumn("cost", _cost())
    failed = F.col("event_type") == "error"
    return c.groupBy("user_id").agg(F.sum(F.when(~failed, _nano(F.col("cost")))).alias("measured"), F.coalesce(F.sum(F.when(failed, _nano(F.col("cost") * L.MARGIN))), F.lit(0)).alias("reserved"), F.count("*").alias("attempts"))


@query("""
    SELECT conv_id, round(sum((ceil(ceil(length(text) / 3.5) * 1.25) * 4 * 1.25 + 16000 * 20) / 1000000) * 3, 6) AS worst, sum((ceil(ceil(length(text) / 3.5) * 1.25) * 4 * 1.25 + 16000 * 20) / 1000000) * 3 <= 3.5 AS fits FROM conversations GROUP BY conv_id""")
def worst_case_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All input written to the cache with a margin, the longest output, every attempt; and whether that fits a budget."""
    tokens = F.ceil(F.ceil(F.length("text") / F.lit(3.5)) * L.MARGIN)
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.sum((tokens * 4 * L.CACHE_WRITE + 16000 * 20) / 1_000_000) * L.ATTEMPTS).alias("w"))
    return c.select("conv_id", F.round("w", 6).alias("worst"), (F.col("w") <= 3.5).alias("fits"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R') ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def idempotent_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures are not done; the limit is applied after what is done was skipped."""
    done = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.planned(table(spark, sf_dir, "orders"), done, ["o_orderkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 50).select("o_orderkey")


@query("""
    SELECT CASE WHEN o.o_orderkey IS NULL THEN 'unknown' WHEN r.k IS NULL AND dropped THEN 'dropped' WHEN r.k IS NULL THEN 'missing' WHEN dropped THEN 'late' ELSE 'collected' END AS status, count(*) AS n, coalesce(sum(r.n - 1), 0)::BIGINT AS duplicates
    FROM (SELECT o_orderkey, o_orderstatus = 'P' AS dropped FROM orders) o FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON r.k = o.o_orderkey GROUP BY 1""")
def batch_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests against results: duplicates and unknown ids ignored, missing ones retried, results of dropped titles logged as late."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderstatus") == "P").alias("dropped"))
    r = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    x = o.join(r, "k", "full")
    status = F.when(F.col("dropped").isNull(), "unknown").when(F.col("n").isNull() & F.col("dropped"), "dropped").when(F.col("n").isNull(), "missing").when(F.col("dropped"), "late").otherwise("collected")
    return x.select(status.alias("status"), "n").groupBy("status").agg(F.count("*").alias("m"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")).withColumnRenamed("m", "n")


TTL = {"view": 86_400, "click": 3600, "purchase": None, "signup": 0, "error": 600}


@query("""
    SELECT event_type, count(*) AS n, count(*) FILTER (fresh) AS fresh FROM (SELECT event_type, CASE event_type WHEN 'purchase' THEN true WHEN 'signup' THEN false
        ELSE epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(ts) BETWEEN 0 AND CASE event_type WHEN 'view' THEN 86400 WHEN 'click' THEN 3600 ELSE 600 END END AS fresh FROM events) GROUP BY event_type""")
def cache_ttl_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache entries that may be read at a given time: for ever without a limit, never with a limit of 0, else while young enough."""
    from fabula.sources.cache import is_fresh

    e = table(spark, sf_dir, "events")
    fresh = F.coalesce(*[F.when(F.col("event_type") == k, is_fresh(F.col("ts"), F.lit("2024-01-30 00:00:00").cast("timestamp"), ttl)) for k, ttl in TTL.items()])
    return e.select("event_type", fresh.alias("fresh")).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("fresh").alias("fresh"))


@query("""
    SELECT conv_id, string_agg('<' || role || ' ' || turn || '>' || chr(10) || text, chr(10) ORDER BY turn) AS request, sum(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '')))::BIGINT AS words,
        2 + 3 * count(*) AS blocks FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""")
def request_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request as one text, blocks in fixed places, with the totals that are verified again."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    block = F.concat(F.lit("<"), "role", F.lit(" "), F.col("turn").cast("string"), F.lit(">\n"), "text")
    words = F.size(F.filter(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), lambda x: x != ""))
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))).alias("s"), F.sum(words).alias("words"), (F.lit(2) + F.lit(3) * F.count("*")).alias("blocks"))
    return g.select("conv_id", F.array_join(F.transform("s", lambda x: x["b"]), "\n").alias("request"), "words", "blocks")
