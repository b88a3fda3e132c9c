"""Mixing sources to target weights by temperature.

A source's share p of all tokens becomes a weight proportional to p ** a. The exponent a is
bisected: at 1 the sources keep their shares, at 0 all weigh alike; it is the largest that
reaches a target entropy, or, if that would repeat some source too often, the smallest that
keeps the repetition limit. The target is set by the effective number of sources, the exponential of
the entropy: it is to be SPREAD of their number. The budget is the least that
spends every source at least once: the source that is rarest against its weight is read
once, each other one w / p times as often in proportion.

The budget is then realised as block permutations. A source's documents are read in epochs,
each in an order of its own (by a digest of document and epoch); whole epochs come first, and of
the last one what the budget still holds. A document's place is its running token count over
its source's budget, and its block that place times the number of blocks, so each block
holds every source at about its weight. Inside a block all sources are shuffled together: a
row's position is its rank by a second digest.

All of it is DataFrame expressions; the bisection is a fold over the numbers of tokens that sources have,
each once with the number of such sources, and three numbers of it come back. Tokens are counted once,
into a table of a small row for each document; equal rows are one with a count. Running
counts of a large source are taken in ranges of digests: sums by range first, then within.

Null texts have no tokens, null sources are a source of their own. Documents without tokens
come with the first epoch, and a table without tokens comes back as it is, in block 0. Documents
without doc_id are told apart by their text. Repeated rows are documents of their own, one after the
other in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabula.llm.scratch import written

#: Steps of the bisection; fewest blocks; the largest number of epochs of a source; effective number of sources as a part of their number.
STEPS, BLOCKS, REPEATS, SPREAD = 50, 64, 2.0, 0.98
#: Tokens of a digest range, and of a block where there are more than BLOCKS, about.
RANGE_TOKENS, BLOCK_TOKENS = 1 << 20, 1 << 22
TOKEN = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Stretches without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _total(s: Column, of) -> Column:
    """The sum of ``of(x)`` over all sources; s: x and the number k of sources that have it."""
    return F.aggregate(s, F.lit(0.0), lambda acc, y: acc + y["k"] * of(y["x"]))


def _entropy(p: Column, a: Column) -> Column:
    """The entropy of the weights that shares p give at exponent a."""
    z = _total(p, lambda x: F.pow(x, a))
    scaled = F.transform(p, lambda y: F.struct((F.pow(y["x"], a) / z).alias("x"), y["k"].alias("k")))
    return -_total(scaled, lambda w: w * F.log(w))


def temperature(sources: DataFrame, spread: float = SPREAD, repeats: float = REPEATS) -> tuple[float, float, float]:
    """sources: source, n_tokens. The exponent, the sum of all n_tokens ** exponent, and the tokens to spend for one of that sum.

    What is folded is sorted by tokens, so sums have one order."""
    sizes = sources.where("n_tokens > 0").groupBy(F.col("n_tokens").cast("double").alias("x")).agg(F.count("*").cast("double").alias("k"))
    one = sizes.agg(F.array_sort(F.collect_list(F.struct("x", "k"))).alias("s"))
    one = one.withColumn("p", F.transform("s", lambda y: F.struct((y["x"] / _total(F.col("s"), lambda x: x)).alias("x"), y["k"].alias("k"))))
    p, xs = F.col("p"), F.transform("p", lambda y: y["x"])

    def bisect(go_up) -> Column:
        """The last low and high end of an interval that began as 0 to 1."""

        def step(s: Column, _: Column) -> Column:
            mid = (s["low"] + s["high"]) / 2
            up = go_up(mid)
            return F.struct(F.when(up, mid).otherwise(s["low"]).alias("low"), F.when(up, s["high"]).otherwise(mid).alias("high"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), step)

    reach = F.log(F.lit(spread) * F.aggregate("p", F.lit(0.0), lambda acc, y: acc + y["k"]))
    for_entropy = F.when(_entropy(p, F.lit(1.0)) >= reach, F.lit(1.0)).otherwise(bisect(lambda a: _entropy(p, a) >= reach)["low"])
    # epochs of the smallest source at exponent a, when the largest is read once
    most = lambda a: F.pow(F.array_max(xs) / F.array_min(xs), 1 - a)
    for_repeats = F.when(most(F.lit(0.0)) <= repeats, F.lit(0.0)).otherwise(bisect(lambda a: most(a) > repeats)["high"])
    one = one.where(F.size("s") > 0).withColumn("a", F.greatest(for_entropy, for_repeats))
    one = one.withColumn("total", _total(F.col("s"), lambda x: F.pow(x, F.col("a")))).withColumn("scale", F.array_max(F.transform("s", lambda y: y["x"] / F.pow(y["x"], F.col("a")))))
    row = one.select("a", "total", "scale").first()
    return tuple(row) if row else (1.0, 1.0, 1.0)


def plan(sources: DataFrame, spread: float = SPREAD, repeats: float = REPEATS) -> DataFrame:
    """sources: source, n_tokens. Adds weight and budget (tokens to spend, a whole number); sources without tokens get 0 of both."""
    a, total, scale = temperature(sources, spread, repeats)
    n = F.coalesce("n_tokens", F.lit(0)).cast("long")
    raw, some = F.pow(n.cast("double"), F.lit(a)), n > 0
    return sources.select(
        "source", n.alias("n_tokens"), F.lit(a).alias("a"), F.when(some, raw / F.lit(total)).otherwise(0.0).alias("weight"),
        F.when(some, F.greatest(n, F.floor(raw * F.lit(scale) + 0.5))).otherwise(F.lit(0)).cast("long").alias("budget"),
    )


def _placed(docs: DataFrame, spread: float, repeats: float, blocks: int, *ids: str) -> DataFrame:
    """docs: doc_id, text, source and what else tells rows apart. One row per document and epoch in which it is read, with its block and position in it."""
    t = docs.select("doc_id", "source", tokens(F.col("text")).alias("n_tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("key"), *ids)
    t = written(t.groupBy("doc_id", "source", "n_tokens", "key", *ids).agg(F.count("*").cast("int").alias("copies")), "tokens")
    all_of = F.col("n_tokens") * F.col("copies")
    budget = written(plan(t.groupBy("source").agg(F.sum(all_of).alias("n_tokens")), spread, repeats), "budget")
    blocks = max(blocks, -(-(budget.agg(F.sum("budget")).first()[0] or 0) // BLOCK_TOKENS))
    whole = F.when(F.col("all_tokens") > 0, F.floor(F.col("budget") / F.col("all_tokens"))).otherwise(1)
    budget = budget.select(F.col("source").alias("s"), F.col("n_tokens").alias("all_tokens"), "budget")
    budget = budget.withColumn("whole", whole.cast("int")).withColumn("ranges", F.ceil((F.col("all_tokens") + 1) / RANGE_TOKENS).cast("long"))
    # a row per epoch, with its digest and range
    x = t.join(budget, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    last = F.col("whole") - F.when((F.col("n_tokens") == 0) | (F.col("budget") <= F.col("whole") * F.col("all_tokens")), 1).otherwise(0)
    x = x.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.when(F.col("n_tokens") == 0, 0).otherwise(last))))
    x = x.withColumn("digest", F.md5(F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), "key"), "epoch")))
    x = x.withColumn("range", F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.col("ranges"), 32))
    ranges = x.groupBy("source", "epoch", "range").agg(F.sum(all_of).alias("n"))
    before = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = x.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("range") == F.col("r")))
    inside = Window.partitionBy("source", "epoch", "range").orderBy("digest", "doc_id", "n_tokens", "key", *ids).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.col("epoch") * F.col("all_tokens") + F.col("before") + F.coalesce(F.sum(all_of).over(inside), F.lit(0)))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).withColumn("place", F.col("place") + F.col("copy") * F.col("n_tokens"))
    rows = rows.where((F.col("n_tokens") == 0) | (F.col("place") < F.col("budget")))
    block = F.when(F.col("budget") > 0, F.least(F.lit(blocks - 1), F.floor(F.col("place").cast("double") * F.lit(float(blocks)) / F.col("budget")))).otherwise(0)
    rows = rows.withColumn("block", block.cast("int")).withColumn("shuffled", F.md5(F.concat("digest", F.lit("#"))))
    position = F.row_number().over(Window.partitionBy("block").orderBy("shuffled", "source", "doc_id", "n_tokens", "key", *ids, "copy")) - 1
    return rows.select("doc_id", "source", "epoch", "n_tokens", "block", position.alias("position"), *ids)


def mixed(docs: DataFrame, spread: float = SPREAD, repeats: float = REPEATS, blocks: int = BLOCKS) -> DataFrame:
    """docs: doc_id, text, source. One row per document and epoch in which it is read: doc_id, source, epoch (from 0), n_tokens, block, position in the block (from 0)."""
    return _placed(docs.select("doc_id", "text", "source"), spread, repeats, blocks)


def remixed(docs: DataFrame, spread: float = SPREAD, repeats: float = REPEATS) -> DataFrame:
    """docs with all its columns, each row as often as the budget reads it. A partition holds whole blocks, one after another, in the order of their positions."""
    names = {f"c{k}": c for k, c in enumerate(docs.columns)}
    plain = docs.select([F.col(c).alias(k) for k, c in names.items()])
    digest = [F.coalesce(F.md5(F.col(k).cast("string").cast("binary")), F.lit("-")) for k in names]
    plain = plain.withColumn("row", F.md5(F.concat_ws(" ", *digest)))
    at = {c: F.col(k) for k, c in names.items()}
    keys = _placed(plain.select(at["doc_id"].alias("doc_id"), at["text"].alias("text"), at["source"].alias("source"), "row"), spread, repeats, BLOCKS, "row")
    # equal rows are one here, so the join repeats none that the budget doesn't
    out = keys.select("row", "block", "position").join(plain.dropDuplicates(["row"]), "row")
    return out.repartition("block").sortWithinPartitions("block", "position").select([F.col(k).alias(c) for k, c in names.items()])


def op7_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens, md5(coalesce(text, '')) AS key FROM documents),
sums AS (SELECT source, sum(n_tokens)::BIGINT AS all_tokens FROM t GROUP BY source),
sizes AS (SELECT all_tokens::DOUBLE AS x, count(*)::DOUBLE AS k FROM sums WHERE all_tokens > 0 GROUP BY all_tokens),
one AS (SELECT list(x ORDER BY x) AS x, list(k ORDER BY x) AS k, range(1, count(*) + 1) AS every FROM sizes),
shares AS (SELECT x, k, every, list_transform(x, lambda v: v / list_reduce(list_transform(every, lambda i: k[i] * x[i]), lambda s, y: s + y, 0.0::DOUBLE)) AS p FROM one),
ends AS (
    SELECT x, k, p, every, ln({SPREAD}::DOUBLE * list_reduce(k, lambda s, y: s + y, 0.0::DOUBLE)) AS reach,
        -list_reduce(list_transform(every, lambda i: k[i] * (p[i] * ln(p[i]))), lambda s, y: s + y, 0.0::DOUBLE) AS h, list_max(p) / list_min(p) AS ratio FROM shares),
bisected AS (
    WITH RECURSIVE b AS (
        SELECT 0 AS step, 0.0::DOUBLE AS e_low, 1.0::DOUBLE AS e_high, 0.0::DOUBLE AS r_low, 1.0::DOUBLE AS r_high
        UNION ALL
        SELECT step + 1, CASE WHEN up THEN e_mid ELSE e_low END, CASE WHEN up THEN e_high ELSE e_mid END, CASE WHEN more THEN r_mid ELSE r_low END, CASE WHEN more THEN r_high ELSE r_mid END
        FROM (
            SELECT step, e_low, e_high, r_low, r_high, e_mid, r_mid, pow(ratio, 1 - r_mid) > {REPEATS} AS more,
                -list_reduce(list_transform(every, lambda i: k[i] * (w[i] / z * ln(w[i] / z))), lambda s, y: s + y, 0.0::DOUBLE) >= reach AS up
            FROM (
                SELECT *, list_reduce(list_transform(every, lambda i: k[i] * w[i]), lambda s, y: s + y, 0.0::DOUBLE) AS z
                FROM (
                    SELECT b.*, (e_low + e_high) / 2 AS e_mid, (r_low + r_high) / 2 AS r_mid, ratio, reach, k, every, list_transform(p, lambda v: pow(v, (e_low + e_high) / 2)) AS w
                    FROM b, ends WHERE step < {STEPS}))))
    SELECT * FROM b WHERE step = {STEPS}),
a AS (
    SELECT x, greatest(CASE WHEN h >= reach THEN 1.0 ELSE e_low END, CASE WHEN ratio <= {REPEATS} THEN 0.0 ELSE r_high END) AS a FROM ends, bisected),
scaled AS (SELECT a, list_max(list_transform(x, lambda v: v / pow(v, a))) AS scale FROM a),
budget AS (
    SELECT source, all_tokens, CASE WHEN all_tokens > 0 THEN greatest(all_tokens, floor(pow(all_tokens::DOUBLE, a) * scale + 0.5)::BIGINT) ELSE 0 END AS budget FROM sums, scaled),
blocks AS (SELECT greatest({BLOCKS}, ceil(sum(budget)::DOUBLE / {BLOCK_TOKENS})::BIGINT) AS blocks FROM budget),
epochs AS (
    SELECT t.*, all_tokens, budget, unnest(CASE WHEN n_tokens = 0 THEN [0] ELSE range(0, (ceil(budget / all_tokens))::BIGINT) END)::INT AS epoch
    FROM t JOIN budget ON t.source IS NOT DISTINCT FROM budget.source),
digests AS (SELECT *, md5(coalesce(doc_id::VARCHAR, key) || '-' || epoch) AS digest FROM epochs),
placed AS (
    SELECT *, epoch * all_tokens + coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY digest, doc_id NULLS FIRST, n_tokens, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM digests),
dealt AS (
    SELECT *, CASE WHEN budget > 0 THEN least(blocks - 1, floor(place::DOUBLE * blocks::DOUBLE / budget)) ELSE 0 END::INT AS block
    FROM placed, blocks WHERE n_tokens = 0 OR place < budget)
SELECT doc_id, source, epoch, n_tokens, block,
    (row_number() OVER (PARTITION BY block ORDER BY md5(digest || '#'), source NULLS FIRST, doc_id NULLS FIRST, n_tokens, key, place) - 1)::INT AS position
FROM dealt
"""
