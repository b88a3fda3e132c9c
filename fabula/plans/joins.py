"""Joins: matching, resolution, reconciliation, graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.operators import matching
from fabula.registry import query
from fabula.sources.tables import table

# Seeds are customers, items their orders: nation and month take the place of title and year.
_SEED = "SELECT c_custkey, c_custkey % 24 AS yr FROM customer"
_ITEM = "SELECT o_orderkey, o_custkey AS c_custkey, o_orderkey % 26 AS item_yr, round(o_totalprice) AS fame FROM orders"


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 24).alias("yr"))
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 26).alias("item_yr"), F.round("o_totalprice").alias("fame"))
    return matching.year_window(seeds, items, ["c_custkey"], "c_custkey", "yr", "item_yr")


_HITS = f"SELECT *, abs(yr - item_yr) AS gap FROM ({_SEED}) JOIN ({_ITEM}) USING (c_custkey) WHERE abs(yr - item_yr) <= 1"


@query(f"SELECT c_custkey, o_orderkey, gap FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY gap, fame DESC, o_orderkey::VARCHAR) AS k FROM ({_HITS})) WHERE k = 1")
def year_window_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest year wins, then fame, then the id as text."""
    return matching.best(_hits(spark, sf_dir), "c_custkey", [F.col("gap"), F.desc("fame"), F.col("o_orderkey").cast("string")]).select("c_custkey", "o_orderkey", "gap")


_TIED = f"SELECT c_custkey, CASE WHEN count(DISTINCT o_orderkey) = 1 THEN min(o_orderkey) END AS o_orderkey, count(DISTINCT o_orderkey) AS tied FROM (SELECT *, min(gap) OVER (PARTITION BY c_custkey) AS least FROM ({_HITS})) WHERE gap = least GROUP BY c_custkey"


@query(_TIED)
def ambiguous_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unless_tied(_hits(spark, sf_dir), "c_custkey", "gap", "o_orderkey")


@query(f"""
    SELECT c_custkey, CASE WHEN a.tied IS NOT NULL THEN a.o_orderkey ELSE b.o_orderkey END AS o_orderkey,
        CASE WHEN a.tied = 1 THEN 'tier0' WHEN a.tied > 1 THEN 'ambiguous' WHEN b.tied = 1 THEN 'tier1' WHEN b.tied > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status
    FROM customer LEFT JOIN ({_TIED}) a USING (c_custkey)
    LEFT JOIN (SELECT o_custkey AS c_custkey, CASE WHEN count(*) = 1 THEN min(o_orderkey) END AS o_orderkey, count(*) AS tied FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) b USING (c_custkey)""")
def pair_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates first, then other items; a title that several fit stays open."""
    first = matching.unless_tied(_hits(spark, sf_dir), "c_custkey", "gap", "o_orderkey")
    rest = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey").groupBy("c_custkey").agg(F.count("*").alias("tied"), F.min("o_orderkey").alias("k"))
    rest = rest.select("c_custkey", F.when(F.col("tied") == 1, F.col("k")).alias("o_orderkey"), "tied")
    return matching.cascade(table(spark, sf_dir, "customer"), "c_custkey", [first, rest], "o_orderkey")


@query("""
    SELECT a.doc_id, b.doc_id AS other, list_filter([CASE WHEN a.n_chars < 500 THEN 'a:short' END, CASE WHEN b.n_chars < 500 THEN 'b:short' END, CASE WHEN b.doc_id IS NULL THEN 'b:missing' END], lambda x: x IS NOT NULL) AS problems
    FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 7""")
def pair_scorability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs (a document and the seventh after it), with what keeps each side from being scored."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    b = d.select(F.col("doc_id").alias("other"), (F.col("doc_id") - 7).alias("doc_id"), F.col("n_chars").alias("m"))
    p = d.join(b, "doc_id", "left")
    problems = F.array_compact(F.array(F.when(F.col("n_chars") < 500, "a:short"), F.when(F.col("m") < 500, "b:short"), F.when(F.col("other").isNull(), "b:missing")))
    return p.select("doc_id", "other", problems.alias("problems"))


@query("""
    SELECT p_partkey, list_filter([CASE WHEN p_name = '' THEN 'blank' END, CASE WHEN n > 1 THEN 'duplicate' END, CASE WHEN p_size NOT BETWEEN 1 AND 45 THEN 'bad_value' END, CASE WHEN pins > 1 THEN 'conflicting_pins' END], lambda x: x IS NOT NULL) AS problems
    FROM (SELECT p_partkey, p_name, p_size, count(*) OVER (PARTITION BY p_name, p_brand, p_size) AS n, count(*) FILTER (p_size % 2 = 0) OVER (PARTITION BY p_name, p_brand) AS pins FROM part)""")
def pair_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All problems of a row: its own, and those that only its neighbours show."""
    n = F.count("*").over(Window.partitionBy("p_name", "p_brand", "p_size"))
    pins = F.sum((F.col("p_size") % 2 == 0).cast("int")).over(Window.partitionBy("p_name", "p_brand"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", n.alias("n"), pins.alias("pins"))
    rules = F.array(F.when(F.col("p_name") == "", "blank"), F.when(F.col("n") > 1, "duplicate"), F.when(~F.col("p_size").between(1, 45), "bad_value"), F.when(F.col("pins") > 1, "conflicting_pins"))
    return p.select("p_partkey", F.array_compact(rules).alias("problems"))


@query("""
    SELECT c_custkey, n AS sitelinks, first_year FROM (SELECT o_custkey AS c_custkey, count(*) AS n, min(year(o_orderdate)) AS first_year FROM orders GROUP BY o_custkey)
    JOIN customer USING (c_custkey) WHERE first_year <= 1996 AND n >= 8 AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3)) AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    ORDER BY n DESC, c_custkey LIMIT 60""")
def pool_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top of a pool: classes by semi join, an article by another, range and count after grouping."""
    o = table(spark, sf_dir, "orders")
    n = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("sitelinks"), F.min(F.year("o_orderdate")).alias("first_year")).where("first_year <= 1996 and sitelinks >= 8")
    nations = table(spark, sf_dir, "nation").where("n_regionkey in (1, 3)").select(F.col("n_nationkey").alias("c_nationkey"))
    c = table(spark, sf_dir, "customer").join(nations, "c_nationkey", "left_semi").select("c_custkey")
    done = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return n.join(c, "c_custkey", "left_semi").join(done, "c_custkey", "left_semi").orderBy(F.desc("sitelinks"), "c_custkey").limit(60)


@query("""
    SELECT c_custkey, coalesce(statuses, []) AS statuses, coalesce(years, []) AS years, least_price, n_name FROM customer
    LEFT JOIN (SELECT o_custkey AS c_custkey, list_sort(list_distinct(list(o_orderstatus))) AS statuses, min(o_totalprice) AS least_price FROM orders GROUP BY 1) USING (c_custkey)
    LEFT JOIN (SELECT o_custkey AS c_custkey, list_sort(list_distinct(list(year(o_orderdate)::VARCHAR))) AS years FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) USING (c_custkey)
    LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 4""")
def detail_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional branches, each aggregated before it is joined, so branches don't multiply; values distinct and sorted as text."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    a = o.groupBy("c_custkey").agg(F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"), F.min("o_totalprice").alias("least_price"))
    b = o.where("o_orderpriority = '1-URGENT'").groupBy("c_custkey").agg(F.array_sort(F.collect_set(F.year("o_orderdate").cast("string"))).alias("years"))
    n = table(spark, sf_dir, "nation").where("n_regionkey <> 4").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(a, "c_custkey", "left").join(b, "c_custkey", "left").join(n, "c_nationkey", "left")
    none = F.array().cast("array<string>")
    return c.select("c_custkey", F.coalesce("statuses", none).alias("statuses"), F.coalesce("years", none).alias("years"), "least_price", "n_name")


@query("SELECT DISTINCT c_mktsegment AS label, c_nationkey AS item FROM customer WHERE c_acctbal > 0 UNION SELECT c_mktsegment, s_nationkey FROM supplier, (SELECT DISTINCT c_mktsegment FROM customer) WHERE s_acctbal > 8000")
def label_or_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that a label names, or an alias does, each once."""
    c = table(spark, sf_dir, "customer")
    a = c.where("c_acctbal > 0").select(F.col("c_mktsegment").alias("label"), F.col("c_nationkey").alias("item"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 8000").select("s_nationkey").distinct()
    labels = c.agg(F.collect_set("c_mktsegment").alias("labels"))  # one row
    alias = s.join(F.broadcast(labels), F.lit(True)).select(F.explode("labels").alias("label"), F.col("s_nationkey").alias("item"))
    return a.unionByName(alias).distinct()


@query("""
    WITH RECURSIVE up(node, above) AS (SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey > 0 UNION SELECT node, above // 3 FROM up WHERE above > 0)
    SELECT p_partkey, EXISTS (SELECT 1 FROM up JOIN part q ON q.p_partkey = up.above WHERE up.node = part.p_partkey AND q.p_brand = 'Brand#7') AS inside FROM part""")
def transitive_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether any ancestor is of a class: marks pushed down the edges until nothing is new."""
    from fabula.operators.graph import below

    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    edges = p.where("p_partkey > 0").select(F.col("p_partkey").alias("node"), F.floor(F.col("p_partkey") / 3).alias("above"))
    marked = p.where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("node"))
    inside = below(edges, marked).select(F.col("node").alias("p_partkey"), F.lit(True).alias("inside"))
    return p.join(inside, "p_partkey", "left").select("p_partkey", F.coalesce("inside", F.lit(False)).alias("inside"))


@query("SELECT s_suppkey, s_nationkey, claims, claims = 1 AS kept FROM (SELECT s_suppkey, s_nationkey, count(*) OVER (PARTITION BY s_nationkey, s_suppkey % 4) AS claims FROM supplier)")
def duplicate_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pages that claim one season are both dropped."""
    s = table(spark, sf_dir, "supplier").withColumn("claims", F.count("*").over(Window.partitionBy("s_nationkey", F.col("s_suppkey") % 4)))
    return s.select("s_suppkey", "s_nationkey", "claims", (F.col("claims") == 1).alias("kept"))


@query("SELECT l_orderkey, arg_min(l_partkey, (r, q, l_partkey::VARCHAR)) AS item, count(*) AS n FROM (SELECT l_orderkey, l_partkey, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS r, CASE WHEN l_quantity > 40 THEN 0 ELSE l_linenumber END AS q FROM lineitem) GROUP BY l_orderkey")
def best_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest by rank, then ordinal (0 where unknown), then id as text."""
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    order = F.struct(rank, F.when(F.col("l_quantity") > 40, 0).otherwise(F.col("l_linenumber")), F.col("l_partkey").cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_partkey", order).alias("item"), F.count("*").alias("n"))


@query("""
    SELECT p.p_partkey, coalesce(d.k, r.k) AS linked FROM part p LEFT JOIN (SELECT DISTINCT l_partkey, l_partkey AS k FROM lineitem WHERE l_quantity = 50) d ON d.l_partkey = p.p_partkey
    LEFT JOIN (SELECT l_partkey // 10 AS target, min(l_partkey) AS k FROM lineitem WHERE l_quantity = 50 GROUP BY 1) r ON r.target = p.p_partkey WHERE d.k IS NOT NULL OR r.k IS NOT NULL""")
def redirect_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages linked to directly or through redirects: the direct link first, else the smallest alias."""
    links = table(spark, sf_dir, "lineitem").where("l_quantity = 50").select("l_partkey").distinct()
    alias = links.groupBy(F.floor(F.col("l_partkey") / 10).alias("p_partkey")).agg(F.min("l_partkey").alias("alias"))
    direct = links.select(F.col("l_partkey").alias("p_partkey"), F.col("l_partkey").alias("direct"))
    p = table(spark, sf_dir, "part").select("p_partkey").join(direct, "p_partkey", "left").join(alias, "p_partkey", "left")
    return p.select("p_partkey", F.coalesce("direct", "alias").alias("linked")).where("linked is not null")


@query("SELECT o_orderkey, slot FROM (SELECT o_orderkey, unnest(range(1, CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE 2 END)) AS slot FROM orders WHERE o_orderstatus <> 'P')")
def row_duplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per labeller slot; titles labelled twice have two."""
    slots = F.sequence(F.lit(1).cast("long"), F.when(F.col("o_orderkey") % 4 == 0, 2).otherwise(1).cast("long"))
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", F.explode(slots).alias("slot"))


_SLOTS = "SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS slot, l_quantity > 5 AS valid FROM lineitem"


@query(f"""
    SELECT orphan, count(*) AS n FROM (SELECT slot = 2 AND NOT EXISTS (SELECT 1 FROM ({_SLOTS}) y WHERE y.l_orderkey = x.l_orderkey AND y.slot = 1 AND y.valid) AS orphan FROM ({_SLOTS}) x WHERE valid) GROUP BY orphan""")
def orphan_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second labels without a valid first one."""
    x = table(spark, sf_dir, "lineitem").where("l_quantity > 5").select("l_orderkey", F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("slot"))
    first = x.where("slot = 1").select("l_orderkey").distinct().withColumn("has", F.lit(True))
    return x.join(first, "l_orderkey", "left").groupBy(((F.col("slot") == 2) & F.col("has").isNull()).alias("orphan")).agg(F.count("*").alias("n"))


@query("""
    SELECT p_partkey, CASE WHEN lines IS NULL THEN 'not_fetched' WHEN returned > 0 AND returned = lines THEN 'all_failed' WHEN NOT ok THEN 'fetched_not_ok' WHEN p_size > 40 THEN 'reserve' ELSE 'effective' END AS status
    FROM part LEFT JOIN (SELECT l_partkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned, max(l_quantity) >= 45 AS ok FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey WHERE p_size > 30""")
def priority_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), (F.max("l_quantity") >= 45).alias("ok"))  # noqa: E741
    p = table(spark, sf_dir, "part").where("p_size > 30").join(l, "p_partkey", "left")
    status = F.when(F.col("lines").isNull(), "not_fetched").when((F.col("returned") > 0) & (F.col("returned") == F.col("lines")), "all_failed").when(~F.col("ok"), "fetched_not_ok").when(F.col("p_size") > 40, "reserve").otherwise("effective")
    return p.select("p_partkey", status.alias("status"))


@query("""
    SELECT item_id, place, doc_id FROM (SELECT item_id, row_number() OVER (ORDER BY first) AS place FROM (SELECT item_id * 7 % 30 AS item_id, min(item_id) AS first FROM benchmark GROUP BY 1))
    LEFT JOIN (SELECT doc_id FROM documents WHERE n_chars > 1000) ON doc_id = item_id""")
def wanted_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted titles in the order asked for, each once, with what was found (null: missing)."""
    w = table(spark, sf_dir, "benchmark").groupBy((F.col("item_id") * 7 % 30).alias("item_id")).agg(F.min("item_id").alias("first"))
    w = w.withColumn("place", F.row_number().over(Window.orderBy("first")).cast("long"))  # a short list by nature
    d = table(spark, sf_dir, "documents").where("n_chars > 1000").select("doc_id")
    return w.join(d, F.col("doc_id") == F.col("item_id"), "left").select("item_id", "place", "doc_id")


@query("""
    SELECT doc_id FROM (SELECT d.doc_id, list_sort([sha256(d.text), sha256(d.source)]) AS a, list_sort([sha256(CASE WHEN d.doc_id % 9 = 0 THEN b.text ELSE d.text END), sha256(d.source)]) AS z
        FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 40) WHERE a <> z""")
def hash_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles whose sorted source hashes differ between two sides."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("other"))
    d = table(spark, sf_dir, "documents").withColumn("item_id", F.col("doc_id") % 40).join(b, "item_id")
    h = lambda x: F.sha2(x.cast("binary"), 256)
    z = F.when(F.col("doc_id") % 9 == 0, F.col("other")).otherwise(F.col("text"))
    return d.where(F.array_sort(F.array(h(F.col("text")), h(F.col("source")))) != F.array_sort(F.array(h(z), h(F.col("source"))))).select("doc_id")
