"""Discovery: browse rows, spoilers, similarity and recommendation. An extension: specified, never built elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula import vocabulary as V
from fabula.operators import similar
from fabula.registry import query
from fabula.sources.tables import table

#: Spoiler levels of the terms used here.
LEVELS = {term: V.SPOILERS.get(term, 0) for term in ("mentor_dies", "twist_ending", "found_family", "time_loop")}
_LEVELS = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in LEVELS.items()) + ") AS v(term, level)"

# Tags of a document by simple facts.
_TAGS = "SELECT doc_id, source, lang, n_chars, list_filter([CASE WHEN n_chars % 2 = 0 THEN 'mentor_dies' END, CASE WHEN n_chars % 3 = 0 THEN 'twist_ending' END, CASE WHEN n_chars % 5 < 2 THEN 'found_family' END, CASE WHEN n_chars % 7 = 0 THEN 'time_loop' END], lambda x: x IS NOT NULL) AS tags FROM documents"


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    tags = F.array_compact(F.array(F.when(n % 2 == 0, "mentor_dies"), F.when(n % 3 == 0, "twist_ending"), F.when(n % 5 < 2, "found_family"), F.when(n % 7 == 0, "time_loop")))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", tags.alias("tags"))


@query(f"""
    SELECT row_name, count(*) AS n, min(doc_id) AS first_id FROM (
        SELECT doc_id, unnest(list_filter([CASE WHEN list_contains(tags, 'time_loop') THEN 'loops' END, CASE WHEN list_has_all(tags, ['found_family', 'twist_ending']) THEN 'families with a twist' END,
            CASE WHEN n_chars > 3000 AND lang <> 'en' THEN 'long reads abroad' END, CASE WHEN len(tags) >= 3 THEN 'busy stories' END], lambda x: x IS NOT NULL)) AS row_name FROM ({_TAGS})) GROUP BY row_name""")
def browse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of each browse row: predicates over labels."""
    has = lambda t: F.array_contains("tags", t)
    rows = F.array_compact(F.array(F.when(has("time_loop"), "loops"), F.when(has("found_family") & has("twist_ending"), "families with a twist"), F.when((F.col("n_chars") > 3000) & (F.col("lang") != "en"), "long reads abroad"), F.when(F.size("tags") >= 3, "busy stories")))
    return _tags(spark, sf_dir).select("doc_id", F.explode(rows).alias("row_name")).groupBy("row_name").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query(f"""
    SELECT doc_id, list_sort(list(term) FILTER (level <= 0)) AS as_tags, list_sort(list(term) FILTER (level <= 1)) AS as_shapes, max(level) AS level
    FROM (SELECT doc_id, unnest(tags) AS term FROM ({_TAGS})) JOIN {_LEVELS} USING (term) GROUP BY doc_id HAVING count(*) FILTER (level <= 0) > 0""")
def spoiler_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that may be shown: tags only without spoilers, shapes up to mild ones; what is derived has the highest level."""
    levels = spark.createDataFrame(list(LEVELS.items()), "term string, level int")
    t = _tags(spark, sf_dir).select("doc_id", F.explode("tags").alias("term")).join(F.broadcast(levels), "term")  # a row per term
    pick = lambda most: F.array_sort(F.collect_list(F.when(F.col("level") <= most, F.col("term"))))
    return t.groupBy("doc_id").agg(pick(0).alias("as_tags"), pick(1).alias("as_shapes"), F.max("level").alias("level")).where(F.size("as_tags") > 0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


_COSINE = "list_dot_product({0}::DOUBLE[], {1}::DOUBLE[]) / (sqrt(list_dot_product({0}::DOUBLE[], {0}::DOUBLE[])) * sqrt(list_dot_product({1}::DOUBLE[], {1}::DOUBLE[])))"


@query(f"""
    SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN (s >= 0.05) = expected THEN 'ok' ELSE 'violation' END AS verdict
        FROM (SELECT round({_COSINE.format('a.embedding', 'b.embedding')}, 6) AS s, a.label = b.label AS expected FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)) GROUP BY verdict""")
def pair_threshold_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring vectors: alike by similarity where they are alike by label."""
    e = table(spark, sf_dir, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"), F.col("label").alias("label2"))
    p = e.join(b, "vec_id").select(F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("s"), (F.col("label") == F.col("label2")).alias("expected"))
    return p.select(F.when(F.col("s").isNull(), "unscored").when((F.col("s") >= 0.05) == F.col("expected"), "ok").otherwise("violation").alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@query(f"""
    SELECT query_id, rank, vec_id FROM (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_COSINE.format('q.embedding', 'e.embedding')}, 9) DESC, e.vec_id) AS rank
        FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q WHERE e.vec_id <> q.vec_id) WHERE rank <= 5""")
def similar_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More like every fiftieth title: a stated set of queries against all rows, exactly."""
    return similar.most_similar(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


@query("""
    SELECT label, list(round(m, 6) ORDER BY k) AS profile FROM (SELECT label, k, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS k FROM embeddings) GROUP BY label, k) GROUP BY label""")
def profile_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of vectors by position."""
    p = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("k", "x"))
    m = p.groupBy("label", "k").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("m"))
    return m.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("s")).select("label", F.transform("s", lambda x: x["m"]).alias("profile"))


_RECO = f"SELECT t.doc_id, round(0.6 * ({_COSINE.format('e.embedding', 'p.embedding')}) + 0.3 * len(list_intersect(t.tags, ['found_family', 'time_loop'])) / 2 + 0.1 * coalesce(l.quality, 0) - CASE WHEN t.lang = 'de' THEN 0.2 ELSE 0 END, 6) AS score"


@query(f"""
    SELECT doc_id, score, rank FROM (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM (
        {_RECO} FROM ({_TAGS}) t JOIN embeddings e ON e.vec_id = t.doc_id JOIN (SELECT embedding FROM embeddings WHERE vec_id = 0) p ON true LEFT JOIN labels l ON l.doc_id = t.doc_id WHERE t.source IN ('src1', 'src4', 'src9')))
    WHERE rank <= 20""")
def reco_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity to a profile, shared tags and quality, less penalties; only what is available. The best twenty."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    p = e.where("doc_id = 0").select(F.col("embedding").alias("p"))  # one row
    t = _tags(spark, sf_dir).where(F.col("source").isin("src1", "src4", "src9")).join(e, "doc_id").join(F.broadcast(p), F.lit(True))
    t = t.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    shared = F.size(F.array_intersect("tags", F.array(F.lit("found_family"), F.lit("time_loop"))))
    score = 0.6 * cosine(F.col("embedding"), F.col("p")) + 0.3 * shared / 2 + 0.1 * F.coalesce("quality", F.lit(0)) - F.when(F.col("lang") == "de", 0.2).otherwise(0)
    top = t.select("doc_id", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")).cast("long"))
