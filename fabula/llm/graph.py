"""Connected components of an edge table, by rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm.scratch import dropped, place, written


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node, root (the smallest node reachable), for nodes on edges. Edges with a null are left out.

    Alternates large and small stars until the edges no longer change; each star takes a
    minimum by node, which partial aggregation gathers before the shuffle, and a join that
    adaptive execution splits where a node has very many edges."""
    spark, path = edges.sparkSession, None
    nxt = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    was = None
    while True:
        old, path = path, place(spark, "edges")
        e = written(nxt, "edges", path)
        if old:
            dropped(spark, old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == was:
            break
        was = now
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        nxt = large.join(small, "a").select(F.greatest("b", "m").alias("x"), F.col("m").alias("y")).union(small.select("a", "m")).toDF("a", "b").where("a <> b").distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
