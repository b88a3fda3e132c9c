"""Closures over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.sources.scratch import dropped, place, written


def below(edges: DataFrame, marked: DataFrame) -> DataFrame:
    """edges: node, above. marked: node. The nodes (distinct) that have a marked one above them, any number of steps up.

    Marks go down one step a round, from those that are new, until none is; so work grows with the nodes reached, not with pairs
    of node and ancestor. Each round is a written table, so that no plan grows. Cycles end by themselves; nulls reach nothing."""
    spark = edges.sparkSession
    edges = edges.where("node is not null and above is not null").select("node", "above").distinct()
    path = place(spark, "below")
    new = written(edges.join(marked.select(F.col("node").alias("above")).distinct(), "above", "left_semi").select("node").distinct(), "below", path)
    out = new
    while not new.isEmpty():
        step = edges.join(new.withColumnRenamed("node", "above"), "above", "left_semi").select("node").distinct().join(out, "node", "left_anti")
        new = written(step, "below", place(spark, "below"))
        old, path = path, place(spark, "below")
        out = written(out.union(new), "below", path)
        dropped(spark, old)
    return out


def ancestors(edges: DataFrame) -> DataFrame:
    """edges: node, above. All pairs of a node and what is above it, to any depth, by doubling: each round joins the pairs with themselves until none is new. For a class of ancestors ``below`` is cheaper, as pairs may be many."""
    spark, path = edges.sparkSession, place(edges.sparkSession, "ancestors")
    out = written(edges.where("node is not null and above is not null").select("node", "above").distinct(), "ancestors", path)
    n, m = -1, out.count()
    while m != n:
        step = out.select(F.col("node").alias("above"), F.col("above").alias("next"))
        old, path = path, place(spark, "ancestors")
        out = written(out.union(out.join(step, "above").select("node", F.col("next").alias("above"))).distinct(), "ancestors", path)
        dropped(spark, old)
        n, m = m, out.count()
    return out
