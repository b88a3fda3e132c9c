"""Sinks: tables, single files and rendered reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines, in as many files as partitions; the commit protocol makes the table appear at once."""
    df.write.mode("overwrite").json(path)


def write_one(df: DataFrame, path: str, form: str = "json") -> None:
    """One file by that name: written beside it, then renamed, so readers see the old or the new one. For small reports."""
    spark = df.sparkSession
    beside = f"{path}.{uuid.uuid4().hex}"
    writer = df.coalesce(1).write.option("lineSep", "\n")
    (writer.option("header", True).csv if form == "csv" else writer.json if form == "json" else writer.text)(beside)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(beside), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(folder, True)


def stale(spark: SparkSession, path: str, kept: DataFrame, name: str) -> DataFrame:
    """Files of a folder that the new set of names no longer has."""
    from pyspark.sql import functions as F

    there = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias(name))
    return there.join(kept.select(name), name, "left_anti")


def markdown(df: DataFrame, title: str = "", most: int = 200) -> str:
    """A small frame as a table; null as a dash, ratios with three digits. Shows at most so many rows and says if there are more."""
    rows = df.limit(most + 1).collect()
    form = lambda v: "–" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)
    out = [f"## {title}", ""] if title else []
    out += ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    out += ["| " + " | ".join(form(v) for v in r) + " |" for r in rows[:most]]
    return "\n".join(out + (["", f"First {most} rows."] if len(rows) > most else [])) + "\n"
