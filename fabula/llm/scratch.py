"""Tables written between steps, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, as in tests, a folder of this machine."""
    there = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        there = f"{tempfile.gettempdir()}/fabula"
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return there.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df as a Parquet table of its own; what is read of it later doesn't run df again. It is deleted when the driver ends, or by ``dropped``."""
    spark = df.sparkSession
    path = path or place(spark, name)
    df.write.parquet(path)
    files, at = _files(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a written table that nothing reads any more."""
    files, at = _files(spark, path)
    files.delete(at, True)
