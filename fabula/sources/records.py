"""Records and runs as sources."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

JUDGEMENT = "struct<present: boolean, confidence: double>"
RECORD = f"title_key string, record_kind string, annotator string, schema_version string, prompt_version string, model string, outcome string, primary_plot string, plots map<string, {JUDGEMENT}>, tags map<string, {JUDGEMENT}>, tones array<string>, arc_points array<double>, source_hashes array<string>, _corrupt string"


def records(spark: SparkSession, *paths: str) -> DataFrame:
    """Annotation records of JSON files, JSON lines and folders of both, with their file; a record that does not parse stops the read."""
    parts = [spark.read.schema(RECORD).option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("multiLine", p.endswith(".json")).json(p).withColumn("file", F.col("_metadata.file_path")) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    bad = F.col("_corrupt").isNotNull() | F.col("title_key").isNull()
    return out.withColumn("title_key", F.when(bad, F.raise_error(F.concat(F.lit("invalid record in "), "file"))).otherwise(F.col("title_key"))).drop("_corrupt")


def one_version(model: DataFrame) -> DataFrame:
    """The records of a run, which must be of one schema, prompt and model, one for each title."""
    groups = model.agg(F.count_distinct("schema_version", "prompt_version", "model").alias("groups"), F.count("*").alias("n"), F.count_distinct("title_key").alias("titles")).first()  # three numbers
    if groups.groups > 1 or groups.n != groups.titles:
        raise ValueError(f"{groups.groups} versions, {groups.n} records of {groups.titles} titles")
    return model


def wanted(spark: SparkSession, path: str) -> DataFrame:
    """Titles of a list, one by line or as JSON with qid, title_key or key; remarks left out, the first of equal ones kept. Columns: ordinal, name."""
    from fabula.sources.sheets import lines

    x = lines(spark, path).withColumn("line", F.trim("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    j = F.from_json("line", "qid string, title_key string, key string")
    name = F.when(F.col("line").startswith("{"), F.coalesce(j["qid"], j["title_key"], j["key"])).otherwise(F.col("line"))
    return x.select("ordinal", name.alias("name")).groupBy("name").agg(F.min("ordinal").alias("ordinal")).select("ordinal", "name")


class _CacheReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        import os

        return [InputPartition(f"{self.path}/{n}") for n in sorted(os.listdir(self.path)) if n.endswith(".json")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import json

        with open(partition.value, encoding="utf-8") as f:
            row = json.load(f)
        yield row.get("key"), row.get("url"), row.get("fetched_at"), json.dumps(row.get("body"), sort_keys=True)


class ResponseCache(DataSource):
    """A folder of cached responses, a JSON file each, as a table. For folders that driver and executors both mount."""

    @classmethod
    def name(cls) -> str:
        return "response_cache"

    def schema(self) -> str:
        return "key string, url string, fetched_at string, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _CacheReader(self.options)
