"""The tables of an app on top of the engine: their columns, and how they are laid out."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Columns by table.
TABLES = {
    "titles": "id string, tmdb_id bigint, type string, year int, runtime int, genres array<string>, poster string, summary_source string",
    "narrative_analysis": "title_id string, layer1 string, layer2 string, layer3 string, layer4 string, tags array<string>, confidence double, model_version string, prompt_version string",
    "narrative_embeddings": "title_id string, vector array<float>",
    "availability": "title_id string, country string, service string, link string, last_seen timestamp",
    "users": "id string",
    "user_services": "user_id string, country string, service string",
    "user_feedback": "user_id string, title_id string, feedback string, at timestamp",
}
#: Only availability is always read by country; the other tables are read whole or by key.
PARTITIONS = {"availability": "country"}


def create_tables(spark: SparkSession, database: str) -> None:
    """Creates what is missing of the tables in a database, as Parquet; tables that exist are left alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in TABLES.items():
        by = f" PARTITIONED BY ({PARTITIONS[name]})" if name in PARTITIONS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")
