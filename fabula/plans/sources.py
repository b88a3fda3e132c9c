"""Queries over file sources and streams, with small fixtures of their own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.plans.ledger import _STATE
from fabula.registry import query
from fabula.sources import sheets
from fabula.sources.tables import table
from fabula.streaming import attempts


def folder(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share: the one the cluster names, else, in local mode, one of this machine."""
    there = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not there and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    there = there or tempfile.gettempdir()
    return f"{there.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SEED_ROWS = """
    SELECT CASE WHEN p_partkey % 10 = 3 THEN '# ' || p_name WHEN p_partkey % 10 = 7 THEN '  ' ELSE p_name || ', part "' || CAST(p_partkey AS VARCHAR(20)) || '"' END AS title,
        CASE WHEN p_partkey % 6 = 1 THEN '20x0' ELSE CAST(1950 + p_size AS VARCHAR(20)) END AS year, CASE WHEN p_size % 2 = 0 THEN 'movie' ELSE 'tv_series' END AS type, p_brand AS note FROM part"""


@query(f"SELECT title, try_cast(year AS INT) AS year, type FROM ({_SEED_ROWS}) WHERE trim(title) <> '' AND title NOT LIKE '#%'")
def seed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed file written from the parts, with remarks, blank titles and odd years, as it is read."""
    table(spark, sf_dir, "part").createOrReplaceTempView("seed_parts")
    path = folder(spark, "seeds")
    spark.sql(_SEED_ROWS.replace("FROM part", "FROM seed_parts")).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return sheets.seeds(spark, path).select("title", "year", "type")


_ARC = "|".join(["0,5"] * 11)
# A labelling sheet of the suppliers, two lines a title: some lines break a rule each, some are help.
_SHEET = {
    "qid": "CASE WHEN s_suppkey % 37 = 11 THEN '#help' WHEN s_suppkey % 29 = 3 THEN 'X1' ELSE 'Q' || CAST(CAST(floor(s_suppkey / 2) AS INT) AS VARCHAR(20)) END",
    "slot": "CASE WHEN s_suppkey % 31 = 5 THEN '3' ELSE CAST(s_suppkey % 2 + 1 AS VARCHAR(20)) END", "labeler": "CASE WHEN s_suppkey % 23 = 2 THEN ' ' ELSE s_name END",
    "plot": "CASE WHEN s_suppkey % 19 = 8 THEN 'Farce' WHEN s_suppkey % 3 = 0 THEN 'Comedy' WHEN s_suppkey % 3 = 1 THEN ' The  Quest' ELSE 'voyage-and-return' END",
    "arc": f"CASE WHEN s_suppkey % 11 = 1 THEN '0|1' WHEN s_suppkey % 11 = 4 THEN '{_ARC.replace('0,5', '1.5')}' WHEN s_suppkey % 5 < 3 THEN '{_ARC}' ELSE '' END",
    "confidence": "CASE WHEN s_suppkey % 17 = 4 THEN 'sure' WHEN s_suppkey % 2 = 0 THEN 'High' ELSE ' medium' END", "tones": "CASE WHEN s_suppkey % 13 = 6 THEN 'warm|warm' ELSE 'tense|Warm' END",
}
_SHEET_ROWS = "SELECT s_suppkey, " + ", ".join(f"{v} AS {k}" for k, v in _SHEET.items()) + " FROM supplier"


@query(rf"""
    WITH x AS (SELECT * REPLACE (regexp_replace(lower(trim(plot)), '[\s\-]+', '_', 'g') AS plot) FROM ({_SHEET_ROWS}) WHERE qid <> '#help'),
    y AS (SELECT qid, slot::INT AS slot, plot, list_filter([CASE WHEN qid = 'X1' THEN 'qid' END, CASE WHEN slot = '3' THEN 'slot' END, CASE WHEN labeler = ' ' THEN 'labeler' END, CASE WHEN plot = 'farce' THEN 'plot' END,
        CASE WHEN arc = '0|1' OR arc LIKE '1.5%' THEN 'arc' END, CASE WHEN confidence = 'sure' THEN 'confidence' END, CASE WHEN tones = 'warm|warm' THEN 'tones' END], lambda v: v IS NOT NULL) AS found FROM x)
    SELECT qid, slot, plot, array_to_string(CASE WHEN slot = 2 AND qid NOT IN (SELECT qid FROM y WHERE slot = 1 AND len(found) = 0) THEN list_append(found, 'orphan_slot') ELSE found END, ' ') AS errors FROM y""")
def gold_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelling sheet written from the suppliers, as it is imported: all errors of each line."""
    table(spark, sf_dir, "supplier").createOrReplaceTempView("sheet_suppliers")
    path = folder(spark, "sheet")
    rows = spark.sql(_SHEET_ROWS.replace("FROM supplier", "FROM sheet_suppliers")).select(*_SHEET)
    rows.coalesce(1).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return sheets.gold_sheet(spark, path).select("qid", "slot", "plot", F.array_join("errors", " ").alias("errors"))


@query("SELECT * FROM (VALUES (0, 'single', 'linear'), (1, 'dual', 'in_medias_res'), (2, 'ensemble', NULL)) AS t(place, protagonist, chronology)")
def dropdown_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.dropdowns(spark, {"protagonist": ("single", "dual", "ensemble"), "chronology": ("linear", "in_medias_res")})


@query("""
    SELECT CASE WHEN doc_id % 11 <> 5 AND doc_id % 17 <> 6 THEN 'Q' || doc_id END AS qid, CASE WHEN doc_id % 11 = 5 THEN 'corrupt' WHEN doc_id % 17 = 6 THEN 'no_key' WHEN doc_id % 9 = 4 THEN 'too_short'
        WHEN coalesce(text, '') = '' THEN 'no_text' WHEN doc_id % 7 = 2 THEN 'hash' ELSE 'usable' END AS result FROM documents""")
def plot_load_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plot files written from all documents, some of them broken in one way each, as they are loaded."""
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    qid = F.when(n % 17 != 6, F.concat(F.lit("Q"), n.cast("string")))
    sha = F.when(n % 7 == 2, "0").otherwise(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    row = F.to_json(F.struct(qid.alias("qid"), F.when(n % 9 == 4, "too_short").otherwise("ok").alias("status"), "text", sha.alias("content_sha256")))
    path = folder(spark, "plots")
    d.select(F.when(n % 11 == 5, "{broken").otherwise(row).alias("value")).write.text(path)
    usable, other = sheets.plots(spark, path)
    return usable.select("qid", F.lit("usable").alias("result")).unionByName(other.select("qid", F.col("reason").alias("result")))


@query(_STATE.replace("SELECT title, attempts, CASE", "SELECT title, attempts::INT AS attempts, CASE"))
def streaming_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of all titles after the stream has run dry: the last one sent of each."""
    out = folder(spark, "states")
    schema = table(spark, sf_dir, "events").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    attempts.run_available(spark, f"{sf_dir}/events.parquet*", schema, folder(spark, "stream"), out)
    s = spark.read.parquet(out)
    return s.groupBy("title").agg(F.max_by(F.struct("attempts", "state"), "epoch").alias("s")).select("title", "s.*")
