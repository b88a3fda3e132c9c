"""Queries on plot files and their owners, records of a run's making, and tables without season headings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.functions import provenance as P
from fabula.functions import staleness as S
from fabula.operators import ordered
from fabula.registry import query
from fabula.sources.tables import table


@query("""
    SELECT doc_id, found AND NOT coalesce(owner = 'pairs', false) AS pilot, found AS either, NOT found OR coalesce(owner = 'pairs', false) AS pairs_own
    FROM (SELECT d.doc_id, l.doc_id IS NOT NULL AS found, CASE WHEN toxic = 1 THEN 'pairs' WHEN quality = 1 THEN 'pilot' END AS owner FROM documents d LEFT JOIN labels l USING (doc_id))""")
def file_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whose plot file a title has: whether the pilot sees it, whether the pairs do, and whether they may write it."""
    owner = F.when(F.col("toxic") == 1, "pairs").when(F.col("quality") == 1, "pilot")
    files = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("found"), owner.alias("owner"))
    d = table(spark, sf_dir, "documents").select("doc_id").join(files, "doc_id", "left")
    found, owner = F.coalesce("found", F.lit(False)), F.col("owner")
    return d.select("doc_id", P.visible(found, owner).alias("pilot"), P.visible(found, owner, include_pairs=True).alias("either"), P.pairs_own(found, owner).alias("pairs_own"))


_EFFORT = "CASE WHEN o_orderkey % 40 = 7 THEN repeat(o_orderpriority, 60) ELSE o_orderpriority END"


@query(f"""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS annotated_at, o_orderstatus AS model_version, o_custkey AS input_tokens, CASE WHEN length(n) <= 500 THEN n ELSE substr(n, 1, 497) || '...' END AS notes,
        CASE WHEN o_orderstatus = 'F' THEN 'seasons 1 to ' || (o_orderkey % 9 + 1) END AS coverage
    FROM (SELECT *, 'attempts=' || (o_orderkey % 3 + 1) || '; effort=' || {_EFFORT} || '; cache_creation_input_tokens=' || (o_custkey * 2) || '; request_id=' || CASE WHEN o_orderkey % 5 = 0 THEN 'None' ELSE 'r' || o_orderkey END AS n FROM orders)""")
def record_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What records say of their making: run, usage, notes cut to size, and the coverage where the prompt states one."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    run = {"annotated_at": F.col("o_orderdate"), "model_version": F.col("o_orderstatus"), "prompt_version": F.lit("p1"), "run_id": F.lit("run")}
    usage = {"input_tokens": F.col("o_custkey"), "output_tokens": F.lit(0), "cache_read_input_tokens": F.lit(0), "batch": F.lit(False)}
    note = P.notes(key % 3 + 1, F.expr(_EFFORT), F.col("o_custkey") * 2, F.when(key % 5 != 0, F.concat(F.lit("r"), key.cast("string"))))
    coverage = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("seasons 1 to "), (key % 9 + 1).cast("string")))
    made = P.provenance(run, usage, F.array(F.lit("s")), F.lit(0), note, coverage)
    return o.select("o_orderkey", made.alias("p")).select("o_orderkey", "p.annotated_at", "p.annotator.model_version", "p.usage.input_tokens", "p.notes", "p.coverage")


@query("""
    WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 3 THEN p_name || ' again' WHEN p_partkey % 5 <> 0 THEN p_name END AS title FROM part), s AS (SELECT p_name, arg_max(p_brand, p_partkey) AS plot, arg_max(p_type, p_partkey) AS arc FROM part GROUP BY p_name)
    SELECT p_partkey, coalesce(plot, 'unknown') AS guessed_plot, coalesce(arc, 'unknown') AS guessed_arc, p_name IS NOT NULL AS seed FROM c LEFT JOIN s ON title = p_name""")
def seed_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plot and arc that the seeds guess for a candidate by its seed title; of seeds with one title the last counts, without one both are unknown."""
    p = table(spark, sf_dir, "part")
    last = lambda c: F.max_by(c, "p_partkey")
    seeds = p.groupBy(F.col("p_name").alias("title")).agg(last("p_brand").alias("plot"), last("p_type").alias("arc"), F.lit(True).alias("seed"))
    title = F.when(F.col("p_partkey") % 7 == 3, F.concat("p_name", F.lit(" again"))).when(F.col("p_partkey") % 5 != 0, F.col("p_name"))
    got = p.select("p_partkey", title.alias("title")).join(seeds, "title", "left")
    return got.select("p_partkey", F.coalesce("plot", F.lit("unknown")).alias("guessed_plot"), F.coalesce("arc", F.lit("unknown")).alias("guessed_arc"), F.coalesce("seed", F.lit(False)).alias("seed"))


# Headings of a page's tables: a page in four has one that names a season.
_HEADING = "CASE WHEN conv_id % 4 = 0 AND turn = 1 THEN 'Season 2' WHEN turn % 5 = 4 THEN 'Specials' WHEN turn % 3 = 2 THEN 'Part ' || CAST(turn AS VARCHAR(9)) WHEN conv_id % 7 = 0 AND turn % 2 = 1 THEN '1999' ELSE 'Episodes' END"


@query(rf"""
    WITH t AS (SELECT conv_id, turn, lower({_HEADING}) AS h, CASE WHEN conv_id % 3 = 0 THEN NULL ELSE conv_id % 3 END AS seasons FROM conversations),
    u AS (SELECT *, bool_or(regexp_matches(h, '^(season|series)\s+\d')) OVER (PARTITION BY conv_id) AS named FROM t)
    SELECT conv_id, turn, 1 AS season, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM u
    WHERE NOT named AND coalesce(seasons, 1) = 1 AND (h IN ('', 'episodes', 'episode list', 'list of episodes') OR regexp_matches(h, '^part\s+([0-9]{{1,2}}|[ivx]{{1,5}})\b'))""")
def unheaded_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of pages that name no season anywhere: they are season 1, in order, of a series that has no second one."""
    seasons = F.when(F.col("conv_id") % 3 != 0, F.col("conv_id") % 3)
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_HEADING).alias("heading"), seasons.alias("seasons"))
    return ordered.unheaded_season(t, "conv_id", "turn", "heading", "seasons").select("conv_id", "turn", "season", "place")


# Plot files of all documents, as JSON: versions, results and evidence vary by id.
_SKIP = "CASE doc_id % 7 WHEN 0 THEN 'too_short' WHEN 1 THEN 'no_plot_section' WHEN 2 THEN 'season_too_long' WHEN 3 THEN 'fetch_error' END"
_FILE = f"""
    SELECT doc_id, to_json(struct(concat('Q', doc_id % 40) AS qid, CASE WHEN doc_id % 7 > 3 THEN 'ok' ELSE 'skipped' END AS status, {_SKIP} AS skip_reason, concat('1.', 2 + doc_id % 4, '.', doc_id % 11) AS fetcher_version,
        CASE WHEN doc_id % 10 = 3 THEN 'movie' ELSE 'tv_series' END AS media_type, CASE WHEN doc_id % 3 > 0 THEN 'seasons' END AS via, CASE WHEN doc_id % 8 < 4 THEN 'episode_table' END AS via_detail, CAST(doc_id % 600 AS INT) AS word_count,
        CASE WHEN doc_id % 5 > 0 THEN struct(CASE WHEN doc_id % 5 = 1 THEN 'disabled' WHEN doc_id % 5 = 2 THEN 'used' END AS status, array(struct(CASE WHEN doc_id % 13 = 2 THEN 'main_article_link' ELSE 'statement' END AS basis)) AS evidence,
            array(struct(CASE WHEN doc_id % 2 = 0 THEN 'List of x episodes' ELSE 'x' END AS title, CASE WHEN doc_id % 9 < 4 THEN 'unverified: y' WHEN doc_id % 9 = 7 THEN 'statement in another item' END AS reason)) AS skipped) END AS season_articles,
        CASE WHEN doc_id % 3 <> 1 THEN struct(array(struct(CASE WHEN doc_id % 17 = 4 THEN 'main_article_link' END AS basis)) AS evidence) END AS episode_tables,
        array(struct(concat('S1E1 "Start": Bob waits.', chr(10), chr(10), 'S1E2: ', CASE WHEN doc_id % 19 < 5 THEN 'Music: a song.' ELSE 'Eve sings.' END) AS text)) AS sources)) AS body FROM files"""
_RUN_RULES = {"Q3": "1.5.4", "Q7": "1.5.7"}


@query(f"""
    WITH f AS (SELECT doc_id, doc_id % 40 AS q, (2 + doc_id % 4) * 100 + doc_id % 11 AS v, doc_id % 7 AS r, doc_id % 10 <> 3 AS tv, doc_id % 5 AS s, doc_id % 3 <> 1 AS tables, doc_id % 7 > 3 AS ok, doc_id % 8 < 4 AS detail FROM documents),
    g AS (SELECT *, tv AND r < 3 AND s > 1 AS tried FROM f)
    SELECT doc_id, array_to_string(list_filter([CASE WHEN r = 3 THEN 'fetch_error' END, CASE WHEN v < 400 THEN 'current_ingest' END, CASE WHEN tv AND r < 2 AND s = 0 THEN 'seasons' END, CASE WHEN tried AND v < 500 THEN 'episode_tables' END,
        CASE WHEN tv AND r <> 3 AND (q = 3 AND v < 504 OR q = 7 AND v < 507) THEN 'run_rule' END, CASE WHEN tried AND v < 502 AND doc_id % 2 = 0 AND doc_id % 9 < 4 THEN 'list_link' END,
        CASE WHEN q IN (3, 9, 11) AND ok AND tv AND doc_id % 3 = 0 AND doc_id % 600 < 500 AND v < 502 THEN 'richer_text' END,
        CASE WHEN v < 506 AND (s > 0 AND (doc_id % 13 = 2 OR doc_id % 9 = 7) OR tables AND doc_id % 17 = 4) THEN 'link_hardening' END, CASE WHEN tables AND v >= 505 AND v < CASE q WHEN 7 THEN 507 ELSE 506 END THEN 'year_heading' END,
        CASE WHEN ok AND detail AND v < 507 THEN 'episode_marker' END, CASE WHEN tables AND v < 508 THEN 'episode_text' END, CASE WHEN q = 5 AND v < 508 THEN 'prefer_episode_text' END,
        CASE WHEN ok AND detail AND v < 509 AND doc_id % 19 < 5 THEN 'trivia_rules' END], lambda x: x IS NOT NULL), ' ') AS reasons FROM g""")
def fetch_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why the plot files of all documents are fetched again."""
    table(spark, sf_dir, "documents").select("doc_id").createOrReplaceTempView("staleness_files")
    files = spark.sql(_FILE.replace("FROM files", "FROM staleness_files")).select("doc_id", F.from_json("body", S.FILE).alias("f")).select("doc_id", "f.*")
    return files.select("doc_id", F.array_join(S.fetch_reasons(_RUN_RULES, ("Q3", "Q9", "Q11"), ("Q5",)), " ").alias("reasons"))
