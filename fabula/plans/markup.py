"""Queries over page markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabula.functions import markup
from fabula.functions.text import word_count
from fabula.registry import query
from fabula.sources.tables import table


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", markup.html_to_text("html").alias("text"))
    return p.select("page_id", "text", word_count(F.col("text")).alias("words"))


_PARTS = (("Season 1", "the", "walked"), ("Reception", "de", "home"), ("Specials", "que", "aired"), ("Story", "der", "critics"))


def _every(k: int):
    """Lines of one part, by their place."""
    return lambda x, i: i % (len(_PARTS) + 1) == k


@query()
def section_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections built from documents: a lead, then its lines under headings of four kinds, some words standing for cues."""
    from fabula.functions.sections import section_filter as keep

    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    body = F.lit("")
    for k, (name, a, b) in enumerate(_PARTS):
        mine = F.filter(lines, _every(k + 1))
        text = F.replace(F.array_join(F.transform(mine, lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), ""), F.lit(f" {a} "), F.lit(f" {b} "))
        body = F.concat(body, F.lit(f'<div class="mw-heading mw-heading3"><h3>{name}</h3></div>'), text)
    lead = F.concat(F.lit('<div class="mw-heading mw-heading2"><h2>Episodes</h2></div><p>'), F.get(lines, F.lit(0)), F.lit("</p>"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(lead, body).alias("html"), F.when(F.col("lang") == "en", "episodes").otherwise("plot").alias("heading"), F.when(F.col("lang") == "fr", "movie").otherwise("tv_series").alias("media"))
    return d.select("doc_id", keep("html", "heading", "media").alias("s")).select("doc_id", "s.*")


@query(r"""
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS row, replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS cell
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS item, generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) AS k FROM pages)""")
def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of lists, one cell each here."""
    spark.udtf.register("table_rows", markup.TableRows)
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    p.createOrReplaceTempView("markup_pages")
    return spark.sql("SELECT page_id, CAST(r.row AS BIGINT) AS row, r.cells[0] AS cell FROM markup_pages, LATERAL table_rows(html) r")


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(replace(lower(replace(replace(line, '&', ' and '), '×', 'x')), 'ß', 'ss')), '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM (SELECT doc_id, split_part(coalesce(text, ''), chr(10), 1) AS line FROM documents)")
def title_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of all documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1)).alias("line"))
    return d.select("doc_id", markup.normalize_title("line").alias("title"))
