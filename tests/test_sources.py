from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fabula import verbs
from fabula import vocabulary as V
from fabula.sources import cache, records, sheets, sinks


def test_seeds_leave_out_remarks(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿title,year,type,note\nA,1999,movie,\n# x,,,\n,1,movie,\n", encoding="utf-8")
    assert [tuple(r)[:2] for r in sheets.seeds(spark, str(tmp_path / "s.csv")).collect()] == [("A", 1999)]


def test_wanted_keeps_order_and_drops_repeats(spark, tmp_path):
    (tmp_path / "w.txt").write_text('# titles\nQ2\n{"qid": "Q1"}\n\nQ2\n{"key": "k"}\n')
    got = records.wanted(spark, str(tmp_path / "w.txt")).orderBy("ordinal").collect()
    assert [r.name for r in got] == ["Q2", "Q1", "k"]


def test_records_of_files_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"title_key": "m:Q1", "outcome": "annotated"}]))
    (tmp_path / "b.jsonl").write_text('{"title_key": "m:Q2"}\n{"title_key": "m:Q3"}\n')
    got = records.records(spark, str(tmp_path / "a.json"), str(tmp_path / "b.jsonl"))
    assert sorted(r.title_key for r in got.collect()) == ["m:Q1", "m:Q2", "m:Q3"]
    (tmp_path / "c.jsonl").write_text("{broken\n")
    with pytest.raises(Exception, match="invalid record"):
        records.records(spark, str(tmp_path / "c.jsonl")).collect()


def test_one_version(spark):
    rows = spark.createDataFrame([("a", "1", "p", "m"), ("b", "1", "p", "m")], "title_key string, schema_version string, prompt_version string, model string")
    assert records.one_version(rows) is rows
    with pytest.raises(ValueError, match="2 versions"):
        records.one_version(rows.withColumn("model", F.col("title_key")))


def test_response_cache_source(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"key": "k", "url": "u", "fetched_at": "2024-01-01T00:00:00Z", "body": {"b": 1}}))
    spark.dataSource.register(records.ResponseCache)
    assert [tuple(r) for r in spark.read.format("response_cache").load(str(tmp_path)).collect()] == [("k", "u", "2024-01-01T00:00:00Z", '{"b": 1}')]


@pytest.mark.parametrize("ttl, n", [(None, 2), (0, 0), (3600, 1)])
def test_cache_limits(spark, tmp_path, ttl, n):
    rows = [{"key": k, "url": "u", "fetched_at": f"2024-01-01T0{h}:00:00Z", "body": ""} for k, h in (("a", 1), ("b", 4))]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert cache.read_cache(spark, str(tmp_path), "2024-01-01T04:30:00Z", ttl).count() == n


def test_single_file_is_replaced_whole(spark, tmp_path):
    path = tmp_path / "report.csv"
    for k in (1, 2):
        sinks.write_one(spark.createDataFrame([(k,)], "n int"), str(path), "csv")
        assert path.read_text() == f"n\n{k}\n" and {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"report.csv"}


def test_stale_files(spark, tmp_path):
    for n in ("Q1.txt", "Q2.txt"):
        (tmp_path / n).write_text("x")
    assert [r[0] for r in sinks.stale(spark, str(tmp_path), spark.createDataFrame([("Q2.txt",)], "name string"), "name").collect()] == ["Q1.txt"]


def test_markdown(spark):
    assert sinks.markdown(spark.createDataFrame([(1, 0.5, None)], "a int, b double, c string"), "T") == "## T\n\n| a | b | c |\n|---|---|---|\n| 1 | 0.500 | – |\n"


def test_quotas_sum_up(spark):
    assert sum(q for _, _, q, _ in V.BUCKETS) == 500 == verbs.buckets(spark).agg(F.sum("quota")).first()[0]


def test_candidates_and_evaluation(spark):
    items = [(f"Q{k}", f"t{k}", 1950 + k % 70, "movie", ["horror film"] if k % 2 else ["concert film"] if k % 10 == 0 else ["drama"], "film:english", k, "a", k, False) for k in range(1, 400)]
    df = spark.createDataFrame(items, "qid string, title string, year int, media_type string, genres array<string>, bucket string, sitelinks int, enwiki_title string, tmdb_id int, tmdb_id_ambiguous boolean")
    got = verbs.candidates(df, spark.createDataFrame([("Q1",)], "qid string")).where("role = 'pilot'").collect()
    assert any(r.qid == "Q1" and r.phase == "forced" for r in got) and not any("concert film" in r.genres for r in got)
    gold = spark.createDataFrame([("a", "annotated", "comedy"), ("b", "annotated", "tragedy"), ("c", "abstained", None)], "title_key string, outcome string, primary_plot string")
    model = spark.createDataFrame([("a", "annotated", "comedy", 0.97)], "title_key string, outcome string, primary_plot string, confidence double")
    report = verbs.evaluate(gold, model)
    assert tuple(report["headline"].first()) == (2, 1, 0.5, False)
    assert {(r.gold, r.label) for r in report["confusion"].collect()} == {("comedy", "comedy"), ("tragedy", "(no model record)")}
    assert {r.band: r.n for r in report["calibration"].collect()}["0.95-1.00"] == 1
