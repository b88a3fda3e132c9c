"""Pair files, locks, prompts, closures, streams in any order."""

from __future__ import annotations

import hashlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from fabula.operators import graph
from fabula.sources import lock, pairs

HEAD = ",".join(pairs.COLUMNS + pairs.PINS)


def test_all_problems_of_a_line(spark, tmp_path):
    lines = [
        HEAD, 'P1,match,A,1999,movie,B,2000,movie,"a, shape",why,seed,Q1,', "P1,match,A,1999,movie,B,x,film,shape,why,seed,Q01,", "P2,match,A,1999,movie,C,2000,movie,s,w,seed,Q2,Q3", "P3,perhaps,,1999,movie,C,2000,movie,,w,odd,,Q9",
        "P4,no_match,C,2000,movie,D,2001,movie,s,w,approved,Q4,",
    ]
    (tmp_path / "p.csv").write_text("\ufeff" + "\n".join(lines) + "\n", encoding="utf-8")
    got = {r.row: r.problems for r in pairs.load_pairs(spark, str(tmp_path / "p.csv")).collect()}
    assert got == {2: [], 3: ["duplicate", "type_b", "year_b", "qid_a"], 4: ["pin_a"], 5: ["expect", "status", "title_a", "why"], 6: ["pin_a"]}
    (tmp_path / "q.csv").write_text("pair_id,expect\nP1,match\n")
    with pytest.raises(ValueError, match="columns must be"):
        pairs.load_pairs(spark, str(tmp_path / "q.csv"))


def test_expectations(spark, tmp_path):
    (tmp_path / "e.csv").write_text("title_a,title_b,expectation,note\n A ,B,should_match, x \nC,D,should_not_match,\n")
    assert [tuple(r) for r in pairs.load_expectations(spark, str(tmp_path / "e.csv")).collect()] == [(2, "A", "B", "should_match", "x"), (3, "C", "D", "should_not_match", "")]
    (tmp_path / "f.csv").write_text("title_a,title_b,expectation\nA,B,maybe\n")
    with pytest.raises(Exception, match="unknown expectation in line 2"):
        pairs.load_expectations(spark, str(tmp_path / "f.csv")).collect()


def test_one_run_in_a_folder(spark, tmp_path):
    with lock.run_lock(spark, str(tmp_path)):
        with pytest.raises(lock.Held), lock.run_lock(spark, str(tmp_path)):
            pass
    with lock.run_lock(spark, str(tmp_path)):
        pass


def test_pinned_prompt(spark, tmp_path):
    (tmp_path / "a-1.md").write_bytes("Schreibe: é\n".encode())
    sha = hashlib.sha256("Schreibe: é\n".encode()).hexdigest()
    assert lock.load_prompt(spark, str(tmp_path), "a-1", {"a-1": sha}) == "Schreibe: é\n"
    for version, known in (("a-1", {"a-1": "0"}), ("a-2", {"a-1": sha})):
        with pytest.raises(ValueError):
            lock.load_prompt(spark, str(tmp_path), version, known)


def test_marks_reach_the_end_of_a_long_chain_and_cycles_end(spark):
    edges = spark.createDataFrame([(k, k - 1) for k in range(1, 80)] + [(200, 201), (201, 200), (None, 3), (5, None)], "node long, above long")
    got = graph.below(edges, spark.createDataFrame([(0,), (200,)], "node long"))
    assert sorted(r.node for r in got.collect()) == [*range(1, 80), 200, 201]


def test_stream_states_do_not_depend_on_file_order(spark, tmp_path):
    from fabula.catalogue import QUERIES
    from fabula.streaming import attempts

    events = spark.read.parquet(f"{SF}/events.parquet")
    want = {tuple(r) for r in QUERIES["title_state"](spark, SF).select("title", "attempts", "state").collect()}
    for k, order in enumerate((F.col("event_id"), F.desc("event_id"), F.xxhash64("event_id"))):
        path = str(tmp_path / f"events{k}")
        for n in range(3):  # files of mixed ids, one a batch
            events.where(F.pmod(F.xxhash64("event_id", F.lit(k)), F.lit(3)) == n).orderBy(order).coalesce(1).write.mode("append").parquet(path)
        schema = events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
        attempts.run_available(spark, path, schema, str(tmp_path / f"c{k}"), str(tmp_path / f"s{k}"))
        last = spark.read.parquet(str(tmp_path / f"s{k}")).groupBy("title").agg(F.max_by(F.struct("attempts", "state"), "epoch").alias("x"))
        assert {(r.title, r.x.attempts, r.x.state) for r in last.collect()} == want


def test_ancestors_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k - 1) for k in range(1, 101)], "node long, above long")
    assert graph.ancestors(edges).where("node = 100").count() == 100
