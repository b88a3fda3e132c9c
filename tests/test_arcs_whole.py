"""Arcs of means that lie half way between two hundredths: the rows that DuckDB gives, to the last bit."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fabula.catalogue import ORACLE_SQL, QUERIES
from fabula.functions import arc


@pytest.fixture(scope="module")
def halves(tmp_path_factory):
    """300 users with one event for each point, all of whose points are odd 200ths before they are rounded."""
    out = tmp_path_factory.mktemp("halves")
    users, n = 300, 11
    value = 60 + 0.3 * (2 * np.random.default_rng(5).integers(-60, 60, users * n) + 1)
    pq.write_table(pa.table({"event_id": np.arange(users * n), "user_id": np.repeat(np.arange(users), n), "value": np.round(value, 2)}), f"{out}/events.parquet")
    return str(out)


def both(spark, path, name):
    df = QUERIES[name](spark, path)
    cur = duckdb.execute(f"WITH events AS (FROM read_parquet('{path}/events.parquet')) SELECT * FROM ({ORACLE_SQL[name]})")
    names = [d[0] for d in cur.description]
    return sorted(repr(tuple(r[c] for c in names)) for r in df.collect()), sorted(map(repr, cur.fetchall()))


def test_half_away(spark):
    x = [0.285, -0.285, 1.005, 2.675, -0.003, 0.0, 0.125, -0.125, float("inf"), float("nan"), None]
    got = [r.y for r in spark.createDataFrame([(k, v) for k, v in enumerate(x)], "k int, x double").orderBy("k").select(arc.half_away(F.col("x"), 2).alias("y")).collect()]
    want = [r[0] for r in duckdb.execute("SELECT round(x, 2) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [x]).fetchall()]
    assert list(map(repr, got)) == list(map(repr, want))


def test_arc_agreement(spark, halves):
    got, want = both(spark, halves, "arc_agreement")
    assert got == want


def test_arc_confidence_cap(spark, tmp_path):
    """Users whose confidence is capped or not by one point's last digit."""
    values = [
        [43.5, 32.7, 77.7, 86.1, 53.1, 61.5, 56.7, 82.5, 71.7, 29.7, 51.3], [54.3, 66.9, 80.1, 50.1, 95.1, 73.5, 35.7, 60.9, 47.7, 77.1, 66.3],
        [75.9, 74.1, 50.1, 53.7, 42.9, 44.1, 36.9, 56.1, 76.5, 26.1, 55.5], [53.7, 62.1, 59.1, 51.9, 32.1, 57.3, 93.3, 59.1, 50.7, 46.5, 90.9],
    ]
    pq.write_table(pa.table({"event_id": np.arange(44), "user_id": np.repeat(np.arange(4), 11), "value": np.ravel(values)}), f"{tmp_path}/events.parquet")
    got, want = both(spark, str(tmp_path), "arc_confidence_cap")
    assert got == want and sum(r.endswith("0.49)") for r in got) == 3


def test_arc_label(spark, halves):
    got, want = both(spark, halves, "arc_label")
    assert got == want


def test_arc_moves(spark, halves):
    got, want = both(spark, halves, "arc_moves")
    assert got == want


def test_record_round_trip(spark, halves):
    got, want = both(spark, halves, "record_round_trip")
    assert got == want


def test_record_round_trip_zeros(spark, tmp_path):
    """Points just under zero are stored as zeros without a sign."""
    value = 60 + 0.1 * np.random.default_rng(6).integers(-5, 6, 40 * 11)
    pq.write_table(pa.table({"event_id": np.arange(40 * 11), "user_id": np.repeat(np.arange(40), 11), "value": np.round(value, 1)}), f"{tmp_path}/events.parquet")
    got, want = both(spark, str(tmp_path), "record_round_trip")
    assert got == want and not any("-0.0," in r or "-0.0]" in r for r in got)
