"""The most similar rows, all against all: the rows that DuckDB gives, with odd vectors and many parts, and in time."""

from __future__ import annotations

import time

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from fabula.catalogue import ORACLE_SQL, QUERIES
from fabula.operators import similar


def both(spark, path, ids, vectors):
    t = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(ids), pa.int32())})
    pq.write_table(t, f"{path}/embeddings.parquet")
    began = time.perf_counter()
    got = sorted(tuple(r) for r in QUERIES["similar_topk"](spark, str(path)).select("query_id", "rank", "vec_id").collect())
    took = time.perf_counter() - began
    want = duckdb.execute(f"WITH embeddings AS (FROM read_parquet('{path}/embeddings.parquet')) SELECT * FROM ({ORACLE_SQL['similar_topk']})").fetchall()
    return got, sorted(want), took


def test_in_time(spark, tmp_path):
    """16,000 rows and 320 queries took 133 seconds with a Column expression for each pair."""
    vectors = np.random.default_rng(1).normal(size=(16_000, 64)).astype(np.float32)
    got, want, took = both(spark, tmp_path, np.arange(16_000), list(vectors))
    assert got == want and len(got) == 1600 and took < 25


def test_odd_vectors(spark, tmp_path, monkeypatch):
    """Zero vectors, null ones, NaN, copies, ids negative and null; parts of a few rows, blocks of a few queries."""
    monkeypatch.setattr(similar, "PART_ROWS", 40)
    rng = np.random.default_rng(2)
    vectors = [list(map(float, v)) for v in rng.integers(-2, 3, (300, 4))]  # many alike, some zero
    for k in (0, 7, 50, 61):
        vectors[k] = None
    for k in (3, 100):
        vectors[k] = [float("nan"), 1.0, 0.0, 0.0]
    vectors[150] = [0.0] * 4
    ids = [*range(-50, 249), None]
    got, want, _ = both(spark, tmp_path, ids, vectors)
    assert got == want and len(got) == 30


def test_few_rows(spark, tmp_path):
    """Fewer others than wanted, and nulls last among them; no rows at all."""
    got, want, _ = both(spark, tmp_path, [0, 50, 7], [[1.0, 0.0], None, [1.0, 1.0]])
    assert got == want == [(0, 1, 7), (0, 2, 50), (50, 1, 0), (50, 2, 7)]
    assert both(spark, tmp_path, [], [])[0] == []
