from __future__ import annotations

import random

from pyspark.sql import functions as F

from fabula.operators import gold, ledger, matching, metrics, ordered, selection
from fabula.operators.graph import ancestors


def pick(items, quota):
    """The quota rule as a plain loop."""
    rank = lambda i: (-i["fame"], i["id"])
    out = sorted((i for i in items if i["must"]), key=rank)[:quota]
    left = sorted((i for i in items if i not in out), key=rank)
    share = max(0, -(-quota // 2) - len(out))
    out, left = out + left[:share], left[share:]
    while left and len(out) < quota:
        have = lambda g: sum(i["genre"] == g for i in out)
        best = min(left, key=lambda i: (have(i["genre"]), rank(i)))
        out.append(best)
        left.remove(best)
    return {i["id"] for i in out}


def test_quota_pick_equals_a_loop(spark):
    rng = random.Random(3)
    rows = [{"id": k, "cell": f"c{k % 40}", "genre": rng.choice("abcd"), "fame": rng.randint(0, 9), "must": rng.random() < 0.15} for k in range(900)]
    quotas = {f"c{k}": rng.randint(1, 9) for k in range(40)}
    items = spark.createDataFrame(rows, "id long, cell string, genre string, fame long, must boolean")
    got = selection.quota_pick(items, spark.createDataFrame(list(quotas.items()), "cell string, quota int")).where("role = 'pilot'").select("cell", "id").collect()
    for c, q in quotas.items():
        assert {r.id for r in got if r.cell == c} == pick([r for r in rows if r["cell"] == c], q)


def test_capped_prefix_stops_at_the_first_over(spark):
    df = spark.createDataFrame([("a", k, w) for k, w in enumerate((3, 0, 4, 9, 1))], "key string, k int, w int")
    got = ordered.capped_prefix(df, "key", "k", "w", 8, 10).collect()
    assert [r.w for r in sorted(got, key=lambda r: r.k)] == [3, 4] and got[0].reason == "word_cap"


def test_rising_until_restart(spark):
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate((1, 2, 2, 5, 3, 9))], "key string, k int, v int")
    assert sorted(r.v for r in ordered.rising_until_restart(df, "key", "k", "v").collect()) == [1, 2, 2, 5]


def test_ties_stay_open(spark):
    hits = spark.createDataFrame([("s", 0, 1), ("s", 0, 2), ("t", 1, 3), ("t", 2, 4)], "key string, gap int, item int")
    assert {r.key: (r.item, r.tied) for r in matching.unless_tied(hits, "key", "gap", "item").collect()} == {"s": (None, 2), "t": (3, 1)}


def test_kappa_is_null_when_chance_is_certain(spark):
    same = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    assert metrics.kappa(same, "a", "b").first().kappa is None
    assert metrics.kappa(spark.createDataFrame([(1, 1), (0, 0), (1, 0), (0, 1)], "a int, b int"), "a", "b").first().kappa == 0


def test_empty_sets_are_alike(spark):
    none = F.array().cast("array<string>")
    assert spark.range(1).select(metrics.jaccard(none, none)).first()[0] == 1.0


def test_attempts_end_with_an_outcome(spark):
    log = spark.createDataFrame([(1, 1, "retry"), (1, 2, "done"), (1, 3, "done"), (2, 1, "retry"), (2, 2, "retry"), (2, 3, "retry"), (2, 4, "done")], "t int, k int, outcome string")
    tried = ledger.attempts(log, "t", "k")
    assert {r.t: (r.attempts, r.state) for r in ledger.states(tried, "t").collect()} == {1: (2, "record"), 2: (3, "exhausted")}


def test_ancestors(spark):
    edges = spark.createDataFrame([(4, 3), (3, 2), (2, 1), (9, 8)], "node long, above long")
    assert {tuple(r) for r in ancestors(edges).collect()} == {(4, 3), (4, 2), (4, 1), (3, 2), (3, 1), (2, 1), (9, 8)}


def test_gold_set_is_balanced():
    import pandas as pd

    rng = random.Random(4)
    pool = pd.DataFrame([{"qid": f"Q{k}", "media_type": rng.choice(("movie", "tv_series")), "region": rng.choice(("english", "korean")), "seed": k < 40, "plot": f"p{k % 4}", "arc": f"a{k % 3}", "fame": k % 50} for k in range(1, 300)])
    picks = gold.chosen(pool, 50, 0.3, 10)
    assert len(picks) == 50 and sum(p["media_type"] == "tv_series" for p in picks) == 15 and sum(p["region"] != "english" for p in picks) >= 10
    seeds = sum(p["seed"] for p in picks)
    assert seeds >= 30
    marked = gold.twice(picks, 10, frozenset({picks[1]["qid"], picks[7]["qid"]}))
    assert len(marked) == 10 and {1, 7} <= marked
    assert gold.twice([], 5) == set()
