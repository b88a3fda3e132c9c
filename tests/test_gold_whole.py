"""The gold set is chosen from all documents."""

from __future__ import annotations

from collections import Counter

from fabula.catalogue import QUERIES
from fabula.plans import selection

SF = "/root/testdata/sf0.01"


def test_gold_set_equals_a_choice_from_all_rows(spark):
    labelled = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()}
    left = [(r.id, "tv_series" if r.id % 4 == 0 else "movie", r.id in labelled, r.genre == "en", r.cell, r.genre, r.fame) for r in selection._items(spark, SF).collect()]
    assert len(left) == 1000
    lack, plots, arcs, regional, want = Counter(tv_series=30, movie=70), Counter(), Counter(), 0, []
    for _ in range(100):
        pick = min(left, key=lambda r: (lack[r[1]] <= 0, not r[2], regional < 20 and r[3], *((plots[r[4]], arcs[r[5]]) if r[2] else (0, 0)), -r[6], r[0]))
        left.remove(pick)
        lack[pick[1]] -= 1
        regional += not pick[3]
        if pick[2]:
            plots[pick[4]] += 1
            arcs[pick[5]] += 1
        want.append(f"Q{pick[0]}")
    got = sorted(QUERIES["gold_greedy"](spark, SF).collect())
    assert [r.qid for r in got] == want
