"""Copies of whole documents go, however short; short repeats inside documents stay."""

from __future__ import annotations

from fabula.llm import chunk_dedup

SHORT, LONG = "one short line", "a line of fifty bytes and a few more, cut in chunks"
DATA = [(1, SHORT), (2, SHORT), (3, f"{SHORT} and other words after it"), (4, "é"), (5, "é"), (6, LONG), (7, LONG), (8, ""), (9, None), (10, "alone"), (None, SHORT)] + [(k, SHORT) for k in range(20, 40)]
GONE = {2, 5, 7, None, *range(20, 40)}


def test_short_copies_are_removed(spark):
    got = chunk_dedup.chunk_dedup(spark.createDataFrame(DATA, "doc_id long, text string")).collect()
    assert len(got) == len(DATA)
    assert all(r.n_removed == (r.n_bytes if r.doc_id in GONE else 0) and r.n_spans == (r.doc_id in GONE) for r in got)


def test_their_rows_go(spark):
    got = chunk_dedup.deduplicated(spark.createDataFrame(DATA, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: t for i, t in DATA if i not in GONE}
