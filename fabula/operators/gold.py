"""The gold set: a greedy, balanced choice, and which of it is labelled twice.

Each pick depends on counters that all earlier picks move, so it is one ordered fold over what can be
chosen at all: the first rows of each cell, alike in all that the counters look at. Rows: qid, media_type, region, seed, plot, arc, fame."""

from __future__ import annotations

from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Titles, share of series, fewest regional titles, titles labelled twice.
TITLES, SERIES_SHARE, REGIONAL, DOUBLE = 100, 0.3, 20, 25
OUT = "place int, qid string, media_type string, region string, plot string, arc string, double_label boolean"


def choosable(rows: DataFrame, order: list[Column], n: int = TITLES) -> DataFrame:
    """All that n picks can reach: of rows that differ only in fame and number, the first n. order: by fame and number."""
    cell = Window.partitionBy("media_type", "seed", F.col("region") == "english", F.when(F.col("seed"), F.col("plot")), F.when(F.col("seed"), F.col("arc")))
    return rows.withColumn("of_cell", F.dense_rank().over(cell.orderBy(*order))).where(F.col("of_cell") <= n).drop("of_cell")  # limited by cell in each task before the shuffle


def chosen(pool: pd.DataFrame, n: int = TITLES, series_share: float = SERIES_SHARE, regional_min: int = REGIONAL) -> list[dict]:
    """Picks in order: a media type that still lacks titles, seeds, regional titles until there are enough, the rarest plot and arc so far
    (seeds only), fame, the smaller number."""
    series = round(n * series_share)
    lack = Counter({"tv_series": series, "movie": n - series})
    plots, arcs, regional, out = Counter(), Counter(), 0, []
    cells = defaultdict(deque)
    for r in sorted({r["qid"]: r for r in pool.to_dict("records")}.values(), key=lambda r: (-r["fame"], int(r["qid"][1:]))):
        cells[r["media_type"], r["seed"], r["region"] == "english", *((r["plot"], r["arc"]) if r["seed"] else ())].append(r)
    while cells and len(out) < n:

        def rank(r: dict) -> tuple:
            balance = (plots[r["plot"]], arcs[r["arc"]]) if r["seed"] else (0, 0)
            return (lack[r["media_type"]] <= 0, not r["seed"], regional < regional_min and r["region"] == "english", *balance, -r["fame"], int(r["qid"][1:]))

        at = min(cells, key=lambda c: rank(cells[c][0]))
        pick = cells[at].popleft()
        if not cells[at]:
            del cells[at]
        lack[pick["media_type"]] -= 1
        regional += pick["region"] != "english"
        if pick["seed"]:
            plots[pick["plot"]] += 1
            arcs[pick["arc"]] += 1
        out.append(pick)
    return out


def twice(picks: list[dict], k: int = DOUBLE, forced: frozenset[str] = frozenset()) -> set[int]:
    """Evenly spaced places; a forced title takes its mark from the nearest marked film that is not forced, else from any such title."""
    k, n = min(k, len(picks)), len(picks)
    marked = {i * n // k for i in range(k)} if k else set()
    for i in (i for i, r in enumerate(picks) if k and r["qid"] in forced and i not in marked):
        free = [j for j in sorted(marked) if picks[j]["qid"] not in forced]
        givers = [j for j in free if picks[j]["media_type"] == "movie"] or free
        if not givers:
            break
        marked = marked - {min(givers, key=lambda j: abs(j - i))} | {i}
    return marked


def select(pool: DataFrame, n: int = TITLES, forced: frozenset[str] = frozenset()) -> DataFrame:
    """pool: what ``choosable`` leaves, in one task."""

    columns = pool.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        picks = chosen(pd.concat(rows), n) if rows else []
        marked = twice(picks, DOUBLE, forced)
        names = [c.split()[0] for c in OUT.split(", ")]
        yield pd.DataFrame([{**r, "place": i + 1, "double_label": i in marked} for i, r in enumerate(picks)], columns=sorted({*names, *columns}))[names]

    return pool.coalesce(1).mapInPandas(run, OUT)
