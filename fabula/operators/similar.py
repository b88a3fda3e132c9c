"""The rows most alike to each query by cosine: exact, all rows against all queries, block by block.

Rows are dealt into parts and queries into blocks by a hash of their id; each pair of a part and a block is one group, and works on
numbers in place of Column expressions, which take some hundred times as long for each pair of vectors. A product of
matrices in single precision finds what may be among the best; cosines of these are taken anew, summed in the order of the vectors' components, and
rounded half away from zero in binary: the numbers that SQL compares. Best answers of the groups meet in a window by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a part and queries of a block at most, in the mean; rows of a part that are worth a task; parts wanted: so many that queries, a fiftieth of the rows, are not sent more often than rows are; pairs at once; pairs of which the greatest stands for all.
PART_ROWS, LEAST_ROWS, PARTS, AT_ONCE, GROUP = 1 << 16, 1 << 10, 48, 1 << 21, 64
#: Places of what is no number among cosines: first what is NaN, then numbers, then what is null; last the query itself, which is no answer.
NAN, NULL, SELF = 2.0, -2.0, -3.0


class Vectors:
    """Vectors of a table that is not empty, in order of their ids, as columns of x. size: of each, or -1 where it is null or holds nulls."""

    def __init__(self, t: pa.Table, width: int) -> None:
        t = t.sort_by("vec_id")
        self.id = t["vec_id"].to_numpy()
        v = pa.concat_arrays(t["embedding"].chunks)
        flat, sizes = v.flatten(), sizes_of(v)
        x = np.zeros((len(v), width))
        x[np.arange(width) < sizes[:, None]] = flat.to_numpy(zero_copy_only=False)
        self.size = sizes.copy()
        if flat.null_count:
            self.size[np.repeat(np.arange(len(v)), np.maximum(sizes, 0))[flat.is_null().to_numpy(zero_copy_only=False)]] = -1
        self.x = np.ascontiguousarray(x.T)
        self.norm = np.sqrt(dots(self.x, self.x))
        self.odd = ~(np.isfinite(self.norm) & (self.norm > 0))  # no cosine, whatever the other vector
        self.unit = np.where(self.odd, 0, self.x / np.where(self.odd, 1, self.norm)).astype(np.float32)


def slack(width: int, places: int) -> float:
    """Twice what a product of unit vectors in single precision may be off (its terms and eight roundings more), and what rounding makes equal."""
    return (width + 8) * 2.0**-23 + 2 * 10.0**-places


def sizes_of(v: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(pc.fill_null(pc.list_value_length(v), -1))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of columns, summed component by component."""
    s = np.zeros(a.shape[1])
    for x, y in zip(a, b, strict=True):
        s += x * y
    return s


def half_away(x: np.ndarray, places: int) -> np.ndarray:
    y = x * 10.0**places
    whole = np.trunc(y)
    return (whole + np.copysign(np.abs(y - whole) >= 0.5, y)) / 10.0**places + 0.0


def best(rows: pa.Table, asked: pa.Table, k: int, places: int) -> pa.Table:
    """The k best rows of this part for each query of this block, ties to smaller vec_id; s: rounded cosines."""
    width = max([0, *(int(sizes_of(t["embedding"]).max()) for t in (rows, asked) if len(t))])
    out: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool))]
    with np.errstate(all="ignore"):
        if len(rows) and len(asked):
            r, q = Vectors(rows, width), Vectors(asked, width)
            step = max(1, AT_ONCE // len(rows))
            out += [_best(r, q, slice(i, i + step), k, places) for i in range(0, len(asked), step)]
    query_id, vec_id, s, null = map(np.concatenate, zip(*out, strict=True))
    return pa.table({"query_id": query_id, "vec_id": vec_id, "s": pa.array(s, mask=null)})


def _best(r: Vectors, q: Vectors, at: slice, k: int, places: int) -> tuple[np.ndarray, ...]:
    ids, size, x, norm, n = q.id[at], q.size[at], q.x[:, at], q.norm[at], len(r.id)
    groups = -(-n // GROUP)
    s = np.full((len(ids), groups * GROUP), SELF, np.float32)
    s[:, :n] = q.unit[:, at].T @ r.unit
    s[:, :n][:, r.odd] = NAN
    s[q.odd[at], :n] = NAN
    if (size != len(x)).any() or (r.size != len(x)).any():
        s[:, :n][(size[:, None] != r.size) | (size[:, None] < 0)] = NULL
    own = np.searchsorted(r.id, ids, "left"), np.searchsorted(r.id, ids, "right")
    for j in np.flatnonzero(own[0] < own[1]):
        s[j, own[0][j] : own[1][j]] = SELF
    grouped = s.reshape(len(ids), GROUP, groups)
    most = grouped.max(axis=1)
    # k groups hold a pair of the k-th greatest value at least, so k pairs do
    least = np.partition(most, groups - k, axis=1)[:, groups - k] - np.float32(slack(len(x), places)) if groups >= k else np.full(len(ids), SELF)
    j, g = np.nonzero(most >= least[:, None])
    hit, i = np.nonzero(grouped[j, :, g] >= least[j][:, None])
    j, i = j[hit], i * groups + g[hit]
    place = s[j, i]
    j, i, place = j[place != SELF], i[place != SELF], place[place != SELF]
    score = half_away(dots(x[:, j], r.x[:, i]) / (norm[j] * r.norm[i]), places)
    place = np.where(place == NULL, NULL, np.where(np.isnan(score), NAN, score))
    order = np.lexsort((i, -place, j))  # rows lie in the order of their ids
    j, i, score, place = j[order], i[order], score[order], place[order]
    keep = np.arange(len(j)) - np.searchsorted(j, j) < k
    return ids[j[keep]], r.id[i[keep]], score[keep], place[keep] == NULL


def most_similar(df: DataFrame, asked: str, k: int, places: int = 9) -> DataFrame:
    """query_id, rank, vec_id: for each row that the condition picks the k others of the greatest cosine, rounded; ties to smaller
    vec_id. Vectors without a direction come first, as NaN is the greatest number; null ones, those that hold nulls and
    those of another size last. Of df, vec_id and embedding are read."""
    e = df.select("vec_id", "embedding").where("vec_id is not null")
    n, m = e.agg(F.count("*"), F.count_if(F.expr(asked))).first()
    parts, blocks = max(1, min(PARTS, n // LEAST_ROWS), -(-n // PART_ROWS)), max(1, -(-m // PART_ROWS))
    one = lambda of: F.pmod(F.xxhash64("vec_id"), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    rows = e.withColumn("part", one(parts)).withColumn("block", every(blocks))
    queries = e.where(asked).withColumn("block", one(blocks)).withColumn("part", every(parts))
    p = rows.groupBy("part", "block").cogroup(queries.groupBy("part", "block")).applyInArrow(lambda a, b: best(a, b, k, places), "query_id long, vec_id long, s double")
    w = Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id")
    return p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "vec_id")
