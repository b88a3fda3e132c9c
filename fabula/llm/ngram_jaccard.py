"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

1. Equal sets collapse into one, named by its smallest doc_id (an exchange of set digests).
2. The distinct sets ask by how many buckets each of their shingles is held. Shingles are
   ordered by that number, then by hash, the same for every set; two linked sets share a
   shingle among the first n - ceil(0.8 n) + 1 of each. A set all of whose first shingles
   are its own has no link and leaves here, which is the fate of nearly all.
3. Rounds of links with representatives. Of the sets that hold a first shingle the smallest is its
   leader; every other one is compared with it, once for each leader, and linked sets become one
   class. A shingle whose holders are all of one class is done, and a hot family of near copies
   ends here, in joins that adaptive execution splits. Where other classes hold the shingle too, the
   distances to the leader are known answers: by the triangle inequality a set of the leader's
   class can only be linked with another class if it is far enough from the leader. What remains is active.
4. Active sets that share a first shingle form families, in which the join skips by set relations. Index
   level: posting lists, by shingle and group, are blocks ordered by set size; a block is skipped
   when its largest set is too small or its first position leaves too few shingles. Answer
   level: each group has a leader, a highly similar set whose distances to its members are known
   answers. One comparison with a leader decides a whole group: if linked, the sets are one
   component; if not, the triangle inequality excludes all members whose known distance is too
   far from the new one, and only the rest are compared. Sets of one class are never compared.
   A family of more than FAMILY_BYTES of active sets is joined block by block, all pairs of blocks.

Equality of sets is that of 96 bits of their digests. Shingles have 64 bits; which are shared is told by 48,
and a false "shared" only adds a comparison. Nulls, empty texts and texts without words have empty
sets and are linked with nothing, not even with each other. Rows of one doc_id with different texts are
documents of their own. Documents without doc_id have links like others, so sets that they connect are
connected; their component is null in the result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm import exchange as X
from fabula.llm import hashing as H
from fabula.llm.graph import components
from fabula.llm.memory import release, releasing
from fabula.llm.scratch import written

#: Words of a shingle; the least similarity, as a ratio of whole numbers; bytes of a family, and of a block of a larger one.
WORDS, NUM, DEN, FAMILY_BYTES = 5, 80, 100, 32 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, row by row in ascending order, and the offsets of rows."""
    parts, sizes = [np.zeros(0, np.uint64)], np.zeros(len(off) - 1, np.int64)
    for i, j in X.pieces(off):
        buf = _LOWER[data[off[i] : off[j]]]
        if not len(buf):
            continue
        edge = np.zeros(len(buf) + 1, bool)
        edge[off[i : j + 1] - off[i]] = True
        word = ~_SPACE[buf]
        before, after = np.append(False, word[:-1]), np.append(word[1:], False)
        s = np.flatnonzero(word & (~before | edge[:-1]))
        e = np.flatnonzero(word & (~after | edge[1:])) + 1
        if not len(s):
            continue
        hw = H.prefix(H.between(H.prefix(buf), s, e))
        row = np.searchsorted(off[i + 1 : j + 1] - off[i], s, "right")
        count = np.bincount(row, minlength=j - i)
        last = np.cumsum(count)
        n = np.maximum(np.where(count > 0, 1, 0), count - WORDS + 1)
        at = np.repeat(last - count, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        of = np.repeat(np.arange(j - i), n)
        key = H.between(hw, at, np.minimum(at + WORDS, last[of]))
        o = np.argsort(key)
        o = o[np.argsort(of[o].astype(np.uint16) if j - i < 1 << 16 else of[o], kind="stable")]
        key, of = key[o], of[o]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
        parts.append(key[new])
        sizes[i:j] = np.bincount(of[new], minlength=j - i)
    return np.concatenate(parts), np.append(0, np.cumsum(sizes))


def digests(key: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set; 0 for empty ones."""
    out = []
    for salt in (0x51, 0xA7):
        total = np.append(np.uint64(0), np.cumsum(H.mix(key ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), dtype=np.uint64))
        out.append(H.mix(total[cut[1:]] - total[cut[:-1]] + np.diff(cut).astype(np.uint64)) * (np.diff(cut) > 0))
    return out[0], out[1]


def need(n: np.ndarray | int):
    """The least intersection of a linked pair of which one set has n shingles: ceil(0.8 n)."""
    return (NUM * n + DEN - 1) // DEN


SET = "doc_id long, node long, n int, h1 long, h2 long, shared binary, first binary"
#: Stand-ins for missing ids begin here.
STAND_IN = 1 << 62


class _Bucket:
    """What every step computes anew of a bucket: shingles of all rows, and which rows stand for their sets in it."""

    def __init__(self, table: pa.Table) -> None:
        self.ids = X.doc_ids(table)
        data, off = X.bodies(table)
        self.key, self.cut = shingles(data, off)
        self.h1, self.h2 = digests(self.key, self.cut)
        self.n = np.diff(self.cut)
        o = np.lexsort((self.ids, self.h2, self.h1))
        o = o[self.n[o] > 0]
        first = np.ones(len(o), bool)
        first[1:] = (self.h1[o][1:] != self.h1[o][:-1]) | (self.h2[o][1:] != self.h2[o][:-1])
        self.sets = o[first]  # rows, by digest

    def of_sets(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shingles of some rows with the row's place among them, all distinct ones, and the place among these of each."""
        n = self.n[rows]
        at = np.repeat(self.cut[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        key = self.key[at]
        o = np.argsort(key)
        new = np.ones(len(o), bool)
        new[1:] = key[o][1:] != key[o][:-1]
        entry = np.empty(len(o), np.int64)
        entry[o] = np.cumsum(new) - 1
        return key, np.repeat(np.arange(len(rows)), n), key[o][new], entry


def survivors(dealt: X.Bucketed) -> DataFrame:
    """Rows of SET: one for each row; where it stands for its set (the one of the smallest id does), node is a number that no other set has: doc_id, or a stand-in where doc_id is missing or names another text too. shared (hashes another set holds, sorted) and first (those among the set's first, in order, with their places) are there if the set may have a link."""
    n = dealt.digits

    def publish_sets(table: pa.Table) -> pa.Table:
        b = _Bucket(table)
        return X.publish(table.column("bucket")[0].as_py(), b.h1[b.sets], n, (b.h2[b.sets] >> np.uint64(32)).astype(np.uint32))

    def publish_shingles(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        b = _Bucket(table)
        known = b.of_sets(b.sets[X.replies(reply) == 0])[2]
        return X.publish(key[0].as_py(), known, n, bits=48)

    def finish(table: pa.Table, reply: pa.Table) -> pa.Table:
        b = _Bucket(table)
        one, two = X.parts(reply)
        rows = b.sets[X.replies(one) == 0]
        key, of, known, entry = b.of_sets(rows)
        held = X.replies(two)
        other = (held[entry] > 1) | (np.bincount(entry, minlength=len(known))[entry] > 1)
        o = np.argsort((held[entry].astype(np.uint64) << np.uint64(56)) | (key >> np.uint64(8)))
        o = o[np.argsort(of[o].astype(np.uint16) if len(rows) < 1 << 16 else of[o], kind="stable")]
        start = np.cumsum(b.n[rows]) - b.n[rows]
        place = np.arange(len(o)) - start[of[o]]
        lead = other[o] & (place < (b.n[rows] - need(b.n[rows]) + 1)[of[o]])
        shared, first = {}, {}
        for r in np.unique(of[o][lead]):
            a, z = start[r], start[r] + b.n[rows[r]]
            k = key[a:z]
            shared[rows[r]] = k[other[a:z]].tobytes()
            pick = a + np.flatnonzero(lead[a:z])
            first[rows[r]] = key[o[pick]].tobytes() + place[pick].astype(np.uint32).tobytes()
        node = np.full(len(b.n), -1, np.int64)
        node[rows] = (b.h1[rows] >> np.uint64(2)).astype(np.int64) | STAND_IN
        once = rows[np.unique(b.ids[rows], return_index=True)[1]]
        once = once[b.ids[once] != X.NULL_ID]
        node[once] = b.ids[once]
        standing = np.zeros(len(b.n), bool)
        standing[rows] = True
        every = range(len(b.n))
        return pa.table({
            "doc_id": table.column("doc_id"), "node": pa.array(node, mask=~standing), "n": pa.array(b.n, pa.int32()), "h1": pa.array(b.h1.view(np.int64)), "h2": pa.array(b.h2.view(np.int64)),
            "shared": pa.array([shared.get(r) for r in every], pa.binary()), "first": pa.array([first.get(r) for r in every], pa.binary()),
        })

    own = X.ask(dealt, publish_sets, X.resolve_later)
    return X.with_replies(dealt, X.ask_again(dealt, own, publish_shingles, X.resolve_count), finish, SET)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, keys = [], []
        for i, first in zip(b.column("node").to_pylist(), b.column("first").to_pylist(), strict=True):
            k = np.frombuffer(first, np.int64, len(first) // 12)
            keys.append(k)
            ids.append(np.full(len(k), i, np.int64))
        if ids:
            yield pa.record_batch({"token": pa.array(np.concatenate(keys)), "id": pa.array(np.concatenate(ids))})


class Family:
    """The join of step 4 over one family. Sets come in ascending size; ``root`` gives components by position."""

    BLOCK = 64

    def __init__(self) -> None:
        self.n: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.parent: list[int] = []
        self.leader: list[int] = []
        self.far: list[float] = []  # distance to the leader
        # shingle -> leader -> blocks: [sizes, places, positions], sizes ascending
        self.index: dict[int, dict[int, list[list[list[int]]]]] = {}
        self.classes: dict[int, int] = {}
        self.compared = 0

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def distance(self, x: int, y: int) -> tuple[float, bool]:
        """Jaccard distance, and whether the two are linked."""
        self.compared += 1
        both = len(np.intersect1d(self.tokens[x], self.tokens[y], assume_unique=True))
        union = self.n[x] + self.n[y] - both
        return 1 - both / union, DEN * both >= NUM * union

    def union(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        self.parent[max(a, b)] = min(a, b)

    def members(self, x: int, first: list[tuple[int, int]], leader: int, d: float, cross: list[bool] | None) -> set[int]:
        """Members of a group that may be linked with x: by shingle, size, place and the leader's answers."""
        out: set[int] = set()
        n, least = self.n[x], need(self.n[x])
        slack = 1 - NUM / DEN + 1e-9
        for token, place in first:
            for sizes, places, at in self.index.get(token, {}).get(leader, ()):
                if sizes[-1] < least or min(n - place, sizes[-1] - places[0]) < least:
                    continue  # the block's largest set is too small, or too few shingles follow
                for k in range(bisect_left(sizes, least), len(sizes)):
                    y = at[k]
                    if abs(self.far[y] - d) <= slack and (cross is None or cross[x] != cross[y]):
                        out.add(y)
        return out

    def add(self, n: int, tokens: np.ndarray, first: list[tuple[int, int]], cross: list[bool] | None = None, known: int | None = None) -> None:
        """known: the set's class, if it has one already."""
        x = len(self.n)
        self.n.append(n)
        self.tokens.append(tokens)
        self.parent.append(x)
        if known is not None:
            self.union(x, self.classes.setdefault(known, x))
        groups = sorted({g for token, _ in first for g in self.index.get(token, ())})
        best, nearest = x, 2.0
        for g in groups:
            if self.root(g) == self.root(x):
                continue
            d, linked = self.distance(x, g)
            if linked and (cross is None or cross[x] != cross[g]):
                self.union(x, g)
            if d < nearest and linked:
                best, nearest = g, d
            if self.root(g) == self.root(x):
                continue
            for y in self.members(x, first, g, d, cross):
                if y != g and self.root(y) != self.root(x) and self.distance(x, y)[1]:
                    self.union(x, y)
        self.leader.append(best)
        self.far.append(nearest if best != x else 0.0)
        for token, place in first:
            blocks = self.index.setdefault(token, {}).setdefault(best, [])
            if not blocks or len(blocks[-1][0]) >= self.BLOCK:
                blocks.append([[], [], []])
            sizes, places, at = blocks[-1]
            sizes.append(n)
            places.append(min(place, places[0]) if places else place)
            places[0] = min(places[0], place)
            at.append(x)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family and block pair -> (id, root) within each; of a pair of two blocks only links across count."""
    key, rows = None, []

    def flush() -> pa.RecordBatch:
        fam, order = Family(), sorted(rows, key=lambda r: (r[1], r[0]))
        cross = [r[4] == r[5] for r in order] if key[1] != key[2] else None
        for _, n, shared, first, *_, known in order:
            m = len(first) // 12
            fam.add(n, np.frombuffer(shared, np.uint64), list(zip(np.frombuffer(first, np.int64, m).tolist(), np.frombuffer(first, np.uint32, m, 8 * m).tolist(), strict=True)), cross, known)
        ids, least = [r[0] for r in order], {}
        for k, i in enumerate(ids):
            r = fam.root(k)
            least[r] = min(least.get(r, i), i)
        return pa.record_batch({"id": pa.array(ids, pa.int64()), "root": pa.array([least[fam.root(k)] for k in range(len(ids))], pa.int64())})

    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("family", "x", "y", "node", "n", "shared", "first", "block", "class")), strict=True):
            if r[:3] != key:
                if rows:
                    yield flush()
                key, rows = r[:3], []
            rows.append((*r[3:7], r[7], r[1], r[8]))
    if rows:
        yield flush()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sets -> their Jaccard distance, and whether they are linked."""
    for b in batches:
        far, linked = [], []
        for n, x, m, y in zip(*(b.column(c).to_pylist() for c in ("n", "shared", "m", "other")), strict=True):
            both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            far.append(1 - both / (n + m - both))
            linked.append(DEN * both >= NUM * (n + m - both))
        yield pa.record_batch({"id": b.column("id"), "low": b.column("low"), "far": pa.array(far, pa.float64()), "linked": pa.array(linked, pa.bool_())})


def _roots(links: DataFrame) -> DataFrame:
    """id, root of all ids on links (a, b) of two different ids."""
    return components(links).select(F.col("node").alias("id"), "root")


def _facts(rows: DataFrame, by_token: DataFrame) -> DataFrame:
    """rows with what is known of their shingle. Adaptive execution splits the shingles that very many sets hold; for that the facts are a table of their own and the join a merge."""
    return rows.join(written(by_token, "facts").hint("merge"), "token")


def linked(sets: DataFrame, family_bytes: int = FAMILY_BYTES) -> DataFrame:
    """sets: rows of SET with first, one for each set. Returns id, root of sets (by node), at least of those that are linked."""
    tokens = sets.select("node", "first").mapInArrow(releasing(_tokens), "token long, id long")
    least = tokens.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("token", "low")
    tokens = written(_facts(tokens, least), "tokens")
    # step 3: each set with the leaders of its shingles
    pairs = tokens.where("id <> low").select("id", "low").distinct()
    light = sets.select("node", "n", "shared")
    pairs = pairs.join(light.withColumnRenamed("node", "id"), "id").join(light.select(F.col("node").alias("low"), F.col("n").alias("m"), F.col("shared").alias("other")), "low")
    pairs = written(pairs.select("id", "low", "n", "shared", "m", "other").mapInArrow(releasing(_compared), "id long, low long, far double, linked boolean"), "stars")
    classes = written(_roots(pairs.where("linked").select(F.col("id").alias("a"), F.col("low").alias("b"))), "classes")
    held = tokens.join(pairs.select("id", "low", "far"), ["id", "low"], "left").join(classes.withColumnRenamed("root", "class"), "id", "left")
    held = written(held.select("token", "id", "low", F.coalesce("far", F.lit(0.0)).alias("far"), F.coalesce("class", "id").alias("class")), "held")
    by_class = held.groupBy("token", "class").agg(F.min("far").alias("far"), F.max(F.col("id") == F.col("low")).alias("leads"))
    rivals = by_class.groupBy("token").agg(F.max(F.when(F.col("leads"), F.col("class"))).alias("own"), F.min(F.when(~F.col("leads"), F.col("far"))).alias("nearest")).where("nearest is not null")
    reach = F.col("nearest") - (1 - NUM / DEN) - 1e-9
    active = written(_facts(held, rivals).where((F.col("class") != F.col("own")) | (F.col("far") >= reach)).select("token", "id", "class"), "active")
    if active.isEmpty():
        return classes
    # step 4: what may still be linked across classes
    low = active.groupBy("token").agg(F.min("id").alias("low"))
    families = written(_roots(_facts(active, low).where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))), "families")
    known = active.select("id", "class").distinct()
    rows = sets.join(families.join(known, "id").select(F.col("id").alias("node"), F.col("root").alias("family"), "class"), "node")
    blocks = rows.groupBy("family").agg(F.ceil(F.sum(F.octet_length("shared") + F.octet_length("first")) / family_bytes).cast("int").alias("blocks"))
    rows = rows.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    dealt = rows.select("family", "x", "y", "node", "n", "shared", "first", "block", "class").repartition("family", "x", "y").sortWithinPartitions("family", "x", "y")
    found = dealt.mapInArrow(releasing(_links), "id long, root long")
    return _roots(found.union(classes).toDF("a", "b"))


def jaccard_components(docs: DataFrame, bucket_bytes: int = X.BUCKET_BYTES, family_bytes: int = FAMILY_BYTES) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_shingles, component_id, set_id (smallest doc_id of the documents of the same set; its own for empty sets), one row per input row."""
    table = written(survivors(X.bucketed(docs, bucket_bytes)), "sets")
    found = linked(table.where("first is not null"), family_bytes)
    light = table.select("doc_id", "node", "n", "h1", "h2")
    sets = light.where("n > 0").groupBy("h1", "h2", "n").agg(F.max("node").alias("node"), F.min("doc_id").alias("set_id"))
    roots = found.where("id <> root")
    roots = roots.union(roots.select("root", "root").distinct()).select(F.col("id").alias("node"), "root")
    sets = sets.join(roots, "node", "left")
    names = sets.where("root is not null").groupBy("root").agg(F.min("set_id").alias("name"))
    sets = sets.join(names, "root", "left").select("h1", "h2", "n", "set_id", F.coalesce("name", "set_id").alias("component"))
    out = light.join(sets, ["h1", "h2", "n"], "left")
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(known, F.coalesce("component", "doc_id")).alias("component_id"), F.when(known, F.coalesce("set_id", "doc_id")).alias("set_id"),
    )


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
