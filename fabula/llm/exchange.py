"""Which keys has another part of the corpus too? The shuffle that three operators share.

Documents are dealt once into buckets by ranges of doc_id, so a smaller bucket number means
smaller ids. The ranges are cut by bytes: a bucket holds at most one document more than the wanted
size, however long its neighbours are. A bucket publishes the distinct keys of its documents
(hashes of windows, chunks or shingles), sorted and cut by their leading digit into packed rows;
all rows of one digit meet in one task, which answers each bucket with one byte per key in the order
published. No document id and no key's list of holders ever travels: a key that a third of all
documents hold still counts once per bucket, so no task sees more than (buckets x keys of a digit)
entries. Where 64 bits decide, 32 more are sent as a check, so that equality is that of 96 bits.

There are at most MOST_BUCKETS buckets, and a digit for every DIGIT_SHARE of them: beyond
MOST_BUCKETS * BUCKET_BYTES (1.5 TB) buckets grow with the table, and with them the memory of a task,
about twelve times its text. Packed rows number buckets x digits, as blocks of any shuffle do.

The dealt documents are one exchange that all steps of a plan reuse.

A bucket holds whole documents; all rows of one doc_id are in one. Rows without doc_id are dealt by
hash of text into buckets of their own, from NULL_BUCKET on; they count as larger than all others,
and none of them as smaller than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabula.llm.memory import freeing
from fabula.llm.scratch import written

#: Text bytes in a bucket; a task holds one bucket and its arrays.
BUCKET_BYTES = 6 << 20
#: Most buckets; buckets to a digit; fewest digits; ranges of ids in which bytes are added up; most partitions; bytes that a row counts for besides its text.
MOST_BUCKETS, DIGIT_SHARE, LEAST_DIGITS, CELLS, MOST_PARTITIONS, ROW_BYTES = 1 << 18, 4, 64, 2048, 1 << 15, 64
#: A null doc_id counts as larger than every other; the first bucket of rows without one.
NULL_ID, NULL_BUCKET = (1 << 63) - 1, 1 << 30
KEYS = "digit int, bucket int, n int, key binary, tag binary"
REPLY = "bucket int, digit int, reply binary"


@dataclass
class Bucketed:
    """rows: bucket, doc_id, body (binary) and what was asked for besides; buckets and digits: their numbers."""

    rows: DataFrame
    buckets: int
    digits: int


def _cell(at: Column, cuts: list[int]) -> Column:
    """The range that holds an id, by two levels, so that a row is compared with about 2 * sqrt(ranges) cuts."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    k = F.size(F.filter(F.lit(cuts[::step]), lambda x: x <= at))
    fine = F.slice(F.lit(cuts), (k - 1) * step + 1, F.lit(step))
    return F.when(k == 0, 0).otherwise((k - 1) * step + F.size(F.filter(fine, lambda x: x <= at)))


def bucketed(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, *more: str) -> Bucketed:
    """Deals documents into buckets by doc_id ranges. Null texts become empty."""
    at = F.col("doc_id").cast("long")
    # an id and its bytes: one small row for each document
    sizes = written(docs.select(at.alias("at"), (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).alias("size")).groupBy("at").agg(F.sum("size").alias("size")), "sizes")
    total, nulls, cuts = sizes.agg(
        F.sum("size"), F.sum(F.when(F.col("at").isNull(), F.col("size"))), F.percentile_approx("at", [i / CELLS for i in range(1, CELLS)], 10 * CELLS)
    ).first()  # at most CELLS numbers
    size = max(bucket_bytes, -(-int(total or 0) // MOST_BUCKETS))
    cuts = sorted(set(cuts or ()))
    before = F.sum("size").over(Window.partitionBy("cell").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.where("at is not null").withColumn("cell", _cell(F.col("at"), cuts)).withColumn("k", F.floor(F.coalesce(before, F.lit(0)) / size))
    starts = starts.groupBy("cell", "k").agg(F.min("at").alias("at"), F.sum("size").alias("size"))
    # at most MOST_BUCKETS + CELLS rows; short ends of neighbouring ranges share a bucket
    starts = sorted(tuple(r) for r in starts.select("at", "cell", "size").collect())
    by_cell: dict[int, list[list[int]]] = {}
    n, held = 0, 0
    for first, cell, bytes_ in starts:
        if held and held + bytes_ > size:
            n, held = n + 1, 0
        held += bytes_
        firsts, numbers = by_cell.setdefault(cell, [[], []])
        firsts.append(first)
        numbers.append(n)
    n += 1
    spark, null_buckets = docs.sparkSession, max(1, -(-int(nulls or 0) // size))
    cells = sorted(by_cell)
    table = spark.createDataFrame(pa.table({
        "cell": pa.array(cells, pa.int32()), "firsts": pa.array([by_cell[c][0] for c in cells], pa.list_(pa.int64())), "numbers": pa.array([by_cell[c][1] for c in cells], pa.list_(pa.int32())),
    }))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"), *more, F.when(at.isNotNull(), _cell(at, cuts)).alias("_cell"))
    rows = rows.join(F.broadcast(table), F.col("_cell") == F.col("cell"), "left")  # 12 bytes for each of those buckets
    bucket = F.element_at("numbers", F.size(F.filter("firsts", lambda x: x <= F.col("doc_id").cast("long"))))
    bucket = F.when(F.col("_cell").isNull(), NULL_BUCKET + F.pmod(F.xxhash64("body"), F.lit(null_buckets))).otherwise(bucket).cast("int")
    rows = rows.withColumn("bucket", bucket).select("bucket", "doc_id", "body", *more)
    n += null_buckets if nulls else 0
    return Bucketed(rows.repartition(min(n, MOST_PARTITIONS), "bucket"), n, max(LEAST_DIGITS, -(-n // DIGIT_SHARE)))


def bodies(table: pa.Table, column: str = "body") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in one buffer, and the offsets of its rows."""
    col = table.column(column).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.binary())
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0] : off[-1]] if len(col) else np.zeros(0, np.uint8)
    return data, off - off[0]


def doc_ids(table: pa.Table) -> np.ndarray:
    return np.array([NULL_ID if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)


def ranks(ids: np.ndarray) -> np.ndarray:
    """Dense ranks: rows of one doc_id share theirs."""
    return np.unique(ids, return_inverse=True)[1].astype(np.int64)


def pieces(off: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes, one document at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def digits(keys: np.ndarray, n: int) -> np.ndarray:
    """The leading digit of 64-bit keys in base n; grows with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _wide(x: np.ndarray) -> np.ndarray:
    """48-bit numbers in six bytes each: four low, then two high."""
    out = np.empty((len(x), 6), np.uint8)
    out[:, :4] = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[:, 4:] = (x >> np.uint64(32)).astype("<u2").view(np.uint8).reshape(-1, 2)
    return out


def planes(x: np.ndarray) -> bytes:
    """Numbers as byte planes, the lowest first, as many as the largest needs: high planes of small numbers are all alike and pack well."""
    wide = -(-int(x.max()).bit_length() // 8) or 1
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()


def from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    rows = np.frombuffer(data, np.uint8).reshape(-1, n)
    out[:, : len(rows)] = rows.T
    return out.view("<u8").ravel()


def publish(bucket: int, keys: np.ndarray, n: int, tag: np.ndarray | None = None, bits: int = 64) -> pa.Table:
    """Packed rows of sorted distinct keys, as differences; bits: 48 or 64, from the top. tag: what goes with the keys, a 48-bit number as uint64, or a check as uint32."""
    cut = np.searchsorted(digits(keys, n), np.arange(n + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(cut))
    short = keys >> np.uint64(64 - bits)
    tags = b"" if tag is None else (_wide(tag) if tag.dtype == np.uint64 else tag.astype("<u4")).tobytes()
    width = 0 if tag is None else 6 if tag.dtype == np.uint64 else 4
    return pa.table({
        "digit": pa.array(full, pa.int32()), "bucket": pa.array(np.full(len(full), bucket), pa.int32()), "n": pa.array(np.diff(cut)[full], pa.int32()),
        "key": pa.array([planes(np.append(short[cut[k]], np.diff(short[cut[k] : cut[k + 1]]))) for k in full], pa.binary()),
        "tag": pa.array([tags[width * cut[k] : width * cut[k + 1]] for k in full], pa.binary()),
    })


@dataclass
class Meeting:
    """The keys of one digit: key, tag and bucket of each entry; groups of equal keys (and checks) that more than one bucket holds."""

    key: np.ndarray
    tag: np.ndarray | None
    bucket: np.ndarray
    rows: list[tuple[int, int, int]]
    order: np.ndarray
    starts: np.ndarray


def equal_groups(key: np.ndarray, check: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit radix passes over 64-bit keys, then over 32-bit checks: entries that are
    alone after a pass leave, so later digits are only looked at inside groups that still tie. Returns
    the entries that remain, group by group, and the groups' starts."""
    alive = np.arange(len(key))
    group = np.zeros(len(key), np.uint64)
    passes = [lambda at: key[at] >> np.uint64(32), lambda at: key[at] & np.uint64(0xFFFFFFFF)]
    if check is not None:
        passes.append(lambda at: check[at].astype(np.uint64))
    for digit in passes:
        whole = (group << np.uint64(32)) | digit(alive)
        o = np.argsort(whole)
        whole = whole[o]
        first = np.ones(len(whole), bool)
        first[1:] = whole[1:] != whole[:-1]
        starts = np.flatnonzero(first)
        size = np.diff(np.append(starts, len(whole)))
        keep = np.repeat(size > 1, size)
        alive = alive[o][keep]
        group = np.repeat(np.arange(int((size > 1).sum()), dtype=np.uint64), size[size > 1])
        if not len(alive):
            break
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    return alive, np.flatnonzero(first)


def meet(table: pa.Table) -> Meeting:
    counts, buckets = np.asarray(table.column("n")), np.asarray(table.column("bucket"))
    total, cut = int(counts.sum()), np.append(0, np.cumsum(counts))
    key = np.empty(total, np.uint64)
    for k, data in enumerate(table.column("key")):
        np.cumsum(from_planes(data.as_buffer(), int(counts[k])), out=key[cut[k] : cut[k + 1]])
    tags = bodies(table, "tag")[0]
    tag = check = None
    if len(tags) == 6 * total:
        six = tags.reshape(-1, 6)
        tag = np.ascontiguousarray(six[:, :4]).view("<u4").ravel().astype(np.uint64) | (np.ascontiguousarray(six[:, 4:]).view("<u2").ravel().astype(np.uint64) << np.uint64(32))
    elif len(tags):
        check = tags.view("<u4")
    order, starts = equal_groups(key, check)
    return Meeting(key, tag, np.repeat(buckets, counts), list(zip(buckets.tolist(), table.column("digit").to_pylist(), counts.tolist(), strict=True)), order, starts)


def answer(m: Meeting, reply: np.ndarray) -> pa.Table:
    cut = np.cumsum([0] + [n for *_, n in m.rows])
    return pa.table({
        "bucket": pa.array([b for b, *_ in m.rows], pa.int32()), "digit": pa.array([d for _, d, _ in m.rows], pa.int32()),
        "reply": pa.array([reply[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
    })


def earlier(m: Meeting) -> np.ndarray:
    """By entry in m.order: whether a smaller bucket has the key too. Rows without id are alike."""
    size = np.diff(np.append(m.starts, len(m.order)))
    bucket = np.minimum(m.bucket[m.order], NULL_BUCKET)
    return bucket > np.repeat(np.minimum.reduceat(bucket, m.starts), size)


def resolve_earlier(table: pa.Table) -> pa.Table:
    """1 where a smaller bucket holds the key too, else 0."""
    m = meet(table)
    reply = np.zeros(len(m.key), np.uint8)
    if len(m.starts):
        reply[m.order] = earlier(m)
    return answer(m, reply)


def resolve_later(table: pa.Table) -> pa.Table:
    """The same, but buckets of rows without id have an order as well: one bucket of all gets 0."""
    m = meet(table)
    reply = np.zeros(len(m.key), np.uint8)
    if len(m.starts):
        bucket = m.bucket[m.order]
        reply[m.order] = bucket > np.repeat(np.minimum.reduceat(bucket, m.starts), np.diff(np.append(m.starts, len(m.order))))
    return answer(m, reply)


def resolve_count(table: pa.Table) -> pa.Table:
    """By how many buckets the key is held, 255 at most."""
    m = meet(table)
    reply = np.ones(len(m.key), np.uint8)
    if len(m.starts):
        size = np.diff(np.append(m.starts, len(m.order)))
        reply[m.order] = np.repeat(np.minimum(size, 255), size)
    return answer(m, reply)


#: Answers to a second question carry digits from here on.
LATE = 1 << 24


def late(resolver):
    def run(table: pa.Table) -> pa.Table:
        out = resolver(table)
        return out.set_column(1, "digit", pa.array(np.asarray(out.column("digit")) + LATE, pa.int32()))

    return run


def parts(reply: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The answers to the first question, and to the second."""
    second = np.asarray(reply.column("digit")) >= LATE
    return reply.filter(pa.array(~second)), reply.filter(pa.array(second))


def replies(table: pa.Table) -> np.ndarray:
    """The bytes of all answers to a bucket, in the order of its sorted keys."""
    rows = sorted(zip(table.column("digit").to_pylist(), table.column("reply").to_pylist(), strict=True))
    return np.frombuffer(b"".join(x for _, x in rows), np.uint8)


def ask(dealt: Bucketed, publisher, resolver) -> DataFrame:
    """publisher: table of a bucket -> packed rows; resolver: rows of a digit -> answers."""
    return dealt.rows.groupBy("bucket").applyInArrow(freeing(publisher), KEYS).groupBy("digit").applyInArrow(freeing(resolver), REPLY)


def ask_again(dealt: Bucketed, reply: DataFrame, publisher, resolver) -> DataFrame:
    """The same, where the publisher(table of a bucket, its answers) knows answers to a first question. Returns both questions' answers."""
    asked = dealt.rows.groupBy("bucket").cogroup(reply.groupBy("bucket")).applyInArrow(freeing(publisher), KEYS)
    return reply.unionByName(asked.groupBy("digit").applyInArrow(freeing(late(resolver)), REPLY))


def with_replies(dealt: Bucketed, reply: DataFrame, fn, schema: str) -> DataFrame:
    """fn(table of a bucket, its answers) -> rows."""
    return dealt.rows.groupBy("bucket").cogroup(reply.groupBy("bucket")).applyInArrow(freeing(fn), schema)
