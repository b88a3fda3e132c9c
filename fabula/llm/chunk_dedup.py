"""Substring dedup by content-defined chunking.

A gear rolling hash cuts each text where the last GEAR bytes say so, so an insertion
moves no cut but those near it. A chunk's digest is compared with those of all other
documents (see exchange), and the document of the smallest doc_id keeps it. Runs of
neighbouring chunks that an earlier document has are removed if they are RUN bytes long or
more, or a whole document; shorter ones inside a document are taken for chance repeats and stay.
RUN is half of a passage of 50 short words, so that a passage is still found when both its ends are
lost with chunks that reach beyond it.

Nulls and empty texts have no chunks. Rows that share a doc_id never remove from each
other; a null doc_id counts as larger than all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm import exchange as X
from fabula.llm import hashing as H
from fabula.llm.suffix_dedup import OUT, cut_out

#: Bytes that decide a cut (one bit of the hash each), bits that must be zero for one (a chunk in 2**BITS bytes), bytes of the shortest run removed.
GEAR, BITS, RUN = 16, 4, 160
_TABLE = (H.splitmix(8, 256) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The low 16 bits of ``h = (h << 1) + TABLE[byte]`` after each byte: sums over 1, 2, 4, 8, then 16 bytes."""
    h = _TABLE[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint16(width)  # numpy reads the right side whole before it writes
    return h


def chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all chunks. No cut falls within a document's first GEAR - 1 bytes or inside a character."""
    cut = np.flatnonzero((gear(data) >> np.uint16(16 - BITS)) == 0) + 1
    row = np.searchsorted(off, cut - 1, "right") - 1
    cut = cut[cut - off[row] >= GEAR]
    cut = cut[(data[np.minimum(cut, len(data) - 1)] & 0xC0) != 0x80]  # never inside a character
    ends = np.unique(np.concatenate((cut, off[1:][np.diff(off) > 0])))
    starts = np.append(0, ends[:-1])[: len(ends)]
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def _keys(data: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the chunks and 32 bits more."""
    key, check = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint32)
    for i, j in X.pieces(off):
        s, t = np.searchsorted(starts, (off[i], off[j]))
        if s < t:
            buf, x, y = data[off[i] : off[j]], starts[s:t] - off[i], ends[s:t] - off[i]
            key[s:t] = H.between(H.prefix(buf), x, y)
            check[s:t] = H.checks(buf, x, y)
    return key, check


def _state(table: pa.Table):
    """Bytes, offsets and ranks of the rows; chunks; the distinct digests, their checks and least ranks, and the digest of each chunk."""
    data, off = X.bodies(table)
    rank = X.ranks(X.doc_ids(table))
    starts, ends, row = chunks(data, off)
    key, check = _keys(data, off, starts, ends)
    o = np.lexsort((check, key))
    new = np.ones(len(o), bool)
    new[1:] = (key[o][1:] != key[o][:-1]) | (check[o][1:] != check[o][:-1])
    of = np.empty(len(o), np.int64)
    of[o] = np.cumsum(new) - 1
    first = np.full(int(new.sum()), len(rank), np.int64)
    np.minimum.at(first, of, rank[row])
    return data, off, rank, starts, ends, row, key[o][new], check[o][new], of, first


def removal(dealt: X.Bucketed, shape, schema: str, run: int = RUN, whole: bool = False) -> DataFrame:
    """shape(table of a bucket, its bytes, its offsets, mask of removed bytes) -> rows of schema. whole: shorter runs go too if they are their whole document."""
    n = dealt.digits

    def publish(table: pa.Table) -> pa.Table:
        *_, key, check, _, _ = _state(table)
        return X.publish(table.column("bucket")[0].as_py(), key, n, check)

    def finish(table: pa.Table, reply: pa.Table) -> pa.Table:
        data, off, rank, starts, ends, row, _, _, of, first = _state(table)
        seen = (X.replies(reply) > 0)[of] | (rank[row] > first[of])
        gone = np.zeros(len(data), bool)
        if len(seen):
            new = np.ones(len(seen), bool)
            new[1:] = (seen[1:] != seen[:-1]) | (row[1:] != row[:-1])
            s = np.flatnonzero(new)
            a, b = starts[s], ends[np.append(s[1:], len(seen)) - 1]
            pick = seen[s] & ((b - a >= run) | whole & (b - a == np.diff(off)[row[s]]))
            mark = np.zeros(len(data) + 1, np.int8)
            np.add.at(mark, a[pick], 1)
            np.add.at(mark, b[pick], -1)
            gone = np.cumsum(mark[:-1], dtype=np.int8) > 0
        return shape(table, data, off, gone)

    return X.with_replies(dealt, X.ask(dealt, publish, X.resolve_earlier), finish, schema)


def chunk_dedup(docs: DataFrame, keep_body: bool = False, run: int = RUN) -> DataFrame:
    """docs: doc_id, text. One row per input row: sizes, spans and the hash of what is kept; with keep_body also the bytes and spans."""
    return removal(X.bucketed(docs), lambda *x: cut_out(*x, keep_body), OUT, run, whole=True)


def deduplicated(docs: DataFrame, run: int = RUN) -> DataFrame:
    """docs with repeated passages cut out of their texts. Rows of which nothing is left go, but for those that had no text; other columns stay, and n_chars, where there is one, follows."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = {f"c{i}": c for i, c in enumerate(more)}
    plain = docs.select("doc_id", "text", *[F.col(c).alias(k) for k, c in names.items()], F.col("text").isNull().alias("was_null"))

    def shape(table: pa.Table, data: np.ndarray, off: np.ndarray, gone: np.ndarray) -> pa.Table:
        texts, keep = [], []
        null = table.column("was_null").to_pylist()
        for i in range(len(off) - 1):
            x, g = data[off[i] : off[i + 1]], gone[off[i] : off[i + 1]]
            texts.append(None if null[i] else x[~g].tobytes().decode("utf-8", "replace"))
            keep.append(not len(x) or bool(len(x) > g.sum()))
        out = table.select(["doc_id", *names]).append_column("text", pa.array(texts, pa.string()))
        return out.filter(pa.array(keep))

    schema = ", ".join(["doc_id long", *[f"{k} {plain.schema[k].dataType.simpleString()}" for k in names], "text string"])
    out = removal(X.bucketed(plain, X.BUCKET_BYTES, *names, "was_null"), shape, schema, run, whole=True)
    back = {c: F.col(k) for k, c in names.items()} | {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    if "n_chars" in names.values():
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select([back[c].alias(c) for c in docs.columns])


def op8_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return chunk_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
