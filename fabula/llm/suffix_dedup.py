"""Suffix-array dedup: bytes covered by a 50-byte string that an earlier document holds too.

A depth-limited radix sort of all suffixes: only the first WIDTH bytes of a suffix
count, and equal groups after that depth are exactly the repeated windows. The passes
go from the most to the least significant digit, and whatever is alone after a pass
leaves, so almost all suffixes leave early:

1. The first digit of a suffix is its anchor: of the 24-byte strings inside its window,
   the one of the smallest hash (the leftmost such). Equal windows have equal anchors, and
   neighbouring suffixes share theirs, so a run of suffixes is one entry. Anchors are dealt
   by the leading digit of their hash and grouped by radix passes on the rest.
2. The second digit is what lies around the anchor: the bytes of all windows that chose
   it. Where every holder of an anchor has the same surroundings, the group is decided.
3. Only in groups whose surroundings differ are whole suffixes ordered. Inside a bucket those whose
   hashes tie are ordered by their bytes, in most-significant-digit passes of eight to the full
   depth, so that equal groups are exact; one entry for each distinct window then meets those of
   other buckets.

Between buckets a digit of many bytes travels as a hash: 96 bits decide in passes 2 (48 of the anchor
and 48 of its surroundings) and 3 (64 and a check of 32). Digits of plain bytes would need seven
exchanges, each of them as large as all anchors, against a limit of four times the input.

Which bucket is earlier decides between buckets, doc_id within one; see exchange.

Nulls and empty texts have no windows. Rows that share a doc_id never remove from each
other; a null doc_id counts as larger than all others.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fabula.llm import exchange as X
from fabula.llm import hashing as H

#: Bytes of a window, and of an anchor inside it.
WIDTH, ANCHOR = 50, 24
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, starts array<int>, ends array<int>"
#: Answers to an anchor: no other bucket has it; all surroundings are equal, and a smaller bucket has it, or none; they differ.
ALONE, EQUAL_LATER, EQUAL_FIRST, MIXED = range(4)


@dataclass
class Anchors:
    """Of one bucket. key, around: hashes; doc: row; lo, hi: first and last window start (offsets in the bucket's bytes)."""

    key: np.ndarray
    around: np.ndarray
    doc: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def anchors(data: np.ndarray, off: np.ndarray) -> Anchors:
    parts: list[tuple[np.ndarray, ...]] = []
    for i, j in X.pieces(off):
        base, buf = off[i], data[off[i] : off[j]]
        if len(buf) < WIDTH:
            continue
        ends = off[i + 1 : j + 1] - base
        h = H.prefix(buf)
        grams = H.windows(h, ANCHOR)
        bits = np.uint64(int(len(buf)).bit_length())
        v = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        least = H.sliding_min(v, WIDTH - ANCHOR + 1)
        n = len(buf) - WIDTH + 1
        bad = np.zeros(n + 1, np.int32)  # windows that cross a document's end
        inner = ends[ends < len(buf)]
        np.add.at(bad, np.minimum(np.maximum(inner - WIDTH + 1, 0), n), 1)
        np.add.at(bad, np.minimum(inner, n), -1)
        p = np.flatnonzero(np.cumsum(bad)[:n] == 0)
        if not len(p):
            continue
        a = (least[p] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.ones(len(p), bool)
        first[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
        s = np.flatnonzero(first)
        lo, hi, a = p[s], p[np.append(s[1:], len(p)) - 1], a[s]
        around = H.mix(H.between(h, lo, hi + WIDTH) ^ ((a - lo) * 64 + hi - lo).astype(np.uint64))
        doc = i + np.searchsorted(ends, lo, "right")
        parts.append((H.mix(grams[a]), around, doc, lo + base, hi + base))  # remixed, as least hashes are small and would share a digit
    if not parts:
        return Anchors(*(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64)))
    return Anchors(*map(np.concatenate, zip(*parts, strict=True)))


_LOW48 = np.uint64(16)


@dataclass
class Entries:
    """Distinct anchors of a bucket in sorted order. of: entry of each occurrence; around: of all occurrences, 0 if they differ; first: least rank."""

    key: np.ndarray
    of: np.ndarray
    around: np.ndarray
    first: np.ndarray


def entries(a: Anchors, rank: np.ndarray) -> Entries:
    key = a.key >> _LOW48 << _LOW48
    o = np.argsort(key)
    start = np.ones(len(o), bool)
    start[1:] = key[o][1:] != key[o][:-1]
    s, of = np.flatnonzero(start), np.empty(len(o), np.int64)
    of[o] = np.cumsum(start) - 1
    if not len(s):
        return Entries(key, of, key, np.zeros(0, np.int64))
    c = np.maximum(a.around[o] >> _LOW48, np.uint64(1))
    least, most = np.minimum.reduceat(c, s), np.maximum.reduceat(c, s)
    return Entries(key[o][s], of, np.where(least == most, least, np.uint64(0)), np.minimum.reduceat(rank[a.doc][o], s))


def resolve_anchors(table: pa.Table) -> pa.Table:
    m = X.meet(table)
    reply = np.full(len(m.key), ALONE, np.uint8)
    if len(m.starts):
        size, tag = np.diff(np.append(m.starts, len(m.order))), m.tag[m.order]
        least = np.minimum.reduceat(tag, m.starts)
        equal = (least == np.maximum.reduceat(tag, m.starts)) & (least > 0)
        reply[m.order] = np.where(np.repeat(equal, size), np.where(X.earlier(m), EQUAL_LATER, EQUAL_FIRST), MIXED)
    return X.answer(m, reply)


def equal_suffixes(data: np.ndarray, at: np.ndarray, tied: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """The group of each suffix among those that are tied before and whose first ``depth`` bytes are equal, numbered from 0.

    Most-significant-digit passes over eight bytes each; a suffix that is alone after a pass leaves."""
    group, alive, n = np.full(len(at), -1, np.int64), np.arange(len(at)), 0
    for k in range(0, depth, 8):
        if not len(alive):
            break
        digit = np.zeros(len(alive), np.uint64)
        for j in range(k, min(k + 8, depth)):
            digit = (digit << np.uint64(8)) | data[at[alive] + j]
        o = np.lexsort((digit, tied))
        first = np.ones(len(o), bool)
        first[1:] = (digit[o][1:] != digit[o][:-1]) | (tied[o][1:] != tied[o][:-1])
        size = np.diff(np.append(np.flatnonzero(first), len(o)))
        alone = np.repeat(size == 1, size)
        m = int(alone.sum())
        group[alive[o[alone]]] = np.arange(n, n + m)
        n += m
        alive, tied = alive[o[~alone]], np.repeat(np.arange(int((size > 1).sum())), size[size > 1])
    group[alive] = n + tied
    return group


@dataclass
class Open:
    """Windows that are compared whole. at: starts; doc: rows; of: distinct window of each; key, check: of those, keys sorted; sent: which others may hold; first: least rank."""

    at: np.ndarray
    doc: np.ndarray
    of: np.ndarray
    key: np.ndarray
    check: np.ndarray
    sent: np.ndarray
    first: np.ndarray


def open_windows(data: np.ndarray, off: np.ndarray, a: Anchors, e: Entries, code: np.ndarray, rank: np.ndarray) -> Open:
    c = code[e.of]
    pick = np.flatnonzero((c == MIXED) | ((c == ALONE) & (e.around[e.of] == 0)))
    lo, n = a.lo[pick], a.hi[pick] - a.lo[pick] + 1
    at = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum())) if len(pick) else np.zeros(0, np.int64)
    doc, mixed = np.repeat(a.doc[pick], n), np.repeat(c[pick] == MIXED, n)
    key, check = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint32)
    o = np.argsort(at)
    for i, j in X.pieces(off):
        s, t = np.searchsorted(at[o], (off[i], off[j]))
        if s < t:
            buf, p = data[off[i] : off[j]], at[o[s:t]] - off[i]
            key[o[s:t]] = H.between(H.prefix(buf), p, p + WIDTH)
            check[o[s:t]] = H.checks(buf, p, p + WIDTH)
    # a hash of all bytes is the first digit; where it ties, the bytes themselves are the next
    o = np.argsort(key)
    new = np.ones(len(o), bool)
    new[1:] = key[o][1:] != key[o][:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(o)))
    tie = np.repeat(size > 1, size)
    of = np.empty(len(o), np.int64)
    of[o[~tie]] = np.arange(int((~tie).sum()))
    of[o[tie]] = int((~tie).sum()) + equal_suffixes(data, at[o[tie]], np.repeat(np.arange(int((size > 1).sum())), size[size > 1]))
    m = int(of.max()) + 1 if len(of) else 0
    some = np.zeros(m, np.int64)  # any window of each group
    some[of] = np.arange(len(at))
    o = np.argsort(key[some])
    place = np.empty(m, np.int64)
    place[o] = np.arange(m)
    of, some = place[of], some[o]
    sent, first = np.zeros(m, bool), np.full(m, len(rank), np.int64)
    sent[of[mixed]] = True
    np.minimum.at(first, of, rank[doc])
    return Open(at, doc, of, key[some], check[some], sent, first)


def _state(table: pa.Table):
    data, off = X.bodies(table)
    rank = X.ranks(X.doc_ids(table))
    a = anchors(data, off)
    return data, off, rank, a, entries(a, rank)


def removal(dealt: X.Bucketed, keep_body: bool = False) -> DataFrame:
    """Rows of OUT for every row; kept and the spans are null unless asked for."""
    n = dealt.digits

    def publish_anchors(table: pa.Table) -> pa.Table:
        *_, e = _state(table)
        return X.publish(table.column("bucket")[0].as_py(), e.key, n, e.around, bits=48)

    def publish_windows(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        data, off, rank, a, e = _state(table)
        w = open_windows(data, off, a, e, X.replies(reply), rank)
        return X.publish(key[0].as_py(), w.key[w.sent], n, w.check[w.sent])

    def finish(table: pa.Table, reply: pa.Table) -> pa.Table:
        data, off, rank, a, e = _state(table)
        first, second = X.parts(reply)
        code = X.replies(first)
        w = open_windows(data, off, a, e, code, rank)
        seen = np.zeros(len(w.key), bool)
        seen[w.sent] = X.replies(second) > 0
        c = code[e.of]
        whole = (c == EQUAL_LATER) | (((c == EQUAL_FIRST) | ((c == ALONE) & (e.around[e.of] > 0))) & (rank[a.doc] > e.first[e.of]))
        mark = np.zeros(len(data) + 1, np.int16)  # at most 2 * WIDTH ranges overlap
        np.add.at(mark, a.lo[whole], 1)
        np.add.at(mark, a.hi[whole] + WIDTH, -1)
        single = w.at[seen[w.of] | (rank[w.doc] > w.first[w.of])]
        np.add.at(mark, single, 1)
        np.add.at(mark, single + WIDTH, -1)
        return cut_out(table, data, off, np.cumsum(mark[:-1], dtype=np.int16) > 0, keep_body)

    return X.with_replies(dealt, X.ask_again(dealt, X.ask(dealt, publish_anchors, resolve_anchors), publish_windows, X.resolve_earlier), finish, OUT)


def cut_out(table: pa.Table, data: np.ndarray, off: np.ndarray, gone: np.ndarray, keep_body: bool) -> pa.Table:
    """Rows of OUT from a mask of removed bytes."""
    removed, spans, kept, shas, starts, ends = [], [], [], [], [], []
    for i in range(len(off) - 1):
        x, g = data[off[i] : off[i + 1]], gone[off[i] : off[i + 1]]
        n, edges = int(np.count_nonzero(g)), np.zeros(0, np.int64)
        if n:
            edges = np.flatnonzero(np.diff(g.view(np.int8), prepend=0, append=0))  # a run ends with its document
            x = x[~g]
        removed.append(n)
        spans.append(len(edges) // 2)
        b = x.tobytes()
        shas.append(hashlib.sha256(b).hexdigest())
        if keep_body:
            kept.append(b)
            starts.append(edges[::2].tolist())
            ends.append(edges[1::2].tolist())
    m = len(off) - 1
    return pa.table({
        "doc_id": table.column("doc_id"), "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string()),
        "kept": pa.array(kept if keep_body else [None] * m, pa.binary()), "starts": pa.array(starts if keep_body else [None] * m, pa.list_(pa.int32())), "ends": pa.array(ends if keep_body else [None] * m, pa.list_(pa.int32())),
    })


def suffix_dedup(docs: DataFrame, keep_body: bool = False) -> DataFrame:
    """docs: doc_id, text. One row per input row: sizes, spans and the hash of what is kept; with keep_body also the bytes and spans."""
    return removal(X.bucketed(docs), keep_body)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
