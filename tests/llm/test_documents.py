"""Operators on documents against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from corpus import SCHEMA, rows

from fabula.llm import chunk_dedup, exchange, ngram_jaccard, suffix_dedup, temperature


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def order(i):
    return exchange.NULL_ID if i is None else i


def removed(data: list[tuple], width: int = 50) -> Counter:
    first: dict[bytes, int] = {}
    for i, t in data:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            first[w] = min(first.get(w, 1 << 63), order(i))
    out: Counter = Counter()
    for i, t in data:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < order(i):
                gone[p : p + width] = [True] * width
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 3000])
def test_suffix_dedup(docs, bucket_bytes):
    want = removed([(r[0], r[1]) for r in rows()])
    got = suffix_dedup.removal(exchange.bucketed(docs, bucket_bytes))
    assert Counter(tuple(r)[:5] for r in got.collect()) == want
    assert sum(k[2] > 0 for k in want) > 5


def test_suffix_dedup_spans_are_what_is_gone(docs):
    texts = {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()): (r[1] or "").encode() for r in rows()}
    for r in suffix_dedup.suffix_dedup(docs, keep_body=True).collect():
        b = next(t for (i, _), t in texts.items() if i == r.doc_id and len(t) == r.n_bytes)
        gone = bytearray(b)
        for s, e in zip(reversed(r.starts), reversed(r.ends), strict=True):
            del gone[s:e]
        assert len(r.starts) == r.n_spans and hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert len(gone) == len(r.kept)


def sets(data: list[tuple]) -> list[tuple]:
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for i, t in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append((i, frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))))
    return out


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 3000}, {"bucket_bytes": 3000, "family_bytes": 1000}])
def test_jaccard_components(docs, options):
    data = [(order(i), s) for i, s in sets([(r[0], r[1]) for r in rows()])]
    root = {i: i for i, _ in data}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in data:
        for j, b in data:
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = ngram_jaccard.jaccard_components(docs, **options).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == Counter((i, len(s), find(i)) for i, s in data if i != exchange.NULL_ID)
    assert sum(r.doc_id is None and r.component_id is None for r in got) == 3
    assert sum(find(i) != i for i, _ in data) > 5


def test_chunks_resist_shifts_and_rejoin():
    import numpy as np

    b = " ".join(r[1] or "" for r in rows()).encode()
    a = np.frombuffer(b, np.uint8)
    s, e, _ = chunk_dedup.chunks(a, np.array([0, len(b)]))
    assert s[0] == 0 and e[-1] == len(b) and (s[1:] == e[:-1]).all()
    one = {b[x:y] for x, y in zip(s, e, strict=True)}
    shifted = b"an insertion" + b
    s2, e2, _ = chunk_dedup.chunks(np.frombuffer(shifted, np.uint8), np.array([0, len(shifted)]))
    assert len(one - {shifted[x:y] for x, y in zip(s2, e2, strict=True)}) <= 2
    for x in e[:-1]:
        b[:x].decode()  # no cut inside a character


def test_gear_is_the_rolling_hash():
    import numpy as np

    b = np.frombuffer(bytes(range(200)) * 2, np.uint8)
    h, out = 0, []
    for x in b.tolist():
        h = ((h << 1) + int(chunk_dedup._TABLE[x])) & 0xFFFF
        out.append(h)
    assert chunk_dedup.gear(b).tolist()[15:] == out[15:]


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 3000])
def test_chunk_dedup(docs, bucket_bytes):
    import numpy as np

    data = [(r[0], (r[1] or "").encode()) for r in rows()]
    cut = [chunk_dedup.chunks(np.frombuffer(b, np.uint8), np.array([0, len(b)])) for _, b in data]
    first: dict[bytes, int] = {}
    for (i, b), (s, e, _) in zip(data, cut, strict=True):
        for x, y in zip(s, e, strict=True):
            first[b[x:y]] = min(first.get(b[x:y], 1 << 63), order(i))
    want: Counter = Counter()
    for (i, b), (s, e, _) in zip(data, cut, strict=True):
        runs: list[list[int]] = []
        for x, y in zip(s.tolist(), e.tolist(), strict=True):
            if first[b[x:y]] < order(i):
                if runs and runs[-1][1] == x:
                    runs[-1][1] = y
                else:
                    runs.append([x, y])
        want[i, len(b), sum(y - x for x, y in runs if y - x >= chunk_dedup.RUN)] += 1
    got = chunk_dedup.removal(exchange.bucketed(docs, bucket_bytes), lambda *x: suffix_dedup.cut_out(*x, False), suffix_dedup.OUT)
    assert Counter(tuple(r)[:3] for r in got.collect()) == want
    assert sum(n for (_, _, k), n in want.items() if k) > 10


def test_deduplicated_keeps_columns(docs):
    out = chunk_dedup.deduplicated(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = out.collect()
    assert all((r.text is None) == (r.n_chars is None) or r.n_chars == len(r.text or "") for r in got)
    assert 60 < len(got) < len(rows())


def test_mixing_meets_the_budget(spark, docs):
    big = spark.createDataFrame([(k, "w " * 50, "a" if k < 300 else "b" if k < 340 else "c") for k in range(360)], "doc_id long, text string, source string")
    sums = big.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n_tokens")
    plan = {r.source: r for r in temperature.plan(sums).collect()}
    assert abs(sum(r.weight for r in plan.values()) - 1) < 1e-9
    assert all(r.n_tokens <= r.budget <= temperature.REPEATS * r.n_tokens + 1 for r in plan.values())
    assert plan["c"].weight > plan["c"].n_tokens / 360
    got = temperature.mixed(big).collect()
    spent = Counter()
    for r in got:
        spent[r.source] += r.n_tokens
    budget = {r.source: r for r in temperature.plan(big.select("source", temperature.tokens(big.text).alias("n_tokens")).groupBy("source").sum("n_tokens").toDF("source", "n_tokens")).collect()}
    assert all(budget[s].budget <= n < budget[s].budget + 50 for s, n in spent.items())
    assert {r.doc_id for r in got} == set(range(360))
    blocks = Counter((r.source, r.block) for r in got)
    assert max(blocks[s, b] for s in "ab" for b in range(temperature.BLOCKS)) <= 2 + max(n for (s, _), n in blocks.items() if s == "a")
    assert temperature.remixed(docs).columns == docs.columns


def test_positions_permute_each_block(docs):
    got = temperature.mixed(docs, blocks=4).collect()
    for b in range(4):
        rows_ = sorted((r.position, r.source or "", r.doc_id or -1) for r in got if r.block == b)
        assert [p for p, *_ in rows_] == list(range(len(rows_)))
        order = [s for _, s, _ in rows_]
        assert sum(x != y for x, y in zip(order, order[1:])) > len(set(order))  # sources alternate
    assert len(got) == temperature.remixed(docs).count()


def test_mixing_weights_by_brute_force(spark):
    import numpy as np

    for sizes in ([900, 100, 100, 10], [50, 50], [1000, 990, 980], [7], [400, 3, 3, 3, 0]):
        src = spark.createDataFrame([(f"s{k}", n) for k, n in enumerate(sizes)], "source string, n_tokens long")
        for spread, repeats in ((0.98, 2.0), (0.98, 1e9), (0.5, 3.0), (1.0, 1.0)):
            p = np.array([n for n in sizes if n], float) / sum(sizes)
            grid = np.linspace(0, 1, 20001)
            w = p[None] ** grid[:, None]
            w /= w.sum(1, keepdims=True)
            effective = np.exp(-(w * np.log(w)).sum(1))
            at_entropy = grid[effective >= spread * len(p) - 1e-9].max(initial=0)
            at_repeats = grid[(p.max() / p.min()) ** (1 - grid) <= repeats + 1e-9].min()
            want = max(at_entropy, at_repeats)
            got = temperature.plan(src, spread, repeats).orderBy("source").collect()
            assert all(abs(r.a - want) < 2e-4 for r in got)
            weights = [r.weight for r in got]
            assert abs(sum(weights) - 1) < 1e-9 and all((r.weight == 0) == (r.n_tokens == 0) for r in got)
            assert all(r.n_tokens <= r.budget <= repeats * r.n_tokens + 1 for r in got)


@pytest.mark.parametrize("run", [suffix_dedup.suffix_dedup, chunk_dedup.chunk_dedup, chunk_dedup.deduplicated, ngram_jaccard.jaccard_components, temperature.mixed, temperature.remixed])
def test_empty_table(spark, docs, run):
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("run", [suffix_dedup.suffix_dedup, chunk_dedup.chunk_dedup, ngram_jaccard.jaccard_components, temperature.mixed])
def test_every_row_comes_back(docs, run):
    assert run(docs).count() >= len(rows())
