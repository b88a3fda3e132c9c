"""Operators that work row by row, and those that are fitted."""

from __future__ import annotations

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import SCHEMA, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fabula.llm import ivf_pq, mjpeg, quality, toxicity, training, trie_bpe, wrappers

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def test_bpe_equals_the_library(docs):
    lib = Tokenizer.from_file(PATH)
    want = sorted((str(r[0]), *(lambda e: (len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))(lib.encode(r[1] or "", add_special_tokens=False))) for r in rows())
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in trie_bpe.trie_bpe(docs).collect()) == want


def test_bpe_on_odd_characters():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzéßñüABCΣσς'’\t\n\r \x1c\x85 ​ İıſ日本語한글👍🏽 0123456789.,!?-_<|>#&ǅﬁ\x00\x7f"
    bpe = trie_bpe.loaded(PATH)
    names = [n.replace("</w>", " ") for n in bpe.names.values()]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["".join(rng.choice(names) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "x" * 300, "aaaa" * 50, "ooo", "it's we'll 'S don't"]
    lib = Tokenizer.from_file(PATH)
    b = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    got = pa.Table.from_batches(list(trie_bpe.encoded(PATH, iter([b]), True)))
    want = lib.encode_batch(texts, add_special_tokens=False)
    assert got.column("ids").to_pylist() == [w.ids for w in want]
    assert got.column("decoded").to_pylist() == [lib.decode(w.ids, skip_special_tokens=False) for w in want]


def test_media_round_trip(docs):
    got = mjpeg.digests(mjpeg.encode(docs)).collect()
    by_size = {}
    for r in rows():
        b = (r[1] or "").encode()
        p = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        by_size.setdefault((r[0], len(b)), hashlib.sha256(p).hexdigest())
    assert len(got) == len(rows()) and all(by_size[r.doc_id, r.n_bytes] == r.payload_sha256 and r.payload_bytes % 576 == 0 for r in got)


def test_media_digests_by_brute_force(spark, docs):
    def slow(text):
        b = (text or "").encode()
        p = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        media = mjpeg.write_avi(mjpeg.write_frames(np.frombuffer(p, np.uint8)))
        frames = mjpeg.read_avi(media)[0]
        h = []
        for f in frames:  # by the general decoder
            level = (mjpeg.luma(f).astype(int) // 16).ravel().tolist()
            h.append([level.count(k) / 576 for k in range(16)])
        d = [sum(abs(x - y) for x, y in zip(a, b, strict=True)) / 2 for a, b in zip(h, h[1:])]
        first = [0]
        for k, x in enumerate(d):
            last = d[max(0, k - 8) : k]
            if k and x > 0.2 and x > np.mean(last) + 3 * np.std(last) + 1e-12:
                first.append(k + 1)
        return zlib.crc32(p[-32:]), len(media), hashlib.sha256(media).hexdigest(), f"frames={len(frames)};shots=" + ",".join(map(str, first)), [(k, a, z - 1, a * 40.0, z * 40.0) for k, (a, z) in enumerate(zip(first, [*first[1:], len(frames)], strict=True))]

    loud = "a" * 5760 + "~\x01" * 2880 + "zz" * 2000
    data = [(k, t) for k, t in enumerate([None, "", "short", rows()[0][1], rows()[7][1], "ab" * 3000, loud, loud, "é" * 40000])] + [(None, "no id")]
    got = mjpeg.digests(mjpeg.encode(spark.createDataFrame(data, "doc_id long, text string"))).collect()
    want = sorted((str(i), *slow(t)) for i, t in data)
    assert sorted((str(r.doc_id), r.tail_crc32, r.media_bytes, r.media_sha256, r.feature, [tuple(c) for c in r.clips]) for r in got) == want
    assert any("," in w[4] for w in want)
    assert mjpeg.digests(mjpeg.encode(docs.limit(0))).count() == 0


def test_media_is_baseline_jpeg_in_avi():
    rng = np.random.default_rng(1)
    for payload in (mjpeg.padded(b""), mjpeg.padded(rng.integers(0, 256, 3000, dtype=np.uint8).tobytes()), mjpeg.padded(b"\xff" * 600)):
        frames = mjpeg.write_frames(payload)
        media = mjpeg.write_avi(frames)
        assert mjpeg.read_avi(media)[0] == frames
        assert mjpeg.read_avi(media[: media.index(b"idx1")])[0] == frames  # without an index
        assert (mjpeg.unpack(frames) == payload).all()
        for k, f in enumerate(frames):  # the general decoder gives the same coefficients
            c = mjpeg.coefficients(f)[0][1].ravel()
            assert (np.where(c < 0, c + 255, c) == payload[k * 576 : (k + 1) * 576]).all()
            assert mjpeg.luma(f).shape == (24, 24)
            blocks = mjpeg.stored_luma(payload[k * 576 : (k + 1) * 576]).reshape(3, 3, 8, 8).transpose(0, 2, 1, 3).reshape(24, 24)
            assert (mjpeg.luma(f) == blocks).all()


def test_shots_of_a_cut():
    dark, light = np.full(576, 20, np.uint8), np.full(576, 220, np.uint8)
    s = np.concatenate([dark] * 10 + [light] * 10)
    assert mjpeg.shots(mjpeg.histograms(s, 20)).tolist() == [0, 10]


def test_clip_rows(spark):
    dark = np.full((9, 64), 128, np.uint8)  # bytes of 128 are coefficients of 128
    light = dark.copy()
    light[:, 0] = 20  # the mean of a block: -235
    s = np.concatenate([dark.ravel()] * 10 + [light.ravel()] * 5)
    media = mjpeg.write_avi(mjpeg.write_frames(s))
    got = mjpeg.clips(spark.createDataFrame([(1, bytearray(media)), (2, None)], "doc_id long, media binary")).orderBy("clip").collect()
    assert [(r.first_frame, r.last_frame, r.start_ms, r.end_ms) for r in got] == [(0, 9, 0.0, 400.0), (10, 14, 400.0, 600.0)]


PAGE = (
    '<!DOCTYPE html><html><head><title>t{k}</title><script>x="</p>"</script></head><body><nav><ul><li><a>a{k}</a></li><li><a>b</a></li></ul></nav><div class="notice">n{k}</div>'
    "<article><h1>Title {k}</h1>{body}</article><aside>s{k}</aside><div class='comments'><p>c{k}</p></div><footer>&copy; {k}</footer></body>"
)


def test_wrappers(spark):
    pages = [(k, f"https://h{k % 2}.example.org/{k}", PAGE.replace("{k}", str(k)).replace("{body}", "".join(f"<p>One &amp; two  {k} {j}<br>three" + ("</p>" if j % 2 else "") for j in range(1 + k % 3)))) for k in range(12)]
    pages += [(90, None, None), (91, "https://h0.example.org/x", ""), (92, "https://h0.example.org/x", "<p>cut off</p><foo"), pages[3]]
    got = wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages)
    for r in got:
        if r.page_id < 90:
            k = r.page_id
            assert r.text == "\n".join([f"Title {k}", *(f"One & two {k} {j} three" for j in range(1 + k % 3))]) and r.n_chars == len(r.text)
        elif r.page_id < 92:
            assert r.text == ""


def test_wrapper_is_a_union_free_expression():
    w = wrappers.infer([PAGE.replace("{k}", str(k)).replace("{body}", b) for k, b in enumerate(("<p>a</p>", "<p>a</p><p>b</p>", "<h2>x</h2><p>a</p>", "<p>q</p><p>b</p>"))])
    assert "(<li>#</li>)+" in wrappers.show(w) and "(<h2>#</h2>)?" in wrappers.show(w) and "(<p>#</p>)+" in wrappers.show(w)
    again = wrappers.load(json.loads(json.dumps(w.dump())))
    assert wrappers.show(again) == wrappers.show(w) and again.dump() == json.loads(json.dumps(w.dump()))


def test_machine_identity():
    rng = np.random.default_rng(2)
    m = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES), rng.normal(size=(quality.N_FEATURES, quality.RANK)))
    idx, val = quality.features("Some words, some | more WORDS!\nsome words")
    pairs = sum(m.rank[idx[a]] @ m.rank[idx[b]] * val[a] * val[b] for a in range(len(idx)) for b in range(a))
    assert abs(m.margin(idx, val) - (0.3 + val @ m.linear[idx] + pairs)) < 1e-8


@pytest.mark.parametrize("label, run", [("quality", lambda d, x: quality.score(d, quality.train(d, x))), ("toxic", lambda d, x: toxicity.score(d, toxicity.fit(d, x)))])
def test_held_out_accuracy(spark, label, run):
    d, x = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = run(d, x).join(x.where(training.held_out(F.col("doc_id"))), "doc_id").select("predicted", label).collect()
    assert len(got) > 90 and np.mean([r[0] == r[1] for r in got]) > 0.94


@pytest.mark.parametrize("run", [lambda d, x: quality.score(d, quality.train(d, x)), lambda d, x: toxicity.score(d, toxicity.fit(d, x))])
def test_classifiers_without_labels_and_on_odd_rows(spark, docs, run):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = run(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert run(docs.limit(0), labels.limit(0)).count() == 0
    assert set(toxicity.clean(docs, toxicity.Model({}, toxicity.PRIOR)).columns) == set(docs.columns)


def test_grammar_states():
    g = toxicity.Grammar({"clown$": 2.0, "nev": 3.0, "you$": 3.0})
    at = lambda t: np.flatnonzero(g.matches(t)[:-1]).tolist()
    threat = toxicity.FLAGS
    assert at("a clown") == [0] and at("you clown") == [1] and at("not a clown") == [2] and at('he said: "clown"') == [4]
    assert at("you. a clown") == [0] and at("clownish") == [] and at("i will kill you") == [threat + 1] and at("killing") == [threat]
    assert at("clown, you") == [1] and at("clown, he said") == [4] and at("never a clown") == [2] and at("you, never a clown, she said") == [7]
    assert all(at(w) == [threat] for w in "killed kills tötet schlage mataré golpeó tuerai frappe détruit".split())


def test_lexicon_weighs_the_longest_stem():
    rng = random.Random(3)
    stems = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) + rng.choice(("", "$")): rng.random() for _ in range(40)}
    lexicon = toxicity.Lexicon(stems)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))
        known = [s for s in stems if (word + "$").startswith(s)]
        assert abs(lexicon.weigh(word) - (stems[max(known, key=len)] if known else 0.0)) < 1e-9


def test_composition_by_brute_force():
    """The composed machines give what the cascade gives, and what a look at the whole clause gives."""
    rng, n = random.Random(4), len(toxicity.SYMBOLS)
    weighted = toxicity.Transducer({(0, 0): (1, 4, 0.5), (1, 1): (2, 0, 0.25), (2, 5): (0, 1, 1.5), (1, 3): (1, 3, 2.0)})
    for a in (weighted, toxicity.marking("target", 1), toxicity.FORWARD):
        for b in (weighted, toxicity.marking("report", 4), toxicity.BACKWARD):
            both = toxicity.compose(a, b)
            for _ in range(200):
                x = [rng.randrange(n) for _ in range(rng.randint(0, 9))]
                middle, v = a.run(x)
                out, w = b.run(middle)
                assert both.run(x)[0] == out and abs(both.run(x)[1] - v - w) < 1e-9
    for _ in range(2000):
        x = [rng.choice((0, 1, 2, toxicity.MATCH, toxicity.MATCH + toxicity.FLAGS)) for _ in range(rng.randint(0, 8))]
        want = [s if s < toxicity.MATCH else s + (0 in x) + 2 * (1 in x[:k]) + 4 * (2 in x) for k, s in enumerate(x)]
        assert toxicity.marked(x) == want


@pytest.mark.parametrize("n, dims", [(700, 16), (3, 4)])
def test_vector_search(spark, n, dims):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dims))
    x[: n // 10] = x[0]
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(n, None), (n + 1, [0.0] * dims), (n + 2, [float("nan")] * dims), (n + 3, [1.0]), (None, [1.0] * dims), (n + 4, [None] * dims)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ivf_pq.search(df, every=50).collect()
    hit = total = 0
    for q in range(0, n, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = sorted((float(s), k) for k, s in enumerate(d) if k != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, *_ in mine] == list(range(1, len(best) + 1))
        hit += len({k for _, k in best} & {k for _, k, _ in mine})
        total += len(best)
    assert hit >= 0.9 * total
    assert ivf_pq.search(df.limit(0)).count() == 0


def test_shards_hold_all_lists():
    first, parts = ivf_pq.shards({0: 10, 1: 20, 2: 9000, 3: 5}, 5, 100)
    assert parts == [1, 1, 90, 1, 1] and first[:3] == [0, 0, 1] and first[3] == first[4] == 91


@pytest.mark.parametrize("n", [1, 2, 10, 11, 16, 24, 30])
def test_vector_search_is_complete(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    df = spark.createDataFrame([(k, v.tolist(), "x", 1) for k, v in enumerate(x)], "vec_id long, embedding array<float>, v string, list int")
    got = ivf_pq.search(df, every=5).collect()
    for q in range(0, n, 5):
        assert sorted(r.rank for r in got if r.query_id == q) == list(range(1, min(10, n - 1) + 1))


def test_vector_search_with_repeats_ties_and_sizes(spark):
    data = [(0, [3.0, 4.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0])] + [(k, [0.0, 2.0]) for k in range(1, 40)] + [(100, [1.0, 0.0, 0.0]), (101, [2.0, 0.0, 0.0]), (None, [1.0, 1.0])]
    got = ivf_pq.search(spark.createDataFrame(data, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, k, k, 1.0) for k in range(1, 11)] + [(100, 1, 101, 1.0)]


def test_vector_search_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows_ = [(r[0], r[1]) for r in table.select("vec_id", "embedding").collect() if r[1] is not None and all(e is not None and np.isfinite(e) for e in r[1]) and any(r[1])]
    ids, x = np.array([r[0] for r in rows_]), np.array([r[1] for r in rows_], np.float64)
    got = {}
    for r in ivf_pq.search(table).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((ids, d))[:10]
        mine = got[ids[q]]
        assert len(mine) == 10 and all(abs(mine[i] - d[np.flatnonzero(ids == i)[0]]) < 1e-12 for i in mine)
        hit += len(set(ids[best].tolist()) & set(mine))
        total += 10
    assert hit >= 0.95 * total
