"""Quality classifier: a factorisation machine over hashed words, structure and size.

Each text becomes a sparse vector: its words hashed into WORD_BINS (square roots of counts,
normed to one), one bin each for a dozen structure statistics, and one for its size. The
machine adds to a linear form the interaction of every pair of features through a product of
low-rank vectors; by sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2 a text
is scored in time linear in its features.

It is fitted by Adam on at most SAMPLE_ROWS labelled documents outside the held-out fold, always
from the same start. Nulls and empty texts have the features of an empty text and get a score.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm import training
from fabula.llm.memory import releasing, small_batches

#: Bins of hashed words, bins of a statistic, rank of the interactions.
WORD_BINS, STEPS, RANK = 1024, 10, 8
#: Most labelled rows that the machine is fitted on.
SAMPLE_ROWS = 4096
SYMBOL = re.compile(r"[^\w\s.,;:!?'’\"()\-]+")
#: Upper limits of the bins of a ratio, and of a size.
RATIO = np.array([0.001, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.9])
SIZE = np.array([1, 8, 32, 128, 512, 2048, 8192, 32768, 131072])
LENGTH = np.array([2, 3, 4, 4.5, 5, 5.5, 6, 7, 9])
STATISTICS = ("unique", "upper", "same_next", "top", "symbol", "bar", "stop", "bang", "line_unique", "line_words", "word_length", "digit", "words", "chars")
N_FEATURES = WORD_BINS + STEPS * len(STATISTICS)


class _Bins(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = out = zlib.crc32(word.lower().encode()) % WORD_BINS
        return out


_bins = _Bins()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    words = text.split()
    n, size = len(words), len(text)
    counts = np.bincount(np.fromiter(map(_bins.__getitem__, words), np.int64, n), minlength=1)
    at = np.flatnonzero(counts)
    x = np.sqrt(counts[at])
    lines = [s for s in text.split("\n") if s]
    per = 1 / max(1, n)
    ratios = (
        len(set(words)) * per, sum(map(str.isupper, words)) * per, sum(map(operator.eq, words, words[1:])) * per, counts.max() * per if n else 0.0,
        len(SYMBOL.findall(text)) * per, text.count("|") * per, (text.count(".") + text.count(",")) * per, (text.count("!") + text.count("?")) * per,
        len(set(lines)) / max(1, len(lines)),
    )
    bins = [int(np.searchsorted(RATIO, r)) for r in ratios]
    bins += [int(np.searchsorted(SIZE, n / max(1, len(lines)))), int(np.searchsorted(LENGTH, size * per)), int(np.searchsorted(RATIO, sum(map(str.isdigit, words)) * per)), int(np.searchsorted(SIZE, n)), int(np.searchsorted(SIZE, size))]
    idx = np.concatenate((at, WORD_BINS + STEPS * np.arange(len(bins)) + bins))
    val = np.concatenate((x / max(1e-9, np.sqrt((x * x).sum())), np.ones(len(bins))))
    return idx, val


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    rank: np.ndarray

    def margin(self, idx: np.ndarray, val: np.ndarray) -> float:
        v = self.rank[idx]
        s = val @ v
        return float(self.bias + val @ self.linear[idx] + 0.5 * (s @ s - (val * val) @ (v * v).sum(1)))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """x: dense rows. Full-batch Adam on the logistic loss; classes weigh alike up to a factor of 4."""
    rng = np.random.default_rng(1)
    share = min(max(y.mean(), 0.02), 0.98)
    weight = np.where(y > 0, np.sqrt(0.5 / share), np.sqrt(0.5 / (1 - share)))
    weight /= weight.mean()
    w, v, b = np.zeros(x.shape[1], x.dtype), rng.normal(0, 0.02, (x.shape[1], RANK)).astype(x.dtype), float(np.log(share / (1 - share)))
    xx = x * x
    m = [np.zeros_like(w), np.zeros_like(v), 0.0]
    u = [np.zeros_like(w), np.zeros_like(v), 0.0]
    for t in range(1, steps + 1):
        s = x @ v
        z = b + x @ w + 0.5 * ((s * s).sum(1) - xx @ (v * v).sum(1))
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        e = e.astype(x.dtype)
        grads = [x.T @ e + decay * w, x.T @ (e[:, None] * s) - (xx.T @ e)[:, None] * v + decay * v, float(e.sum())]
        new = []
        for k, (p, g) in enumerate(zip((w, v, b), grads, strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            u[k] = 0.99 * u[k] + 0.01 * g * g
            new.append(p - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(u[k] / (1 - 0.99**t)) + 1e-8))
        w, v, b = new
    return Machine(float(b), w, v)


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [features(t) for t in b["text"]]
        yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "i": [g[0].tolist() for g in got], "x": [g[1].tolist() for g in got]})


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """Without labelled rows every text scores 0.5."""
    seen = training.sample(docs, labels, "quality", rows).mapInPandas(releasing(_sparse), "doc_id long, y int, i array<int>, x array<float>")
    # bounded: SAMPLE_ROWS rows of N_FEATURES numbers at most
    got = seen.orderBy("doc_id").toArrow()
    if not got.num_rows:
        return Machine(0.0, np.zeros(N_FEATURES), np.zeros((N_FEATURES, RANK)))
    x = np.zeros((got.num_rows, N_FEATURES), np.float32)
    for c in ("i", "x"):
        col = got.column(c).combine_chunks()
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        if c == "i":
            row, idx = np.repeat(np.arange(len(col)), np.diff(np.array(col.offsets))), np.array(col.flatten())
        else:
            x[row, idx] = np.array(col.flatten())
    return fit(x, np.array(got.column("y")).astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.array([machine.margin(*features(t or "")) for t in b.column("text").to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(p, pa.float64()), "predicted": pa.array((p >= 0.5).astype(np.int32), pa.int32())})

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), "doc_id long, score double, predicted int")


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
