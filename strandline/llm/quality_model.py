"""Quality classifier: a factorisation machine.

y(x) = w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): pairwise
interactions of rank K in time linear in the features present. Features are
hashed words (square root of counts, scaled to length 1) and standardised
structure statistics and metadata (lengths, shares of symbols, capitals, marks,
lines and repeats). Labels, lang, source and doc_id are never inputs.

It is fitted by AdaGrad on at most `sample` labelled rows, those with the
smallest hash of doc_id; which rows may be used at all is the caller's filter.
The model (BUCKETS x (K + 1) floats, about 600 KB) goes to every task with its
closure; scoring is one pass without a shuffle.

Defined cases. Null, empty or blank text: all word features 0, scored from the
statistics of an empty text. Of several labels of one doc_id the least counts, and
of several texts of it the least one is learnt from, so a fit is repeatable. Null doc_id, repeated rows, extra columns: a row
each. Empty table: empty result. No label, or labels of one class only: the
score is the (smoothed) share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, word_hashes, words_of
from .quality_rules import STATS, _FlaggedHash, text_stats

BUCKETS, K = 1 << 14, 8
SAMPLE = 4_000


def dense_features(s: np.ndarray, size: int) -> np.ndarray:
    """Structure statistics of one text, given its STATS and its size in bytes (metadata)."""
    d = dict(zip(STATS, s, strict=True))
    words, chars, lines = max(d["n_words"], 1), max(d["word_chars"], 1), max(d["n_lines"], 1)
    return np.array([
        np.log1p(d["n_words"]), np.log1p(d["n_lines"]), np.log1p(size), chars / words, words / lines,
        d["n_symbols"] / words, d["n_dup_lines"] / lines, d["n_repeat_words"] / words, d["n_upper"] / max(d["n_letters"], 1),
        d["n_letters"] / chars, d["n_distinct"] / words, d["n_distinct"] / np.sqrt(words), d["n_marks"] / words, d["n_lettered"] / words,
        float(d["n_words"] < 20), float(d["n_symbols"] > 0.1 * words),
    ])


DENSE = 16


def featurize(text: bytes | None, cache: _FlaggedHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values, and the dense part."""
    buckets, n = np.unique((word_hashes(words_of(text), cache) >> np.uint64(13)) % np.uint64(BUCKETS), return_counts=True)
    values = np.sqrt(n)
    norm = np.sqrt((values**2).sum())
    return buckets.astype(np.int64), values / norm if norm else values, dense_features(np.array(text_stats(text, cache), np.float64), len(text or b""))


@dataclass
class Model:
    w0: float
    w: np.ndarray  # BUCKETS + DENSE
    v: np.ndarray  # BUCKETS + DENSE, K
    mean: np.ndarray
    scale: np.ndarray

    def sparse(self, idx: np.ndarray, val: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((dense - self.mean) / self.scale, -5, 5)
        return np.r_[idx, BUCKETS + np.arange(DENSE)], np.r_[val, z]

    def margin(self, idx: np.ndarray, x: np.ndarray) -> float:
        v = self.v[idx]
        s = x @ v
        return self.w0 + x @ self.w[idx] + 0.5 * float((s * s).sum() - (x * x) @ (v * v).sum(axis=1))

    def score(self, *features) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*self.sparse(*features)), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 8, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Model:
    """Logistic loss by AdaGrad, one document at a time in a seeded order."""
    rng = np.random.default_rng(seed)
    n = BUCKETS + DENSE
    share = (y.sum() + 1) / (len(y) + 2)
    dense = np.array([r[2] for r in rows]).reshape(-1, DENSE)
    mean, scale = (dense.mean(axis=0), dense.std(axis=0) + 1e-6) if len(rows) else (np.zeros(DENSE), np.ones(DENSE))
    m = Model(float(np.log(share / (1 - share))), np.zeros(n), np.zeros((n, K)), mean, scale)
    if len(set(y.tolist())) < 2:
        return m
    m.v = rng.normal(0, 0.01, (n, K))
    g0, gw, gv = 1e-6, np.full(n, 1e-6), np.full((n, K), 1e-6)
    data = [m.sparse(*r) for r in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            idx, x = data[i]
            v, w = m.v[idx], m.w[idx]
            s = x @ v
            margin = m.w0 + x @ w + 0.5 * float((s * s).sum() - (x * x) @ (v * v).sum(axis=1))
            d = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[i]
            dw = d * x + decay * w
            dv = d * (x[:, None] * s[None, :] - v * (x * x)[:, None]) + decay * v
            g0 += d * d
            gw[idx] += dw * dw
            gv[idx] += dv * dv
            m.w0 -= rate * d / np.sqrt(g0)
            m.w[idx] = w - rate * dw / np.sqrt(gw[idx])
            m.v[idx] = v - rate * dv / np.sqrt(gv[idx])
    return m


def fit_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` rows of docs joined with labels (doc_id, quality), in order of a hash of doc_id."""
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    ids = F.broadcast(chosen)  # `sample` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _FlaggedHash()
        for batch in batches:
            f = [featurize(t.as_py(), cache) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([a[k].astype(kind).tobytes() for a in f], pa.binary()) for k, kind in enumerate(("<i4", "<f4", "<f8")))], ["doc_id", "quality", "idx", "val", "dense"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min(F.col("quality").cast("int")).alias("quality"))
    found = rows.mapInArrow(run, "doc_id long, quality int, idx binary, val binary, dense binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"], r["quality"], r["idx"], r["dense"]))
    parsed = [(np.frombuffer(r["idx"], "<i4").astype(np.int64), np.frombuffer(r["val"], "<f4").astype(np.float64), np.frombuffer(r["dense"], "<f8")) for r in found]
    return fit(parsed, np.array([float(r["quality"] > 0) for r in found]))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted: one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _FlaggedHash()
        for batch in batches:
            scores = np.array([model.score(*featurize(t.as_py(), cache)) for t in batch.column(1).cast(pa.binary())], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int"), "quality-scores")


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_quality_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score_documents(docs, fit_documents(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
