"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct 5-word shingles. Each of M registers holds
floor(1 - log_b(min h)) of an exponential hash h of the set's members, clipped to
[0, Q+1]: the minima are exponentially spaced and truncated, so two sketches
merge by an element-wise maximum, and registers of similar sets agree with a
probability close to their Jaccard similarity. The steps:

1. sketch every document (Arrow batches; no shuffle) and write the sketches;
2. collapse texts whose whole word sequence is the same (128-bit digest);
3. band the registers: a bucket compares each member with its least id by the
   joint maximum-likelihood estimate of their similarity from the registers. Only
   buckets with a member unlike the least one go on: their unlike members meet
   all of the bucket's, by registers too, in blocks. So what chains documents is
   an estimate near the threshold, never a collision alone;
4. components of those links are candidate clusters, where pairs that share a
   band and whose estimate allows it are compared by full shingle sets. Clusters
   above `block` members are dealt in blocks, and every pair of blocks is one
   small task that gives links of a spanning forest only;
5. connected components over those links.

With bands of 5 of 120 registers a pair at similarity 0.85 shares no band with a
probability under 1e-6; the estimate discards a pair only 4.5 standard
deviations below the threshold.

Defined cases. Null, empty or blank text: empty set, linked with nothing. Fewer
than five words: the whole sequence is the one shingle. Null doc_id: not linked,
component null, kept. Repeated rows with one doc_id: a row each, as one
document. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHash, join_counted, lower_words_of, materialize, mix64, only_ids, window_hashes, word_hashes
from .graph import connected_components

SHINGLE = 5
M, BAND = 120, 5
BANDS = M // BAND
A, B, Q = 20.0, 1.001, 2**16 - 2
_rng = np.random.default_rng(20240917)
_MUL = (_rng.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32)[:, None]
_CHUNK = 2048
Near = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of uint64 shingle hashes.

    h = -ln(1 - u) / A grows with the uniform hash u, so the least u of each
    register is found first, chunk by chunk, and transformed once.
    """
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(M, 2**32 - 1, np.uint32)
    for at in range(0, len(x), _CHUNK):
        z = x[at : at + _CHUNK] * _MUL
        z += _ADD
        np.minimum(least, z.min(axis=1), out=least)
    u = (least.astype(np.float64) + 0.5) / 2**32
    h = -np.log1p(-u) / A
    return np.clip(np.floor(1 - np.log(h) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def band_hashes(regs: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band (last axis: registers)."""
    r = regs.reshape(*regs.shape[:-1], BANDS, BAND).astype(np.uint64)
    z = np.zeros(r.shape[:-1], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND):
        z = mix64(z * np.uint64(0x9E3779B97F4A7C15) + r[..., i])
    return z


_GRID = np.linspace(0.0, 1.0, 51)


def estimate_similarity(more: np.ndarray, less: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood Jaccard similarity on a grid of 0.02.

    more and less count registers where u's value is above and below v's; the
    sizes are known exactly. p_b(x) = -log_b(1 - x (b - 1) / b).
    """
    u = (n_u / (n_u + n_v))[:, None]
    v = 1 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))
    p = lambda x: -np.log1p(-np.maximum(x, 1e-12) * (B - 1) / B) / np.log(B)
    up, down = p(u - v * j), p(v - u * j)
    same = np.maximum(1 - up - down, 1e-12)
    ll = more[:, None] * np.log(up) + less[:, None] * np.log(down) + (M - more - less)[:, None] * np.log(same)
    return np.take_along_axis(j, ll.argmax(axis=1)[:, None], 1)[:, 0]


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for batch in batches:
        sizes, keys, regs, bands = [], [], [], []
        for text in batch.column(1).cast(pa.binary()):
            words = lower_words_of(text.as_py())
            keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
            s = np.unique(window_hashes(word_hashes(words, cache), SHINGLE))
            sizes.append(len(s))
            if len(words) >= SHINGLE:
                r = registers(s)
                regs.append(r.tobytes())
                bands.append(band_hashes(r).view(np.int64))
            else:
                regs.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "text_key", "regs", "bands"],
        )
        pa.default_memory_pool().release_unused()


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, text_key (digest of the word sequence), regs, bands."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sketch_batches, "doc_id long, n_shingles long, text_key binary, regs binary, bands array<long>")


def shingle_ids(texts: list[bytes]) -> list[np.ndarray]:
    """Exact: equal ids mean equal 5-word shingles (of texts with five words at least)."""
    vocabulary: dict[bytes, int] = {}
    ids = [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in lower_words_of(t)), np.int64) for t in texts]
    counts = [max(len(x) - SHINGLE + 1, 0) for x in ids]
    runs = [np.concatenate([x[i : len(x) - SHINGLE + 1 + i] for x in ids]) if ids else np.empty(0, np.int64) for i in range(SHINGLE)]
    code = runs[0]
    for nxt in runs[1:]:
        _, code = np.unique(code * (len(vocabulary) + 1) + nxt, return_inverse=True)
    cuts = np.cumsum(counts)[:-1]
    return [np.unique(x) for x in np.split(code, cuts)]


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self) -> np.ndarray:
        r = self.up
        while True:
            s = r[r]
            if (s == r).all():
                self.up = r
                return r
            r = s


def _link_cluster(pdf: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Spanning links of the pairs of one cluster, or of two of its blocks, that reach the similarity."""
    pdf = pdf.sort_values("doc_id", ignore_index=True)
    n = len(pdf)
    ids, side = pdf["doc_id"].to_numpy(), pdf["block"].to_numpy()
    both = len(np.unique(side)) > 1
    regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(n, M)
    bands = band_hashes(regs)
    sets = shingle_ids(list(pdf["text"]))
    sizes = np.array([len(s) for s in sets], np.float64)
    marks = np.zeros(int(max((s[-1] for s in sets if len(s)), default=-1)) + 1, np.int8)
    forest, links = _Forest(n), []
    for i in range(n - 1):
        later = np.arange(i + 1, n)
        if both:
            later = later[side[later] != side[i]]
        later = later[np.minimum(sizes[later], sizes[i]) * 100 >= percent * np.maximum(sizes[later], sizes[i])]
        if len(later):
            roots = forest.roots()
            later = later[roots[later] != roots[i]]
        if len(later):
            later = later[(bands[later] == bands[i]).any(axis=1)]
        if not len(later):
            continue
        more = (regs[i] > regs[later]).sum(axis=1)
        less = (regs[i] < regs[later]).sum(axis=1)
        later = later[estimate_similarity(more, less, np.full(len(later), sizes[i]), sizes[later]) >= _floor(percent)]
        if not len(later):
            continue
        marks[sets[i]] = 1
        lens = np.array([len(sets[j]) for j in later])
        common = np.add.reduceat(marks[np.concatenate([sets[j] for j in later])].astype(np.int64), np.r_[0, np.cumsum(lens)[:-1]])
        marks[sets[i]] = 0
        for j in later[100 * common >= percent * (lens + len(sets[i]) - common)]:
            a, b = forest.root(i), forest.root(j)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                links.append((int(ids[j]), int(ids[i])))
    return links


def _floor(percent: int) -> float:
    """The least estimate that a pair at the similarity may have: 4.5 standard deviations below it."""
    p = percent / 100
    return p - 4.5 * float(np.sqrt(p * (1 - p) / M))


def registers_of(column: Iterable[bytes], n: int) -> np.ndarray:
    """A row of uint16 registers for each of n sketches."""
    return np.frombuffer(b"".join(column), np.uint16).reshape(n, -1)


def near_sketches(percent: int) -> Near:
    """May sketches a and b of sets of n and m members reach the similarity?"""

    def near(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
        alike = estimate_similarity((a > b).sum(axis=1), (a < b).sum(axis=1), n, m) >= _floor(percent)
        return alike & (np.minimum(n, m) * 100 >= percent * np.maximum(n, m))

    return near


def _bucket_links(members: pa.Table, near: Near) -> list[tuple[int, int]]:
    """Spanning links, by registers, of one bucket's pairs (or of two of its blocks) with an unlike member."""
    n = members.num_rows
    ids, side, unlike = (members.column(c).to_numpy() for c in ("doc_id", "block", "unlike"))
    if n < 2 or not unlike.any():
        return []
    order = np.argsort(ids, kind="stable")
    ids, side, unlike = ids[order], side[order], unlike[order]
    both = side.min() != side.max()
    regs = registers_of(members.column("regs").to_pylist(), n)[order]
    sizes = members.column("n_shingles").to_numpy()[order].astype(np.float64)
    forest, links, at = _Forest(n), [], np.arange(n)
    for i in np.flatnonzero(unlike):
        others = at[(at > i) | ~unlike]
        if both:
            others = others[side[others] != side[i]]
        if len(others):
            roots = forest.roots()
            others = others[roots[others] != roots[i]]
        if not len(others):
            continue
        for j in others[near(regs[others], sizes[others], regs[i : i + 1], sizes[i : i + 1])]:
            a, b = forest.root(i), forest.root(j)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                links.append((int(ids[j]), int(ids[i])))
    return links


def block_pairs(blocks: str, block: str) -> Column:
    """Every pair of blocks (a <= b) that a member's block takes part in."""
    return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda o: F.struct(F.least(o, block).alias("a"), F.greatest(o, block).alias("b")))


def candidate_links(sketches: DataFrame, near: Near, block: int = 2048, banded: DataFrame | None = None) -> DataFrame:
    """Links (u, v) whose components hold every pair that shares a band and is near by registers.

    sketches: doc_id, n_shingles, regs, bands, one row per text. banded: doc_id,
    band, each once, where the caller has them instead of bands; read twice.
    """

    @F.pandas_udf("boolean")
    def alike(regs_u: pd.Series, n_u: pd.Series, regs_v: pd.Series, n_v: pd.Series) -> pd.Series:
        n = len(regs_u)
        return pd.Series(near(registers_of(regs_u, n), n_u.to_numpy(np.float64), registers_of(regs_v, n), n_v.to_numpy(np.float64)) if n else np.zeros(0, bool))

    if banded is None:
        banded = materialize(sketches.select("doc_id", F.explode("bands").alias("band")).dropDuplicates(["doc_id", "band"]), "bands")
    pivots = banded.groupBy("band").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("v < last").drop("last")
    pivots = materialize(pivots, "pivots")
    shared = materialize(only_ids(banded, "band", pivots), "shared-bands")
    stars = join_counted(shared, pivots, ["band"], "n", pivots.agg(F.sum("n")).first()[0] or 0).where("doc_id != v").select("band", F.col("doc_id").alias("u"), "v")
    stars = materialize(stars, "stars")
    pairs = stars.select("u", "v").distinct()
    ids = stars.select("u").unionByName(stars.select(F.col("v").alias("u"))).distinct()
    regs = materialize(only_ids(sketches.select("doc_id", "n_shingles", "regs"), "doc_id", ids).dropDuplicates(["doc_id"]), "star-registers")
    mine = regs.select(F.col("doc_id").alias("u"), F.col("n_shingles").alias("n_u"), F.col("regs").alias("regs_u"))
    other = regs.select(F.col("doc_id").alias("v"), F.col("n_shingles").alias("n_v"), F.col("regs").alias("regs_v")).join(pairs.groupBy("v").count(), "v")
    judged = join_counted(pairs.join(mine, "u"), other, ["v"], "count").select("u", "v", alike("regs_u", "n_u", "regs_v", "n_v").alias("alike"))
    judged = materialize(judged, "stars-judged")
    unlike = stars.join(judged.where("NOT alike"), ["u", "v"]).select("band", "u")
    # a bucket of two has no pair but the one that is judged
    sizes = unlike.groupBy("band").agg(F.count("*").alias("_u")).join(pivots.where("n > 2").select("band", "n"), "band").select("band", "n", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = join_counted(stars.join(judged, ["u", "v"]).select("band", F.col("u").alias("doc_id"), (~F.col("alike")).alias("unlike")), sizes, ["band"], "n")
    members = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    members = members.join(regs, "doc_id").withColumn("p", F.explode(block_pairs("blocks", "block")))

    def compare(members: pa.Table) -> pa.Table:
        links = _bucket_links(members, near)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    more = members.select("band", "doc_id", "n_shingles", "regs", "unlike", "block", "p.a", "p.b").groupBy("band", "a", "b").applyInArrow(compare, "u long, v long")
    return judged.where("alike").select("u", "v").unionByName(more)


def near_components(docs: DataFrame, percent: int = 85, block: int = 512) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents with 100 * |intersection| >= percent * |union| of their shingle
    sets are linked; component_id is the least doc_id reachable.
    """
    sketches = materialize(sketch(docs), "sketches")
    # a word sequence's first document stands for all its copies
    named = sketches.where("text_key IS NOT NULL AND doc_id IS NOT NULL")
    copies = materialize(named.groupBy("text_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "copies")
    reps = sketches.where("bands IS NOT NULL AND doc_id IS NOT NULL").join(copies.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    clusters = materialize(connected_components(candidate_links(reps, near_sketches(percent))), "clusters")
    sizes = clusters.groupBy("label").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = join_counted(clusters, sizes, ["label"], "n").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.select(F.col("id").alias("doc_id"), "label", "blocks", "block")
    placed = placed.join(only_ids(sketches.select("doc_id", "regs"), "doc_id", placed).dropDuplicates(["doc_id"]), "doc_id")
    texts = only_ids(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")), "doc_id", placed.select("doc_id"))
    members = texts.join(placed, "doc_id").dropDuplicates(["doc_id"]).withColumn("p", F.explode(block_pairs("blocks", "block")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_link_cluster(pdf, percent), columns=["u", "v"]).astype("int64")

    links = members.select("doc_id", "text", "regs", "block", "label", "p.a", "p.b").groupBy("label", "a", "b").applyInPandas(compare, "u long, v long")
    labels = connected_components(links).select(F.col("id").alias("rep"), "label")
    by_key = copies.join(labels, "rep", "left").select("text_key", F.coalesce("label", "rep").alias("component_id"), "n")
    met = join_counted(named.select("doc_id", "n_shingles", "text_key"), by_key, ["text_key"], "n").drop("text_key")
    alone = sketches.where("text_key IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = met.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_minhash_dedup(spark, sf_dir):
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
