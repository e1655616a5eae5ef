"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Each unit vector is rotated at random and kept as the signs of its components,
packed to bits, with one correction scalar <o', o> (the code's agreement with
its vector). For a unit query q, <o', q> / <o', o> estimates <o, q> without bias,
and its error stays within

    epsilon * sqrt((1 - <o', o>^2) / <o', o>^2) / sqrt(d - 1)

with high probability. The query is rotated once and cut to 8-bit planes, so
<o', q> is a few ANDs and bit counts of packed words.

Vectors are encoded once and written with their codes. Queries are dealt in
blocks to blocks of vectors (a stated query set against all rows): copies of a
row are as many as blocks of the other side, so both blocks are as large as a
task's memory allows. In a block, the best few estimates are computed exactly,
more until they hold `k` ids, which gives a threshold (the k-th best id's); every
vector whose upper bound reaches it is then computed exactly too (reranking), and
the block returns its `k` nearest. The blocks' results meet by query. Reranking
needs the original vectors beside the codes: at 64 dimensions the bounds leave
15 % and more of unrelated vectors to rerank, so sending survivors by id would
move far more than the blocks do.

Cosine is sum(a b) / (sqrt(sum a^2) sqrt(sum b^2)) in double precision, summed
in the same order for equal vectors, so that ties are ties.

Defined cases. Vectors null, zero, empty or holding null or non-finite
components take no part, nor do null ids. Vectors of different lengths don't
meet. Rows that repeat both id and vector count once; an id with several vectors
is as near as the nearest of them. Fewer than k candidates: all of them. Extra
columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import materialize

EPSILON = 3.0
QUERY_BITS = 8
VECTOR_BLOCK, QUERY_BLOCK = 16_384, 16_384


@lru_cache(4)
def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits (n, words of uint64) and <o', o> of unit vectors."""
    n, d = unit.shape
    turned = unit @ rotation(d)
    bits = np.packbits(turned > 0, axis=1, bitorder="little")
    words = np.zeros((n, -(-d // 64) * 8), np.uint8)
    words[:, : bits.shape[1]] = bits
    return words.view(np.uint64), np.abs(turned).sum(axis=1) / np.sqrt(d)


def estimate(codes: np.ndarray, agree: np.ndarray, query: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products with a unit query, and their error bounds."""
    d = len(query)
    turned = query @ rotation(d)
    low, high = turned.min(), turned.max()
    step = (high - low) / (2**QUERY_BITS - 1) or 1.0
    level = np.rint((turned - low) / step).astype(np.uint8)
    planes = np.zeros((QUERY_BITS, codes.shape[1] * 8), np.uint8)
    for b in range(QUERY_BITS):
        packed = np.packbits((level >> b) & 1, bitorder="little")
        planes[b, : len(packed)] = packed
    planes = planes.view(np.uint64)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    weighted = np.zeros(len(codes), np.int64)
    for b in range(QUERY_BITS):
        weighted += np.bitwise_count(codes & planes[b]).sum(axis=1, dtype=np.int64) << b
    # signs are 2 bit - 1, the query low + step level
    dot = (low * (2 * ones - d) + step * (2 * weighted - int(level.sum()))) / np.sqrt(d)
    bound = epsilon * np.sqrt(np.maximum(1 - agree**2, 0)) / agree / np.sqrt(max(d - 1, 1)) + step * np.sqrt(d) / 2 / agree
    return dot / agree, bound


def _in_order(products: np.ndarray) -> np.ndarray:
    """Row sums, added from the first component to the last."""
    return np.add.accumulate(products, axis=1)[:, -1]


def _cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    return _in_order(vectors * query) / (norms * norm)


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    """Lists of d numbers as rows of doubles."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _nearest(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest of a block of coded vectors for each of a block of queries."""
    if not len(vectors) or not len(queries):
        return _FOUND.empty_table()
    vectors = vectors.sort_by("vec_id")
    ids, d = vectors["vec_id"].to_numpy(), vectors["d"][0].as_py()
    x, q = _matrix(vectors["vector"], d), _matrix(queries["vector"], d)
    norms, q_norms = np.sqrt(_in_order(x * x)), np.sqrt(_in_order(q * q))
    codes = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint64).reshape(len(ids), -1)
    agree = vectors["agree"].to_numpy()
    out: list[list] = [[], [], []]
    for own, vector, norm in zip(queries["vec_id"].to_pylist(), q, q_norms, strict=True):
        est, bound = estimate(codes, agree, vector / norm)
        est[ids == own] = -np.inf
        size = 4 * k
        while True:
            first = np.argpartition(-est, min(size, len(est) - 1))[:size]
            first = first[np.isfinite(est[first])]
            exact = _cosines(x[first], norms[first], vector, norm)
            # the k-th best id, not row: an id may have many vectors
            down = np.argsort(-exact, kind="stable")
            _, best = np.unique(ids[first][down], return_index=True)
            if len(best) >= k or size >= len(est):
                break
            size *= 4
        least = exact[down][np.sort(best)[k - 1]] if len(best) >= k else -np.inf
        again = np.flatnonzero((est + bound >= least) & np.isfinite(est))
        again = np.union1d(again, first)
        scores = _cosines(x[again], norms[again], vector, norm)
        # an id with several vectors counts once, as its nearest
        order = np.lexsort((ids[again], -scores))
        taken: dict[int, float] = {}
        for i in order:
            taken.setdefault(int(ids[again[i]]), float(scores[i]))
            if len(taken) == k:
                break
        for c, v in zip(out, ([own] * len(taken), taken.keys(), taken.values()), strict=True):
            c.extend(v)
    return pa.table(out, schema=_FOUND)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (floats where they are given as such, else doubles) of the rows that take part, each once."""
    kind = vectors.schema[vector_col].dataType
    number = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{number}>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)).distinct()


def coded(vectors: DataFrame) -> DataFrame:
    """vectors plus d (their length), code (packed signs) and agree (the correction scalar)."""
    columns = [f.name for f in vectors.schema.fields]
    at = columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(at)).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                some = batch.filter(pa.array(sizes == d))
                x = some.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                words, agree = encode(x / np.sqrt(_in_order(x * x))[:, None])
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.full(len(x), d, np.int32)), pa.array([w.tobytes() for w in words], pa.binary()), pa.array(agree)], [*columns, "d", "code", "agree"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kinds}, d int, code binary, agree double")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of vectors for each of queries (both as usable() gives them)."""
    vectors = materialize(coded(vectors), "vectors", batch_rows=None)
    queries = materialize(queries, "queries")
    n, q_blocks = vectors.count(), max(1, ceil(queries.count() / query_block))
    # blocks of full size, or of less where that leaves cores idle
    busy = ceil(2 * vectors.sparkSession.sparkContext.defaultParallelism / q_blocks)
    v_blocks = max(1, ceil(n / vector_block), min(busy, n // 2_048))

    def block(n):
        return F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.withColumn("vb", block(v_blocks)).withColumn("qb", every(q_blocks))
    right = queries.withColumn("d", F.size("vector")).withColumn("qb", block(q_blocks)).withColumn("vb", every(v_blocks))

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        return _nearest(a, b, k)

    found = left.groupBy("d", "vb", "qb").cogroup(right.groupBy("d", "vb", "qb")).applyInArrow(nearest, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op1_ann(spark, sf_dir):
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(vectors, vectors.where("vec_id % 50 = 0"))


#: Exact nearest neighbours by DuckDB.
OP1_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
pair AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) / (sqrt(list_dot_product(q.x, q.x)) * sqrt(list_dot_product(c.x, c.x))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
best AS (SELECT query_id, vec_id, max(score) AS score FROM pair GROUP BY query_id, vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM best)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
