"""Shared helpers: table access, lineage cuts in shared storage, word kernels."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir, which every executor can reach; removed when Python ends.

    Where the setting is missing, a local master gets a temporary folder and any other an error.
    """
    context = spark.sparkContext
    found = _FOLDERS.get(context.applicationId)
    if found is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="strandline-")
        found = _FOLDERS[context.applicationId] = f"{configured.rstrip('/')}/strandline-{context.applicationId}"
        atexit.register(remove, spark, found)
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage; a stopped session leaves it."""
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """names, each with as many leading underscores as keep it apart from columns (whatever their case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the folders that materialize() writes meanwhile in this thread, for a caller that knows when they can go."""
    token = _MADE.set([])
    try:
        yield _MADE.get()
    finally:
        _MADE.reset(token)


BATCH_ROWS = 1_000


def materialize(df: DataFrame, name: str, batch_rows: int | None = BATCH_ROWS) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    This cuts lineage: a lost executor costs the reread of a file, never the
    recomputation of what came before. While it is written, Arrow batches hold
    batch_rows rows at most unless the session asks for other than Spark's
    default: a batch of 10,000 texts fills Arrow's buffers on both sides of a
    Python worker, and neither side gives such memory back while it lives.
    """
    return materialize_at(df, name, batch_rows)[0]


def materialize_at(df: DataFrame, name: str, batch_rows: int | None = BATCH_ROWS) -> tuple[DataFrame, str]:
    """materialize(), and the folder, for callers that know when nothing reads it any more."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", spark.conf.get(key)
    if (made := _MADE.get()) is not None:
        made.append(path)
    small = batch_rows and before == "10000"
    if small:
        spark.conf.set(key, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        if small:
            spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path), path


HEAVY = 1_000


def join_counted(rows: DataFrame, one: DataFrame, keys: list[str], count: str, total: int | None = None, heavy: int = HEAVY) -> DataFrame:
    """rows (inner) joined with `one`, which has a row a key and in `count` how many of rows have that key.

    A key with over 1 / heavy of all rows would fill one task. There are `heavy`
    such keys at most, so their rows of `one` are broadcast and rows stay where
    they are; all other keys meet by a shuffle. `count` isn't in the result.
    total: how many rows there are, where the caller knows it.
    """
    if total is None:
        one = materialize(one, "keys")
        total = one.agg(F.sum(count)).first()[0] or 0
    many = F.col(count) > total // heavy
    hot, cold = one.where(many).drop(count), one.where(~many).drop(count)
    left = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(F.broadcast(hot), keys).unionByName(left)


class WordHash(dict):
    """64-bit hash of a word (bytes), remembered for a bounded vocabulary."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(z: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 arrays."""
    z = (z ^ (z >> _S30)) * _MIX1
    z = (z ^ (z >> _S27)) * _MIX2
    return z ^ (z >> _S31)


def word_hashes(words: list[bytes], cache: WordHash) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes; of the whole where fewer."""
    n = len(h)
    if n == 0:
        return h
    k = min(k, n)
    z = h[: n - k + 1].copy()
    for i in range(1, k):
        z *= _MULT
        z += h[i : n - k + 1 + i]
    return mix64(z + np.uint64(k))


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 text; bytes.split() cuts at exactly these six characters."""
    return text.split() if text else []


def lower_words_of(text: bytes | None) -> list[bytes]:
    """The same after lower-casing A-Z alone."""
    return text.lower().split() if text else []


ID_BITS = 1 << 25


def flag_ids(df: DataFrame, key: str, ids: DataFrame, flag: str = "_maybe", bits: int = ID_BITS) -> DataFrame:
    """df plus flag: true for every row whose key is among ids' first column, and for a few others.

    A bitmap of the ids' hashes (4 MB at most, whatever the input) is broadcast,
    so that a following join shuffles little of df. Where ids fill the bitmap all
    rows are flagged, which costs a shuffle, never a row.
    """
    at, bucket, bit, found, byte = fresh([*df.columns, flag], "_at", "_bucket", "_bit", "_map", "_byte")
    hashed = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(bits))
    known = ids.where(F.col(ids.columns[0]).isNotNull()).select(hashed(F.col(ids.columns[0])).alias(at))
    maps = known.selectExpr(f"bitmap_bucket_number({at}) AS {bucket}", f"bitmap_bit_position({at}) AS {bit}").groupBy(bucket).agg(F.expr(f"bitmap_construct_agg({bit})").alias(found))
    out = df.withColumn(at, F.when(F.col(key).isNotNull(), hashed(F.col(key))))
    out = out.withColumns({bucket: F.expr(f"bitmap_bucket_number({at})"), bit: F.expr(f"bitmap_bit_position({at})")})
    out = out.join(F.broadcast(maps), bucket, "left")
    out = out.withColumn(byte, F.conv(F.hex(F.expr(f"substring({found}, CAST({bit} DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int"))
    out = out.withColumn(flag, F.expr(f"coalesce((shiftright({byte}, CAST({bit} % 8 AS INT)) & 1) = 1, false)"))
    return out.select(*df.columns, flag)


def only_ids(df: DataFrame, key: str, ids: DataFrame, bits: int = ID_BITS) -> DataFrame:
    """The rows of df that flag_ids flags."""
    (flag,) = fresh(df.columns, "_maybe")
    return flag_ids(df, key, ids, flag, bits).where(F.col(flag)).drop(flag)
