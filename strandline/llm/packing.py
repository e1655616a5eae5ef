"""Best-fit packing of documents into token sequences, certified by lower bounds.

Documents become token ids plus an end id; longer ones than a sequence are cut,
the remainder first, so that all later pieces fill a sequence each. The other
pieces are dealt at random to partitions of a bounded size, and each partition
runs best-fit decreasing. Dual-feasible functions give a lower bound of each
partition's sequences; a partition at its bound is done. Those with a gap pool
the pieces of the sequences that their bound doesn't excuse (the emptiest), deal
them anew to fewer partitions and pack again, until no gap is left, only one
partition has one, a round saves nothing, or `rounds` are over. Each piece tells
its partition's certificate: packed_in (the partition), bound (the fewest
sequences its pieces can take) and gap (sequences above that; 0: certified best).
Pieces that fill a sequence each have no partition and gap 0.

Token ids are the public tokenizer's. Ordinary text goes through the rank file
of the same vocabulary, a whole text at once; a text with the end marker's own
string goes through `tokenizers` itself, which reads it as one id.

Defined cases. Null text: empty, a piece of the end id alone. Null doc_id and
repeated rows: packed like others, a piece each. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

SEQUENCE = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"


class Encoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.json_path, self.full = json_path, None
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.json_path)
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.frombuffer(array("I", self.plain(text)), np.uint32).astype("<u4", copy=False).tobytes()


@lru_cache(1)
def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Encoder:
    """One a Python worker. The paths are of the public tokenizers package unless given."""
    import public_tokenizers

    return Encoder(json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: the remainder first, then full ones."""
    if length <= size:
        return [(0, length)]
    head = length % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, length, size)]


def tokenize(docs: DataFrame, size: int = SEQUENCE, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(json_path, ranks_path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc(text.as_py() or "") + end
                view = memoryview(ids)
                for k, (s, n) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((doc, k, s, n, zlib.crc32(view[4 * s : 4 * (s + n)])))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin of each item, and the place in it.

    Bins are kept by the room left; the set of rooms in use is a bit mask, so
    the tightest bin with room for an item is found without a search.
    """
    order = np.argsort(-lengths, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask, used = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            b, room, used = used, size, used + 1
        bins[i], offsets[i] = b, size - room
        room -= n
        if room:
            by_room[room].append(b)
            mask |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Fewest bins possible, by three families of dual-feasible functions.

    f(x) summed over the items, with f at most 1 over any set that fits: plain
    shares; items above size - t count 1 and those under t nothing; and x (k + 1)
    / size rounded down to k-ths where it isn't whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1)[: size + 1]
    x = np.arange(size + 1)
    best = -(-int((count * x).sum()) // size)
    up = np.r_[0, np.cumsum(count)]  # up[i]: items under i
    mass = np.r_[0, np.cumsum(count * x)]
    t = np.arange(1, size // 2 + 1)
    large = len(lengths) - up[size - t + 1]
    middle = mass[size - t + 1] - mass[t]
    best = max(best, int((large + -(-middle // size)).max()))
    for k in range(1, 20):
        whole = x * (k + 1) % size == 0
        value = np.where(whole, x * k, (x * (k + 1) // size) * size)  # times k * size
        best = max(best, -(-int((count * value).sum()) // (k * size)))
    return best


def pack(pieces: DataFrame, size: int = SEQUENCE, part_rows: int = 50_000, rounds: int = 4) -> DataFrame:
    """pieces (doc_id, piece, length of 1 to size, and others) plus sequence_id, offset, packed_in, bound and gap.

    part_rows bounds what one task packs; a task's sequences are numbered below 2^26.
    Where pieces has a column of one of these names, the result's gets a leading underscore.
    """
    given = pieces.columns
    columns = [c if c == "length" else f"_given{i}" for i, c in enumerate(given)]
    pieces = pieces.toDF(*columns)
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    full = pieces.where(F.col("length") >= size).withColumn("offset", F.lit(0).cast("long")).withColumn("sequence_id", 2 * F.col("_row") + 1)
    full = full.withColumns({"packed_in": F.lit(None).cast("long"), "bound": F.lit(1).cast("long"), "gap": F.lit(0).cast("long")})

    def deal(items: DataFrame, n: int, r: int) -> DataFrame:
        parts = max(1, -(-n // part_rows))

        def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            part = int(key[0])
            pdf = pdf.drop(columns="_part").sort_values("_row", ignore_index=True)
            lengths = pdf["length"].to_numpy()
            bins, offsets = best_fit(lengths, size)
            used = int(bins.max()) + 1
            bound = lower_bound(lengths, size)
            gap = used - bound
            # open to exchange: the emptiest sequence of each task, and with a gap, four for each that could be saved
            open_bins = np.zeros(used, bool)
            if parts > 1:
                open_bins[np.argsort(np.bincount(bins, lengths), kind="stable")[: 1 + 4 * gap]] = True
            return pdf.assign(offset=offsets, sequence_id=2 * (((r << 28 | part) << 26) + bins), packed_in=r << 28 | part, bound=bound, gap=gap, _open=open_bins[bins])

        dealt = items.select(*columns, "_row").withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(r)), F.lit(parts)).cast("int"))
        return materialize(dealt.groupBy("_part").applyInPandas(one, f"{schema}, offset long, sequence_id long, packed_in long, bound long, gap long, _open boolean"), "packed")

    left = pieces.where(F.col("length") < size)
    n = left.count()
    done = [full]
    if n:
        current = deal(left, n, 0)
        for r in range(1, rounds):
            held = current.where("_open").agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("used")).first()
            if held.used < 2:
                break
            new = deal(current.where("_open"), held.n, r)
            if new.agg(F.countDistinct("sequence_id")).first()[0] >= held.used:
                break
            done.append(current.where("NOT _open"))
            current = new
        done.append(current)
    certified = ["sequence_id", "offset", "packed_in", "bound", "gap"]
    out = done[0].select(*columns, *certified)
    for d in done[1:]:
        out = out.unionByName(d.select(*columns, *certified))
    return out.toDF(*given, *fresh(given, *certified))


def pack_documents(docs: DataFrame, size: int = SEQUENCE, **kw) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and the certificate: one row per piece."""
    return pack(tokenize(docs, size), size, **kw)


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
