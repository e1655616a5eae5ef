"""Mixing sources to target weights by Pfair scheduling.

Block k of a source of share w has the release time floor(k / w) and the deadline
ceil((k + 1) / w); earliest-deadline-first over the released blocks fills every
slot, and at any time each source is within one block of its share. Shares are
integers of a sum near 2^62, so times are exact over the whole run.

A source's documents are put in an order of their own and cut into blocks of
`block` documents, however many there are. The schedule is made in frames of
`frame` slots side by side. A frame needs to know which sources are a block ahead
of their share at its first slot. It finds that by scheduling the slots before
it, from a guess; a frame whose guess differs from what the frame before ends
with is made again from that, until all agree. So the result is the one schedule
from slot 0, whatever the frames: the first frame's start is certain, and each
round settles one more at least. The schedule ends with the slot in
which the slowest source has given all its blocks; others begin again (epochs),
so every document of a source with a weight is used at least once and the mix
holds to the end. Ranks inside a source come from counts of bounded hash ranges,
so no task holds a whole source. Only ids are ranked and scheduled; texts move
once to their places and once into the order of the schedule.

Defined cases. Null source: a source of its own. Sources without a given weight,
when weights are given: an error. Weight 0: no slots, so none of its documents;
as many sources as a task's memory holds (millions), each with a weight of its
own. Null doc_id, repeated rows and null or empty texts: documents like others.
Extra columns stay; where one has the name of a result's column (epoch, block,
slot, place), the result's gets a leading underscore. Empty table: empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialize

BLOCK = 16
FRAME = 1 << 20
#: A plan of more sources than this isn't broadcast.
MOST_PLAN = 100_000
RANGE_ROWS = 20_000


def shares(weights: dict[str | None, float]) -> dict[str | None, int]:
    """Integers in the ratio of the weights over 0, exact to one in 2^62."""
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be at least 0, with a positive sum")
    exact = {s: Fraction(w) for s, w in weights.items() if w > 0}
    total = sum(exact.values())
    return {s: max(1, round(w / total * 2**62)) for s, w in exact.items()}


def exact_schedule(parts: list[int], slots: int, begin: int = 0, counts: list[int] | None = None, strict: bool = True) -> Iterator[tuple[int, int, int]]:
    """(number of the source, k, slot) of the slots from begin to slots, by earliest deadline first.

    counts: how many blocks each source has given before begin (none at slot 0). A
    missed deadline is an error, or taken as it comes where not strict.
    """
    whole = sum(parts)
    given = counts or [0] * len(parts)
    waiting = [(k * whole // p, i, k) for i, (p, k) in enumerate(zip(parts, given, strict=True))]  # release, source, k
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    for slot in range(begin, slots):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * whole // parts[i]), i, k))
        if not ready and not strict:
            continue
        deadline, i, k = heapq.heappop(ready)
        if strict and deadline <= slot:
            raise AssertionError("a deadline was missed")
        yield i, k, slot
        heapq.heappush(waiting, ((k + 1) * whole // parts[i], i, k + 1))


def _counts(parts: list[int], slot: int, ahead: bytes) -> list[int]:
    """Blocks given before a slot: the share rounded down, and one more for sources ahead (a bit each)."""
    whole = sum(parts)
    return [slot * p // whole + (ahead[i >> 3] >> (i & 7) & 1) for i, p in enumerate(parts)]


def _ahead(parts: list[int], slot: int, counts: list[int]) -> bytes:
    """The bits of _counts(); sources further off than a block count as one."""
    whole, out = sum(parts), bytearray(-(-len(parts) // 8))
    for i, (p, k) in enumerate(zip(parts, counts, strict=True)):
        if k > slot * p // whole:
            out[i >> 3] |= 1 << (i & 7)
    return bytes(out)


def _likely(parts: list[int], slot: int) -> list[int]:
    """A guess of the blocks given before a slot: of the sources inside a block, those with the earliest deadlines are ahead."""
    whole = sum(parts)
    counts = [slot * p // whole for p in parts]
    inside = [i for i, p in enumerate(parts) if slot * p % whole]
    inside.sort(key=lambda i: (-(-(counts[i] + 1) * whole // parts[i]), i))
    for i in inside[: slot - sum(counts)]:
        counts[i] += 1
    return counts


def _run(parts: list[int], begin: int, end: int, counts: list[int]) -> list[int]:
    """Blocks given before `end` from those before `begin`, a guess maybe."""
    out = list(counts)
    for i, k, _ in exact_schedule(parts, end, begin, counts, strict=False):
        out[i] = k + 1
    return out


def _ranked(docs: DataFrame, row: str, range_rows: int) -> tuple[DataFrame, DataFrame]:
    """row, source, rank (from 0) of each row inside its source, and documents by source (source, n)."""
    n = docs.count()
    ranges = max(1, ceil(n / range_rows))
    own = docs.select(F.col(row).alias("row"), F.col("source").cast("string")).withColumn("range", F.pmod(F.xxhash64("row"), F.lit(ranges)).cast("int"))
    counts = own.groupBy("source", "range").agg(F.count("*").alias("n"))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = materialize(counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-starts")
    # a group is a range of a source: range_rows rows, more or less
    inside = W.partitionBy("source", "range").orderBy("row")
    ranked = own.withColumn("at", F.row_number().over(inside) - 1)
    s = starts.select(F.col("source").alias("s"), F.col("range").alias("r"), "start")
    ranked = ranked.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    return ranked.select("row", "source", (F.col("start") + F.col("at")).alias("rank")), starts.groupBy("source").agg(F.sum("n").alias("n"))


def _starts(spark: SparkSession, numbers: list[int], slots: int, frame: int) -> DataFrame:
    """frame, ahead: which sources are a block ahead at each frame's first slot, as the schedule from slot 0 has it."""
    frames = -(-slots // frame)

    def ends(at: int, ahead: bytes) -> bytes:
        end = min((at + 1) * frame, slots)
        return _ahead(numbers, end, _run(numbers, at * frame, end, _counts(numbers, at * frame, ahead)))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                begin = at * frame
                before = max(0, begin - max(1, frame // 4))
                ahead = _ahead(numbers, begin, _run(numbers, before, begin, _likely(numbers, before)))
                yield pa.RecordBatch.from_pylist([{"frame": at, "ahead": ahead, "end": ends(at, ahead)}], _STARTS)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ahead in zip(batch.column("frame").to_pylist(), batch.column("ahead").to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist([{"frame": at, "ahead": ahead, "end": ends(at, ahead)}], _STARTS)

    if frames == 1:
        return spark.range(1).select(F.col("id").alias("frame"), F.lit(bytes(-(-len(numbers) // 8))).alias("ahead"))
    made = materialize(spark.range(0, frames, 1, frames).mapInArrow(guess, "frame long, ahead binary, end binary"), "mix-frames")
    while True:
        due = made.select((F.col("frame") + 1).alias("frame"), F.col("end").alias("due"))
        wrong = made.join(due, "frame").where(F.col("due") != F.col("ahead")).select("frame", F.col("due").alias("ahead"))
        wrong = materialize(wrong, "mix-wrong")
        n = wrong.count()
        if n == 0:
            return made.select("frame", "ahead")
        mended = wrong.repartition(n, "frame").mapInArrow(again, "frame long, ahead binary, end binary")
        made = materialize(made.join(wrong.select("frame"), "frame", "left_anti").unionByName(mended), "mix-frames")


_STARTS = pa.schema([("frame", pa.int64()), ("ahead", pa.binary()), ("end", pa.binary())])


def _schedule(spark: SparkSession, numbers: list[int], slots: int, frame: int) -> DataFrame:
    """j (number of the source), k, slot of all slots, a task a frame."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ahead in zip(batch.column("frame").to_pylist(), batch.column("ahead").to_pylist(), strict=True):
                made = exact_schedule(numbers, min((at + 1) * frame, slots), at * frame, _counts(numbers, at * frame, ahead))
                while part := list(islice(made, 50_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], ["j", "k", "slot"])

    frames = -(-slots // frame)
    starts = _starts(spark, numbers, slots, frame).repartitionById(frames, F.col("frame").cast("int"))
    return materialize(starts.mapInArrow(rows, "j long, k long, slot long"), "mix-schedule")


def _places(ranks: DataFrame, weights: dict, blocks: dict, block: int, frame: int) -> tuple[DataFrame, int]:
    """row, epoch, block, slot, place of every use of a row, and the number of slots."""
    spark = ranks.sparkSession
    parts = shares(weights)
    names, whole = list(parts), sum(parts.values())
    numbers = [parts[s] for s in names]
    slots = max(-(-blocks[s] * whole // parts[s]) for s in names)
    plan = spark.createDataFrame([(s, i, blocks[s], -(-slots * parts[s] // whole)) for i, s in enumerate(names)], "s string, i long, blocks long, total long")
    table = _schedule(spark, numbers, slots, frame)
    uses = ranks.join(F.broadcast(plan) if len(names) <= MOST_PLAN else plan, F.col("source").eqNullSafe(F.col("s")))
    first = F.floor(F.col("rank") / block)
    last = F.floor((F.col("total") - 1 - first) / F.col("blocks"))
    uses = uses.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    uses = uses.withColumn("block", first + F.col("epoch") * F.col("blocks")).withColumn("place", F.col("rank") % block)
    met = uses.join(table, (F.col("i") == F.col("j")) & (F.col("block") == F.col("k")))
    return met.select("row", "epoch", "block", "slot", "place"), slots


def _mixed(docs: DataFrame, names: list[str], weights: dict[str | None, float] | None, exponent: float, block: int, frame: int, range_rows: int) -> tuple[DataFrame, int]:
    """docs with the uses' epoch, block, slot and place under `names`, and the number of slots."""
    (row,) = fresh([*docs.columns, *names], "_row")
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    ranks, sizes = _ranked(rows, row, range_rows)
    found = {r.source: r.n for r in sizes.collect()}  # a row a source
    if not found:
        return docs.select("*", *(F.lit(0).cast("long").alias(c) for c in names)), 0
    if weights is not None and (missing := set(found) - set(weights)):
        raise ValueError(f"no weight for {sorted(map(str, missing))}")
    given = {s: weights[s] if weights else found[s] ** exponent for s in found}
    places, slots = _places(ranks, given, {s: ceil(n / block) for s, n in found.items()}, block, frame)
    places = places.select(F.col("row").alias(row), *(F.col(c).alias(n) for c, n in zip(("epoch", "block", "slot", "place"), names, strict=True)))
    return rows.join(places, row).select(*docs.columns, *names), slots


def result_names(docs: DataFrame) -> list[str]:
    """The names of the result's epoch, block, slot and place."""
    return fresh(docs.columns, "epoch", "block", "slot", "place")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.9, block: int = BLOCK, frame: int = FRAME, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The columns of docs plus epoch, block (of its source), slot and place (inside the block): see result_names().

    Without weights, a source's is its number of documents to the power `exponent`.
    """
    return _mixed(docs, result_names(docs), weights, exponent, block, frame, range_rows)[0]


def mix_documents(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.9, block: int = BLOCK, frame: int = FRAME, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The documents in the order of the schedule, with their own columns only.

    Partition k holds the k-th part of the slots, in order.
    """
    names = result_names(docs)
    out, slots = _mixed(docs, names, weights, exponent, block, frame, range_rows)
    parts = max(1, min(slots, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    at = F.floor(F.col(names[2]) * parts / max(slots, 1)).cast("int")
    return out.repartitionById(parts, at).sortWithinPartitions(names[2], names[3]).select(*docs.columns)


def op7_source_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix(docs)
