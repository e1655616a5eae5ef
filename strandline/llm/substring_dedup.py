"""Repeated passages by paragraph MinHash banding.

Paragraphs are lines of `min_words` words at least, and shorter lines joined: a
run of them up to the next blank or long line, cut after a line whose hash says
so once it has `min_words` words. Their MinHash signatures over distinct 5-word
shingles (A-Z lower-cased) are banded for recall: 16 bands of 3 find a pair at
similarity 0.8 with a probability of 1 - (1 - 0.8^3)^16 > 0.99998. Equal
paragraphs are collapsed first; colliding ones are judged by whole signatures
(4.5 standard deviations of slack), clusters of what is left are compared by exact
Jaccard similarity of whole shingle sets, and the links' connected components are
the groups of which one stays (large clusters are dealt in pairs of blocks).

A passage need not be a paragraph: it may begin and end inside longer lines. So a
document's runs of `min_words` words that begin at content-defined anchors (the
least 5-word hash of any 12 in a row) are looked up too, by a 128-bit digest of
their words that is made in the same reading. Whatever over 50 words two
documents share holds such a run, at each of its places. These finds are told
apart by `method`.

Texts are read once, and once more for paragraphs in clusters. What is written
and shuffled of them are digests and registers: a run's digest and place, written
once and shuffled once by digest; a paragraph's registers (bands are made from
them) and its bands, shuffled once. Only what a second document holds goes on.

Of each group the first document (least doc_id) keeps its passage. The result has
a row per passage to remove from another document: doc_id, first_word, n_words
(places in the document's words; finds that overlap, of one method and kept in
one document, are joined), kept_in (the document that keeps it), method
(paragraph or run) and similar (false where all finds are equal texts).

Defined cases. Null, empty or short texts: nothing found. Null doc_id: takes no
part. Repeated rows with one doc_id: read as one document. A passage that repeats
inside one document alone is left. Extra columns are ignored. Empty table: empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import flag_ids, join_counted, lower_words_of, materialize, mix64, only_ids, remove, scratch, window_hashes
from .graph import connected_components
from .minhash_dedup import SHINGLE, Near, _Forest, block_pairs, candidate_links, registers_of, shingle_ids

MIN_WORDS = 40
BANDS, BAND = 16, 3
ANCHOR = 12
CUT = 3
_rng = np.random.default_rng(77)
_MUL = (_rng.integers(0, 2**32, BANDS * BAND, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 2**32, BANDS * BAND, dtype=np.uint64).astype(np.uint32)[:, None]
WAITING = 20_000


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash registers (the low 16 bits, a row a set) of sets that begin at starts in an array of uint64 shingle hashes."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    return np.minimum.reduceat(x * _MUL + _ADD, starts, axis=1).T.astype(np.uint16)


def minhash_bands(signature: np.ndarray) -> np.ndarray:
    """Band hashes (int64, a row a set) of registers: 48 bits a band, so sets that share none meet by chance once in 10^14."""
    r = signature.reshape(-1, BANDS, BAND).astype(np.uint64)
    z = np.zeros((len(r), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND):
        z = mix64(z * np.uint64(0x9E3779B97F4A7C15) + r[:, :, i])
    return z.view(np.int64)


def near_signatures(percent: int) -> Near:
    """May paragraphs of these registers (the low 16 bits) reach the similarity?"""
    p = percent / 100
    least = p - 4.5 * np.sqrt(p * (1 - p) / (BANDS * BAND))
    return lambda a, n, b, m: (a == b).mean(axis=1) >= least


def window_least(s: np.ndarray, w: int) -> np.ndarray:
    """Place of the least value, the first of equal ones, of each w in a row."""
    at, have = np.arange(len(s)), 1
    while have < w:
        step = min(have, w - have)
        a, b = at[:-step], at[step:]
        at = np.where(s[b] < s[a], b, a)
        have += step
    return at


def anchors(shingles: list[np.ndarray], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of the anchors where a run of min_words words begins, in order, for texts of these SHINGLE hashes."""
    # a text with fewer than ANCHOR is one window
    filled = [np.r_[s, np.full(ANCHOR - len(s), 2**64 - 1, np.uint64)] if len(s) < ANCHOR else s for s in shingles]
    sizes = np.array([len(s) for s in filled])
    begin, text = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    least = window_least(np.concatenate(filled), ANCHOR)
    chosen = np.zeros(len(text), bool)
    chosen[least[text[: len(least)] == text[ANCHOR - 1 :]]] = True
    at = np.flatnonzero(chosen)
    of = text[at]
    at -= begin[of]
    fits = at <= np.array([len(s) for s in shingles])[of] + SHINGLE - 1 - min_words
    return of[fits], at[fits]


def joined_places(text: np.ndarray, at: np.ndarray, digest: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """text, first word, words and digest (two int64) of the runs: places of one run that overlap or touch in a text are joined (words over min_words)."""
    order = np.lexsort((at, digest[:, 1], digest[:, 0], text))
    text, at, digest = text[order], at[order], digest[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1]).any(axis=1) | (np.diff(at) > min_words)][: len(at)]
    first, last = np.flatnonzero(new), np.flatnonzero(np.r_[new[1:], True][: len(at)])
    return text[first], at[first], at[last] - at[first] + min_words, digest[first]


def paragraphs(lines: list[list[bytes]], min_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(first line, lines, first word, words) of every paragraph; lines as words."""
    at = first = begun = 0
    for k, words in enumerate(lines):
        n = len(words)
        if n >= min_words or not n:
            if at - begun >= min_words:
                yield first, k - first, begun, at - begun
            if n:
                yield k, 1, at, n
            first, begun = k + 1, at + n
        elif at + n - begun >= min_words and hashlib.blake2b(b" ".join(words), digest_size=1).digest()[0] % CUT == 0:
            yield first, k + 1 - first, begun, at + n - begun
            first, begun = k + 1, at + n
        at += n
    if at - begun >= min_words:
        yield first, len(lines) - first, begun, at - begun


def _documents(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), "text")


UNITS = "doc_id long, line int, lines int, first_word long, n_words long, mark long, text_key binary, regs binary, at array<int>, words array<int>, one array<long>, two array<long>"
_LISTS = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 2
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *_LISTS]
_NAMES = [c.split(" ")[0] for c in UNITS.split(", ")]


def units(docs: DataFrame, min_words: int) -> DataFrame:
    """A row a paragraph (line, lines, first_word, n_words, text_key, mark: its first 64 bits, regs) and one for a document's anchored runs (line null; lists of first word, words and digest), in one pass."""

    def table(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(columns[0]), k) if c is None else pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)

    def digest(text: memoryview) -> bytes:
        return hashlib.blake2b(text, digest_size=16).digest()

    def looked_up(texts: list[tuple]) -> pa.RecordBatch:
        """The runs of some documents: (doc_id, words joined, where each begins, shingle hashes)."""
        of, at = anchors([s for *_, s in texts], min_words)
        found = []
        for k, f in zip(of.tolist(), at.tolist(), strict=True):
            _, whole, begin, _ = texts[k]
            found.append(digest(whole[begin[f] : begin[f + min_words] - 1]))
        of, at, n, both = joined_places(of, at, np.frombuffer(b"".join(found), np.int64).reshape(-1, 2), min_words)
        ends = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(v, k.value_type)) for v, k in zip((at, n, both[:, 0], both[:, 1]), _LISTS, strict=True)]
        return table([[doc for doc, *_ in texts], *[None] * 7, *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            shingles, sizes, regs, waiting, texts = [], [], [], 0, []

            def sign() -> None:
                if shingles:  # noqa: B023
                    regs.extend(r.tobytes() for r in signatures(np.concatenate(shingles), np.r_[0, np.cumsum(sizes)[:-1]]))  # noqa: B023

            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                parts = [lower_words_of(x) for x in text.as_py().split(b"\n")]
                words = [w for p in parts for w in p]
                if len(words) < min_words:
                    continue
                s = window_hashes(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), SHINGLE)
                whole = memoryview(b" ".join(words))
                begin = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)].tolist()
                texts.append((doc, whole, begin, s))
                for line, lines, at, n in paragraphs(parts, min_words):
                    shingles.append(s[at : at + n - SHINGLE + 1])
                    sizes.append(len(shingles[-1]))
                    key = digest(whole[begin[at] : begin[at + n] - 1])
                    for c, v in zip(rows, (doc, line, lines, at, n, key), strict=True):
                        c.append(v)
                waiting += len(s)
                if waiting > WAITING:
                    sign()
                    yield looked_up(texts)
                    shingles, sizes, waiting, texts = [], [], 0, []
            if texts:
                sign()
                yield looked_up(texts)
            if rows[0]:
                yield table([*rows[:5], np.frombuffer(b"".join(rows[5]), np.int64)[::2], rows[5], regs, *[None] * 4])
            pa.default_memory_pool().release_unused()

    return _documents(docs).mapInArrow(run, UNITS)


def _links(members: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Spanning links among paragraphs that share a band and reach the exact similarity."""
    ids = members.column("id").to_numpy()
    order = np.argsort(ids)
    ids, side = ids[order], members.column("block").to_numpy()[order]
    both = side.min() != side.max()
    bands = minhash_bands(registers_of(members.column("regs").to_pylist(), len(order)))[order]
    texts = members.column("text").to_pylist()
    sets = shingle_ids([texts[i] for i in order])
    sizes = np.array([len(s) for s in sets])
    marks = np.zeros(int(max(s[-1] for s in sets)) + 1, np.int64)
    forest, links = _Forest(len(sets)), []
    for i in range(len(sets) - 1):
        later = np.arange(i + 1, len(sets))
        if both:
            later = later[side[later] != side[i]]
        later = later[(bands[later] == bands[i]).any(axis=1)]
        if len(later):
            r = forest.roots()
            later = later[r[later] != r[i]]
        if not len(later):
            continue
        marks[sets[i]] = 1
        common = np.array([marks[sets[j]].sum() for j in later])
        marks[sets[i]] = 0
        for j in later[100 * common >= percent * (sizes[later] + sizes[i] - common)]:
            a, b = forest.root(i), forest.root(j)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                links.append((int(ids[j]), int(ids[i])))
    return links


def numbered_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """units plus an id, written once."""
    return materialize(units(docs, min_words).withColumn("id", F.monotonically_increasing_id()), "units")


def _paragraph_texts(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """id, text of paragraphs (id, doc_id, line, lines): each document's are cut from it at once."""
    wanted = placed.groupBy("doc_id").agg(F.collect_list(F.struct("id", "line", "lines")).alias("wanted"))
    texts = only_ids(_documents(docs), "doc_id", wanted.select("doc_id")).join(wanted, "doc_id")
    cut = F.transform("wanted", lambda p: F.struct(p["id"].alias("id"), F.array_join(F.slice("x", p["line"] + 1, p["lines"]), "\n").cast("binary").alias("text")))
    # of rows that repeat a doc_id, the first that has these lines
    return texts.withColumn("x", F.split("text", "\n", -1)).select(F.explode(cut).alias("p")).select("p.*").dropDuplicates(["id"])


def _bands(regs: DataFrame) -> DataFrame:
    """doc_id, band: the bands of paragraphs (doc_id, regs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = minhash_bands(registers_of(batch.column(1).to_pylist(), batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(bands.ravel())], ["doc_id", "band"])

    return regs.mapInArrow(run, "doc_id long, band long")


def similar_paragraphs(docs: DataFrame, found: DataFrame, percent: int = 80, block: int = 512) -> DataFrame:
    """doc_id, first_word, n_words, cluster, text_key of the paragraphs (of units) in clusters of two at least."""
    own = found.where("line IS NOT NULL").drop("at", "words", "one", "two")
    copied = materialize(own.groupBy("text_key", "mark").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "copied-paragraphs")
    copies = join_counted(only_ids(own.select("id", "text_key", "mark"), "mark", copied.select("mark")), copied.drop("mark"), ["text_key"], "n")
    copies = materialize(copies.where("id != first").select("id"), "copies")
    # of equal paragraphs the first; the others are few, so only rows that the bitmap takes for one are shuffled
    flagged = flag_ids(own.drop("first_word", "n_words"), "id", copies)
    reps = flagged.where("NOT _maybe").unionByName(flagged.where("_maybe").join(copies, "id", "left_anti")).drop("_maybe")
    regs = reps.select(F.col("id").alias("doc_id"), F.lit(0).alias("n_shingles"), "regs")
    links = candidate_links(regs, near_signatures(percent), banded=_bands(regs.select("doc_id", "regs")))
    clusters = materialize(connected_components(links), "paragraph-clusters")
    sizes = clusters.groupBy("label").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = join_counted(clusters, sizes, ["label"], "n").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = materialize(only_ids(own.drop("first_word", "n_words"), "id", clusters.select("id")).join(placed, "id"), "paragraphs-placed")
    members = placed.join(_paragraph_texts(docs, placed), "id").withColumn("p", F.explode(block_pairs("blocks", "block")))

    def compare(members: pa.Table) -> pa.Table:
        links = _links(members, percent)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    links = members.select("id", "text", "regs", "block", "label", "p.a", "p.b").groupBy("label", "a", "b").applyInArrow(compare, "u long, v long")
    labelled = placed.select("id", "text_key", "mark").join(connected_components(links), "id").drop("id")
    named = copied.join(labelled, ["text_key", "mark"], "full").select("text_key", "mark", F.coalesce("label", "first").alias("cluster"), F.coalesce("n", F.lit(1)).alias("n"))
    named = materialize(named, "paragraphs-named")
    total = named.agg(F.sum("n")).first()[0] or 0
    some = only_ids(own.select("doc_id", "first_word", "n_words", "text_key", "mark"), "mark", named.select("mark")).drop("mark")
    return join_counted(some, named.drop("mark"), ["text_key"], "n", total)


def equal_runs(found: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, kept_in of the runs (of units) that two documents hold at least; kept_in is the first of these, whose own aren't in the result."""
    runs = found.where("line IS NULL").select("doc_id", "at", "words", "two", F.posexplode("one").alias("p", "one"))
    runs = runs.select("doc_id", F.expr("CAST(at[p] AS long)").alias("first_word"), F.expr("CAST(words[p] AS long)").alias("n_words"), "one", F.expr("two[p]").alias("two"))
    firsts = runs.groupBy("one", "two").agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("kept_in < last").drop("last")
    firsts = materialize(firsts, "repeated-runs")
    some = materialize(only_ids(runs, "one", firsts.select("one")), "runs")
    return join_counted(some, firsts, ["one", "two"], "n", firsts.agg(F.sum("n")).first()[0] or 0).where("doc_id != kept_in")


def _later(finds: DataFrame, group: str, *more) -> DataFrame:
    """finds of all but the first document of each group that two documents hold, with kept_in."""
    firsts = finds.groupBy(group).agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("last"), F.count("*").alias("n"), *more).where("kept_in < last").drop("last")
    return join_counted(finds, firsts, [group], "n").where("doc_id != kept_in")


def passages(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = 80, block: int = 512) -> DataFrame:
    """doc_id, first_word, n_words, kept_in, method, similar: see the module."""
    with scratch() as folders:
        found = numbered_units(docs, min_words)
    equal = equal_runs(found).withColumns({"method": F.lit("run"), "similar": F.lit(False)})
    near = materialize(similar_paragraphs(docs, found, percent, block), "similar-paragraphs")
    for folder in folders:  # what comes reads the finds alone
        remove(docs.sparkSession, folder)
    columns = ["doc_id", "first_word", "n_words", "kept_in", "method", "similar"]
    alike = _later(near, "cluster", (F.min("text_key") != F.max("text_key")).alias("similar")).withColumn("method", F.lit("paragraph"))
    spans = alike.select(columns).unionByName(equal.select(columns))
    by_keeper = W.partitionBy("doc_id", "kept_in", "method").orderBy("first_word", "n_words", "similar")
    reach = F.max(F.col("first_word") + F.col("n_words")).over(by_keeper.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first_word") > reach), 1).otherwise(0)
    spans = spans.withColumn("_new", new).withColumn("_island", F.sum("_new").over(by_keeper.rowsBetween(W.unboundedPreceding, 0)))
    end = F.max(F.col("first_word") + F.col("n_words"))
    out = spans.groupBy("doc_id", "kept_in", "method", "_island").agg(F.min("first_word").alias("first_word"), (end - F.min("first_word")).alias("n_words"), F.max("similar").alias("similar"))
    return out.select(columns)


def op10_substring_dedup(spark, sf_dir):
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
