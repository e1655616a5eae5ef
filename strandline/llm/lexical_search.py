r"""Ranked lexical search over an inverted index in shards, by MaxScore.

Terms are the maximal matches of `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+` (ASCII
letters and digits, and all characters outside ASCII) with A-Z alone lower-cased.

`build_index` cuts each task's documents into shards of a bounded number of
terms, so nothing is shuffled and no task holds more than a shard; a shard gives
a row per term (its documents and their counts, and for each count the shortest
document with it) and one row for its documents. `search` weighs the queries'
terms by sums over all shards, brings a block's query terms and a shard's
postings together, and ranks each query inside the shard:

* the greatest part that a term can add follows from the shard's (count, shortest
  document) pairs, so it is exact whatever the corpus' mean length;
* lists are read from the highest bound down while a document in none of those
  read could still reach the k-th best score so far: these are the essential ones;
* the others are probed, only for documents whose score so far plus the bounds
  left still reaches the k-th best. A document that could tie is kept.

Each shard returns its k best for each query; a window over those ranks them.
Queries come in blocks of a bounded number, so a group's memory is bounded too.

Defined cases. Null or empty text, or one without a term: it counts nowhere and
isn't found. Null doc_id: after all others of the same score. Repeated rows and
ids: each row is a document. Queries without a term give no row; null and
repeated item ids: each row is a query, ranked by itself. Very long texts are
read in slices. Extra columns are ignored, whatever their names. Empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

TOP = 10
BLOCK = 512  # queries that meet a shard at a time
SHARD_TERMS = 1 << 21
SHARD_DOCUMENTS = 1 << 16
SLICE = 1 << 20
_TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, by slices of it."""
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class _Numbers(dict):
    """Words to numbers, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _cut(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary array: the bytes of values between starts."""
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * values.itemsize).astype("<i4")), pa.py_buffer(np.ascontiguousarray(values))])


INDEX = "shard long, term binary, documents long, terms long, postings binary, counts binary, most binary, shortest binary"


class _Shard:
    """Documents of a task until they make a shard."""

    def __init__(self):
        self.words, self.ids, self.lengths, self.doc_ids = _Numbers(), [], [], []
        self.terms = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        n = 0
        for words in terms_of(text):
            self.ids.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
            n += len(words)
        if n:
            self.lengths.append(n)
            self.doc_ids.append(doc_id)
            self.terms += n

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The shard's documents as a row without a term, then a row a term."""
        n, lengths = len(self.lengths), np.array(self.lengths, "<i8")
        known = np.array([d is not None for d in self.doc_ids], "u1")
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        binary = [v.tobytes() for v in (ids, lengths, known)]
        head = [[shard], [None], [n], [self.terms], [binary[0]], [binary[1]], [binary[2]], [None]]
        names, kinds = ["shard", "term", "documents", "terms", "postings", "counts", "most", "shortest"], [pa.int64(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(head, kinds, strict=True)], names)
        key = np.concatenate(self.ids) * n + np.repeat(np.arange(n), lengths)
        key, counts = np.unique(key, return_counts=True)
        term, doc = np.divmod(key, n)
        v = len(self.words)
        starts = np.searchsorted(term, np.arange(v + 1))
        # of each term and count the shortest document: what a bound needs
        order = np.lexsort((lengths[doc], counts, term))
        t, c = term[order], counts[order]
        first = np.r_[True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])]
        t, c, shortest = t[first], c[first], lengths[doc][order][first]
        fronts = np.searchsorted(t, np.arange(v + 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(v, shard)),
                pa.array(list(self.words), pa.binary()),
                pa.array(np.diff(starts).astype(np.int64)),
                pa.nulls(v, pa.int64()),
                _cut(doc.astype("<u2"), starts),
                _cut(counts.astype("<u4"), starts),
                _cut(c.astype("<u4"), fronts),
                _cut(shortest.astype("<i8"), fronts),
            ],
            names,
        )


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """docs (doc_id, text) to index rows; see INDEX. The row without a term holds its shard's doc ids, lengths and which ids aren't null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text.is_valid:
                    shard.add(doc_id, text.as_py())
                if shard.terms >= shard_terms or len(shard.lengths) == SHARD_DOCUMENTS:
                    yield from shard.rows(made)
                    made, shard = made + 1, _Shard()
        if shard.terms:
            yield from shard.rows(made)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(run, INDEX)


def query_terms(items: DataFrame) -> DataFrame:
    """items (item, text) to item, term, times: how often a query holds a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                for words in terms_of(text.as_py() or b""):
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(words), pa.int64()), pa.array(words, pa.binary())], ["item", "term"])

    split = items.select("item", F.col("text").cast("string").cast("binary")).mapInArrow(run, "item long, term binary")
    return split.groupBy("item", "term").agg(F.count("*").alias("times"))


class _List:
    """A term's postings in a shard."""

    def __init__(self, weight: int, docs: np.ndarray, counts: np.ndarray, most: np.ndarray, shortest: np.ndarray, scale: Scale):
        self.weight, self.docs, self.counts, self.scale, self.whole = weight, docs, counts, scale, None
        self.bound = int(weight * part(most, scale.of_lengths(shortest)).max())

    def parts(self) -> np.ndarray:
        """What the term adds to each of its documents, once."""
        if self.whole is None:
            self.whole = self.weight * part(self.counts, self.scale.m[self.docs])
        return self.whole

    def probe(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some documents hold the term (their places), and what it adds to those."""
        at = np.searchsorted(self.docs, docs)
        at[at == len(self.docs)] = 0
        held = np.flatnonzero(self.docs[at] == docs)
        return held, self.weight * part(self.counts[at[held]], self.scale.m[docs[held]])


def part(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 8 * m)


class Scale:
    """m of documents by their lengths, in a corpus of n documents and `terms` terms."""

    def __init__(self, lengths: np.ndarray, n: int, terms: int):
        self.n, self.terms = n, terms
        self.m = self.of_lengths(lengths)

    def of_lengths(self, lengths: np.ndarray) -> np.ndarray:
        # exact integers: 75 * length * n passes 2^63 in a large corpus
        return np.array([25 + 75 * x * self.n // self.terms for x in lengths.tolist()], np.int64)


def max_score(query: list[tuple[_List, int]], n: int, doc_ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(document's place, score) of the k best of a shard's n documents with a score over 0, best first; ties by doc_ids' order."""
    lists = sorted(((q.bound * times, q, times) for q, times in query if q.bound), key=lambda x: -x[0])
    left = np.r_[np.cumsum([x[0] for x in lists][::-1])[::-1], 0]  # bounds of this list and all after it
    score, least, i = np.zeros(n, np.int64), 1, 0
    kth = lambda s: max(1, int(np.partition(s, len(s) - k)[len(s) - k])) if len(s) >= k else 1
    while i < len(lists) and left[i] >= least:  # essential: a document in none of those read could be among the best
        _, q, times = lists[i]
        score[q.docs] += times * q.parts()
        least, i = kth(score), i + 1
    at = np.flatnonzero((score > 0) & (score + left[i] >= least))
    score = score[at]
    for j in range(i, len(lists)):
        _, q, times = lists[j]
        held, more = q.probe(at)
        score[held] += times * more
        least = kth(score)
        stays = score + left[j + 1] >= least
        at, score = at[stays], score[stays]
    best = np.lexsort((doc_ids[at], -score))[:k]
    return list(zip(at[best].tolist(), score[best].tolist(), strict=True))


def search(index: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best; index as build_index gives it, written once."""
    items = materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "search-items")
    blocks = max(1, -(-items.count() // block))
    wanted = materialize(query_terms(items), "search-terms")
    held = index.where("term IS NOT NULL")
    whole = index.where("term IS NULL")
    corpus = whole.agg(F.sum("documents").alias("n"), F.sum("terms").alias("terms")).first()
    n, terms = corpus.n or 0, corpus.terms or 0
    found = held.select("term", "documents").join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("documents").alias("df"))
    weighed = found.select("term", F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight"))
    in_block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    asked = wanted.join(weighed, "term").groupBy(in_block, "term", "weight").agg(F.collect_list(F.struct("item", "times")).alias("items"))  # a block's items at most
    asked = materialize(asked, "search-weights")
    met = held.select("shard", "term", "postings", "counts", "most", "shortest").join(asked, "term").drop("term")
    shards = whole.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "postings", "counts", "most")
    rows = met.unionByName(shards, allowMissingColumns=True)

    def rank(group: pa.Table) -> pa.Table:
        weights, asks = group["weight"].to_pylist(), group["items"].to_pylist()
        array = lambda name, i, kind: np.frombuffer(group[name][i].as_py(), kind)
        head = weights.index(None)
        doc_ids, lengths, known = array("postings", head, "<i8"), array("counts", head, "<i8"), array("most", head, "u1") == 1
        scale, queries = Scale(lengths, n, terms), {}
        for i, (weight, ask) in enumerate(zip(weights, asks, strict=True)):
            if weight is not None:
                own = _List(weight, array("postings", i, "<u2").astype(np.int64), array("counts", i, "<u4").astype(np.int64), array("most", i, "<u4").astype(np.int64), array("shortest", i, "<i8"), scale)
                for a in ask:
                    queries.setdefault(a["item"], []).append((own, a["times"]))
        order = np.empty(len(doc_ids), np.int64)
        order[np.lexsort((doc_ids, ~known))] = np.arange(len(doc_ids))
        out = [(item, int(doc_ids[at]) if known[at] else None, score) for item, query in queries.items() for at, score in max_score(query, len(doc_ids), order, k)]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    best = rows.groupBy("shard", "block").applyInArrow(rank, "item long, doc_id long, score long")
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """search() over an index of docs, built for it."""
    return search(materialize(build_index(docs, shard_terms), "search-index"), items, k, block)


OP12_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), d AS (SELECT row, doc_id, len(terms) AS n, terms FROM w WHERE len(terms) > 0
), c AS (SELECT count(*) AS n_all, sum(n) AS l_all FROM d
), tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weighed AS (
  SELECT item_id, term, count(*) * CAST(floor(1000 * ln((2.0 * any_value(n_all) + 2) / (2 * any_value(df) + 1))) AS BIGINT) AS w
  FROM q JOIN df USING (term) CROSS JOIN c GROUP BY item_id, term
), scored AS (
  SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_all) // CAST(l_all AS BIGINT))))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN d USING (row) CROSS JOIN c GROUP BY item_id, row
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored JOIN d USING (row) WHERE score > 0
QUALIFY rank <= 10
"""


def op12_lexical_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
