"""Quality rules by weak supervision.

Ten rules look at a document's statistics and vote good (1), bad (2) or abstain
(0). Expectation-maximisation over the counts of vote patterns (all documents;
at most 3^10 patterns, whatever the input) estimates how each rule votes on good
and on bad documents, and each pattern gets the posterior probability that its
documents are good. A document stays if that is at least `threshold` and it
passes the two base rules (20 words at least; at most 30 % of its words in
repeated 8-word windows).

Defined cases. Null, empty or blank text: all statistics 0, base_failed. Null
doc_id, repeated rows and extra columns: a row each, unchanged. An empty table
gives an empty result (nothing is estimated).
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, materialize, window_hashes, word_hashes, words_of

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct", "n_marks", "n_lettered"]
WINDOW = 8
RULES = ["length", "word_length", "symbols", "letters", "lettered", "dup_lines", "repeats", "capitals", "variety", "marks"]
PATTERNS = 3 ** len(RULES)
#: Chances of abstain, good, bad that estimation starts from and is smoothed towards:
#: a bad vote is rare on good documents, while bad documents still look good to most rules.
ON_BAD, ON_GOOD = np.array([0.1, 0.6, 0.3]), np.array([0.1, 0.895, 0.005])
SMOOTH = 0.05
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class _FlaggedHash(WordHash):
    """The lowest bit of a word's hash tells whether it has a letter (any byte above 127 counts as one)."""

    def __missing__(self, word: bytes) -> int:
        value = super().__missing__(word)
        value = self[word] = value | 1 if _LETTER.search(word) else value & ~1
        return value


def _repeat_words(h: np.ndarray) -> int:
    n = len(h) - WINDOW + 1
    if n < 2:
        return 0
    z = window_hashes(h, WINDOW)
    order = np.sort(z)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    found = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(np.isin(z, twice))
    np.add.at(found, at, 1)
    np.add.at(found, at + WINDOW, -1)
    return int((np.cumsum(found) > 0).sum())


def text_stats(text: bytes | None, cache: _FlaggedHash) -> tuple[int, ...]:
    """STATS of one text in UTF-8."""
    if not text:
        return (0,) * len(STATS)
    words = words_of(text)
    h = word_hashes(words, cache)
    solid = text.translate(None, b" \t\n\x0b\x0c\r")
    lines = Counter(text.split(b"\n"))
    filled = {line: n for line, n in lines.items() if line.strip(b" \t\n\x0b\x0c\r")}
    chars = solid.decode("utf-8", "replace")
    ascii_upper = len(solid) - len(solid.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    ascii_other = len(solid) - len(solid.translate(None, bytes(b for b in range(33, 127) if not chr(b).isalpha())))
    return (
        len(words),
        len(chars),
        len(text) - len(text.translate(None, b"#*$%&|<>")),
        sum(n - 1 for n in filled.values()),
        _repeat_words(h),
        sum(filled.values()),
        ascii_upper,
        len(chars) - ascii_other,
        len(np.unique(h)),
        solid.count(b"!") + solid.count(b"?"),
        int((h & np.uint64(1)).sum()),
    )


def _table(texts: pa.Array, cache: _FlaggedHash) -> np.ndarray:
    return np.array([text_stats(t.as_py(), cache) for t in texts.cast(pa.binary())], np.int64).reshape(-1, len(STATS))


def vote_codes(stats: np.ndarray) -> np.ndarray:
    """Pattern number of each row of STATS: base-3 digits, rule by rule."""
    s = dict(zip(STATS, stats.T.astype(np.float64), strict=True))
    per_word = lambda x: x / np.maximum(s["n_words"], 1)

    def vote(value, good_to, bad_from, use=True):
        """Good up to good_to, bad from bad_from, nothing between or where not in use."""
        return np.where(use, np.where(value <= good_to, 1, np.where(value >= bad_from, 2, 0)), 0)

    words = s["n_words"]
    length = per_word(s["word_chars"])
    votes = [
        vote(-words, -50, -20),
        np.where((length >= 3) & (length <= 9), 1, np.where((length < 2.5) | (length > 12), 2, 0)),
        vote(per_word(s["n_symbols"]), 0.02, 0.1),
        vote(-s["n_letters"] / np.maximum(s["word_chars"], 1), -0.9, -0.75),
        vote(-per_word(s["n_lettered"]), -0.9, -0.8),
        vote(s["n_dup_lines"] / np.maximum(s["n_lines"], 1), 0.05, 0.3, s["n_lines"] > 1),
        vote(per_word(s["n_repeat_words"]), 0.05, 0.2, words >= 2 * WINDOW),
        vote(s["n_upper"] / np.maximum(s["n_letters"], 1), 0.15, 0.4, s["n_letters"] >= 20),
        vote(-s["n_distinct"] / np.sqrt(np.maximum(words, 1)), -4, -2.5, words >= 20),
        vote(per_word(s["n_marks"]), 0.05, 0.2),
    ]
    code = np.zeros(len(stats), np.int64)
    for v in votes:
        code = code * 3 + v
    return code


def fit(codes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior probability of good for every pattern number.

    Rules vote independently given the class. Each estimate is smoothed towards
    its start by SMOOTH of all documents, so that classes keep their meaning.
    """
    digits = np.array(list(itertools.product(range(3), repeat=len(RULES))), np.int64)
    seen, weight = digits[codes], counts.astype(np.float64)
    share = weight / weight.sum()
    logs = np.log(np.array([[ON_BAD] * len(RULES), [ON_GOOD] * len(RULES)]))
    prior = 0.8

    def posterior(votes: np.ndarray) -> np.ndarray:
        at = np.arange(len(RULES))
        gap = np.log(prior / (1 - prior)) + (logs[1, at, votes] - logs[0, at, votes]).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))

    for _ in range(rounds):
        good = posterior(seen)
        prior = float(np.clip((share * good).sum(), 0.02, 0.98))
        for y, p, start in ((0, 1 - good, ON_BAD), (1, good, ON_GOOD)):
            for r in range(len(RULES)):
                n = np.array([(weight * p * (seen[:, r] == v)).sum() for v in range(3)]) + SMOOTH * weight.sum() * start
                logs[y, r] = np.log(n / n.sum())
    return posterior(digits)


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _FlaggedHash()
    for batch in batches:
        stats = _table(batch.column(1), cache)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in stats.T), pa.array(vote_codes(stats))], ["doc_id", *STATS, "code"])


def _codes_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _FlaggedHash()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(vote_codes(_table(batch.column(0), cache)))], ["code"])


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, STATS and the vote pattern of every row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_stats_batches, "doc_id long, " + ", ".join(f"{c} long" for c in STATS) + ", code long")


def fit_documents(stats: DataFrame, code: str = "code") -> dict[int, float]:
    """Posterior of each pattern that occurs (PATTERNS at most), from the pattern counts of all rows; empty without rows."""
    counts = np.array([(r[0], r[1]) for r in stats.groupBy(code).count().collect()], np.int64).reshape(-1, 2)
    counts = counts[np.argsort(counts[:, 0])]
    if not len(counts):
        return {}
    posteriors = fit(counts[:, 0], counts[:, 1])
    return {int(c): float(posteriors[c]) for c in counts[:, 0]}


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def score_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, statistics, base_failed, quality (posterior), kept: one row per row of docs."""
    stats = materialize(document_stats(docs), "quality-stats")
    model = docs.sparkSession.createDataFrame(list(fit_documents(stats).items()), "code long, quality double")  # PATTERNS rows at most
    out = stats.join(F.broadcast(model), "code").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names.

    The texts are read twice, once to count the vote patterns and once to keep or
    drop each row where it lies, so none of them is written or moved on the way.
    """
    own = docs.select("text").mapInArrow(_codes_batches, "code long")
    good = {c for c, p in fit_documents(own).items() if p >= threshold}  # PATTERNS at most
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _FlaggedHash()
        for batch in batches:
            stats = _table(batch.column(at), cache)
            words, repeats = stats[:, 0], stats[:, STATS.index("n_repeat_words")]
            passed = (words >= 20) & (100 * repeats <= 30 * words)
            yield batch.filter(pa.array(passed & np.fromiter((c in good for c in vote_codes(stats).tolist()), bool, len(stats))))
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def op4_quality_rules(spark, sf_dir):
    out = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *STATS[:5], "base_failed", "kept", "quality")
