"""Token counts of whole texts by a public tokenizer, without keeping any ids.

Each Arrow batch is cut where its bytes reach `batch_bytes`, so a call of the
tokenizer gets much the same amount of text whether rows are short or long. Long
texts are read in slices that end at a space or a line feed. There the tokenizer
itself starts anew: it folds white space, its pieces hold none, composition
(NFC) and lower case don't reach over it, and no special string holds any. What
stands between two such places has a count of its own, so the tokenizer is asked
once for each distinct stretch that a worker hasn't met (in one batch call) and
its lengths are remembered, up to a bounded memory.

Defined cases. Null or empty text: 0 bytes, 0 tokens. Null doc_id and repeated
rows: a row each. Special strings in a text: as the tokenizer reads them by
default. Extra columns are ignored, whatever their names. Empty table: empty
result. Rows are counted where they lie; nothing is shuffled, so no key or source
can fill a task.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20
LIMIT = 2048


class Lengths:
    """Lengths of texts in tokens, for tokenizers that start anew after a space or a line feed."""

    KNOWN, LONGEST = 200_000, 100  # stretches remembered, and code points in one

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        met = set().union(*parts)
        new = met.difference(self.known)
        if len(self.known) + len(new) > self.KNOWN:
            self.known.clear()
            new = met
        new = list(new)
        self.known.update(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        out = [sum(map(self.known.__getitem__, p)) for p in parts]
        for stretch in new:
            if len(stretch) > self.LONGEST:
                del self.known[stretch]
        return out


@lru_cache(1)
def lengths(path: str | None = None) -> Lengths:
    """One a Python worker. The file is of the public tokenizers package unless given."""
    import public_tokenizers

    return Lengths(path or public_tokenizers.path("word_bpe_49k.json"))


def slices(text: str, size: int = BATCH_BYTES) -> Iterator[str]:
    """Parts of a text, of `size` code points or what more a stretch without space or line feed takes."""
    at = 0
    while len(text) - at > size:
        ends = [e for e in (text.find(" ", at + size), text.find("\n", at + size)) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


def balanced(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, after) of runs of rows whose sizes come to `most` or just over."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = int(total[at - 1]) if at else 0
        end = min(len(sizes), int(np.searchsorted(total, before + most)) + 1)
        yield at, end
        at = end


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = lengths(path)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens: list[int] = []
            for a, b in balanced(sizes, batch_bytes):
                some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                longest = some.pop() if sizes[b - 1] > batch_bytes else None  # only the last row of a run can be that long
                tokens += count(some)
                if longest is not None:
                    tokens.append(sum(count([s])[0] for s in slices(longest, batch_bytes)))
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op13_token_counts(spark, sf_dir):
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
