"""Alignment of two tokenizers' tokens over the same bytes, by a dangling-suffix transducer.

Both token streams of a text spell the same bytes. The transducer reads them side
by side: one side leads by some bytes that the other hasn't spelt yet (the
residual, always a suffix of the leader's last token), and the next token comes
from the side behind. It eats the residual, or leaves a shorter one, or overtakes
and leaves one of its own. Such a step depends on the residual and the token
alone and is remembered under both; each is one link between two overlapping
tokens. An empty residual closes a group. A token that doesn't spell the
residual tells that the streams differ.

Where a space or a line feed follows another character than white space, both
tokenizers start a token, so a group ends there too: texts are read in such
stretches, and a stretch's tokens, groups and links are remembered as a whole,
up to a bounded memory; a document's new ones go through tokenizers and transducer
together. Long texts are read by some thousands of stretches at a
time. Each document keeps its links summed by id pair. How often a pair is linked
in the corpus, and whether that is its B id's highest, are sums over all
documents; they come back to the documents by join_counted: frequent pairs, whose
number is bounded, are broadcast, the others meet by a shuffle.

Defined cases. Null or empty text, and texts that B's tokens don't spell: zeros,
and '' for groups_sha256. Null doc_id and repeated rows: a row each, and each
counts. Extra columns are ignored, whatever their names. Empty table: empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize

_OTHER = r"\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode's white space but space and line feed
_STRETCH = re.compile(f"[ \n{_OTHER}]*[^ \n{_OTHER}]*(?:[{_OTHER}][ \n{_OTHER}]*[^ \n{_OTHER}]*)*")
PIECES = 1 << 16  # stretches read at a time, and pairs in a written batch
FREQUENT = 20_000  # pairs with more than one in so many of all (document, pair) rows are broadcast
A_IDS = 1 << 32
LATIN_END = "\u0250"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Bytes with a printable Latin-1 character are that character; the others
    take the code points from 256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Groups and links of two token streams; spelling[side][token] is the token's bytes."""

    STEPS = 500_000

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.spelling = (a_bytes, b_bytes)
        self.steps: tuple[dict, dict] = ({}, {})  # by the leading side: (residual, token of the other) -> (leading side, residual)

    def step(self, lead: int, residual: bytes, token: int) -> tuple[int, bytes] | None:
        """Who leads after the other side's next token, and by which bytes; None where it spells others."""
        memo, key = self.steps[lead], (residual, token)
        if key in memo:
            return memo[key]
        spelt = self.spelling[1 - lead][token]
        if residual.startswith(spelt):
            out = (lead, residual[len(spelt) :])
        elif spelt.startswith(residual):
            out = (1 - lead, spelt[len(residual) :])
        else:
            out = None
        if len(memo) >= self.STEPS:
            memo.clear()
        memo[key] = out
        return out

    def groups(self, a: list[int], b: list[int]) -> Iterator[tuple[list[int], list[int], list[tuple[int, int]]]]:
        """A ids, B ids and links (A id, B id) of each group, in order; ValueError where the streams spell different bytes."""
        streams, at, (a_bytes, _), steps = (a, b), [0, 0], self.spelling, self.steps
        while at[0] < len(a):
            token = a[at[0]]
            at[0] += 1
            lead, residual, group, links = 0, a_bytes[token], ([token], []), []
            while residual:
                behind, leader = 1 - lead, group[lead][-1]
                if at[behind] == len(streams[behind]):
                    raise ValueError("one side ends before the other")
                token = streams[behind][at[behind]]
                at[behind] += 1
                group[behind].append(token)
                links.append((token, leader) if lead else (leader, token))
                known = steps[lead].get((residual, token))
                after = known or self.step(lead, residual, token)
                if after is None:
                    raise ValueError("the streams spell different bytes")
                lead, residual = after
            yield *group, links
        if at[1] < len(b):
            raise ValueError("one side ends before the other")

    def __call__(self, a: list[int], b: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[tuple[int, int]]] | None:
        """Groups (A ids, B ids) and links (A id, B id), or None where the streams don't spell the same bytes."""
        try:
            found = list(self.groups(a, b))
        except ValueError:
            return None
        return [(x, y) for x, y, _ in found], [link for _, _, links in found for link in links]


class _Table:
    """Rows of integers that come one after another, in an array that grows."""

    def __init__(self, width: int):
        self.rows, self.n = np.empty((1024, width), np.int64), 0

    def extend(self, rows: list) -> None:
        if not rows:
            return
        while self.n + len(rows) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Aligner:
    """Stretches of text to what their alignment gives, remembered."""

    CHARS = 4_000_000

    def __init__(self, json_path: str, ranks_path: str, model_path: str):
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(json_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = SentencePieceProcessor(model_file=model_path)
        letters = byte_letters()
        with open(json_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            a_bytes[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.transducer = Transducer(a_bytes, b_bytes)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes = _Table(5)  # A tokens, B tokens, groups (-1 where the bytes differ), where the links begin, and how many
        self.links = _Table(1)
        self.written: list[str] = []
        self.chars = 0

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """A's and B's ids of text that begins with a space or a line feed."""
        # the same vocabulary as ranks is faster; both read letters, digits and white space of the first Latin blocks alike
        a = self.ordinary(text) if max(text) < LATIN_END else self.a.encode(text, add_special_tokens=False).ids
        # B puts a space before what it reads; that and a line feed are a piece each, whatever follows
        return a, self.b.encode("\n" + text)[2:]

    def learn(self, stretches: list[str]) -> None:
        """Align new stretches, joined: tokens and groups end where a stretch does, unless white space ends it."""
        together = [s for s in stretches if not s[-1].isspace()]
        alone = [s for s in stretches if s[-1].isspace()]
        if together and not self._learn(together):
            alone = stretches
        for s in alone:
            if not self._learn([s]):
                self._keep([s], [(-1, -1, -1, 0, 0)], [""], [])

    def _learn(self, stretches: list[str]) -> bool:
        a_bytes, (a, b) = self.transducer.spelling[0], self.ids("".join(stretches))
        ends = iter(stretches)
        sizes, written, links = [], [], []
        left, n_a, n_b, n_groups, own, texts = 0, 0, 0, 0, [], []
        try:
            for x, y, pairs in self.transducer.groups(a, b):
                if not left:
                    left = len(next(ends).encode())
                left -= len(a_bytes[x[0]]) if len(x) == 1 else sum(len(a_bytes[t]) for t in x)
                n_a, n_b, n_groups = n_a + len(x), n_b + len(y), n_groups + 1
                own += [q * A_IDS + p for p, q in pairs]
                texts.append(f"{x[0]}|{y[0]}" if len(x) == len(y) == 1 else f"{','.join(map(str, x))}|{','.join(map(str, y))}")
                if left < 0:
                    return False
                if not left:
                    sizes.append((n_a, n_b, n_groups, self.links.n + len(links), len(own)))
                    links += own
                    written.append(";".join(texts))
                    n_a, n_b, n_groups, own, texts = 0, 0, 0, [], []
        except (ValueError, StopIteration):
            return False
        if left or len(sizes) < len(stretches):
            return False
        self._keep(stretches, sizes, written, links)
        return True

    def _keep(self, stretches: list[str], sizes: list[tuple], written: list[str], links: list[int]) -> None:
        self.number.update(zip(stretches, range(self.sizes.n, self.sizes.n + len(stretches)), strict=True))
        self.sizes.extend(sizes)
        self.links.extend([(x,) for x in links])
        self.written += written
        self.chars += sum(map(len, stretches))

    def _stretches(self, text: str) -> Iterator[list[str]]:
        if len(text) < PIECES:
            yield _STRETCH.findall(text)[:-1]  # the last one is the empty rest
            return
        found = _STRETCH.finditer(text)
        while some := [m.group() for m in islice(found, PIECES)]:
            yield some if some[-1] else some[:-1]

    def __call__(self, text: str) -> tuple[tuple[int, int, int], str, np.ndarray, np.ndarray] | None:
        """(A tokens, B tokens, groups), digest of the groups, and id pairs with their numbers of links."""
        total, digest = np.zeros(3, np.int64), hashlib.sha256()
        pairs, numbers = np.empty(0, np.int64), np.empty(0, np.int64)
        between = ""
        for stretches in self._stretches(" " + text):
            if not stretches:
                continue
            if self.chars > self.CHARS:
                self.forget()
            own = list(map(self.number.get, stretches))
            if None in own:
                self.learn(list(dict.fromkeys(s for s, n in zip(stretches, own, strict=True) if n is None)))
                own = list(map(self.number.__getitem__, stretches))
            sizes = self.sizes.rows[own]
            if sizes[:, 0].min() < 0:
                return None
            total += sizes[:, :3].sum(axis=0)
            digest.update((between + ";".join(map(self.written.__getitem__, own))).encode())
            between = ";"
            starts, many = sizes[:, 3], sizes[:, 4]
            links = self.links.rows[np.repeat(starts - np.cumsum(many) + many, many) + np.arange(many.sum()), 0]
            found, times = np.unique(links, return_counts=True)
            if len(pairs):
                found, back = np.unique(np.concatenate([pairs, found]), return_inverse=True)
                times = np.bincount(back, np.concatenate([numbers, times]), len(found)).astype(np.int64)
            pairs, numbers = found, times
        return tuple(total.tolist()), digest.hexdigest(), pairs, numbers


@lru_cache(1)
def aligner(json_path: str | None = None, ranks_path: str | None = None, model_path: str | None = None) -> Aligner:
    """One a Python worker. The files are of the public tokenizers package unless given."""
    import public_tokenizers

    return Aligner(json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), model_path or public_tokenizers.path("piece_bpe_32k.model"))


_SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, numbers array<long>"


def align_documents(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """A row per document: row (a number of its own), the counts and digest, and pairs (B id * 2^32 + A id) with their numbers of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(json_path, ranks_path, model_path)

        def batch_of(rows: list[tuple], pairs: list[np.ndarray], numbers: list[np.ndarray]) -> pa.RecordBatch:
            plain = [pa.array(c, pa.string() if i == 6 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
            ends = pa.array(np.r_[0, np.cumsum(list(map(len, pairs)))].astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v))) for v in (pairs, numbers)]
            return pa.RecordBatch.from_arrays([*plain, *lists], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "numbers"])

        empty = np.empty(0, np.int64)
        for batch in batches:
            rows, pairs, numbers, held = [], [], [], 0
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py()
                found = align(text) if text else None
                (a, b, groups), digest, own, times = found or ((0, 0, 0), "", empty, empty)
                rows.append((row, doc, a, b, groups, int(times.sum()), digest))
                pairs.append(own)
                numbers.append(times)
                held += len(own)
                if held > PIECES:
                    yield batch_of(rows, pairs, numbers)
                    rows, pairs, numbers, held = [], [], [], 0
            if rows:
                yield batch_of(rows, pairs, numbers)
            pa.default_memory_pool().release_unused()

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, its links in all documents (total), whether that is the highest of its B id (best), and how many rows hold it (held)."""
    links = aligned.selectExpr("inline(arrays_zip(pairs, numbers))").toDF("pair", "number")
    counts = materialize(links.groupBy("pair").agg(F.sum("number").alias("total"), F.count("*").alias("held")).withColumn("b", F.shiftright("pair", 32)), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("total").alias("highest"))
    return counts.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"), "held")


def align(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None, model_path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    aligned = materialize(align_documents(docs, json_path, ranks_path, model_path), "aligned")
    links = aligned.selectExpr("row", "inline(arrays_zip(pairs, numbers))").toDF("row", "pair", "number")
    met = join_counted(links, pair_counts(aligned), ["pair"], "held", heavy=frequent)
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("number")).otherwise(0)).alias("n_best"), F.sum(F.col("number") * F.col("total")).alias("count_sum"))
    out = aligned.drop("pairs", "numbers").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op11_token_alignment(spark, sf_dir):
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
