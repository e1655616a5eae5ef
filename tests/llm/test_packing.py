import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = ["", " ", "a", "two words", "line\nfeed", "double  space", " lead", "trail ", "a\n\nb", "\n", "tab\there", "don't we'll 's x", "é b  c", "<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y\nz", "日本語 text 123,456!", "word " * 3000, "a" * 5000, " " * 50_000 + "x", "\n" * 20_000, "\r\n a\r", "\u0085 x", "\x1c y"]


def test_ids_are_the_tokenizers(tokenizer, spark, sf):
    enc = packing.encoder()
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(enc(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'st\n\t1é|<>! \x85\x1c日")), max_size=40))
def test_ids_of_any_text(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    test_ids_of_any_text.t = t
    assert np.frombuffer(packing.encoder()(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def check_layout(rows, size):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_documents(spark, sf, tokenizer):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = real + [(10**6 + i, t) for i, t in enumerate(TEXTS)] + [(10**7, None), (None, "no id"), (5 * 10**6, "again"), (5 * 10**6, "again")] + [(6 * 10**6, "w " * 2000)] * 2
    out = packing.pack_documents(spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, length int"), part_rows=60).collect()
    used = check_layout(out, 1024)
    expected = defaultdict(int)
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            expected[d, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    got = defaultdict(int)
    for r in out:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    assert got == expected
    total = sum(r.length for r in out)
    assert used <= 1.02 * -(-total // 1024) + 2


def test_exchange_closes_gaps(spark):
    rng = np.random.default_rng(2)
    lengths = [int(x) for x in rng.integers(200, 600, 700)]
    df = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    alone = check_layout(packing.pack(df, part_rows=40, rounds=1).collect(), 1024)
    out = packing.pack(df, part_rows=40).collect()
    assert len(out) == 700
    assert packing.lower_bound(np.array(lengths), 1024) <= check_layout(out, 1024) < alone


def test_clashing_columns(spark):
    names = ["sequence_id", "offset", "Bound", "gap", "packed_in", "_row", "_part", "_open", "_given0"]
    df = spark.createDataFrame([(i, 0, n, *names) for i, n in enumerate([600, 424, 1024, 500, 500, 20])], ", ".join(["doc_id long", "piece int", "length long", *(f"`{n}` string" for n in names)]))
    out = packing.pack(df, part_rows=2)
    assert out.columns == [*df.columns, "_sequence_id", "_offset", "_packed_in", "_bound", "_gap"]
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(range(6)) and all(r[n] == n for r in rows for n in names)
    assert packing.pack(df.where("length = 1024")).first()["_offset"] == 0


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def fewest(lengths, size):
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                rooms[k] -= lengths[i]
                go(i + 1, rooms)
                rooms[k] += lengths[i]
        rooms.append(size - lengths[i])
        go(i + 1, rooms)
        rooms.pop()

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_never_exceeds_the_fewest(lengths):
    x = np.array(sorted(lengths, reverse=True))
    least = fewest(x.tolist(), 12)
    assert packing.lower_bound(x, 12) <= least <= packing.best_fit(x, 12)[0].max() + 1


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]
