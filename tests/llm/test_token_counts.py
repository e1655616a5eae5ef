import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import token_counts

TEXTS = ["", " ", "a", "Two Words", "a\n\nb", "tab\there", "don't we'll 's x", "é é b  c", "a <|endoftext|> b", "x<|endoftext|>y\nz", "日本語 text 123,456!", "word " * 3000, "a" * 5000, "\x1c y!\x1c!", " ̈x", "ΑΣ Σ ς", "İ x", "x" * 90_000 + " tail"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_documents(spark, sf, tokenizer):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = real + [(10**6 + i, t) for i, t in enumerate(TEXTS)] + [(7, None), (None, "no id"), (5, "again here"), (5, "again here")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_tokens int, N_Bytes string")
    for size in (200, token_counts.BATCH_BYTES):
        got = token_counts.count_tokens(docs, limit=400, batch_bytes=size).collect()
        want = []
        for d, t in rows:
            n = len(tokenizer.encode(t or "", add_special_tokens=False))
            want.append((d, len((t or "").encode()), n, n > 400))
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(docs.where("false")).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 'sT\n\t1é|<>! \x85\x1c日̈́Σ")), max_size=40), max_size=4))
def test_any_text(texts):
    count = token_counts.lengths()
    assert count(texts) == [len(count.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert [sum(count([s])[0] for s in token_counts.slices(t, 3)) for t in texts] == count(texts)


def test_memory_is_bounded():
    count = token_counts.lengths()
    keep, count.KNOWN = count.KNOWN, 3
    try:
        assert count(["a b c d e", "f g"]) == [5, 2] and count(["h i"]) == [2]
        assert len(count.known) <= 7
        count(["y" * 500])
        assert "y" * 500 not in count.known
    finally:
        count.KNOWN = keep


def test_batches_are_balanced_by_bytes():
    sizes = np.array([10, 10, 10, 500, 0, 0, 1, 99, 1])
    runs = list(token_counts.balanced(sizes, 30))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(sizes)))
    assert all(sizes[a : b - 1].sum() < 30 for a, b in runs)
    assert "".join(token_counts.slices("ab cd\nef" * 9, 5)) == "ab cd\nef" * 9
    assert list(token_counts.slices("abcdefgh", 3)) == ["abcdefgh"]
