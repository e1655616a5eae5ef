import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import token_alignment as ta

TEXTS = ["", " ", "a", "two words", "line\nfeed", "double  space", " lead", "trail ", "trail  \n ", "a\n\nb", "\n", "tab\there\t\n x", "x;\r\n\r\ny", "don't we'll", "é b  c", "a<|endoftext|> b", "<s> </s>", "日本語 text 123,456!", "word " * 500, "a" * 3000, "\u0085 x", "\x1c y", "under▁score", "nbsp  x　\n y", "emoji 👩‍👩‍👧 z", "\x00 nul"]


def spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(text):
    """Ids, groups and links by byte offsets of the whole text's tokens."""
    al = ta.aligner()
    if not text:
        return None
    a = al.a.encode(" " + text, add_special_tokens=False).ids
    b = al.b.encode(text)
    pa, pb = [al.transducer.spelling[0][i] for i in a], [al.transducer.spelling[1][i] for i in b]
    if b"".join(pa) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
        return None
    sa, sb = spans(pa), spans(pb)
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, i, j = [], 0, 0
    for end in ends:
        x, y = [], []
        while i < len(a) and sa[i][1] <= end:
            x.append(a[i])
            i += 1
        while j < len(b) and sb[j][1] <= end:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    links, j = [], 0
    for i, (s, e) in enumerate(sa):
        while sb[j][1] <= s:
            j += 1
        k = j
        while k < len(b) and sb[k][0] < e:
            links.append((a[i], b[k]))
            k += 1
    written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return len(a), len(b), len(groups), Counter(links), hashlib.sha256(written.encode()).hexdigest()


def check(text):
    found, want = ta.aligner()(text) if text else None, plain(text)
    if want is None:
        assert found is None
        return
    (a, b, g), digest, pairs, numbers = found
    assert int(numbers.sum()) == a + b - g
    assert (a, b, g, digest) == (want[0], want[1], want[2], want[4])
    assert {(p % ta.A_IDS, p // ta.A_IDS): n for p, n in zip(pairs.tolist(), numbers.tolist(), strict=True)} == dict(want[3])


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    check(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'st\n\t\r;1é|<>! \x85\x1c日▁  ")), max_size=40))
def test_any_text(text):
    check(text)


def test_every_white_space_character():
    for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0    ​    　﻿":
        for text in (f"a{c} b", f"a {c}b", f"a{c}\n b", f"a\n{c}{c} !{c}", f"{c}x", f"!{c}! {c}"):
            check(text)


def test_slices_and_a_full_memory(monkeypatch):
    text = "the quick brown fox\njumps over  it 12 times; " * 40
    want = ta.aligner()(text)
    monkeypatch.setattr(ta, "PIECES", 7)
    monkeypatch.setattr(ta.Aligner, "CHARS", 20)
    got = ta.aligner()(text)
    assert got[:2] == want[:2] and all((x == y).all() for x, y in zip(got[2:], want[2:], strict=True))
    ta.aligner().forget()


def test_steps_of_the_transducer():
    t = ta.Transducer([b"ab", b"c", b"abcd", b"x"], [b"a", b"bc", b"abc", b"d", b"zz"])
    assert t([0, 1], [0, 1]) == ([([0, 1], [0, 1])], [(0, 0), (0, 1), (1, 1)])
    assert t([2, 0, 1], [2, 3, 2]) == ([([2], [2, 3]), ([0, 1], [2])], [(2, 2), (2, 3), (0, 2), (1, 2)])
    assert t([0], [0]) is None and t([3], [4]) is None and t([0, 1], [2, 3]) is None and t([], []) == ([], [])
    assert (b"ab", 0) in t.steps[0]


def test_documents(spark, sf):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = real + [(10**6 + i, t) for i, t in enumerate(TEXTS)] + [(7, None), (None, "no id"), (5, "again here"), (5, "again here")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, pair int")
    found = [(d, plain(t) if t else None) for d, t in rows]
    total = Counter()
    for _, f in found:
        if f:
            total.update(f[3])
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(highest.get(b, 0), n)
    want = []
    for d, f in found:
        if f is None:
            want.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(n for p, n in f[3].items() if total[p] == highest[p[1]])
            want.append((d, f[0], f[1], f[2], sum(f[3].values()), best, sum(n * total[p] for p, n in f[3].items()), f[4]))
    key = lambda r: tuple((x is None, x) for x in r)
    for frequent in (3, ta.FREQUENT):
        got = ta.align(docs, frequent=frequent)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert ta.align(docs.where("false")).count() == 0
