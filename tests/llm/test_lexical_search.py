import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from strandline.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    held = [(d, Counter(w), len(w)) for d, w in ((d, words(t)) for d, t in docs) if w]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked = [(t, math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))) for t in words(text) if df[t]]
        scores = []
        for d, c, size in held:
            m = 25 + 75 * size * n // length
            s = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in asked if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if no else d, -s) for i, (s, no, d) in enumerate(sorted(scores)[:k])]
    return out


ODD = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "!?- --"), (None, "alpha beta beta"), (None, "alpha beta beta"), (5 * 10**6, "alpha beta beta"), (5 * 10**6, "alpha beta beta"), (4 * 10**6, "alpha beta beta"), (10**7, "Ärger ÄRGER naïve x_y A-B a.b 日本語"), (10**7 + 1, "gamma " * 4000 + "delta"), (10**7 + 2, "the " * 20)]
QUERIES = [("q1", "alpha BETA"), ("q2", None), ("q3", "unheard wordless"), (None, "gamma delta gamma"), ("q1", "ärger ÄRGER"), ("q1", "Ärger a b x y"), ("q4", "the " * 300 + "alpha")]


@pytest.mark.parametrize(("shard_terms", "block"), [(500, 3), (ls.SHARD_TERMS, ls.BLOCK)])
def test_documents(spark, sf, shard_terms, block):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ODD
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items = [(str(i), t) for i, t in items] + QUERIES
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, rank int, shard int")
    got = ls.search_documents(df, spark.createDataFrame(items, "item_id string, text string"), block=block, shard_terms=shard_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(docs, items), key=key)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([("q", "a")], "item_id string, text string")
    assert ls.search_documents(docs.where("false"), items).count() == 0
    assert ls.search_documents(docs, items.where("false")).count() == 0


def test_max_score_reads_only_essential_lists():
    rng = np.random.default_rng(5)
    n, docs = 3000, np.arange(3000)
    for _ in range(20):
        scale, lists = ls.Scale(rng.integers(5, 900, n), n, 200 * n), []
        for _ in range(12):
            own = np.sort(rng.choice(docs, rng.integers(1, n), replace=False))
            counts = rng.integers(1, 6, len(own))
            lengths = rng.integers(5, 900, len(own))
            lists.append((ls._List(int(rng.integers(1, 9000)), own, counts, counts, np.minimum(lengths, 5), scale), int(rng.integers(1, 3))))
        want = np.zeros(n, np.int64)
        for q, times in lists:
            want[q.docs] += times * q.weight * ls.part(q.counts, scale.m[q.docs])
        best = np.lexsort((docs, -want))[:10]
        assert ls.max_score(lists, n, docs, 10) == [(int(i), int(want[i])) for i in best if want[i] > 0]
    rare = (ls._List(9000, np.arange(40), np.full(40, 3), np.array([3]), np.array([5]), ls.Scale(np.full(n, 100), n, 100 * n)), 1)
    common = ls._List(3, docs, np.ones(n, np.int64), np.array([1]), np.array([5]), rare[0].scale)
    found = ls.max_score([rare, (common, 1)], n, docs, 10)
    assert len(found) == 10 and common.whole is None  # the common list was probed, never read


def test_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = sorted(con.execute(ls.OP12_SQL).fetchall())
    assert sorted(map(tuple, ls.op12_lexical_search(spark, sf).collect())) == want
    per_item = defaultdict(int)
    for r in want:
        per_item[r[0]] += 1
    assert max(per_item.values()) == 10
