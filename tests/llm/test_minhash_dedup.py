import random

import numpy as np

from strandline.llm import minhash_dedup as md

SCHEMA = "doc_id long, text string, n_shingles string"


def brute(rows, percent=85):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(t) for d, t in rows if d is not None}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {d: (len(sets[d]), root(d)) for d in sets}


def result(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "extra") for d, t in rows], SCHEMA)
    out = md.near_components(df, **kw).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None}


def near_rows(seed=3, bases=8, copies=9):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(400)]
    rows = []
    for _ in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.randint(40, 160))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows) + 1, rng.choice([" ", "\n"]).join(w)))
    return rows


def test_matches_brute_force_with_odd_rows(spark):
    rows = near_rows() + [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A  B"), (905, "a b c"), (906, "é É é É é É"), (None, "a b"), (907, "x " * 30_000), (908, "X " * 30_001)]
    rows.append(rows[0])
    assert result(spark, rows) == brute(rows)


def test_blocks_of_a_large_cluster_lose_no_link(spark):
    rows = near_rows(seed=5, bases=2, copies=40)
    assert result(spark, rows, block=7) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == {}


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in md.op9_minhash_dedup(spark, sf).collect()}
    assert got == brute(rows)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = x[:3000], x[1000:]
    ra, rb = md.registers(a), md.registers(b)
    assert (md.merge(ra, rb) == md.registers(x)).all()
    more, less = np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()])
    est = md.estimate_similarity(more, less, np.array([3000.0]), np.array([3000.0]))[0]
    assert abs(est - 0.5) < 0.2
