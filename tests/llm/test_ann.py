import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa

from strandline.llm import ann


def brute(rows, queries, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for qid in sorted({i for i, _ in good if queries(i)}):
        best = {}
        for i, q in good:
            if i != qid:
                continue
            for j, v in good:
                if j != qid and len(v) == len(q):
                    a, b = np.array(q), np.array(v)
                    s = np.add.reduce(a * b) / (np.sqrt(np.add.reduce(b * b)) * np.sqrt(np.add.reduce(a * a)))
                    best[j] = max(best.get(j, -2), s)
        out += [(qid, r + 1, j, best[j]) for r, j in enumerate(sorted(best, key=lambda j: (-best[j], j))[:k])]
    return out


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(240)]
    same = rows[10][1]
    rows += [(1000 + i, same) for i in range(30)]
    rows += [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2003, [float("inf")] + [1.0] * 23), (2004, [None] * 24), (2005, []), (None, same), (50, rows[50][1]), (100, same), (3000, [1.0, 2.0]), (3050, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, d long")
    v = ann.usable(df)
    got = ann.search(v, v.where("vec_id % 50 = 0"), vector_block=60, query_block=3).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    expected = brute(rows, lambda i: i % 50 == 0)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=0, atol=1e-12)


def test_error_bound_and_pruning():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, agree = ann.encode(x)
    assert codes.shape == (4000, 1)
    q = x[0] + 0.1 * rng.normal(size=64)
    q /= np.linalg.norm(q)
    est, bound = ann.estimate(codes, agree, q)
    off = np.abs(est - x @ q)
    assert (off <= bound).mean() > 0.99 and off.mean() < 0.12


def test_sql_gives_the_same(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.op1_ann(spark, sf).collect())
    assert got == sorted(tuple(r) for r in con.execute(ann.OP1_SQL).fetchall())


def test_empty_table(spark):
    v = ann.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert ann.search(v, v).count() == 0


def test_id_with_many_near_vectors():
    """One id holds the nearest 200 rows; five ids come out all the same, the nearest ones."""
    rng = np.random.default_rng(3)
    query = rng.normal(size=256)
    near = query + 0.01 * rng.normal(size=(200, 256))
    far = rng.normal(size=(300, 256)) + 0.3 * query
    x = np.r_[near, far]
    ids = np.r_[np.full(200, 7), np.arange(100, 400)]
    code, agree = ann.encode(x / np.linalg.norm(x, axis=1)[:, None])
    vectors = pa.table({"vec_id": ids, "vector": x.tolist(), "d": [256] * len(x), "code": [c.tobytes() for c in code], "agree": agree})
    queries = pa.table({"vec_id": [1], "vector": [query.tolist()]})
    out = ann._nearest(vectors, queries, 5).to_pandas()
    cosine = x @ query / np.linalg.norm(x, axis=1) / np.linalg.norm(query)
    best = pd.Series(cosine).groupby(ids).max().sort_values(ascending=False).head(5)
    assert list(out["vec_id"]) == list(best.index)
    assert np.allclose(out["score"], best.to_numpy())
