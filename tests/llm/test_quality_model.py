import zlib

import numpy as np

from strandline.llm import quality_model as qm


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    n = qm.BUCKETS + qm.DENSE
    m = qm.Model(0.3, rng.normal(size=n), rng.normal(size=(n, qm.K)), np.zeros(qm.DENSE), np.ones(qm.DENSE))
    idx, x = np.array([5, 99, 1000, n - 1]), np.array([0.5, -1.0, 2.0, 0.25])
    slow = m.w0 + sum(m.w[i] * a for i, a in zip(idx, x, strict=True))
    slow += sum(m.v[idx[p]] @ m.v[idx[q]] * x[p] * x[q] for p in range(4) for q in range(p + 1, 4))
    assert np.isclose(m.margin(idx, x), slow)


def test_held_out_accuracy(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = qm.op3_quality_model(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in judged]) > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 0), (2, None, 1), (3, "", 0), (None, "x", 1), (1, "good words here", 0), (4, "y " * 100_000, 1)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (77, 0)], "doc_id long, quality int")
    got = qm.score_documents(docs, qm.fit_documents(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = qm.score_documents(docs, qm.fit_documents(docs, labels.where("false"))).collect()
    assert {r.score for r in none} == {0.5}
    assert qm.score_documents(docs.where("false"), qm.fit_documents(docs, labels)).count() == 0
