import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_minhash_dedup import brute as brute_near
from test_packing import check_layout
from tokenizers import Tokenizer

import corpus_pipeline as cp
from strandline.llm import packing, quality_rules
from strandline.llm.common import materialize


def test_stages_against_brute_force(spark, sf):
    extra = [(10**6 + i, None if i == 0 else "", "en", f"s{i}", 0) for i in range(2)] + [(None, "no id " * 30, "en", None, 180)]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(spark.createDataFrame(extra, docs.schema))
    seen = [materialize(docs, "t")]
    for name, stage in cp.STAGES:
        seen.append(materialize(stage(spark, seen[-1], sf), f"t-{name}"))
        if name != "best_fit_packing":
            assert seen[-1].columns == docs.columns
    rows = [[tuple(r) for r in df.collect()] for df in seen]

    kept = [tuple(r) for r in quality_rules.score_documents(seen[0]).where("kept").select("doc_id").collect()]
    assert Counter(r[0] for r in rows[1]) == Counter(d for (d,) in kept)
    expected = {(d, t) for (d, _, gone, t), r in zip(brute_lines([r[:2] for r in rows[1]]), rows[1], strict=True) if not gone or t}
    assert {r[:2] for r in rows[2]} == expected
    assert all(r[4] == len(r[1]) for r in rows[2] if r[1] is not None and r not in rows[1])
    near = brute_near([r[:2] for r in rows[2]])
    assert Counter(r[0] for r in rows[3]) == Counter([d for d, (_, c) in near.items() if d == c] + [r[0] for r in rows[2] if r[0] is None])
    assert set(rows[4]) == set(rows[3])
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for r in rows[4]:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            pieces[r[0], k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    assert pieces == Counter(r[:5] for r in rows[5])
    check_layout(seen[5].collect(), 1024)


def test_run_is_the_stages(spark, sf):
    out = cp.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "packed_in", "bound", "gap"]
    assert check_layout(out.collect(), 1024) > 0
    for r in out.where("packed_in IS NOT NULL").groupBy("packed_in").agg({"bound": "max", "gap": "max"}).collect():
        assert r["max(bound)"] > 0 and r["max(gap)"] >= 0


def test_stages_chained_and_run_twice(spark, sf):
    """Nothing is written between stages, stages are called again before the first result is read, and runs overlap."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(cp.STAGES)
    key = lambda df: Counter(map(tuple, df.collect()))
    kept = stages["quality_rules"](spark, docs, sf)
    a = stages["line_dedup"](spark, kept, sf)
    b = stages["line_dedup"](spark, stages["quality_rules"](spark, docs, sf), sf)
    c = stages["minhash_dedup"](spark, a, sf)
    assert key(a) == key(b) and len(key(c)) > 0
    assert key(c) == key(stages["minhash_dedup"](spark, materialize(b, "t-chain"), sf))
    first = cp.run(spark, sf)
    second = cp.run(spark, sf)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    with ThreadPoolExecutor(2) as pool:
        third, fourth = pool.map(lambda _: cp.run(spark, sf), range(2))
    rows = [key(x.select(columns)) for x in (first, second, third, fourth)]
    assert rows[0] == rows[1] == rows[2] == rows[3] and sum(rows[0].values()) > 0


def test_empty_clashing_and_very_long(spark, sf):
    names = ["slot", "place", "epoch", "block", "_row", "_rank", "n_removed", "n_chunks", "_doc", "_gone", "_maybe", "_code", "code", "kept", "length", "offset", "sequence_id", "piece"]
    base = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text for r in base.where("text IS NOT NULL").orderBy("doc_id").collect()]
    long = spark.createDataFrame([(10**6, "\n".join(t[::-1] for t in texts), "en", None, 0), (None, None, None, None, None)], base.schema)
    rows = base.unionByName(long).withColumns({n: F.lit(n) for n in names})
    assert long.selectExpr("max(length(text)) AS n").first().n > 200_000
    for docs in (rows.limit(0), rows):
        wanted = {r.doc_id for r in docs.collect()}
        for name, stage in cp.STAGES:
            out = materialize(stage(spark, docs, sf), f"odd-{name}")
            if name != "best_fit_packing":
                assert out.columns == docs.columns and all(r[n] == n for r in out.collect() for n in names)
                docs = out
        left = {r.doc_id for r in out.collect()}
        assert left <= wanted and len(left) >= len(wanted) / 2
