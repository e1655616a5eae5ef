import hashlib
import random

import duckdb
import pandas as pd

from strandline.llm import line_dedup as ld


def chunks_of(text, every=2, longest=64):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) >> 2 for x in lines]
    out, at, zeros = [], 0, 0
    held = False  # the line before ended a chunk
    ends = []
    for i in range(len(lines) - 2):
        held = not held and i > 0 and (h[i - 1] * 1_000_003 + h[i]) % every == 0
        ends.append(held)
    for i, e in enumerate(ends):
        zeros = 0 if e else zeros + 1
        if zeros == longest:
            ends[i], zeros = True, 0
    for i, e in enumerate([*ends, *([False, True] if len(lines) > 1 else [True])]):
        if e:
            out.append(lines[at : i + 1])
            at = i + 1
    return out


def brute(rows):
    worded = lambda x: bool(x.strip(" \t\n\x0b\x0c\r"))
    cut = [(d, chunks_of(t) if t is not None else []) for d, t in rows]
    at = {}
    for d, cs in cut:
        for p, c in enumerate(cs):
            if sum(map(worded, c)) > 1:
                at.setdefault("\n".join(c), set()).add((d is None, d or 0, p))
    out, least = [], {c: min(places) for c, places in at.items()}
    for (d, t), (_, cs) in zip(rows, cut, strict=True):
        gone = {p for p, c in enumerate(cs) if d is not None and "\n".join(c) in at and least["\n".join(c)] != (False, d, p)}
        kept = "\n".join("\n".join(c) for p, c in enumerate(cs) if p not in gone)
        out.append((d, len(cs), len(gone), t if t is None or not gone else kept))
    return out


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)


def sample():
    rng = random.Random(4)
    lines = [f"line {i} of some words" for i in range(60)] + ["", " ", "é\tü"]
    passage = [f"shared passage line {i}" for i in range(12)]
    rows = []
    for d in range(120):
        body = [rng.choice(lines) for _ in range(rng.randint(0, 12))]
        if d % 3 == 0:
            k = rng.randint(0, len(body))
            body[k:k] = passage
        rows.append((d, "\n".join(body)))
    rows += [(500, None), (501, ""), (502, "\n\n\n"), (503, "one"), (None, "\n".join(passage)), (504, "same\n" * 100_000), (505, "x" * 100_000 + "\ny")]
    return [*rows, rows[3], rows[3]]


def test_matches_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, chunk string, place int")
    out = ld.dedup_lines(df)
    assert out.columns == [*df.columns, "n_chunks", "n_removed"]
    got = [(r.doc_id, r.n_chunks, r.n_removed, r.text) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert sum(r[2] for r in got) > 50


def test_sql_gives_the_same(spark, sf):
    documents = pd.DataFrame([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], columns=["doc_id", "text"])  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    expected = con.execute(ld.OP2_SQL).fetchall()
    assert sorted(map(tuple, ld.op2_line_dedup(spark, sf).collect())) == sorted(expected)


def test_native_and_empty(spark, sf):
    plan = ld.op2_line_dedup(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert ld.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    out = ld.dedup_lines(spark.createDataFrame([], "n_removed string, doc_id long, text string"))
    assert out.columns == ["n_removed", "doc_id", "text", "n_chunks", "_n_removed"] and out.count() == 0


def test_clashing_columns(spark):
    twice = "a b\nc d\ne f\ng h\ni j\nk l"
    names = ["n_chunks", "N_Removed", "_doc", "_gone", "_maybe", "_left", "_at", "_bucket", "_map", "h", "g", "n", "place"]
    df = spark.createDataFrame([(d, twice, *names) for d in (1, 2)], ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in names)]))
    out = ld.dedup_lines(df)
    assert out.columns == [*df.columns, "_n_chunks", "_n_removed"]
    rows = {r.doc_id: r for r in out.collect()}
    assert all(r[n] == n for r in rows.values() for n in names)
    assert rows[1].text == twice and rows[2].text == "" and rows[2]["_n_removed"] == rows[2]["_n_chunks"] > 0


def test_equal_hashes_are_parted_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(ld.F, "xxhash64", lambda *c: ld.F.lit(1).cast("long"))
    rows = sample()
    got = [(r.doc_id, r.n_chunks, r.n_removed, r.text) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_share_of_repeated_runs(spark):
    """Of lines in three worded lines that repeat, at least 0.85 lie in a chunk that repeats (sf0.1: 0.91)."""
    docs = [(r.doc_id, r.text.split("\n")) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").collect()]
    worded = lambda x: bool(x.strip(" \t\n\x0b\x0c\r"))
    runs, many = {}, {}
    for d, x in docs:
        for i in range(len(x) - 2):
            if all(map(worded, x[i : i + 3])):
                runs.setdefault(tuple(x[i : i + 3]), []).append((d, i))
        at = 0
        for c in chunks_of("\n".join(x)):
            if sum(map(worded, c)) > 1:
                many.setdefault("\n".join(c), []).append((d, at, len(c)))
            at += len(c)
    wanted = {(d, i + k) for places in runs.values() if len(places) > 1 for d, i in places for k in range(3)}
    found = {(d, a + k) for places in many.values() if len(places) > 1 for d, a, n in places for k in range(n)}
    assert len(wanted & found) >= 0.85 * len(wanted) > 0
