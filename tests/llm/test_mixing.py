import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from strandline.llm import mixing


def rows_of(spark):
    rows = [(i, "text", f"s{i % 3}" if i % 2 else "s0", "x") for i in range(400)]
    return rows + [(None, None, None, "x"), (7, "", "s1", "y"), (7, "", "s1", "y"), (9, "l" * 50_000, "s2", None)]


def brute(rows, weights, block):
    """Uses of each source's blocks and the sources by slot, by exact fractions and plain search."""
    n = Counter(r[2] for r in rows)
    total = sum(map(Fraction, weights.values()))
    w = {s: Fraction(weights[s]) / total for s in n if weights[s]}
    slots = max(math.ceil(math.ceil(n[s] / block) / w[s]) for s in w)
    k, order = dict.fromkeys(w, 0), []
    for slot in range(slots):
        ready = [s for s in w if math.floor(k[s] / w[s]) <= slot]
        s = min(ready, key=lambda s: math.ceil((k[s] + 1) / w[s]))
        order.append((s, k[s]))
        k[s] += 1
        assert all(abs(k[x] - (slot + 1) * w[x]) < 1 for x in w)
    return order, k


@pytest.mark.parametrize("weights", [None, {"s0": 0.5, "s1": 0.25, "s2": 0.25, None: 0.125}, {"s0": 1.0, "s1": 0.0, "s2": 3.0, None: 1.0}])
def test_whole_schedule_against_brute_force(spark, weights):
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot0 string")
    out = mixing.mix(df, weights=weights, block=2, range_rows=50).collect()
    given = weights or {s: n**0.9 for s, n in Counter(r[2] for r in rows).items()}
    order, used = brute(rows, given, 2)
    uses = Counter((r.doc_id, r.text, r.source, r.slot0) for r in out)
    for row, n in Counter(rows).items():
        assert uses[row] >= n if given[row[2]] else uses[row] == 0
    by_slot = defaultdict(list)
    for r in out:
        by_slot[r.slot].append(r)
    # shares are rounded to one in 2^62, which may move the end by a slot
    assert sorted(by_slot) == list(range(len(by_slot))) and abs(len(by_slot) - len(order)) <= 1
    seen, sizes = Counter(), Counter(r[2] for r in rows)
    for slot in range(len(by_slot)):
        members = by_slot[slot]
        (source,) = {r.source for r in members}
        (block,) = {r.block for r in members}
        assert block == seen[source]
        blocks = -(-sizes[source] // 2)
        assert {r.epoch for r in members} == {block // blocks}
        assert sorted(r.place for r in members) == list(range(min(2, sizes[source] - 2 * (block % blocks))))
        seen[source] += 1
        assert all(abs(seen[s] - (slot + 1) * given[s] / sum(given.values())) < 1.001 for s in seen)
    assert all(abs(seen[s] - n) <= 2 for s, n in used.items())


def test_no_padding(spark):
    """Documents of one size and weights as their numbers: every document once, and one source alone never repeats."""
    df = spark.createDataFrame([(i, "t", "a" if i % 4 else "b") for i in range(1000)], "doc_id long, text string, source string")
    assert mixing.mix(df, exponent=1.0, block=1).count() == 1000
    assert mixing.mix(df.where("source = 'a'")).count() == 750
    assert mixing.mix_documents(df).count() <= 1.4 * 1000


def whole_run(weights, slots):
    parts = list(mixing.shares(dict(enumerate(weights))).values())
    return parts, list(mixing.exact_schedule(parts, slots))


@pytest.mark.parametrize("weights", [[5, 3, 1], [n**0.9 for n in (4000, 900, 300, 77, 20, 5, 1, 1)], [1 / 3] + [2 / 3 / 60] * 60, [1.0, 1e-7, 1e-7]])
def test_frames_give_the_one_schedule(spark, weights):
    """Frames made side by side, from guesses, give row for row the schedule that runs from slot 0."""
    parts, rows = whole_run(weights, 3000)
    for frame in (40, 333, 3000, 5000):
        got = mixing._schedule(spark, parts, 3000, frame).collect()
        assert sorted((r.slot, r.j, r.k) for r in got) == [(slot, i, k) for i, k, slot in rows]


def test_wrong_guesses_are_made_again(spark, monkeypatch):
    """Every frame's guess wrong: the rounds still end with the one schedule."""
    parts, rows = whole_run([7, 5, 3, 2, 2], 600)
    monkeypatch.setattr(mixing, "_likely", lambda parts, slot: [slot * p // sum(parts) for p in parts])
    got = mixing._schedule(spark, parts, 600, 100).collect()
    assert sorted((r.slot, r.j, r.k) for r in got) == [(slot, i, k) for i, k, slot in rows]


def test_small_frames_mix_alike(spark):
    df = spark.createDataFrame(rows_of(spark), "doc_id long, text string, source string, slot0 string")
    one, many = (Counter(map(tuple, mixing.mix(df, block=2, frame=f).collect())) for f in (1 << 20, 30))
    assert one == many


def test_clashing_columns_and_many_sources(spark):
    names = ["slot", "place", "Epoch", "block", "_row", "rank", "_rank", "range", "row", "s", "i"]
    df = spark.createDataFrame([(i, f"s{i % 90}", *names) for i in range(200)], ", ".join(["doc_id long", "source string", *(f"`{n}` string" for n in names)]))
    out = mixing.mix(df, block=1)
    assert out.columns == [*df.columns, "_epoch", "_block", "_slot", "_place"]
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(range(200)) and all(r[n] == n for r in rows for n in names)
    assert mixing.mix_documents(df).columns == df.columns
    many = spark.range(5000).selectExpr("id AS doc_id", "concat('s', id) AS source")
    assert mixing.mix(many).count() == 5000


def test_deviation_from_the_weights():
    for weights in ([0.3] + [0.7 / 19] * 19, [1 / 3] + [2 / 3 / 1999] * 1999, [1 / 3, 1 / 7, 11 / 21], [1.0, 1.0] * 2100):
        parts = list(mixing.shares(dict(enumerate(weights))).values())
        seen, total = [0] * len(weights), sum(weights)
        for n, (i, k, slot) in enumerate(mixing.exact_schedule(parts, 13_000), 1):
            assert slot == n - 1 and k == seen[i]
            seen[i] += 1
            if n % 97 == 0 or n == 13_000:
                assert all(abs(c - n * w / total) < 1 + 1e-6 for c, w in zip(seen, weights, strict=True))
    assert set(mixing.shares({"a": 1, "b": 0})) == {"a"}


def test_mix_keeps_to_the_weights(spark):
    rows = [(i, f"s{i % 20}" if i % 10 > 3 else "s0") for i in range(9000)] + [(9000, None)] * 400 + [(9001, "zero")]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    found = Counter(s for _, s in rows)
    weights = {s: 0.0 if s == "zero" else 0.3 if s == "s0" else 0.05 for s in found}
    out = mixing.mix(df, weights=weights, block=2, range_rows=500).collect()
    assert {(r.doc_id, r.source) for r in out} == {r for r in rows if r[1] != "zero"}
    source = {r.slot: r.source for r in out}
    assert sorted(source) == list(range(len(source)))
    seen, total = Counter(), sum(weights.values())
    for n in range(1, len(source) + 1):
        seen[source[n - 1]] += 1
        assert all(abs(seen[s] - n * w / total) < 1 + 1e-6 for s, w in weights.items())


def test_stage_keeps_columns_and_weights(spark):
    df = spark.createDataFrame(rows_of(spark), "doc_id long, text string, source string, n_chars string")
    out = mixing.mix_documents(df, weights={"s0": 1, "s1": 1, "s2": 1, None: 0})
    assert out.columns == df.columns and out.count() >= df.where("source IS NOT NULL").count()
    with pytest.raises(ValueError):
        mixing.mix(df, weights={"s0": 1})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.op7_source_mixing(spark, sf)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
