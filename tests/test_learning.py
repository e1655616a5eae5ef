"""Learning operators and research statistics against plain computations."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import registry
from strandline.operators import ml, raster, research, tides


def test_kmeans_rows_go_to_the_nearest_mean(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b)) for a, b in np.r_[rng.normal(0, 1, (80, 2)), rng.normal(9, 1, (60, 2))]]
    got = ml.kmeans(spark.createDataFrame(rows, "x double, y double"), ["x", "y"]).collect()
    x, k = np.array([(r.x, r.y) for r in got]), np.array([r.prediction for r in got])
    means = np.array([x[k == i].mean(axis=0) for i in range(2)])
    assert (((x[:, None] - means) ** 2).sum(axis=2).argmin(axis=1) == k).all()
    assert sorted(np.bincount(k)) == [60, 80]


def test_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(a), float(b)) for g in range(2) for a, b in np.r_[rng.normal(0, 3, (40, 2)), rng.normal(60, 3, (30, 2)), rng.uniform(-100, 200, (15, 2))]]
    got = ml.dbscan(spark.createDataFrame(rows, "g int, x double, y double"), ["g"], "x", "y", 5.0, 5).collect()
    for g in range(2):
        mine = [r for r in got if r.g == g]
        p = np.array([(r.x, r.y) for r in mine])
        near = ((p[:, None] - p) ** 2).sum(axis=2) <= 25
        core = near.sum(axis=1) >= 5
        label = np.arange(len(p))
        while True:
            new = np.array([label[near[i] & core].min() if core[i] else label[i] for i in range(len(p))])
            if (new == label).all():
                break
            label = new
        for i, r in enumerate(mine):
            assert (r.cluster == -1) == (not (near[i] & core).any())
            for j, s in enumerate(mine):
                if core[i] and core[j]:
                    assert (r.cluster == s.cluster) == (label[i] == label[j])


def test_components_and_mixtures(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(0, 1, (200, 2)), rng.normal(12, 1, (200, 2))]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    out = np.array([(r.a, r.b, *r.pca) for r in ml.components(df, ["a", "b"]).collect()])
    values, vectors = np.linalg.eigh(np.cov(out[:, :2].T))
    assert np.allclose(np.abs(out[:, 2]), np.abs(out[:, :2] @ vectors[:, 1]), atol=1e-6)
    n, bic = ml.best_mixture(df, ["a", "b"], 2)
    assert n == 2 and bic[2] < bic[1]


def test_classifier_and_folds(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i % 10 > 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    train, test = ml.split(df, ["id"])
    model = ml.train_classifier(train, ["a", "b"], 2, layers=(8,), rounds=60)
    assert ml.accuracy(ml.classify(test, ["a", "b"], model)) > 0.95
    assert min(ml.cross_validate(df, ["a", "b"], 2, ["id"], folds=2, layers=(8,), rounds=60)) > 0.9


def test_pansharpen_against_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(1, 0.2, (50, 3)) + rng.normal(0, 1, (50, 1))
    pan = x.mean(axis=1) + rng.normal(0, 0.05, 50)
    rows = [(1, i, *map(float, v), float(q), i % 9 == 0) for i, (v, q) in enumerate(zip(x, pan, strict=True))]
    df = spark.createDataFrame(rows, "scene_id long, pixel_id long, b double, g double, r double, pan double, cloud boolean")
    got = {r.pixel_id: (r.b, r.g, r.r) for r in raster.pansharpen(df, ["b", "g", "r"]).collect()}
    clear = np.array([i % 9 != 0 for i in range(50)])
    y, q = x[clear], pan[clear]
    centred = y - y.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    first = axes[0] * (np.sign(axes[0].sum()) or 1)
    score = centred @ first
    new = (q - q.mean()) / q.std() * score.std() + score.mean()
    expected = y + np.outer(new - score, first)
    assert all(got[i][0] is None or np.isnan(got[i][0]) for i in np.flatnonzero(~clear))
    assert np.allclose([got[i] for i in np.flatnonzero(clear)], expected)


def test_transect_features_are_lines(spark, sf):
    rows = [json.loads(r.value) for r in registry.QUERIES["s30_transect_features"](spark, sf).collect()]
    for k, f in enumerate(sorted(rows, key=lambda f: f["properties"]["name"])):
        assert f["type"] == "Feature" and f["geometry"] == {"type": "LineString", "coordinates": [[k * 4 - 50, k * 2 - 30], [k * 4 - 20, k * 3 - 20]]}


def test_shared_slope(spark):
    rng = np.random.default_rng(8)
    rows = [("t", float(x), float(0.4 * x + b + rng.normal(0, 0.05))) for x in np.linspace(-1, 1, 60) for b in (-1.0, 1.0)]
    r = research.shared_slope_lines(spark.createDataFrame(rows, "transect_id string, x double, y double"), ["transect_id"], "x", "y").first()
    assert abs(r.slope - 0.4) < 0.05 and abs(r.biases[0] + 1) < 0.1 and abs(r.biases[1] - 1) < 0.1 and r.loss < 0.02


def test_small_objects_on_a_large_grid(spark):
    rng = np.random.default_rng(9)
    on = rng.random((60, 50)) < 0.55
    df = spark.createDataFrame([(1, r, c, bool(on[r, c])) for r in range(60) for c in range(50)], "scene_id long, row int, col int, on boolean")
    got = {(r.row, r.col): r.on for r in raster.drop_small_objects(df, "on", 6).collect()}
    seen, keep = set(), set()
    for p in zip(*np.nonzero(on), strict=True):
        stack, found = [tuple(map(int, p))], []
        while stack:
            r, c = stack.pop()
            if (r, c) in seen or not (0 <= r < 60 and 0 <= c < 50) or not on[r, c]:
                continue
            seen.add((r, c))
            found.append((r, c))
            stack += [(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
        if len(found) >= 6:
            keep.update(found)
    assert {k for k, v in got.items() if v} == keep


@pytest.mark.parametrize("tile", [4, 7, 128])
def test_focal_over_tile_borders(spark, tile):
    rng = np.random.default_rng(10)
    x = {(r, c): float(rng.normal()) if rng.random() < 0.9 else None for r in range(-3, 14) for c in range(2, 20) if rng.random() < 0.95}
    df = spark.createDataFrame([(1, r, c, v) for (r, c), v in x.items()], "scene_id long, row int, col int, v double")
    out = raster.focal(df, 2, {"most": ("v", "max"), "mid": ("v", "median")}, tile=tile).collect()
    assert len(out) == len(x)
    for r in out:
        around = [x[p] for p in ((r.row + a, r.col + b) for a in range(-2, 3) for b in range(-2, 3)) if x.get(p) is not None]
        assert r.most == (max(around) if around else None) and (r.mid is None if not around else abs(r.mid - np.median(around)) < 1e-12)


def test_next_value_over_streams(spark):
    rng = np.random.default_rng(11)
    start = np.datetime64("2020-01-01T00:00:00")
    t = lambda n: (start + (np.sort(rng.integers(0, 10**8, n)) // 500 * 500).astype("timedelta64[s]")).astype("datetime64[us]").tolist()
    left, right = [(i, "s", x) for i, x in enumerate(t(300))], [("s", x, float(i)) for i, x in enumerate(t(60))]
    a = spark.createDataFrame(left, "id long, site string, ts timestamp_ntz")
    b = spark.createDataFrame(right, "site string, ts timestamp_ntz, tide double")
    for days in (1, 30, 10_000):
        got = {r.id: r.tide for r in tides.next_value(a, b, ["site"], "tide", days=days).collect()}
        for i, _, x in left:
            later = [(y, v) for _, y, v in right if y > x]
            assert got[i] == (min(later)[1] if later else None)
    assert tides.next_value(a.withColumn("site", F.lit("other")), b, ["site"], "tide").where("tide IS NOT NULL").count() == 0
