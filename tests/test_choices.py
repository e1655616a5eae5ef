"""Hand-checked cases of labels, clusters, vertices, errors, windows and lines."""

import math

import pytest
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions import spectral as sp
from strandline.operators import evaluate as ev
from strandline.operators import joins, scenes, series, shorelines, tides
from strandline.operators import selection as sel


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def arr(*values):
    return F.array(*(F.lit(float(v)) for v in values))


def test_label_is_the_first_clear_one(spark):
    for means, classes, want in [
        ([40], (0, 1, 1), (0, 0.0)),
        ([10], (0, 1, 1), (1, 50.0)),  # origin too near
        ([15], (0, 1, 1), (1, 50.0)),  # exactly at the limit is too near
        ([10, 45], (0, 1, -1), (-1, 0.0)),
        ([10, 45], (0, 1, 0), (2, 100.0)),
        ([], (-1, -1, 1), (2, 100.0)),
    ]:
        means = arr(*means) if means else F.array().cast("array<double>")
        got = one(spark, c=sel.label_choice(means, [F.lit(c) for c in classes], F.lit(100))).c
        assert (got.place, got.at) == want


def test_clusters_by_side_of_the_label(spark):
    def two(a, b, water):
        return int(bool(water) != ((a > 0) != (b > 0)))

    for a, b, c in [(-9, -5, -1), (-9, -5, 4), (-9, 3, 4), (1, 3, 4), (0, 0, 0)]:
        for water in (True, False):
            w = F.lit(water)
            got = one(spark, two=sel.cluster_of_two(arr(a, b), w), three=sel.cluster_of_three(arr(a, b, c), w), agrees=sel.cluster_agrees(F.lit(a), w))
            assert got.two == two(a, b, water)
            assert got.three == (two(a, b, water) if b > 0 else two(b, c, water) + 1)
            assert got.agrees == ((water and a < 0) or (not water and a > 0))


def test_vertices_without_missing_ones(spark):
    nan = float("nan")
    rows = [(1, 1, 0, 1.0, 1.0), (1, 1, 1, nan, 2.0), (1, 1, 2, 3.0, 3.0), (1, 2, 0, 1.0, None), (1, 2, 1, 5.0, 5.0), (1, 3, 0, 7.0, 7.0), (None, 1, 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "scene_id long, contour_id long, pt_idx long, x double, y double")
    got = {(r.scene_id, r.contour_id, r.pt_idx) for r in sel.whole_vertices(df).collect()}
    assert got == {(1, 1, 0), (1, 1, 2), (1, 3, 0), (None, 1, 0)}  # a whole line of one vertex stays
    assert sel.whole_vertices(df.limit(0)).count() == 0


def test_landward_points_lose_their_chainage(spark):
    t = spark.createDataFrame([("a", 0.0, 0.0, 100.0, 0.0), ("b", 0.0, 1000.0, 100.0, 1000.0)], "transect_id string, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame([(1, 50.0, 1.0), (1, -200.0, 2.0), (1, -390.0, 2.0), (1, -420.0, 2.0), (2, -200.0, 2.0), (1, -200.0, 1001.0)], "scene_id long, x double, y double")
    got = {(r.scene_id, r.transect_id, r.x, r.chainage) for r in joins.transect_chainages(t, p, ["scene_id", "transect_id"]).collect()}
    assert got == {(1, "a", 50.0, 50.0), (1, "a", -200.0, None), (1, "a", -390.0, None)}


def test_errors_fit_and_coverage(spark):
    pairs = spark.createDataFrame([("L8", float(v), 0.0) for v in (1, 2, 3, 4, 100)] + [("L8", None, 1.0), ("S2", 5.0, 1.0)], "satname string, a double, b double")
    got = {r.satname: r for r in ev.satellite_errors(pairs, "a", "b").collect()}
    assert (got["L8"].median, got["L8"].n, got["L8"].low, got["L8"].high) == (3, 5, 1, 4)
    assert (got["S2"].median, got["S2"].n, got["S2"].low, got["S2"].high) == (4, 1, 4, 4)
    line = spark.createDataFrame([("k", float(x), 2.0 * x + 1) for x in range(5)] + [("k", None, 3.0), ("few", 1.0, 1.0)], "g string, x double, y double")
    (r,) = ev.linear_fit(line, ["g"], "x", "y").collect()
    assert (r.g, r.n) == ("k", 5) and r.slope == pytest.approx(2) and r.intercept == pytest.approx(1) and r.slope_std == pytest.approx(0, abs=1e-6)
    places = spark.createDataFrame([("a",), ("b",)], "transect_id string")
    corrected = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("a", 4.0)], "transect_id string, corrected double")
    trends, slopes = spark.createDataFrame([("a", 0.5)], "transect_id string, trend double"), spark.createDataFrame([("a", 0.2)], "transect_id string, slope double")
    r = {x.transect_id: x for x in ev.coverage_records(corrected, trends, slopes, places, spark.range(7)).collect()}
    assert (r["a"].images_used, r["a"].images_total, r["a"].coverage_pct, r["a"].data_gap_pct, r["a"].slope) == (3, 7, 75, 25, 0.2)
    assert (r["b"].images_used, r["b"].coverage_pct, r["b"].slope, r["b"].trend) == (0, None, 0.1, None)


def test_counts_of_an_extraction(spark):
    rows = [("S2", 10.0, 5.0, False, True), ("S2", 90.0, 90.0, False, False), ("S2", 10.0, 90.0, None, None), ("S2", None, 5.0, False, True), ("S2", 1.0, 1.0, True, True), ("S2", 1.0, 1.0, None, False), ("L8", 1.0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "satname string, cloud_cover double, empty_share double, failed boolean, accepted boolean")
    got = {r.satname: tuple(r)[1:] for r in scenes.extraction_counts(df, 50, 50).collect()}
    assert got == {"S2": (6, 1, 1, 1, 2, 1), "L8": (1, 1, 0, 0, 0, 0)}
    p = spark.createDataFrame([(1, True, 1), (1, True, 3), (1, False, 1), (2, True, None)], "scene_id long, in_buffer boolean, label int")
    assert {tuple(r) for r in shorelines.sand_gate(p, 1).collect()} == {(1, 1, 1, True), (2, 0, 0, False)}
    assert {tuple(r) for r in shorelines.class_counts(p).collect()} == {(1, 2, 0.5), (3, 1, 0.25), (None, 1, 0.25)}


def test_windows_boxes_and_lines(spark):
    f = lambda v: F.lit(float(v))
    w = one(spark, w=geo.window_bounds(f(2.5), f(98.5), 5, F.lit(120), F.lit(100))).w
    assert tuple(w) == (94, 100, 0, 8)  # halves round to even: 93.5 -> 94, 7.5 -> 8
    corners = geo.collider(f(0), f(0), f(3), f(4), 1, 0, 0)
    for x, y, want in [(1.5, 2, True), (0, 0, False), (-0.5, -0.5, False), (1.5 + 0.79, 2 - 0.59, True), (1.5 + 0.81, 2 - 0.61, False)]:
        assert one(spark, v=geo.inside_convex(f(x), f(y), corners)).v is want
    x, y = geo.on_transect(f(0), f(0), f(3), f(4), f(-10))
    same = geo.on_transect(f(1), f(1), f(1), f(1), f(5))[0]
    r = one(spark, x=x, y=y, same=same, mid=geo.lerp(f(0), f(1), f(4), f(3), f(1)), out=geo.lerp(f(0), f(1), f(4), f(3), f(5)), upright=geo.slope_intercept(f(1), f(0), f(1), f(2))[0])
    assert (r.x, r.y, r.same, r.mid, r.out, r.upright) == (-6, -8, None, 1.5, None, None)
    a, b = geo.line_crossing((f(1), f(0)), (f(-1), f(4)))
    r = one(spark, a=a, b=b, none=geo.line_crossing((f(1), f(0)), (f(1), f(4)))[0])
    assert (r.a, r.b, r.none) == (2, 2, None)


def test_scaling_ranges_and_slopes(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (1, float("nan")), (1, None), (2, 3.0)], "scene_id long, v double")
    got = sorted(((r.scene_id, r.v) for r in sp.standardize(df, "v", ["scene_id"], -1, 1).collect()), key=str)
    assert got == sorted([(1, -1.0), (1, 1.0), (1, None), (1, None), (2, None)], key=str)
    s = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", -9.0), ("a", None)], "transect_id string, v double")
    (r,) = series.symmetric_range(s, "v", ["transect_id"]).collect()
    (c,) = series.symmetric_range(s, "v", ["transect_id"], centred=True).collect()
    assert (r.low, r.high, c.high) == (-9, 9, 10)
    m = spark.createDataFrame([("a", 10.0, 1.0), ("a", None, 1.0)], "transect_id string, chainage double, tide double")
    assert sorted((r.slope, r.corrected) for r in tides.correct_over(m, [0.1, 0.5]).where("corrected IS NOT NULL").collect()) == [(0.1, 20.0), (0.5, 12.0)]
    for bad in ([], [0.1, 0]):
        with pytest.raises(ValueError):
            tides.correct_over(m, bad)
    assert math.isclose(ev.median_distances(s.select("transect_id").distinct(), s.withColumnRenamed("v", "chainage"), s.where("v > 0").withColumnRenamed("v", "chainage"), ["transect_id"]).first().distance, 1 - 1.5)
