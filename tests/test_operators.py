"""Small cases with answers that can be checked by hand."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import geometry, missing
from strandline.operators import evaluate, joins, outlines, raster, scenes, selection, series, slopes, thresholds, tides

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2020, 1, 1)
SERIES = "transect_id long, scene_id long, ts timestamp_ntz, chainage double"


def frame(spark, values, times=None):
    times = times or [T0 + i * DAY for i in range(len(values))]
    return spark.createDataFrame([(1, i, t, v) for i, (t, v) in enumerate(zip(times, values, strict=True))], SERIES)


def slow_spikes(x, c):
    """The removal rules one value at a time."""
    x = list(enumerate(x))
    while True:
        if len(x) <= 1:
            return []
        v = [b for _, b in x]
        n, gone, end = len(v), None, False
        for k in range(n):
            if k == 0:
                bad = abs(v[0] - v[1]) > c
            elif k == n - 1:
                end, bad = True, abs(v[k] - v[k - 1]) > c
            else:
                m1, p1 = v[k] - v[k - 1], v[k] - v[k + 1]
                bad = abs(m1) > c and abs(p1) > c and np.sign(m1) == np.sign(p1)
                if not bad and 2 <= k < n - 2:
                    m2, p2 = v[k - 1] - v[k - 2], v[k + 1] - v[k + 2]
                    bad = (abs(m1) > c and abs(p2) > c and np.sign(m1) == np.sign(p2)) or (abs(p1) > c and abs(m2) > c and np.sign(p1) == np.sign(m2))
                    bad = bad or (abs(m2) > 1.5 * c and abs(p2) > 1.5 * c and abs(m1) <= c and abs(p1) <= c and np.sign(m2) == np.sign(p2))
            if bad:
                gone = k
                break
        if gone is not None:
            x.pop(gone)
        if end or gone is None:
            return [i for i, _ in x]


def test_spikes_follow_the_rules():
    rng = np.random.default_rng(0)
    for n in range(2, 30):
        for _ in range(40):
            x = np.round(rng.normal(0, rng.choice([10, 40, 80]), n), 1)
            assert series._spikes(x, 40).tolist() == slow_spikes(x, 40), x
    assert series._spikes(np.array([0.0, 100, 0, 0]), 40).tolist() == [2, 3]
    assert series._spikes(np.array([0.0, 0, 0, 100]), 40).tolist() == [0, 1, 2]
    assert series._spikes(np.array([0.0, 100]), 40).tolist() == []


def test_next_tide_is_strictly_later(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    tide = spark.createDataFrame([("s", at(0), 1.0), ("s", at(15), 2.0), ("s", at(30), 3.0)], "site string, ts timestamp_ntz, tide double")
    obs = spark.createDataFrame([("s", at(15), 1), ("s", at(30), 2), ("s", at(-5), 3), ("other", at(0), 4)], "site string, ts timestamp_ntz, k int")
    got = {r.k: r.tide for r in tides.next_value(obs, tide, ["site"], "tide").collect()}
    assert got == {1: 3.0, 2: None, 3: 1.0, 4: None}


def test_clusters_and_dispersion(spark):
    p = spark.createDataFrame([("a", v) for v in (0.0, 20.0, 41.0)], "g string, v double")
    assert sorted((r.v, r.cluster) for r in series.gap_clusters(p, ["g"], "v").collect()) == [(0.0, 0), (20.0, 0), (41.0, 1)]
    s = spark.createDataFrame([(15.0, 1.0, 30.0, 0.0, 3), (15.0, 1.0, 30.0, 0.0, 2), (16.0, 1.0, 30.0, 0.0, 3)], "std double, median double, max double, min double, n long")
    assert [r.chainage for r in series.dispersion_check(s).collect()] == [1.0, None, None]


def test_moving_average_leaves_the_lower_end_out(spark):
    df = frame(spark, [1.0, 10.0, 100.0], [T0, T0 + 90 * DAY, T0 + 180 * DAY])
    assert [r.average for r in series.moving_average(df).orderBy("ts").collect()] == [5.5, 55.0, 100.0]
    assert [r.average for r in series.moving_average(df, least=2).orderBy("ts").collect()] == [5.5, 55.0, None]


def test_seasons_and_months(spark):
    one = frame(spark, [1.0], [dt.datetime(2019, 12, 5)])
    assert series.seasonal_average(one).count() == 0
    two = frame(spark, [1.0, 3.0], [dt.datetime(2019, 12, 5), dt.datetime(2020, 1, 10)])
    assert [(r.year, r.season, r.average) for r in series.seasonal_average(two).collect()] == [(2020, 1, 2.0)]
    for last, kept in ((dt.datetime(2020, 3, 20), True), (dt.datetime(2020, 3, 10), False)):
        months = {r.ts.month for r in series.monthly_average(frame(spark, [1.0, 2.0], [dt.datetime(2020, 2, 25), last])).collect()}
        assert (2 in months) == kept


def test_trend_needs_more_than_the_least(spark):
    assert series.trend(frame(spark, [float(i) for i in range(10)])).count() == 0
    r = series.trend(frame(spark, [float(i) for i in range(11)])).first()
    assert abs(r.trend - 365.2425) < 1e-6 and abs(r.unexplained_var) < 1e-9 and abs(r.intercept) < 1e-6
    r = series.trend(frame(spark, [0.0, 1.0]), least=1).first()
    assert r.trend_std == 0.0


def test_close_scenes(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    schema = "scene_id long, satname string, ts timestamp_ntz, n_points int, sl_length double"
    keep = lambda rows: sorted(r.scene_id for r in scenes.drop_close(spark.createDataFrame(rows, schema)).collect())
    assert keep([(1, "L8", at(0), 9, 5.0), (2, "S2", at(300), 9, 5.0)]) == [1]
    assert keep([(1, "L8", at(0), 9, 5.0), (2, "S2", at(301), 9, 5.0)]) == [1, 2]
    assert keep([(1, "L7", at(0), 9, 9.0), (2, "L9", at(60), 9, 5.0)]) == [2]
    assert keep([(1, "L8", at(0), 1, 9.0), (2, "S2", at(60), 9, 5.0)]) == [2]
    assert keep([(1, "L8", at(0), 1, 9.0), (2, "S2", at(60), 0, 5.0)]) == []


def test_correction_and_defaults(spark):
    df = spark.createDataFrame([(10.0, 0.5, None), (10.0, 0.5, 0.0), (10.0, 0.5, 0.25)], "x double, t double, s double")
    assert [r[0] for r in df.select(tides.correct(F.col("x"), F.col("t"), F.col("s"))).collect()] == [15.0, 15.0, 12.0]
    bad = spark.createDataFrame([(float("nan"), float("inf"))], "a double, b double")
    assert missing.nan_to_null(bad).first().a is None
    assert bad.select(missing.null_if_bad(F.col("b"))).first()[0] is None


def test_slope_grid_and_recovery(spark):
    g = slopes.slope_grid()
    assert len(g) == 80 and g[-1] == 0.4 and len(slopes.slope_grid(step=0.0025)) == 159
    rng = np.random.default_rng(1)
    days = np.sort(rng.uniform(0, 1500, 300))
    tide = np.cos(2 * np.pi * days / 20)
    rows = [(1, T0 + dt.timedelta(days=float(d)), float(20 - z / 0.1 + rng.normal(0, 1)), float(z)) for d, z in zip(days, tide, strict=True)]
    df = spark.createDataFrame(rows, "transect_id long, ts timestamp_ntz, chainage double, tide double")
    f0 = 1 / (20 * 86_400)
    band = spark.createDataFrame([(f0 + k * 1e-9, 1.0) for k in range(-5, 6)], "f double, weight double")
    best = slopes.best_slope(slopes.band_energy(df, band, g)).first()
    assert abs(best.slope - 0.1) <= 0.01 and best.ci_lo <= best.slope <= best.ci_hi and not best.is_default
    freqs = spark.createDataFrame([(f,) for f in slopes.frequency_grid(1500)[::7]], "f double")
    peak = slopes.tidal_peak(slopes.spectrum(df, ["transect_id"], "tide", freqs), ["transect_id"]).first()
    assert abs(1 / peak.f / 86_400 - 20) < 0.3


def test_otsu_parts_two_groups(spark):
    rng = np.random.default_rng(0)
    v = np.r_[rng.normal(-1, 0.1, 500), rng.normal(1, 0.1, 400)]
    df = spark.createDataFrame([(1, float(x)) for x in v], "g int, v double")
    assert -0.8 < thresholds.otsu(df, ["g"], "v").first().threshold < 0.8
    assert -0.8 < thresholds.local_minimum(df, ["g"], "v").first().threshold < 0.8
    assert thresholds.otsu(df.where("false"), ["g"], "v").count() == 0


def test_pareto_ties_stay(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (2, 2), (3, 3)], "a int, b int")
    assert sorted((r.a, r.b) for r in evaluate.pareto_front(df, ["a", "b"]).collect()) == [(1, 2), (2, 1), (2, 2)]


def test_geometry(spark):
    df = spark.createDataFrame([(-123.5, 48.0), (-60.0, 30.0)], "lon double, lat double")
    assert [tuple(r) for r in df.select(geometry.utm_zone(F.col("lon")), geometry.utm_epsg(F.col("lon"), F.col("lat"))).collect()] == [(10, 3157), (21, None)]
    p = spark.createDataFrame([(1.0, 3.0)], "x double, y double")
    c, o = geometry.in_frame(F.col("x"), F.col("y"), *(F.lit(float(v)) for v in (0, 0, 0, 10)))
    assert tuple(p.select(c, o).first()) == (3.0, -1.0)


def test_no_cross_join_in_spatial_plans(spark):
    t = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 10.0)], "transect_id long, x0 double, y0 double, x1 double, y1 double")
    p = spark.range(100).selectExpr("id AS scene_id", "CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    for df in (joins.transect_points(t, p), joins.near_segments(p, t, 5.0), joins.away_from(p, p, 3.0, ["scene_id"])):
        plan = df._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_selection_reasons(spark):
    rows = [(1, 1, 5.0, -1.0), (2, 1, 5.0, 1.0), (2, 1, 50.0, 1.0), (3, 1, 5.0, 1.0), (3, 1, 6.0, 1.0), (3, 1, 7.0, 1.0), (4, 1, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "scene_id long, transect_id long, chainage double, along_normal double")
    got = {r.scene_id: (r.chainage, r.rejection) for r in selection.positions(df).collect()}
    assert got == {1: (None, 1), 2: (None, 2), 3: (6.0, None), 4: (None, 3)}


def test_objects_and_contours(spark):
    px = [(1, r, c, (r, c) in {(0, 0), (2, 2), (2, 3), (3, 2)}) for r in range(5) for c in range(5)]
    df = spark.createDataFrame(px, "scene_id long, row int, col int, on boolean")
    kept = {(r.row, r.col) for r in raster.drop_small_objects(df, "on", 2).collect() if r.on}
    assert kept == {(2, 2), (2, 3), (3, 2)}
    hill = spark.createDataFrame([(1, r, c, float(-((r - 4) ** 2 + (c - 4) ** 2))) for r in range(9) for c in range(9)], "scene_id long, row int, col int, v double")
    line = raster.link_contours(raster.contour_segments(hill, "v", -6.5)).orderBy("pt_idx").collect()
    assert {r.contour_id for r in line} == {0} and (line[0].row, line[0].col) == (line[-1].row, line[-1].col)
    assert all(abs(((r.row - 4) ** 2 + (r.col - 4) ** 2) ** 0.5 - 6.5**0.5) < 0.2 for r in line)


@pytest.mark.parametrize("empty", [True, False])
def test_nearest_distance(spark, empty):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 0.0)], "k int, x double, y double")
    b = spark.createDataFrame([] if empty else [(3.0, 4.0), (-90.0, 0.0)], "x double, y double")
    got = {r.k: round(r.nearest, 6) for r in joins.nearest_distance(a, b, ["k"], 1.0).collect()}
    assert got == ({} if empty else {1: 5.0, 2: round((497**2 + 16) ** 0.5, 6)})


@pytest.mark.parametrize("m", [1, 2, 3])
def test_pareto_front_against_all_pairs(spark, m):
    """Random rows with ties and a front of many rows (on a falling line), whose places need many intervals."""
    rng = np.random.default_rng(m)
    x = np.r_[rng.integers(0, 40, (300, 3)), np.c_[np.arange(300) / 9, -np.arange(300) / 9, -np.arange(300) % 7]][:, :m].astype(float)
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(1000, *[None] * m), (1001, *[float("nan")] * m)]
    df = spark.createDataFrame(rows, ", ".join(["id int", *(f"m{k} double" for k in range(m))]))
    expected = {i for i, r in enumerate(x) if not (x < r).all(axis=1).any()} | {1000, 1001}
    got = [r.id for r in evaluate.pareto_front(df, [f"m{k}" for k in range(m)], probes=2).collect()]
    assert sorted(got) == sorted(expected)
    assert evaluate.pareto_front(df.where("id < 0"), [f"m{k}" for k in range(m)]).count() == 0


def test_not_contained_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    low = rng.integers(-20, 20, (200, 2)) * 0.5
    size = np.exp2(rng.integers(-3, 5, (200, 2)))
    size[::11] = 0
    boxes = [(i % 3, i, *map(float, (*a, *(a + s)))) for i, (a, s) in enumerate(zip(low, size, strict=True))]
    boxes += [(s, 500 + i, *b) for i, (s, _, *b) in enumerate(boxes[:20])] + [(0, 900, *[None] * 4), (None, 901, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(boxes, "site int, image_id int, x_min double, y_min double, x_max double, y_max double")
    df = df.selectExpr("site", "image_id", "CASE WHEN x_min IS NOT NULL THEN struct(x_min, y_min, x_max, y_max) END AS box", "'k' AS _level")
    inside = lambda o, i: o[2] <= i[2] and o[3] <= i[3] and o[4] >= i[4] and o[5] >= i[5]
    known = [b for b in boxes if b[0] is not None and b[2] is not None]
    held = lambda i: any(o[0] == i[0] and o[1] != i[1] and inside(o, i) and (not inside(i, o) or o[1] < i[1]) for o in known)
    out = outlines.not_contained(df, ["site"])
    assert out.columns == df.columns
    assert sorted(r.image_id for r in out.collect()) == sorted(b[1] for b in boxes if b[2] is None or b[0] is None or not held(b))


def test_one_zone_reads_sites_as_streams(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 40)), T0 + dt.timedelta(hours=float(rng.choice([rng.uniform(0, 900), 24.0 * rng.integers(0, 30)]))), int(rng.choice([1, 1, 2, 3]))) for i in range(1500)]
    rows += [(2000 + i, 50, T0 + dt.timedelta(hours=i), 7) for i in range(40)] + [(3000, 3, None, 2)]
    df = spark.createDataFrame(rows, "scene_id long, site long, ts timestamp_ntz, epsg int")
    out = scenes.one_zone(df, ["site"])
    # a group a site and pause costs more than its rows: sites are read in batches
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    gone, day = set(), dt.timedelta(hours=24)
    for site in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == site and r[2]), key=lambda r: (r[2], r[0]))
        codes = [r[3] for r in rows if r[1] == site]
        if len(set(codes)) == 1:
            continue
        main = min(set(codes), key=lambda c: (-codes.count(c), c))
        seed = None
        for r in own:
            if seed is None or r[2] >= seed + day:
                seed = r[2]
                near = [x for x in own if abs(x[2] - seed) < day]
                gone |= {x[0] for x in near if x[3] != main} | {x[0] for x in [x for x in near if x[3] == main][2:]}
    want = {r[0] for r in rows} - gone
    assert {r.scene_id for r in out.collect()} == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {r.scene_id for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
