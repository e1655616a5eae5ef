"""Projection round trips and published values; transects along lines."""

import pytest
from pyspark.sql import functions as F

from strandline.functions import projection
from strandline.operators import transects


def test_utm_round_trip_below_a_millimetre(spark):
    df = spark.createDataFrame([(-123.5 + k * 0.37, 40.0 + k * 2.1, 10) for k in range(12)], "lon double, lat double, zone int")
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), F.col("zone"))
    there = df.withColumns({"x": x, "y": y})
    lon, lat = projection.from_utm(F.col("x"), F.col("y"), F.col("zone"))
    for r in there.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r.lon - r.lon2) < 1e-9 and abs(r.lat - r.lat2) < 1e-9


def test_utm_on_the_central_meridian(spark):
    df = spark.createDataFrame([(-123.0, 0.0), (-123.0, 45.0)], "lon double, lat double")
    rows = df.select(*projection.to_utm(F.col("lon"), F.col("lat"), F.lit(10))).collect()
    assert tuple(rows[0]) == pytest.approx((500_000, 0), abs=1e-6)
    # the meridian arc of GRS80 to 45 degrees is 4 984 944.378 m
    assert rows[1][0] == pytest.approx(500_000, abs=1e-6) and rows[1][1] == pytest.approx(0.9996 * 4_984_944.378, abs=2e-3)


def test_stations_normals_and_casting(spark):
    v = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 250.0, 0.0), (1, 2, 400.0, 0.0), (2, 0, 0.0, 900.0), (2, 1, 10.0, 900.0)], "line_id long, pt_idx int, x double, y double")
    p = transects.stations(v, 100.0, least=50)
    assert sorted((r.line_id, r.at, r.x, r.y) for r in p.collect()) == [(1, 100.0 * k, 100.0 * k, 0.0) for k in range(5)]
    n = transects.normals(p)
    assert {(round(r.nx, 9), round(r.ny, 9)) for r in n.collect()} == {(0.0, 1.0)}
    line = spark.createDataFrame([(0.0, 0.0, 250.0, 0.0), (250.0, 0.0, 400.0, 0.0), (90.0, 80.0, 110.0, 80.0), (190.0, -30.0, 210.0, -30.0)], "x0 double, y0 double, x1 double, y1 double")
    t = {r.transect_id: (r.x0, r.y0, r.x1, r.y1) for r in transects.cast(n, line, 200.0).collect()}
    assert t == {"transect_001": (0, 200, 0, -200), "transect_002": (100, 40, 100, -40), "transect_003": (300, 200, 300, -200), "transect_004": (400, 200, 400, -200)}


def test_best_tide_place(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 1.0, 3, 4, 4, 4), ("a", 1, 2.0, 2.0, 4, 4, 4, 4), ("a", 2, 3.0, 3.0, 4, 4, 4, 4), ("b", 0, 1.0, 1.0, 0, 4, 4, 4)], "site string, place int, x double, y double, f1 int, f2 int, f3 int, f4 int")
    assert [(r.site, r.place) for r in transects.best_tide_place(df).collect()] == [("a", 1)]
