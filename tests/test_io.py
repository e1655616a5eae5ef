"""Sources, sinks, streams and the site pipeline, from files to trends."""

import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import streaming
from strandline.plans import site
from strandline.sources import tables, vector


def test_kml_and_geojson(spark, tmp_path):
    kml = tmp_path / "a.kml"
    kml.write_text("<kml>\n<coordinates>\n\t1,2,0 3,4\n5.5,-6 1,2\n</coordinates><coordinates>9,9</coordinates></kml>")
    ring = vector.read_kml(spark, str(kml)).first().ring
    assert [(p.x, p.y) for p in ring] == [(1, 2), (3, 4), (5.5, -6), (1, 2)]
    both = vector.read_kml(spark, str(kml), every=True).first().ring
    assert len(both) == 6 and (both[0].x, both[-1].x) == (1, 1)
    bad = tmp_path / "bad.kml"
    bad.write_text("<coordinates>1,2 3,4 5,6</coordinates>")
    with pytest.raises(Exception, match="four points"):
        vector.read_kml(spark, str(bad)).collect()
    line = {"type": "LineString", "coordinates": [[0, 0], [1, 1], [0, 10]]}
    many = {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[5, 5], [6, 6], [7, 7]]]}
    poly = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    geo = tmp_path / "t.geojson"
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": n}, "geometry": g} for n, g in (("A", line), ("B", line), ("A", {"type": "LineString", "coordinates": [[9, 9], [8, 8]]}), ("M", many), ("P", poly))]}))
    got = {r.transect_id: (r.x0, r.y0, r.x1, r.y1) for r in vector.read_transects(spark, str(geo)).collect()}
    assert got == {"A": (9, 9, 8, 8), "B": (0, 0, 0, 10)}
    assert vector.read_lines(spark, str(geo)).count() == 5
    assert vector.segments(vector.read_lines(spark, str(geo))).count() == 2 + 2 + 1 + 1 + 2


def test_metadata_tides_and_settings(spark, tmp_path):
    m = tmp_path / "2001-08-10-18-15-13_L7_tile_site_ms.txt"
    m.write_text("filename\t2001-08-10-18-15-13_L7_012034_site_ms.tif\nepsg\t32610\nacc_georef\t7.2\nim_quality\t9\nim_width\t10\n")
    r = tables.read_metadata(spark, str(m)).first()
    assert (r.satname, r.ts, r.tile, r.epsg, r.acc_georef_m, r.acc_georef_flag) == ("L7", dt.datetime(2001, 8, 10, 18, 15, 13), "NA", 32610, 7.2, None)
    t = tmp_path / "tides.csv"
    t.write_text("dates,tide\n2020-01-01,0.0\n2020-01-02 00:00:00,1.0\n2020-01-03T00:00:00+00:00,2.5\n")
    assert [(x.ts.day, x.tide) for x in tables.read_tides(spark, str(t)).orderBy("ts").collect()] == [(1, 0.0), (2, 1.0), (3, 2.5)]
    bad = tmp_path / "bad.csv"
    bad.write_text("when,tide\n")
    with pytest.raises(ValueError, match="dates"):
        tables.read_tides(spark, str(bad))
    s = tmp_path / "settings.json"
    s.write_text(json.dumps({"inputs": {"sitename": "here", "tide_csv_path": "tides.csv"}, "output_epsg": 4326, "tide_filter": [10, 90]}))
    got = tables.read_settings(str(s))
    assert got.tide_csv_path == str(t) and got.tide_mode == "csv" and got.upper_percentile == 90
    with pytest.raises(ValueError):
        tables.tide_filter([95, 5])


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id AS scene_id", "user_id AS transect_id", "CAST(ts AS TIMESTAMP) AS ts", "value AS chainage")
    path = str(tmp_path / "in")
    events.unionByName(events.limit(50)).coalesce(1).write.parquet(path)
    source = spark.readStream.schema(events.schema).parquet(path)

    def drain(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name)

    assert drain(streaming.distinct_scenes(source), "distinct_rows").count() == events.count()
    steps = drain(streaming.steps(spark.readStream.schema(events.schema).parquet(path)), "step_rows")
    assert steps.where("step IS NULL").count() == events.select("transect_id").distinct().count()
    assert drain(streaming.windowed(source, "5 days", delay="1 day"), "window_rows").count() > 0


def test_site_pipeline_finds_the_trend(spark, tmp_path):
    start, rows, points = dt.datetime(2015, 1, 1), [], []
    tide_rows = [("x", start + dt.timedelta(hours=3 * k), math.cos(k / 4.1)) for k in range(8 * 365 * 5 + 40)]
    for k in range(90):
        ts = start + dt.timedelta(days=20 * k, hours=1)
        nxt = next(v for _, t, v in tide_rows if t > ts)
        x = 50 + 3 * (20 * k / 365.2425) - nxt / 0.1
        rows.append((k, "L8", ts, 0.1, "PASSED", None, -0.2, 5, 900.0))
        points += [(k, x + d / 10, float(d)) for d in (-2, -1, 0, 1, 2)]
    frames = {
        "scenes": spark.createDataFrame(rows, "scene_id long, satname string, ts timestamp_ntz, cloud_cover double, acc_georef_flag string, acc_georef_m double, threshold double, n_points int, sl_length double"),
        "points": spark.createDataFrame(points, "scene_id long, x double, y double").withColumns({"nx": F.lit(1.0), "ny": F.lit(0.0)}),
        "transects": spark.createDataFrame([("T1", 0.0, 0.0, 200.0, 0.0)], "transect_id string, x0 double, y0 double, x1 double, y1 double"),
        "tides": spark.createDataFrame(tide_rows, "site string, ts timestamp_ntz, tide double"),
    }
    settings = tables.Settings("here", 4326)
    out = site.run(spark, frames, settings, str(tmp_path / "run"))
    r = out["trends"].first()
    assert abs(r.trend - 3) < 0.2 and r.total_images == 90 and 0 < r.tide_filter_removed_pct < 30
    again = site.run(spark, frames, settings, str(tmp_path / "run"), first="summarise")
    assert abs(again["trends"].first().trend - r.trend) < 1e-9
    with pytest.raises(ValueError):
        site.run(spark, frames, settings, str(tmp_path / "run"), first="nowhere")


def test_site_pipeline_finds_two_slopes(spark, tmp_path):
    """Positions that the tide moves by 1 / slope: the search finds both slopes, and the corrected series don't follow the tide."""
    start, rng = dt.datetime(2021, 1, 1), np.random.default_rng(8)
    tide = lambda hours: 0.9 * np.cos(2 * np.pi * hours / 12.4206) + 0.3 * np.cos(2 * np.pi * hours / 12 + 1)
    tide_rows = [("x", start + dt.timedelta(hours=h / 2), float(tide(h / 2))) for h in range(2 * 24 * 1370)]
    true, scenes, points = {1: 0.05, 2: 0.12}, [], []
    for k in range(170):
        hours = k * 8 * 24 + 10.0 + 0.5 * int(rng.integers(0, 2))
        ts = start + dt.timedelta(hours=hours)
        scenes.append((k, "L8", ts - dt.timedelta(minutes=1), 0.0, "PASSED", None, -0.2, 5, 900.0))
        for t, slope in true.items():
            x = 150 - float(tide(hours)) / slope + float(rng.normal(0, 1))
            points += [(k, x + d / 10, 1000.0 * t + d) for d in (-2, -1, 0, 1, 2)]
    transects = [(t, 0.0, 1000.0 * t, 400.0, 1000.0 * t) for t in true]
    frames = {
        "scenes": spark.createDataFrame(scenes, "scene_id long, satname string, ts timestamp_ntz, cloud_cover double, acc_georef_flag string, acc_georef_m double, threshold double, n_points int, sl_length double"),
        "points": spark.createDataFrame(points, "scene_id long, x double, y double").withColumns({"nx": F.lit(1.0), "ny": F.lit(0.0)}),
        "transects": spark.createDataFrame(transects, "transect_id long, x0 double, y0 double, x1 double, y1 double"),
        "tides": spark.createDataFrame(tide_rows, "site string, ts timestamp_ntz, tide double"),
    }
    settings = tables.Settings(sitename="x", output_epsg=32610, extra={"slope_search": True})
    out = site.run(spark, frames, settings, str(tmp_path / "run"))
    found = {r.transect_id: r for r in out["slopes"].collect()}
    for t, slope in true.items():
        assert abs(found[t].slope - slope) <= 0.1 * slope + 0.005 and found[t].ci_lo <= found[t].slope <= found[t].ci_hi and not found[t].is_default
    spread = {r.transect_id: r.s for r in out["corrected"].groupBy("transect_id").agg(F.stddev("corrected").alias("s")).collect()}
    assert all(s < 3 for s in spread.values())
    assert {r.transect_id: (r.ci_lo, r.ci_hi) for r in out["trends"].collect()} == {t: (r.ci_lo, r.ci_hi) for t, r in found.items()}
    table = tables.Settings(sitename="x", output_epsg=32610, tide_csv_path="t.csv", beach_slope=0.07)
    plain = site.estimate_slopes(frames, table)["slopes"].collect()
    assert {(r.transect_id, r.slope, r.is_default) for r in plain} == {(1, 0.07, True), (2, 0.07, True)}
