"""A straight water line found in synthetic scenes; listings and names."""

import datetime as dt

from pyspark.sql import functions as F

from strandline.operators import shorelines
from strandline.operators.ml import SAND, WATER
from strandline.sources import listing


def test_extraction_finds_the_line(spark):
    rows = []
    for scene, edge in ((1, 7.5), (2, 9.5)):
        for r in range(20):
            for c in range(16):
                wet = 1 / (1 + 2.718281828 ** (-(c - edge) * 2))
                rows.append((scene, r, c, wet, scene == 2 and r == 19 and c == 9, True, WATER if c > edge else SAND))
    px = spark.createDataFrame(rows, "scene_id long, row int, col int, value double, cloud boolean, in_buffer boolean, label int")
    scenes = spark.createDataFrame([(k, 1000.0, 10.0, 0.0, 5000.0, 0.0, -10.0) for k in (1, 2)], "scene_id long, xtr double, xscale double, xshear double, ytr double, yshear double, yscale double")
    out = shorelines.extract(px, scenes, least_length=100.0, clear_of=25.0).collect()
    for scene, edge in ((1, 7.5), (2, 9.5)):
        xs = [r.x for r in out if r.scene_id == scene]
        assert xs and all(abs(x - (1000 + 10 * edge)) < 10 for x in xs)
    assert len({r.y for r in out if r.scene_id == 1}) == 20
    # the cloud's surroundings are left out
    assert min(r.y for r in out if r.scene_id == 2) > 5000 - 10 * 17.5
    assert all(abs(abs(r.nx) - 1) < 0.05 for r in out if r.scene_id == 1)


def test_listing(spark):
    features = [("a", [("B1", "EPSG:32610")], {"system:time_start": "997467313000", "CLOUD_COVER": "12.5", "WRS_PATH": "12", "WRS_ROW": "34", "GEOMETRIC_RMSE_MODEL": "7.2"}), ("b", [], {"system:time_start": "997467313500", "CLOUDY_PIXEL_PERCENTAGE": "1", "MGRS_TILE": "10SEG", "GEOMETRIC_QUALITY_FLAG": "PASSED"}), ("c", None, {})]
    df = listing.flatten(spark.createDataFrame(features, listing.FEATURES))
    a, b, c = df.orderBy("image_id").collect()
    assert (a.ts, a.cloud_cover, a.epsg, a.tile, a.acc_georef_m) == (dt.datetime(2001, 8, 10, 18, 15, 13), 12.5, 32610, "012034", 7.2)
    assert (b.tile, b.acc_georef_flag, b.epsg) == ("10SEG", "PASSED", None) and c.acc_georef_m == 12
    named = listing.file_names(df.where("ts IS NOT NULL").withColumn("satname", F.lit("L7")).withColumn("tile", F.lit("T")), "site").orderBy("image_id").collect()
    assert [r.filename for r in named] == ["2001-08-10-18-15-13_L7_T_site_ms.tif", "2001-08-10-18-15-13_L7_T_site_ms_dup1.tif"]
    assert listing.in_period(df, "2001-01-01", "2001-08-10").count() == 0
