"""Choices, counts and scores around a transect's series: labels, clusters, errors, windows, lines."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import spectral as sp
from ..operators import evaluate as ev
from ..operators import joins, scenes, series, shorelines, slopes
from ..operators import selection as sel
from ..operators import tides as td
from .frames import LONG, OBS, PIXELS, POINTS, TIDES, TRANSECTS, at_site, long_series, observations, pixels, points, rounded, tides, transects
from .rasters import TILES, tiles
from .space import _JOIN
from .tides import _MATCH

PAIR = sel.PAIR


def chainages(spark, d):
    out = joins.transect_chainages(transects(spark, d), points(spark, d), PAIR, along=15, past=40, least=5)
    return rounded(out.select("transect_id", "pt_id", "chainage", "offset"), "chainage", "offset")


CHAINAGES = f"""WITH p AS (SELECT * FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40)
SELECT transect_id, pt_id, round(CASE WHEN chainage >= 5 THEN chainage END, 6) + 0.0::DOUBLE AS chainage, round(off, 6) + 0.0::DOUBLE AS "offset"
FROM p WHERE (scene_id, transect_id) IN (SELECT (scene_id, transect_id) FROM p WHERE chainage >= 5)"""


def _means(spark, d):
    """Ascending means of each pair's gap clusters."""
    p = joins.transect_points(transects(spark, d), points(spark, d), along=15, past=40, least=-20)
    means = series.gap_clusters(p, PAIR, "chainage", 8).groupBy(*PAIR, "cluster").agg(F.avg("chainage").alias("mean"))
    return means.groupBy(*PAIR).agg(F.sort_array(F.collect_list("mean")).alias("means"))


_MEANS = f"""(SELECT scene_id, transect_id, list(m ORDER BY m) AS means FROM (
  SELECT scene_id, transect_id, c, avg(chainage) AS m FROM (
    SELECT *, sum(CASE WHEN gap > 8 THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id, transect_id ORDER BY chainage) AS c FROM (
      SELECT *, chainage - lag(chainage) OVER (PARTITION BY scene_id, transect_id ORDER BY chainage) AS gap
      FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40 AND chainage >= -20)) GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


def label_choice(spark, d):
    k = F.col("transect_id") + F.col("scene_id")
    chosen = sel.label_choice(F.col("means"), [k % 3 - 1, k % 2, F.lit(1)], F.lit(60.0), far=6)
    return _means(spark, d).select(*PAIR, chosen.alias("c")).select(*PAIR, "c.place", F.col("c.at").alias("at_chainage"))


LABEL = f"""SELECT scene_id, transect_id, p::INTEGER AS place, CASE p WHEN 1 THEN 30.0::DOUBLE WHEN 2 THEN 60.0::DOUBLE ELSE 0.0::DOUBLE END AS at_chainage FROM (
  SELECT *, CASE WHEN (transect_id + scene_id) % 3 - 1 <> -1 AND len(list_filter(means, lambda m: abs(m) <= 6)) = 0 THEN 0
    WHEN len(list_filter(means, lambda m: abs(30 - m) <= 6)) = 0 THEN 1 WHEN len(list_filter(means, lambda m: abs(60 - m) <= 6)) = 0 THEN 2 ELSE -1 END AS p FROM {_MEANS})"""


def cluster_choice(spark, d):
    p = _means(spark, d).withColumns({"means": F.transform("means", lambda m: m - 15), "water": (F.col("transect_id") + F.col("scene_id")) % 2 == 1})
    m, water = F.col("means"), F.col("water")
    chosen = F.when(F.size(m) == 1, F.when(sel.cluster_agrees(F.get(m, 0), water), 0).otherwise(-1)).when(F.size(m) == 2, sel.cluster_of_two(m, water)).when(F.size(m) == 3, sel.cluster_of_three(m, water))
    return p.select(*PAIR, F.size(m).cast("long").alias("n_clusters"), chosen.cast("int").alias("chosen"))


CLUSTER = f"""SELECT scene_id, transect_id, len(m)::BIGINT AS n_clusters, (CASE len(m)
    WHEN 1 THEN CASE WHEN w AND m[1] < 0 OR NOT w AND m[1] > 0 THEN 0 ELSE -1 END
    WHEN 2 THEN xor(w::INTEGER, xor((m[1] > 0)::INTEGER, (m[2] > 0)::INTEGER))
    WHEN 3 THEN CASE WHEN m[2] > 0 THEN xor(w::INTEGER, xor((m[1] > 0)::INTEGER, 1)) ELSE 1 + xor(w::INTEGER, (m[3] > 0)::INTEGER) END END)::INTEGER AS chosen
FROM (SELECT scene_id, transect_id, list_transform(means, lambda v: v - 15) AS m, (transect_id + scene_id) % 2 = 1 AS w FROM {_MEANS})"""


def coverage_records(spark, d):
    obs = observations(spark, d)
    corrected = obs.select("transect_id", F.when(F.col("quality") % 4 != 0, F.col("chainage")).alias("corrected"))
    places = transects(spark, d).select("transect_id").unionByName(obs.select("transect_id")).distinct()
    found = obs.where("quality > 50").groupBy("transect_id").agg(F.min(F.col("quality") / 500).alias("slope"))
    out = ev.coverage_records(corrected, series.trend(obs), found, places, obs)
    return rounded(out, "trend", "slope", "coverage_pct", "data_gap_pct", digits=3)


RECORDS = f"""WITH n AS (SELECT transect_id, count(*) AS n, count(CASE WHEN quality % 4 <> 0 THEN chainage END) AS used FROM {OBS} GROUP BY 1),
t AS (
  SELECT transect_id, regr_slope(chainage, x) AS trend FROM (
    SELECT transect_id, chainage, date_diff('day', min(ts) OVER (PARTITION BY transect_id), ts) / 365.2425::DOUBLE AS x FROM {OBS}) GROUP BY 1 HAVING count(*) > 10),
s AS (SELECT transect_id, min(quality / 500.0::DOUBLE) AS slope FROM {OBS} WHERE quality > 50 GROUP BY 1)
SELECT transect_id, round(trend, 3) + 0.0::DOUBLE AS trend, round(coalesce(slope, 0.1::DOUBLE), 3) AS slope, (SELECT count(*) FROM {OBS}) AS images_total, coalesce(used, 0) AS images_used,
  round(100.0::DOUBLE * used / n, 3) AS coverage_pct, round(100 - 100.0::DOUBLE * used / n, 3) + 0.0::DOUBLE AS data_gap_pct
FROM (SELECT transect_id FROM {TRANSECTS} UNION SELECT transect_id FROM {OBS}) LEFT JOIN n USING (transect_id) LEFT JOIN t USING (transect_id) LEFT JOIN s USING (transect_id)"""


def satellite_errors(spark, d):
    return rounded(ev.satellite_errors(observations(spark, d), "chainage", "quality"), "q25", "median", "q75", "low", "high")


ERRORS = f"""WITH e AS (SELECT satname, chainage - quality AS e FROM {OBS} WHERE chainage IS NOT NULL AND quality IS NOT NULL),
b AS (SELECT satname, quantile_cont(e, 0.25) AS q1, median(e) AS m, quantile_cont(e, 0.75) AS q3, count(*) AS n FROM e GROUP BY 1)
SELECT satname, round(q1, 6) + 0.0::DOUBLE AS q25, round(m, 6) + 0.0::DOUBLE AS median, round(q3, 6) + 0.0::DOUBLE AS q75, n, round(min(e), 6) + 0.0::DOUBLE AS low, round(max(e), 6) + 0.0::DOUBLE AS high
FROM e JOIN b USING (satname) WHERE e BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY satname, q1, m, q3, n"""


def median_distances(spark, d):
    """The points of even scenes against those of odd ones."""
    p = joins.transect_points(transects(spark, d), points(spark, d), along=15, past=40, least=-20)
    out = ev.median_distances(transects(spark, d), p.where("scene_id % 2 = 0"), p.where("scene_id % 2 = 1"), ["transect_id"])
    return rounded(out, "distance")


DISTANCES = f"""SELECT transect_id, round(median(chainage) FILTER (scene_id % 2 = 0) - median(chainage) FILTER (scene_id % 2 = 1), 6) + 0.0::DOUBLE AS distance
FROM {TRANSECTS} LEFT JOIN (SELECT transect_id, scene_id, chainage FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40 AND chainage >= -20) USING (transect_id) GROUP BY 1"""


def extraction_counts(spark, d):
    s = observations(spark, d).select("satname", (F.col("quality") * 1.0).alias("cloud_cover"), F.col("chainage").alias("empty_share"), (F.col("scene_id") % 11 == 0).alias("failed"), F.when(F.col("scene_id") % 3 != 0, F.col("scene_id") % 7 != 0).alias("accepted"))
    return scenes.extraction_counts(s, 60, 30)


COUNTS = f"""SELECT satname, count(*) AS total, count(*) FILTER (w = 'kept') AS kept, count(*) FILTER (w = 'cloud') AS cloud, count(*) FILTER (w = 'empty') AS empty, count(*) FILTER (w = 'error') AS error, count(*) FILTER (w = 'user') AS "user"
FROM (SELECT satname, CASE WHEN quality IS NULL OR chainage IS NULL OR scene_id % 11 = 0 THEN 'error' WHEN quality > 60 THEN 'cloud' WHEN chainage > 30 THEN 'empty' WHEN scene_id % 3 <> 0 AND scene_id % 7 = 0 THEN 'user' ELSE 'kept' END AS w FROM {OBS})
GROUP BY 1"""


def _labelled(spark, d):
    label = F.when(F.col("value") > 0.1, 1).when(F.col("value") < -0.05, 3).otherwise(0)
    return tiles(spark, d).withColumns({"label": label, "in_buffer": F.col("col").between(1, 6)})


_LABELLED = f"(SELECT *, CASE WHEN value > 0.1 THEN 1 WHEN value < -0.05 THEN 3 ELSE 0 END AS label, col BETWEEN 1 AND 6 AS in_buffer FROM {TILES})"


def class_counts(spark, d):
    """Labelled pixels of two sites (even and odd tiles) together."""
    p = _labelled(spark, d)
    training = shorelines.training_pixels([p.where("scene_id % 2 = 0"), p.where("scene_id % 2 = 1")])
    return rounded(shorelines.class_counts(training), "share")


CLASSES = f"SELECT label, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM {TILES}), 6) AS share FROM {_LABELLED} GROUP BY 1"


def sand_gate(spark, d):
    return shorelines.sand_gate(_labelled(spark, d), 11)


GATE = f"SELECT scene_id, count(*) FILTER (label = 1) AS n_sand, count(*) FILTER (label = 3) AS n_water, count(*) FILTER (label = 1) >= 11 AS by_class FROM (SELECT scene_id, CASE WHEN in_buffer THEN label END AS label FROM {_LABELLED}) GROUP BY 1"


def symmetric_ranges(spark, d):
    s = long_series(spark, d).withColumn("chainage", F.col("chainage") - 20_000)
    plain = series.symmetric_range(s, "chainage", ["transect_id"])
    middle = series.symmetric_range(s, "chainage", ["transect_id"], centred=True)
    return rounded(plain.join(middle.select("transect_id", F.col("high").alias("centred_high")), "transect_id"), "low", "high", "centred_high", digits=4)


RANGES = f"""WITH s AS (SELECT transect_id, chainage - 20000 AS v, chainage - median(chainage) OVER (PARTITION BY transect_id) AS c FROM {LONG})
SELECT transect_id, round(-max(abs(v)), 4) + 0.0::DOUBLE AS low, round(max(abs(v)), 4) AS high, round(max(abs(c)), 4) AS centred_high FROM s GROUP BY 1"""


def plain_correction(spark, d):
    """The correction that keeps the tide table's own level."""
    out = td.correct_series(at_site(spark, d), tides(spark, d), centre=False)
    return rounded(out.select("scene_id", "in_range", "corrected"), "corrected")


PLAIN = f"""WITH b AS (SELECT quantile_cont(tide, 0.05) AS lo, quantile_cont(tide, 0.95) AS hi FROM {TIDES})
SELECT scene_id, tide BETWEEN lo AND hi AS in_range, round(CASE WHEN tide BETWEEN lo AND hi THEN chainage + tide / 0.1::DOUBLE END, 6) AS corrected FROM ({_MATCH}), b"""


def slope_curves(spark, d):
    """Mean and spread of each transect's series under each slope of a grid."""
    matched = td.next_value(at_site(spark, d), tides(spark, d), ["site"], "tide").where("tide IS NOT NULL")
    each = td.correct_over(matched, slopes.slope_grid(0.02, 0.2, 0.02))
    out = each.groupBy("transect_id", "slope").agg(F.avg("corrected").alias("mean"), F.max("corrected").alias("largest"), F.count("*").alias("n"))
    return rounded(out, "mean", "largest")


CURVES = f"""SELECT transect_id, slope, round(avg(chainage + tide / slope), 6) + 0.0::DOUBLE AS mean, round(max(chainage + tide / slope), 6) + 0.0::DOUBLE AS largest, count(*) AS n
FROM ({_MATCH}), (SELECT round(i * 0.02::DOUBLE, 2) AS slope FROM range(1, 11) r(i)) WHERE tide IS NOT NULL GROUP BY 1, 2"""


def standardized(spark, d):
    bands = pixels(spark, d).withColumn("value", sp.indices()["ndwi"])
    return rounded(sp.standardize(bands, "value", ["scene_id"], -1, 1).select("pixel_id", "value"), "value")


STANDARD = f"""WITH v AS (SELECT pixel_id, scene_id, (g - nir) / (g + nir) AS v FROM {PIXELS}), w AS (SELECT *, min(v) OVER (PARTITION BY scene_id) AS lo, max(v) OVER (PARTITION BY scene_id) AS hi FROM v)
SELECT pixel_id, round(-1 + 2 * (v - lo) / nullif(hi - lo, 0), 6) + 0.0::DOUBLE AS value FROM w"""

_GEO = {"xtr": -30.0, "xscale": 0.5, "xshear": 0.125, "ytr": 30.0, "yshear": -0.25, "yscale": -0.5}


def windows(spark, d):
    """Each point in pixels (column first), and the window of 8 pixels around it in an image of 120 x 100."""
    g = {k: F.lit(v) for k, v in _GEO.items()}
    col, row = geo.world_to_pixel(F.col("x"), F.col("y"), g, swap=False)
    w = geo.window_bounds(F.col("at_col"), F.col("at_row"), 8, F.lit(120), F.lit(100))
    out = points(spark, d).select("pt_id", col.alias("at_col"), row.alias("at_row")).withColumn("w", w)
    return rounded(out.select("pt_id", "at_col", "at_row", "w.*"), "at_col", "at_row")


_DET = _GEO["xscale"] * _GEO["yscale"] - _GEO["xshear"] * _GEO["yshear"]
WINDOWS = f"""SELECT pt_id, round(c, 6) + 0.0::DOUBLE AS at_col, round(r, 6) + 0.0::DOUBLE AS at_row,
  greatest(round_even(r - 8, 0)::INTEGER, 0) AS row_min, least(round_even(r + 8, 0)::INTEGER, 100) AS row_max, greatest(round_even(c - 8, 0)::INTEGER, 0) AS col_min, least(round_even(c + 8, 0)::INTEGER, 120) AS col_max
FROM (SELECT pt_id, (-0.5::DOUBLE * (x + 30) - 0.125::DOUBLE * (y - 30)) / {_DET}::DOUBLE AS c, (0.5::DOUBLE * (y - 30) + 0.25::DOUBLE * (x + 30)) / {_DET}::DOUBLE AS r FROM {POINTS})"""


def colliders(spark, d):
    """Points inside each transect's rectangle of a buffer of 6, and those inside the upright box alone."""
    t = F.broadcast(transects(spark, d))  # a row a nation
    ends = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    box = geo.axis_box(*ends, 6.0)
    boxed = (F.col("x") > box["x_min"]) & (F.col("x") < box["x_max"]) & (F.col("y") > box["y_min"]) & (F.col("y") < box["y_max"])
    met = points(spark, d).join(t, boxed)
    inside = geo.inside_convex(F.col("x"), F.col("y"), geo.collider(*ends, 6.0, 6.0, 6.0))
    return met.withColumn("_in", inside).groupBy("transect_id").agg(F.count("*").alias("in_box"), F.count(F.when(F.col("_in"), 1)).alias("in_collider"))


COLLIDERS = f"""SELECT transect_id, count(*) AS in_box, count(*) FILTER (abs(off) < 6 AND chainage > -6 AND chainage < len + 6) AS in_collider
FROM ({_JOIN}) JOIN (SELECT pt_id, x, y FROM {POINTS}) USING (pt_id) JOIN {TRANSECTS} USING (transect_id)
WHERE x > least(x0, x1) - 6 AND x < greatest(x0, x1) + 6 AND y > least(y0, y1) - 6 AND y < greatest(y0, y1) + 6 GROUP BY 1"""


def transect_places(spark, d):
    """Each observation's place on its transect (by number)."""
    x, y = geo.on_transect(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), F.col("chainage"))
    obs = observations(spark, d).withColumn("transect_id", F.col("transect_id") % 25)
    return rounded(obs.join(F.broadcast(transects(spark, d)), "transect_id").select("scene_id", x.alias("x"), y.alias("y")), "x", "y")


PLACES = f"""SELECT o.scene_id, round(x0 + chainage * (x1 - x0) / len, 6) + 0.0::DOUBLE AS x, round(y0 + chainage * (y1 - y0) / len, 6) + 0.0::DOUBLE AS y
FROM {OBS} o JOIN (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS len FROM {TRANSECTS}) t ON t.transect_id = o.transect_id % 25"""


def line_crossings(spark, d):
    """Where the line through a point and the next one of its scene meets y = x / 2 + 1, and its height in the middle."""
    w = W.partitionBy("scene_id").orderBy("pt_id")
    p = points(spark, d).withColumns({"x1": F.lead("x").over(w), "y1": F.lead("y").over(w)}).where("x1 IS NOT NULL")
    ends = [F.col(c) for c in ("x", "y", "x1", "y1")]
    x, y = geo.line_crossing(geo.slope_intercept(*ends), (F.lit(0.5), F.lit(1.0)))
    left = geo.lerp(*ends, (F.col("x") + F.col("x1")) / 2)
    return rounded(p.select("pt_id", x.alias("x"), y.alias("y"), left.alias("middle")), "x", "y", "middle", digits=4)


CROSSINGS = f"""SELECT pt_id, round((1 - (y - x * s)) / (s - 0.5), 4) + 0.0::DOUBLE AS x, round(s * (1 - (y - x * s)) / (s - 0.5) + y - x * s, 4) + 0.0::DOUBLE AS y, round(CASE WHEN x <= x1 THEN (y + y1) / 2 END, 4) + 0.0::DOUBLE AS middle
FROM (SELECT *, (y1 - y) / (x1 - x) AS s FROM (SELECT *, lead(x) OVER (PARTITION BY scene_id ORDER BY pt_id) AS x1, lead(y) OVER (PARTITION BY scene_id ORDER BY pt_id) AS y1 FROM {POINTS}) WHERE x1 IS NOT NULL)"""


def linear_fit(spark, d):
    return rounded(ev.linear_fit(observations(spark, d), ["transect_id", "satname"], "quality", "chainage"), "slope", "intercept", "r2", "slope_std")


FIT = f"""SELECT transect_id, satname, n, round(s, 6) + 0.0::DOUBLE AS slope, round(i, 6) + 0.0::DOUBLE AS intercept, round(r, 6) + 0.0::DOUBLE AS r2, round(sqrt((1 - r) * yy / nullif(xx * (n - 2), 0)), 6) AS slope_std
FROM (SELECT transect_id, satname, count(chainage + quality) AS n, regr_slope(chainage, quality) AS s, regr_intercept(chainage, quality) AS i, regr_r2(chainage, quality) AS r, regr_sxx(chainage, quality) AS xx, regr_syy(chainage, quality) AS yy
FROM {OBS} GROUP BY 1, 2) WHERE n >= 3"""


def whole_vertices(spark, d):
    """Points as vertices of 40 lines a scene; those far to the west have no x (NULL or NaN)."""
    x = F.when(F.col("x") > -15, F.col("x")).when(F.col("x") < -16, float("nan"))
    p = points(spark, d).select("scene_id", (F.col("pt_id") % 40).alias("contour_id"), F.col("pt_id").alias("pt_idx"), x.alias("x"), "y")
    return rounded(sel.whole_vertices(p), "x", "y")


VERTICES = f"""SELECT scene_id, contour_id, pt_idx, round(x, 6) + 0.0::DOUBLE AS x, round(y, 6) + 0.0::DOUBLE AS y FROM (
  SELECT scene_id, pt_id % 40 AS contour_id, pt_id AS pt_idx, x, y, count(*) FILTER (x > -15) OVER c AS good, count(*) FILTER (NOT x > -15) OVER c AS bad FROM {POINTS} WINDOW c AS (PARTITION BY scene_id, pt_id % 40))
WHERE x > -15 AND (bad = 0 OR good >= 2)"""


def august(spark, d):
    return long_series(spark, d).where(scenes.in_months(F.col("ts"), [8])).groupBy("transect_id").agg(F.count("*").alias("n"))


AUGUST = f"SELECT transect_id, count(*) AS n FROM {LONG} WHERE month(ts) = 8 GROUP BY 1"

QUERIES = {
    "j1b_chainages": chainages, "l4_label_choice": label_choice, "l5_cluster_choice": cluster_choice, "a10_coverage_records": coverage_records, "a12_satellite_errors": satellite_errors,
    "a15_median_distances": median_distances, "a19_extraction_counts": extraction_counts, "a21_u2_class_counts": class_counts, "a27_sand_gate": sand_gate, "a26_symmetric_ranges": symmetric_ranges,
    "t7_plain_correction": plain_correction, "t10_slope_curves": slope_curves, "i17_standardized": standardized, "g3_g24_windows": windows, "g19_colliders": colliders,
    "g21_transect_places": transect_places, "g29_line_crossings": line_crossings, "m9_linear_fit": linear_fit, "f24_whole_vertices": whole_vertices, "f15_august": august,
}
SQL = {
    "j1b_chainages": CHAINAGES, "l4_label_choice": LABEL, "l5_cluster_choice": CLUSTER, "a10_coverage_records": RECORDS, "a12_satellite_errors": ERRORS,
    "a15_median_distances": DISTANCES, "a19_extraction_counts": COUNTS, "a21_u2_class_counts": CLASSES, "a27_sand_gate": GATE, "a26_symmetric_ranges": RANGES,
    "t7_plain_correction": PLAIN, "t10_slope_curves": CURVES, "i17_standardized": STANDARD, "g3_g24_windows": WINDOWS, "g19_colliders": COLLIDERS,
    "g21_transect_places": PLACES, "g29_line_crossings": CROSSINGS, "m9_linear_fit": FIT, "f24_whole_vertices": VERTICES, "f15_august": AUGUST,
}
