"""Spatial joins, selection, geometry, spectral indices and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import spectral as sp
from ..operators import joins, thresholds
from ..operators import selection as sel
from .frames import PIXELS, POINTS, TRANSECTS, pixels, points, rounded, transects


def transect_points(spark, d):
    out = joins.transect_points(transects(spark, d), points(spark, d), along=15, past=40, least=-20)
    return rounded(out.select("transect_id", "pt_id", "chainage", "offset"), "chainage", "offset")


_JOIN = f"""SELECT transect_id, pt_id, scene_id, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / len AS chainage, ((y - y0) * (x1 - x0) - (x - x0) * (y1 - y0)) / len AS off, sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS far, len
FROM (SELECT *, sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS len FROM {TRANSECTS}), {POINTS}"""
JOIN = f'SELECT transect_id, pt_id, round(chainage, 6) + 0.0::DOUBLE AS chainage, round(off, 6) + 0.0::DOUBLE AS "offset" FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40 AND chainage >= -20'


def _directed(spark, d):
    p = joins.transect_points(transects(spark, d), points(spark, d), along=15, past=40, least=-20)
    return p.withColumn("along_normal", F.col("offset") + 8)


def positions(spark, d):
    out = sel.positions(_directed(spark, d), gap=5, max_std=12, max_range=30, least=3)
    return rounded(out.select(*sel.PAIR, F.col("n_clusters").cast("long"), "n", "median", "chainage", "rejection"), "median", "chainage")


POSITIONS = f"""WITH p AS (SELECT * FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40 AND chainage >= -20),
f AS (SELECT *, chainage - lag(chainage) OVER (PARTITION BY scene_id, transect_id ORDER BY chainage) AS gap FROM p WHERE off + 8 > 0),
s AS (SELECT scene_id, transect_id, sum(CASE WHEN gap > 5 THEN 1 ELSE 0 END) + 1 AS nc, count(*) AS n, median(chainage) AS med, stddev_pop(chainage) AS sd, max(chainage) - min(chainage) AS rng FROM f GROUP BY 1, 2)
SELECT a.scene_id, a.transect_id, nc::BIGINT AS n_clusters, coalesce(n, 0)::BIGINT AS n, round(med, 6) + 0.0::DOUBLE AS median,
  round(CASE WHEN nc = 1 AND sd <= 12 AND rng <= 30 AND n >= 3 THEN med END, 6) + 0.0::DOUBLE AS chainage,
  (CASE WHEN nc IS NULL THEN 1 WHEN nc > 1 THEN 2 WHEN NOT (sd <= 12 AND rng <= 30 AND n >= 3) THEN 3 END)::INTEGER AS rejection
FROM (SELECT DISTINCT scene_id, transect_id FROM p) a LEFT JOIN s USING (scene_id, transect_id)"""


def class_selection(spark, d):
    p = _directed(spark, d)
    k = F.col("transect_id") + F.col("scene_id")
    classes = p.select(*sel.PAIR).distinct().withColumns({"at_origin": (k % 3 - 1).cast("int"), "at_middle": (k % 2).cast("int"), "at_end": F.lit(1), "length": F.lit(60.0)})
    out = sel.select_by_class(p, classes, gap=12, far=3)
    return rounded(out.withColumn("n_clusters", F.col("n_clusters").cast("long")), "chainage")


CLASSES = f"""WITH p AS (SELECT * FROM ({_JOIN}) WHERE abs(off) <= 15 AND far <= len + 40 AND chainage >= -20),
g AS (SELECT *, chainage - lag(chainage) OVER (PARTITION BY scene_id, transect_id ORDER BY chainage) AS gap FROM p),
k AS (SELECT *, sum(CASE WHEN gap > 12 THEN 1 ELSE 0 END) OVER (PARTITION BY scene_id, transect_id ORDER BY chainage) AS c FROM g),
m AS (SELECT scene_id, transect_id, c, avg(chainage) AS m FROM k GROUP BY 1, 2, 3),
a AS (SELECT scene_id, transect_id, count(*) AS nc, min(m) AS lo, max(m) AS hi, list(m) AS ms, (transect_id + scene_id) % 3 - 1 AS o, (transect_id + scene_id) % 2 AS mid FROM m GROUP BY 1, 2),
l AS (SELECT *, CASE WHEN o >= 0 AND len(list_filter(ms, lambda v: abs(v) <= 3)) = 0 THEN o WHEN len(list_filter(ms, lambda v: abs(v - 30) <= 3)) = 0 THEN mid WHEN len(list_filter(ms, lambda v: abs(v - 60) <= 3)) = 0 THEN 1 END AS lab,
  CASE WHEN o >= 0 AND len(list_filter(ms, lambda v: abs(v) <= 3)) = 0 THEN 0 WHEN len(list_filter(ms, lambda v: abs(v - 30) <= 3)) = 0 THEN 30 WHEN len(list_filter(ms, lambda v: abs(v - 60) <= 3)) = 0 THEN 60 END AS pos FROM a),
r AS (SELECT *, CASE WHEN nc = 1 THEN lo WHEN nc = 2 AND lab = 0 THEN list_max(list_filter(ms, lambda v: v < pos)) WHEN nc = 2 AND lab = 1 THEN list_min(list_filter(ms, lambda v: v > pos)) END AS ch FROM l)
SELECT scene_id, transect_id, nc::BIGINT AS n_clusters, round(ch, 6) + 0.0::DOUBLE AS chainage, (CASE WHEN nc > 2 THEN 5 WHEN nc = 2 AND ch IS NULL THEN 6 END)::INTEGER AS rejection FROM r"""


def away_from(spark, d):
    p = points(spark, d)
    return joins.away_from(p.where("pt_id % 5 != 0"), p.where("pt_id % 5 = 0"), 6, ["scene_id"]).select("pt_id")


AWAY = f"SELECT pt_id FROM {POINTS} p WHERE pt_id % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM {POINTS} o WHERE o.pt_id % 5 = 0 AND o.scene_id = p.scene_id AND sqrt((o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y)) < 6)"


def near_line(spark, d):
    return joins.near_segments(points(spark, d), transects(spark, d), 4).select("pt_id")


NEAR_LINE = f"""SELECT DISTINCT pt_id FROM (SELECT *, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t FROM {POINTS}, {TRANSECTS})
WHERE sqrt((x - x0 - t * (x1 - x0)) ** 2 + (y - y0 - t * (y1 - y0)) ** 2) <= 4"""


def nearest(spark, d):
    p = points(spark, d)
    return rounded(joins.nearest_distance(p.where("pt_id % 4 = 0"), p.where("pt_id % 4 <> 0"), ["pt_id"], 4.0), "nearest")


NEAREST = f"SELECT a.pt_id, round(min(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) AS nearest FROM {POINTS} a, {POINTS} b WHERE a.pt_id % 4 = 0 AND b.pt_id % 4 <> 0 GROUP BY 1"


def crossings(spark, d):
    p = points(spark, d)
    segments = p.where("pt_id % 2 = 0").alias("a").join(p.alias("b"), F.col("b.pt_id") == F.col("a.pt_id") + 1).select(F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("b.x").alias("x1"), F.col("b.y").alias("y1"))
    rays = transects(spark, d).withColumnRenamed("transect_id", "ray_id")
    return rounded(joins.nearest_crossing(rays, segments, 20.0), "x", "y", "along")


CROSSINGS = f"""WITH s AS (SELECT a.x AS sx0, a.y AS sy0, b.x AS sx1, b.y AS sy1 FROM {POINTS} a JOIN {POINTS} b ON b.pt_id = a.pt_id + 1 WHERE a.pt_id % 2 = 0),
c AS (SELECT transect_id, x0, y0, x1 - x0 AS rx, y1 - y0 AS ry, sx0, sy0, sx1 - sx0 AS sx, sy1 - sy0 AS sy FROM {TRANSECTS}, s),
t AS (SELECT *, ((sx0 - x0) * sy - (sy0 - y0) * sx) / nullif(rx * sy - ry * sx, 0) AS t, ((sx0 - x0) * ry - (sy0 - y0) * rx) / nullif(rx * sy - ry * sx, 0) AS u FROM c),
h AS (SELECT transect_id AS ray_id, x0 + t * rx AS x, y0 + t * ry AS y, t * sqrt(rx * rx + ry * ry) AS along FROM t WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1)
SELECT ray_id, round(min_by(x, along), 6) + 0.0::DOUBLE AS x, round(min_by(y, along), 6) + 0.0::DOUBLE AS y, round(min(along), 6) AS along FROM h WHERE along > 1e-6 GROUP BY 1"""


def raster_lookup(spark, d):
    p = points(spark, d).select("pt_id", "scene_id", (F.col("x") / 4).alias("row"), (F.col("y") / 4).alias("col"))
    grid = p.where("pt_id % 3 = 0").groupBy("scene_id", F.bround("row", 0).cast("int").alias("row"), F.bround("col", 0).cast("int").alias("col")).agg(F.max("pt_id").alias("value"))
    return joins.raster_at(p, grid, "value", ["scene_id"]).select("pt_id", "value")


LOOKUP = f"""WITH p AS (SELECT pt_id, scene_id, round_even(x / 4, 0)::INTEGER AS r, round_even(y / 4, 0)::INTEGER AS c FROM {POINTS}),
g AS (SELECT scene_id, r, c, max(pt_id) AS value FROM p WHERE pt_id % 3 = 0 GROUP BY 1, 2, 3) SELECT pt_id, value FROM p LEFT JOIN g USING (scene_id, r, c)"""

_G = {"xtr": 500_000.0, "xscale": 10.0, "xshear": 0.5, "ytr": 6_200_000.0, "yshear": -0.25, "yscale": -10.0}


def affine(spark, d):
    p = points(spark, d)
    g = {k: F.lit(v) for k, v in _G.items()}
    x, y = geo.pixel_to_world(F.col("x"), F.col("y"), g)
    row, col = geo.world_to_pixel(F.col("wx"), F.col("wy"), g)
    return rounded(p.select("pt_id", x.alias("wx"), y.alias("wy")).select("pt_id", "wx", "wy", row.alias("row"), col.alias("col")), "wx", "wy", "row", "col", digits=5)


AFFINE = f"SELECT pt_id, round(500000 + 10.0 * y + 0.5 * x, 5) AS wx, round(6200000 - 0.25 * y - 10.0 * x, 5) AS wy, round(x, 5) + 0.0::DOUBLE AS row, round(y, 5) + 0.0::DOUBLE AS col FROM {POINTS}"


def utm(spark, d):
    p = points(spark, d).select("pt_id", (F.col("x") * 2 - 100).alias("lon"), (F.col("y") + 50).alias("lat"))
    return p.select("pt_id", geo.utm_zone(F.col("lon")).alias("zone"), geo.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


UTM = "SELECT pt_id, z AS zone, CASE WHEN lat BETWEEN 38 AND 84 THEN CASE z " + " ".join(f"WHEN {k} THEN {v}" for k, v in geo.UTM_EPSG.items()) + f" END END::INTEGER AS epsg FROM (SELECT pt_id, y + 50 AS lat, (floor((x * 2 - 100 + 180) / 6) + 1)::INTEGER AS z FROM {POINTS})"


def densify(spark, d):
    t = transects(spark, d).withColumn("len", geo.distance(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    t = t.withColumn("q", F.explode(geo.points_along(F.col("len"), 7.0)))
    at = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("q") / F.col("len")
    return rounded(t.select("transect_id", "q", at("x0", "x1").alias("x"), at("y0", "y1").alias("y")), "q", "x", "y")


DENSIFY = f"""SELECT transect_id, round(q, 6) AS q, round(x0 + (x1 - x0) * q / len, 6) + 0.0::DOUBLE AS x, round(y0 + (y1 - y0) * q / len, 6) + 0.0::DOUBLE AS y
FROM (SELECT *, unnest(list_distinct(list_append(list_transform(range(0, floor(len / 7)::BIGINT + 1), lambda i: i * 7.0::DOUBLE), len))) AS q FROM (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS len FROM {TRANSECTS}))"""


def normals(spark, d):
    v = points(spark, d).select("scene_id", F.lit(0).alias("contour_id"), F.col("pt_id").alias("pt_idx"), "x", "y")
    return rounded(sel.contour_normals(v).select("pt_idx", "nx", "ny"), "nx", "ny")


NORMALS = f"""WITH v AS (SELECT *, lead(x) OVER w - x AS ax, lead(y) OVER w - y AS ay, x - lag(x) OVER w AS bx, y - lag(y) OVER w AS byy FROM {POINTS} WINDOW w AS (PARTITION BY scene_id ORDER BY pt_id)),
u AS (SELECT pt_id, coalesce(-ay / sqrt(ax * ax + ay * ay), 0) + coalesce(-byy / sqrt(bx * bx + byy * byy), 0) AS sx, coalesce(ax / sqrt(ax * ax + ay * ay), 0) + coalesce(bx / sqrt(bx * bx + byy * byy), 0) AS sy FROM v)
SELECT pt_id AS pt_idx, round(sx / nullif(sqrt(sx * sx + sy * sy), 0), 6) + 0.0::DOUBLE AS nx, round(sy / nullif(sqrt(sx * sx + sy * sy), 0), 6) + 0.0::DOUBLE AS ny FROM u"""


def contour_lengths(spark, d):
    v = points(spark, d).select("scene_id", (F.col("pt_id") % 4).alias("contour_id"), F.col("pt_id").alias("pt_idx"), F.when(F.col("pt_id") % 11 != 0, F.col("x")).alias("x"), "y")
    return rounded(sel.contour_lengths(v).where("length >= 50"), "length", digits=4)


LENGTHS = f"""SELECT scene_id, contour_id, round(coalesce(sum(s), 0), 4) AS length, count(*) AS n_points FROM (SELECT scene_id, pt_id % 4 AS contour_id, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS s
FROM {POINTS} WHERE pt_id % 11 <> 0 WINDOW w AS (PARTITION BY scene_id, pt_id % 4 ORDER BY pt_id)) GROUP BY 1, 2 HAVING coalesce(sum(s), 0) >= 50"""


def collider(spark, d):
    t = transects(spark, d)
    c = geo.collider(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 10, 5, 20)
    box = geo.box(F.transform("c", lambda p: p["x"]), F.transform("c", lambda p: p["y"]))
    out = t.select("transect_id", c.alias("c")).select("transect_id", box.alias("b")).select("transect_id", "b.*")
    return rounded(out, "x_min", "y_min", "x_max", "y_max")


COLLIDER = f"""WITH t AS (SELECT transect_id, x0, y0, x1, y1, (x1 - x0) / sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS ux, (y1 - y0) / sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS uy FROM {TRANSECTS}),
c AS (SELECT transect_id, [x0 - 5 * ux - 10 * uy, x0 - 5 * ux + 10 * uy, x1 + 20 * ux - 10 * uy, x1 + 20 * ux + 10 * uy] AS xs, [y0 - 5 * uy + 10 * ux, y0 - 5 * uy - 10 * ux, y1 + 20 * uy + 10 * ux, y1 + 20 * uy - 10 * ux] AS ys FROM t)
SELECT transect_id, round(list_min(xs), 6) + 0.0::DOUBLE AS x_min, round(list_min(ys), 6) + 0.0::DOUBLE AS y_min, round(list_max(xs), 6) + 0.0::DOUBLE AS x_max, round(list_max(ys), 6) + 0.0::DOUBLE AS y_max FROM c"""


def spectral_indices(spark, d):
    names = sp.indices()
    return rounded(pixels(spark, d).select("pixel_id", *(c.alias(n) for n, c in names.items())), *names)


_ND = "({0} - ({1})) / nullif({0} + ({1}), 0)"
_INDEX = {
    "mndwi": _ND.format("g", "swir1"), "ndwi": _ND.format("g", "nir"),
    "awei_sh": "b + 2.5::DOUBLE * g - 1.5::DOUBLE * (nir + swir1) - 0.25::DOUBLE * swir2", "awei_ns": "4 * (g - swir1) - (0.25::DOUBLE * nir + 2.75::DOUBLE * swir2)",
    "scowi": "b + 2 * (g - nir) - 0.75::DOUBLE * swir1 - 0.5::DOUBLE * swir2", "wi2015": "1.7204::DOUBLE + 171 * g + 3 * r - 70 * nir - 45 * swir1 - 71 * swir2",
    "andwi": "(b + g + r - nir - swir1 - swir2) / (b + g + r + nir + swir1 + swir2)", "wri": "(g + r) / (nir + swir1)", "ewi": "(b - r - nir) / (b + r + nir)",
    "nwi": "(b - nir - swir1 - swir2) / (b + nir + swir1 + swir2)", "wi2019": "(1.75::DOUBLE * g - r - 1.08::DOUBLE * swir1) / (g + swir1)",
    "tct_wetness": "-(0.1511::DOUBLE * b + 0.1973::DOUBLE * g + 0.3283::DOUBLE * r + 0.3407::DOUBLE * nir + 0.7117::DOUBLE * swir1 + 0.4559::DOUBLE * swir2)", "ddwi": "g - nir",
}
INDICES = "SELECT pixel_id, " + ", ".join(f"round({e}, 6) + 0.0::DOUBLE AS {n}" for n, e in _INDEX.items()) + f" FROM {PIXELS}"


def land_water(spark, d):
    return rounded(sp.land_water(pixels(spark, d)), "water_fraction", "land_fraction")


LAND = f"""SELECT scene_id, round(avg((v > 0)::INTEGER), 6) AS water_fraction, round(avg((v <= 0)::INTEGER), 6) AS land_fraction, count(*) AS valid_pixels FROM (SELECT scene_id, (g - swir1) / CASE WHEN g + swir1 = 0 THEN 1e-6 ELSE g + swir1 END AS v FROM {PIXELS} WHERE NOT cloud) GROUP BY 1"""


def _indexed(spark, d):
    names = sp.indices()
    return pixels(spark, d).where("NOT cloud").select("pixel_id", "scene_id", *(names[n].alias(n) for n in ("mndwi", "ndwi", "awei_ns")))


def otsu(spark, d):
    return rounded(thresholds.otsu(_indexed(spark, d), ["scene_id"], "mndwi", 64), "threshold")


def _otsu_sql(frame: str, group: str, value: str, bins: int) -> str:
    return f"""WITH v AS (SELECT {group}, {value} AS v FROM {frame}), s AS (SELECT {group}, min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM v GROUP BY {group}),
h AS (SELECT {group}, least(floor(coalesce((v - lo) / nullif(w, 0), 0)), {bins - 1})::INTEGER AS bin, lo, w, count(*) AS n FROM v JOIN s USING ({group}) GROUP BY ALL),
c AS (SELECT *, lo + (bin + 0.5::DOUBLE) * w AS c FROM h),
k AS (SELECT *, sum(n) OVER u AS w1, sum(n * c) OVER u AS m1, sum(n) OVER a AS wa, sum(n * c) OVER a AS ma FROM c WINDOW u AS (PARTITION BY {group} ORDER BY bin ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY {group})),
b AS (SELECT *, coalesce(round(w1 * (wa - w1) * (m1 / w1 - (ma - m1) / nullif(wa - w1, 0)) ** 2, 6), -1) AS var FROM k)
SELECT {group}, round(min_by(c, (-var, bin)), 6) + 0.0::DOUBLE AS threshold FROM b GROUP BY {group}"""


OTSU = _otsu_sql(f"(SELECT scene_id, {_INDEX['mndwi']} AS m FROM {PIXELS} WHERE NOT cloud)", "scene_id", "m", 64)


def local_minimum(spark, d):
    return rounded(thresholds.local_minimum(_indexed(spark, d), ["scene_id"], "mndwi", 24), "threshold")


def _minimum_sql(frame: str, group: str, value: str, bins: int) -> str:
    return f"""WITH o AS MATERIALIZED ({_otsu_sql(frame, group, value, bins).replace("round(min_by(c, (-var, bin)), 6) + 0.0::DOUBLE", "min_by(c, (-var, bin))")}),
v AS (SELECT {group}, {value} AS v FROM {frame}), s AS (SELECT {group}, min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM v GROUP BY {group}),
h AS (SELECT {group}, least(floor(coalesce((v - lo) / nullif(w, 0), 0)), {bins - 1})::INTEGER AS bin, count(*) AS n FROM v JOIN s USING ({group}) GROUP BY ALL),
f AS (SELECT {group}, bin, coalesce(n, 0) AS n, lo + (bin + 0.5::DOUBLE) * w AS c FROM (
  SELECT {group}, lo, w, unnest(range(0, last + 1))::INTEGER AS bin FROM s JOIN (SELECT {group}, max(bin) AS last FROM h GROUP BY {group}) USING ({group})) LEFT JOIN h USING ({group}, bin)),
r AS (SELECT *, sum(new) OVER (PARTITION BY {group} ORDER BY bin) AS run FROM (SELECT *, CASE WHEN lag(n) OVER (PARTITION BY {group} ORDER BY bin) = n THEN 0 ELSE 1 END AS new FROM f)),
q AS (SELECT {group}, run, (min(bin) + max(bin)) // 2 AS bin, any_value(n) AS n FROM r GROUP BY {group}, run),
p AS (SELECT * FROM (SELECT *, lag(n) OVER (PARTITION BY {group} ORDER BY run) AS b, lead(n) OVER (PARTITION BY {group} ORDER BY run) AS a FROM q) WHERE n > b AND n > a),
k AS (SELECT {group}, arg_max(c, (f.n, -f.bin)) FILTER (c < threshold) AS l, arg_max(c, (f.n, -f.bin)) FILTER (c >= threshold) AS r FROM p JOIN f USING ({group}, bin) JOIN o USING ({group}) GROUP BY {group}),
e AS (SELECT {group}, threshold, coalesce(l, threshold) AS l, coalesce(r, threshold) AS r FROM o LEFT JOIN k USING ({group})),
m AS (SELECT {group}, arg_min(c, (n, bin)) AS c FROM f JOIN e USING ({group}) WHERE c > l AND c < r GROUP BY {group})
SELECT {group}, round(coalesce(c, threshold), 6) + 0.0::DOUBLE AS threshold FROM e LEFT JOIN m USING ({group})"""


MINIMUM = _minimum_sql(f"(SELECT scene_id, {_INDEX['mndwi']} AS m FROM {PIXELS} WHERE NOT cloud)", "scene_id", "m", 24)


def signature(spark, d):
    p = pixels(spark, d).withColumns({"mndwi": sp.indices()["mndwi"], "in_buffer": F.col("pixel_id") % 5 != 0})
    level = thresholds.left_peak(p.where("in_buffer AND NOT cloud"), ["scene_id"], "mndwi", 24)
    return rounded(sp.candidate_signature(p, level, "mndwi", ["g", "nir"]).join(level, "scene_id"), "threshold", "g", "nir")


_BUFFERED = f"(SELECT *, {_INDEX['mndwi']} AS m FROM {PIXELS} WHERE NOT cloud AND pixel_id % 5 <> 0)"
_PEAK = _minimum_sql(_BUFFERED, "scene_id", "m", 24)
SIGNATURE = _PEAK[: _PEAK.index(",\nm AS (")] + f"""
SELECT scene_id, round(any_value(l), 6) + 0.0::DOUBLE AS threshold, round(avg(g), 6) AS g, round(avg(nir), 6) AS nir FROM e JOIN {_BUFFERED} USING (scene_id) WHERE m < l GROUP BY 1"""


def ensemble_vote(spark, d):
    names = ["mndwi", "ndwi", "awei_ns"]
    t = lambda df, group, value: df.groupBy(*group).agg(F.avg(value).alias("threshold"))
    return rounded(sp.ensemble_vote(_indexed(spark, d), names, ["pixel_id", "scene_id"], t), "ensemble")


def ensemble_mean(spark, d):
    names = ["mndwi", "ndwi", "awei_ns"]
    t = lambda df, group, value: df.groupBy(*group).agg(F.avg(value).alias("threshold"))
    return rounded(sp.ensemble_mean(_indexed(spark, d), names, ["pixel_id", "scene_id"], t), "ensemble")


_LONG = " UNION ALL ".join(f"SELECT pixel_id, scene_id, '{n}' AS i, {_INDEX[n]} AS v FROM {PIXELS} WHERE NOT cloud" for n in ("mndwi", "ndwi", "awei_ns"))
VOTE = f"SELECT pixel_id, scene_id, round(avg((v < t)::INTEGER), 6) AS ensemble FROM (SELECT *, avg(v) OVER (PARTITION BY scene_id, i) AS t FROM ({_LONG})) GROUP BY 1, 2"
MEAN = f"SELECT pixel_id, scene_id, round(avg(u - t), 6) + 0.0::DOUBLE AS ensemble FROM (SELECT *, avg(u) OVER (PARTITION BY scene_id, i) AS t FROM (SELECT *, (v - min(v) OVER (PARTITION BY scene_id, i)) / nullif(max(v) OVER (PARTITION BY scene_id, i) - min(v) OVER (PARTITION BY scene_id, i), 0) AS u FROM ({_LONG}))) GROUP BY 1, 2"


def match_histogram(spark, d):
    p = pixels(spark, d).withColumn("g", F.round("g", 2))
    return rounded(thresholds.match_histogram(p.where("pixel_id % 2 = 0"), p.where("pixel_id % 2 = 1"), ["scene_id"], "g"), "matched")


MATCH = f"""WITH p AS (SELECT pixel_id, scene_id, round(g, 2) AS g FROM {PIXELS}),
s AS (SELECT scene_id, g, sum(n) OVER (PARTITION BY scene_id ORDER BY g) / sum(n) OVER (PARTITION BY scene_id) AS q FROM (SELECT scene_id, g, count(*) AS n FROM p WHERE pixel_id % 2 = 0 GROUP BY 1, 2)),
t AS (SELECT scene_id, g, sum(n) OVER (PARTITION BY scene_id ORDER BY g) / sum(n) OVER (PARTITION BY scene_id) AS q FROM (SELECT scene_id, g, count(*) AS n FROM p WHERE pixel_id % 2 = 1 GROUP BY 1, 2)),
m AS (SELECT s.scene_id, s.g, s.q, max(CASE WHEN t.q <= s.q THEN t.q END) AS q0, max(CASE WHEN t.q <= s.q THEN t.g END) AS v0, min(CASE WHEN t.q >= s.q THEN t.q END) AS q1, min(CASE WHEN t.q >= s.q THEN t.g END) AS v1 FROM s JOIN t USING (scene_id) GROUP BY 1, 2, 3)
SELECT scene_id, g, round(coalesce(v0 + coalesce((q - q0) / nullif(q1 - q0, 0), 0) * (v1 - v0), v0, v1), 6) AS matched FROM m"""


def ks(spark, d):
    p = pixels(spark, d)
    return rounded(thresholds.ks_statistic(p.where("pixel_id % 2 = 0"), p.where("pixel_id % 2 = 1"), ["scene_id"], "nir"), "statistic")


KS = f"""WITH u AS (SELECT scene_id, nir AS v, count(*) FILTER (pixel_id % 2 = 0) AS a, count(*) FILTER (pixel_id % 2 = 1) AS b FROM {PIXELS} GROUP BY 1, 2)
SELECT scene_id, round(max(d), 6) AS statistic FROM (SELECT scene_id, abs(sum(a) OVER w / sum(a) OVER (PARTITION BY scene_id) - sum(b) OVER w / sum(b) OVER (PARTITION BY scene_id)) AS d FROM u WINDOW w AS (PARTITION BY scene_id ORDER BY v)) GROUP BY 1"""


def unmix(spark, d):
    p = pixels(spark, d).where("NOT cloud")
    arr = lambda c: F.array(*(F.avg(F.when(c, F.col(b))) for b in sp.BANDS))
    wet = F.col("g") > F.col("swir1")
    sig = p.groupBy("scene_id").agg(arr(~wet).alias("land"), arr(wet).alias("water"))
    own = F.array(*sp.BANDS)
    out = p.join(F.broadcast(sig), "scene_id").select("pixel_id", sp.capped_share(own, F.col("land"), F.col("water")).alias("share"), sp.cosine(own, F.col("water")).alias("cosine"))
    return rounded(out.withColumn("cosine", F.when(F.col("cosine") >= 0.6, F.col("cosine"))), "share", "cosine")


_ARR = "[" + ", ".join(sp.BANDS) + "]"
UNMIX = f"""WITH p AS (SELECT *, {_ARR} AS a FROM {PIXELS} WHERE NOT cloud), s AS (SELECT scene_id, [{", ".join(f"avg(CASE WHEN NOT g > swir1 THEN {b} END)" for b in sp.BANDS)}] AS l, [{", ".join(f"avg(CASE WHEN g > swir1 THEN {b} END)" for b in sp.BANDS)}] AS w FROM p GROUP BY 1),
q AS (SELECT pixel_id, a, w, list_transform(list_zip(w, l), lambda z: z[1] - z[2]) AS dd, list_transform(list_zip(a, l), lambda z: z[1] - z[2]) AS o FROM p JOIN s USING (scene_id))
SELECT pixel_id, round(greatest(least(list_dot_product(o, dd) / nullif(list_dot_product(dd, dd), 0), 1), 0), 6) AS share, round(CASE WHEN list_dot_product(a, w) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(w, w))) >= 0.6 THEN list_dot_product(a, w) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(w, w))) END, 6) AS cosine FROM q"""


def index_histogram(spark, d):
    return thresholds.fixed_histogram(_indexed(spark, d), ["scene_id"], F.col("mndwi"), -1.2, 0.05, 48)


HISTOGRAM = f"SELECT scene_id, floor(({_INDEX['mndwi']} + 1.2::DOUBLE) / 0.05::DOUBLE)::INTEGER AS bin, count(*) AS n FROM {PIXELS} WHERE NOT cloud GROUP BY 1, 2"

QUERIES = {
    "j1_transect_points": transect_points, "l2_a2_positions": positions, "l3_class_selection": class_selection, "j4_f22_away_from": away_from, "j3_g16_near_line": near_line,
    "j5_nearest_distance": nearest, "j7_g13_crossings": crossings, "j9_raster_lookup": raster_lookup, "g1_g2_affine": affine, "g5_utm": utm, "g9_densify": densify,
    "g14_contour_normals": normals, "f21_contour_lengths": contour_lengths, "g18_collider": collider, "i2_i14_indices": spectral_indices, "r11_land_water": land_water,
    "it1_otsu": otsu, "it4_local_minimum": local_minimum, "it5_iu1_signature": signature, "i15_ensemble_mean": ensemble_mean, "i16_ensemble_vote": ensemble_vote, "r7_match_histogram": match_histogram,
    "il4_ks_statistic": ks, "iu_unmix": unmix, "a18_index_histogram": index_histogram,
}
SQL = {
    "j1_transect_points": JOIN, "l2_a2_positions": POSITIONS, "l3_class_selection": CLASSES, "j4_f22_away_from": AWAY, "j3_g16_near_line": NEAR_LINE,
    "j5_nearest_distance": NEAREST, "j7_g13_crossings": CROSSINGS, "j9_raster_lookup": LOOKUP, "g1_g2_affine": AFFINE, "g5_utm": UTM, "g9_densify": DENSIFY,
    "g14_contour_normals": NORMALS, "f21_contour_lengths": LENGTHS, "g18_collider": COLLIDER, "i2_i14_indices": INDICES, "r11_land_water": LAND,
    "it1_otsu": OTSU, "it4_local_minimum": MINIMUM, "it5_iu1_signature": SIGNATURE, "i15_ensemble_mean": MEAN, "i16_ensemble_vote": VOTE, "r7_match_histogram": MATCH, "il4_ks_statistic": KS, "iu_unmix": UNMIX, "a18_index_histogram": HISTOGRAM,
}
