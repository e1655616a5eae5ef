"""Raster operators over tiles (an embedding is a tile of 8 x 8 pixels), sources and sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ml, raster
from ..sources import tables, vector
from .frames import OBS, PIXELS, POINTS, observations, pixels, points, read, rounded, transects


def tiles(spark, d):
    """scene_id, row, col, value of every element of every embedding."""
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("scene_id"), F.posexplode("embedding").alias("i", "v"))
    return e.select("scene_id", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).cast("int").alias("col"), F.col("v").cast("double").alias("value"))


TILES = "(SELECT vec_id AS scene_id, ((i - 1) // 8)::INTEGER AS row, ((i - 1) % 8)::INTEGER AS col, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) r(i))"
_AROUND = "FROM {t} a JOIN {t} b ON a.scene_id = b.scene_id AND abs(a.row - b.row) <= {r} AND abs(a.col - b.col) <= {r} GROUP BY 1, 2, 3"


def local_std(spark, d):
    return rounded(raster.local_std(tiles(spark, d), "value"), "std")


STD = "SELECT a.scene_id, a.row, a.col, round(sqrt(greatest(avg(b.value * b.value) - avg(b.value) ** 2, 0)), 6) AS std " + _AROUND.format(t=TILES, r=1)


def median_smooth(spark, d):
    return rounded(raster.median_smooth(tiles(spark, d), "value"), "value")


MEDIAN = "SELECT a.scene_id, a.row, a.col, round(median(b.value), 6) + 0.0::DOUBLE AS value " + _AROUND.format(t=TILES, r=1)


def opening(spark, d):
    return raster.opening(tiles(spark, d).withColumn("on", F.col("value") > -0.08), "on", 1)


_FLAG = f"(SELECT scene_id, row, col, value > -0.08::DOUBLE AS f FROM {TILES})"
_ERODED = "(SELECT a.scene_id, a.row, a.col, bool_and(b.f) AS f " + _AROUND.format(t=_FLAG, r=1) + ")"
OPENING = 'SELECT a.scene_id, a.row, a.col, bool_or(b.f) AS "on" ' + _AROUND.format(t=_ERODED, r=1)


def small_objects(spark, d):
    # tiles of 3: objects go over borders
    return raster.drop_small_objects(tiles(spark, d).withColumn("on", F.col("value") > 0.1), "on", 4, tile=3)


def diagonal_objects(spark, d):
    found = raster.objects(tiles(spark, d).withColumn("on", F.col("value") > 0.12), "on", True, 3)
    return found.select("scene_id", "row", "col", "size", (F.shiftright("object", 32)).cast("int").alias("first_row"))


_REACH = """WITH RECURSIVE p AS (SELECT scene_id, row, col FROM {t} WHERE value > {level}::DOUBLE),
reach AS (
  SELECT scene_id, row, col, row AS r, col AS c FROM p
  UNION SELECT w.scene_id, w.row, w.col, p.row, p.col FROM reach w JOIN p ON p.scene_id = w.scene_id AND {near}),
s AS (SELECT scene_id, row, col, count(*) AS size, min(r) AS first_row FROM reach GROUP BY 1, 2, 3)"""
SMALL = _REACH.format(t=TILES, level=0.1, near="abs(p.row - w.r) + abs(p.col - w.c) = 1") + f"""
SELECT scene_id, row, col, coalesce(size >= 4, false) AS "on" FROM {TILES} LEFT JOIN s USING (scene_id, row, col)"""
DIAGONAL = _REACH.format(t=TILES, level=0.12, near="abs(p.row - w.r) <= 1 AND abs(p.col - w.c) <= 1") + """
SELECT scene_id, row, col, size, first_row FROM s"""


def open_square(spark, d):
    return raster.open_square(tiles(spark, d).withColumn("on", F.col("value") > -0.12), "on", 2)


_FITS = "(SELECT a.scene_id, a.row, a.col, bool_and(b.value > -0.12::DOUBLE) AS f FROM {t} a JOIN {t} b ON a.scene_id = b.scene_id AND a.row - b.row BETWEEN 0 AND 1 AND a.col - b.col BETWEEN 0 AND 1 GROUP BY 1, 2, 3)"
OPEN_SQUARE = f"""SELECT a.scene_id, a.row, a.col, bool_or(b.f) AS "on" FROM {TILES} a JOIN {_FITS.format(t=TILES)} b
  ON a.scene_id = b.scene_id AND b.row - a.row BETWEEN 0 AND 1 AND b.col - a.col BETWEEN 0 AND 1 GROUP BY 1, 2, 3"""


def contour_segments(spark, d):
    s = raster.contour_segments(tiles(spark, d), "value", 0.02)
    return s.groupBy("scene_id").agg(F.count("*").alias("n"), F.round(F.sum(F.sqrt(F.pow(F.col("p.row") - F.col("q.row"), 2) + F.pow(F.col("p.col") - F.col("q.col"), 2))), 5).alias("length"))


SEGMENTS = f"""WITH t AS (SELECT scene_id, row, col, value AS v FROM {TILES}),
c AS (SELECT a.scene_id, a.row AS r, a.col AS k, a.v AS a, b.v AS b, c.v AS c, d.v AS d, (a.v > 0.02)::INT + 2 * (b.v > 0.02)::INT + 4 * (c.v > 0.02)::INT + 8 * (d.v > 0.02)::INT AS code FROM t a
  JOIN t b ON b.scene_id = a.scene_id AND b.row = a.row AND b.col = a.col + 1 JOIN t c ON c.scene_id = a.scene_id AND c.row = a.row + 1 AND c.col = a.col + 1 JOIN t d ON d.scene_id = a.scene_id AND d.row = a.row + 1 AND d.col = a.col),
p AS (SELECT *, (0.02::DOUBLE - a) / nullif(b - a, 0) AS tx, (0.02::DOUBLE - b) / nullif(c - b, 0) AS ry, (0.02::DOUBLE - d) / nullif(c - d, 0) AS bx, (0.02::DOUBLE - a) / nullif(d - a, 0) AS ly, (a + b + c + d) / 4 > 0.02 AS hi FROM c WHERE code NOT IN (0, 15)),
s AS (SELECT scene_id, sqrt(ly ** 2 + tx ** 2) AS l FROM p WHERE code IN (1, 14) OR (code = 5 AND NOT hi) OR (code = 10 AND hi)
 UNION ALL SELECT scene_id, sqrt((1 - tx) ** 2 + ry ** 2) FROM p WHERE code IN (2, 13) OR (code = 5 AND hi) OR (code = 10 AND NOT hi)
 UNION ALL SELECT scene_id, sqrt((1 - ry) ** 2 + (1 - bx) ** 2) FROM p WHERE code IN (4, 11) OR (code = 5 AND NOT hi) OR (code = 10 AND hi)
 UNION ALL SELECT scene_id, sqrt((1 - ly) ** 2 + bx ** 2) FROM p WHERE code IN (8, 7) OR (code = 5 AND hi) OR (code = 10 AND NOT hi)
 UNION ALL SELECT scene_id, sqrt((ly - ry) ** 2 + 1) FROM p WHERE code IN (3, 12) UNION ALL SELECT scene_id, sqrt((tx - bx) ** 2 + 1) FROM p WHERE code IN (6, 9))
SELECT scene_id, count(*) AS n, round(sum(l), 5) AS length FROM s GROUP BY 1"""


def linked_contours(spark, d):
    # tiles of 3 cells: lines go over borders
    lines = raster.link_contours(raster.contour_segments(tiles(spark, d), "value", 0.02), tile=3)
    w = Window.partitionBy("scene_id", "contour_id").orderBy("pt_idx")
    step = F.sqrt(F.pow(F.col("row") - F.lag("row").over(w), 2) + F.pow(F.col("col") - F.lag("col").over(w), 2))
    one = lines.withColumn("step", step).groupBy("scene_id", "contour_id").agg(F.count("*").alias("points"), F.sum("step").alias("length"), F.min("row").alias("top"))
    return rounded(one.drop("contour_id"), "length", "top", digits=4)


_ENDS = {"l": ("r + ly", "k::DOUBLE"), "t": ("r::DOUBLE", "k + tx"), "r": ("r + ry", "(k + 1)::DOUBLE"), "b": ("(r + 1)::DOUBLE", "k + bx")}
_PAIRS = [("l", "t", "code IN (1, 14) OR (code = 5 AND NOT hi) OR (code = 10 AND hi)"), ("t", "r", "code IN (2, 13) OR (code = 5 AND hi) OR (code = 10 AND NOT hi)")]
_PAIRS += [("r", "b", "code IN (4, 11) OR (code = 5 AND NOT hi) OR (code = 10 AND hi)"), ("b", "l", "code IN (8, 7) OR (code = 5 AND hi) OR (code = 10 AND NOT hi)")]
_PAIRS += [("l", "r", "code IN (3, 12)"), ("t", "b", "code IN (6, 9)")]
_PIECES = " UNION ALL ".join(f"SELECT scene_id, round({_ENDS[a][0]}, 9) AS y0, round({_ENDS[a][1]}, 9) AS x0, round({_ENDS[b][0]}, 9) AS y1, round({_ENDS[b][1]}, 9) AS x1 FROM p WHERE {w}" for a, b, w in _PAIRS)
# pieces that share a point are of one line; a line has a point more than pieces
LINKED = SEGMENTS[: SEGMENTS.index("\ns AS (")].replace("WITH t", "WITH RECURSIVE t", 1) + f"""
g AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY y0, x0, y1, x1) AS id FROM ({_PIECES})),
e AS MATERIALIZED (SELECT scene_id, id, y0 AS y, x0 AS x FROM g UNION ALL SELECT scene_id, id, y1, x1 FROM g),
n AS MATERIALIZED (SELECT DISTINCT a.scene_id, a.id AS u, b.id AS v FROM e a JOIN e b USING (scene_id, y, x) WHERE a.id <> b.id),
reach AS (SELECT scene_id, id, id AS v FROM g UNION SELECT w.scene_id, w.id, n.v FROM reach w JOIN n ON n.scene_id = w.scene_id AND n.u = w.v),
m AS (SELECT scene_id, id, min(v) AS line FROM reach GROUP BY 1, 2)
SELECT scene_id, count(*) + 1 AS points, round(sum(sqrt((y0 - y1) ** 2 + (x0 - x1) ** 2)), 4) AS length, round(min(least(y0, y1)), 4) + 0.0::DOUBLE AS top
FROM g JOIN m USING (scene_id, id) GROUP BY scene_id, line"""


def resample(spark, d):
    r = raster.resample(tiles(spark, d), "value", 2.0)
    return r.groupBy("scene_id").agg(F.count("*").alias("n"), (F.round(F.sum("value"), 5) + 0.0).alias("total"))


RESAMPLE = f"""WITH t AS {TILES}, g AS (SELECT s, r / 2.0::DOUBLE AS y, c / 2.0::DOUBLE AS x FROM (SELECT DISTINCT scene_id AS s FROM t), range(0, 14) a(r), range(0, 14) b(c))
SELECT s AS scene_id, count(*) AS n, round(sum((1 - (y - floor(y))) * ((1 - (x - floor(x))) * a.value + (x - floor(x)) * b.value) + (y - floor(y)) * ((1 - (x - floor(x))) * c.value + (x - floor(x)) * e.value)), 5) + 0.0::DOUBLE AS total
FROM g JOIN t a ON a.scene_id = s AND a.row = floor(y) AND a.col = floor(x) JOIN t b ON b.scene_id = s AND b.row = floor(y) AND b.col = floor(x) + 1
JOIN t c ON c.scene_id = s AND c.row = floor(y) + 1 AND c.col = floor(x) JOIN t e ON e.scene_id = s AND e.row = floor(y) + 1 AND e.col = floor(x) + 1 GROUP BY 1"""


_FROM = {"xtr": 100.0, "xscale": 1.0, "xshear": 0.0, "ytr": 50.0, "yshear": 0.0, "yscale": -1.0}
_TO = {"xtr": 99.8, "xscale": 0.75, "xshear": 0.1, "ytr": 50.2, "yshear": 0.05, "yscale": -0.8}


def warp(spark, d):
    t = tiles(spark, d).withColumn("value", F.when(F.col("value") > -0.2, F.col("value")))
    scenes = t.select("scene_id").distinct()
    source = scenes.withColumns({k: F.lit(v) for k, v in _FROM.items()})
    target = scenes.withColumns({k: F.lit(v) for k, v in _TO.items()} | {"height": F.lit(9), "width": F.lit(10)})
    return rounded(raster.warp(t, "value", source, target), "value")


# target centres in source pixels; the source has no shear
_SX = f"({_TO['xtr']}::DOUBLE + {_TO['xscale']}::DOUBLE * (k + 0.5) + {_TO['xshear']}::DOUBLE * (r + 0.5) - {_FROM['xtr']}) / {_FROM['xscale']} - 0.5"
_SY = f"({_TO['ytr']}::DOUBLE + {_TO['yshear']}::DOUBLE * (k + 0.5) + {_TO['yscale']}::DOUBLE * (r + 0.5) - {_FROM['ytr']}) / {_FROM['yscale']} - 0.5"
WARP = f"""WITH t AS (SELECT * FROM {TILES} WHERE value > -0.2::DOUBLE),
g AS (SELECT s, r, k, {_SY} AS y, {_SX} AS x FROM (SELECT DISTINCT vec_id AS s FROM embeddings), range(9) a(r), range(10) b(k)),
m AS (SELECT s, r, k, (1 - abs(y - row)) * (1 - abs(x - col)) AS w, value, row = floor(y + 0.5) AND col = floor(x + 0.5) AS near FROM g JOIN t ON scene_id = s AND row IN (floor(y), floor(y) + 1) AND col IN (floor(x), floor(x) + 1))
SELECT s AS scene_id, r::INTEGER AS row, k::INTEGER AS col, round(sum(w * value) / sum(w), 6) + 0.0::DOUBLE AS value FROM m GROUP BY 1, 2, 3 HAVING bool_or(near)"""


def degrade(spark, d):
    return rounded(raster.degrade(tiles(spark, d), "value", 10, 20), "value")


_STEP, _W = raster.gaussian_weights(10, 20)
_WEIGHTS = ", ".join(f"({k}, {v!r}::DOUBLE)" for k, v in _W.items())
DEGRADE = f"""WITH w(k, v) AS (VALUES {_WEIGHTS})
SELECT t.scene_id, (t.row - a.k)::INTEGER AS row, (t.col - b.k)::INTEGER AS col, round(sum(t.value * a.v * b.v), 6) + 0.0::DOUBLE AS value FROM {TILES} t, w a, w b
WHERE (t.row - a.k - {max(_W)}) % {_STEP} = 0 AND (t.col - b.k - {max(_W)}) % {_STEP} = 0 GROUP BY 1, 2, 3 HAVING count(*) = {len(_W) ** 2}"""


def edge_padding(spark, d):
    t = tiles(spark, d).withColumn("swir1", F.when(F.col("value") > 0.15, F.col("value")).otherwise(0.0))
    return raster.edge_padding(t).groupBy("scene_id").agg(F.count(F.when(F.col("padding"), 1)).alias("n"))


PADDING = f"""WITH t AS {TILES}, b AS (SELECT scene_id, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM t WHERE value > 0.15 GROUP BY 1)
SELECT scene_id, count(*) FILTER (NOT coalesce(row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1, false)) AS n FROM t LEFT JOIN b USING (scene_id) GROUP BY 1"""


def stretch(spark, d):
    return rounded(raster.stretch(pixels(spark, d), "g", 95.0).select("pixel_id", "g"), "g")


STRETCH = f"""SELECT pixel_id, round(greatest(least(g, t), 0) / t, 6) AS g FROM {PIXELS} JOIN (SELECT scene_id, quantile_cont(g, 0.95) AS t FROM {PIXELS} WHERE NOT cloud GROUP BY 1) USING (scene_id)"""


def qa_cover(spark, d):
    obs = observations(spark, d).withColumns({"cloud": raster.qa_cloud(F.col("quality"), F.col("satname")), "nodata": F.col("chainage") < 5, "pixel_scene": F.col("transect_id")})
    return rounded(raster.cloud_cover(obs.drop("scene_id").withColumnRenamed("pixel_scene", "scene_id")), "cloud_cover", "cloud_cover_combined")


COVER = f"""SELECT transect_id AS scene_id, round(avg(c::INTEGER), 6) AS cloud_cover_combined, round(sum((c AND NOT n)::INTEGER) / sum((NOT n)::INTEGER), 6) AS cloud_cover, count(*) AS total_pixels
FROM (SELECT transect_id, (quality & 14) <> 0 AS c, chainage < 5 AS n FROM {OBS}) GROUP BY 1"""


def mosaic(spark, d):
    t = tiles(spark, d).select(F.col("scene_id").alias("order"), (F.col("row") + F.col("scene_id") % 5).alias("row"), (F.col("col") + F.col("scene_id") % 3).alias("col"), "value", (F.col("value") > 0).alias("valid"))
    return rounded(raster.mosaic(t).select(F.col("row").cast("long"), F.col("col").cast("long"), "value"), "value")


MOSAIC = f"SELECT (row + scene_id % 5)::BIGINT AS row, (col + scene_id % 3)::BIGINT AS col, round(max_by(value, scene_id), 6) AS value FROM {TILES} WHERE value > 0 GROUP BY 1, 2"


def pansharpen(spark, d):
    p = pixels(spark, d).withColumn("pan", (F.col("b") + F.col("g") + F.col("r")) / 3)
    return raster.pansharpen(p.select("scene_id", "pixel_id", "b", "g", "r", "pan", "cloud"), ["b", "g", "r"])


def kml_round_trip(spark, d):
    token = F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"), F.lit("0"))
    text = points(spark, d).groupBy("scene_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pt_id", token.alias("t")))), lambda s: s["t"]), "\n\t").alias("t"))
    ring = vector.coordinates(F.concat(F.lit("<kml><coordinates> "), "t", F.lit(" </coordinates></kml>")))
    return rounded(text.select("scene_id", F.posexplode(ring).alias("i", "p")).select("scene_id", F.col("i").cast("long"), "p.x", "p.y"), "x", "y")


KML = f"SELECT scene_id, row_number() OVER (PARTITION BY scene_id ORDER BY pt_id) - 1 AS i, round(x, 6) + 0.0::DOUBLE AS x, round(y, 6) + 0.0::DOUBLE AS y FROM {POINTS}"


def page_titles(spark, d):
    return read(spark, d, "pages").select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"))


TITLES = "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages"


def wide_series(spark, d):
    s = observations(spark, d).select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"), F.col("satname").alias("transect_id"), "chainage").groupBy("ts", "transect_id").agg(F.max("chainage").alias("chainage"))
    wide = tables.wide_series(s.withColumn("scene_id", F.lit(0)), ["click", "view", "error"])
    return wide.drop("scene_id")


WIDE = "SELECT date_trunc('day', ts)::TIMESTAMP AS ts, " + ", ".join(f"max(value) FILTER (event_type = '{t}') AS \"Transect {t}\"" for t in ("click", "view", "error")) + " FROM events GROUP BY 1"


def manifest_upsert(spark, d):
    obs = observations(spark, d).select("scene_id", "quality")
    return tables.upsert_manifest(obs.where("scene_id % 3 <> 1"), obs.where("scene_id % 3 <> 0").withColumn("quality", F.lit(-1)))


MANIFEST = f"SELECT scene_id, CASE WHEN scene_id % 3 <> 0 THEN -1 ELSE quality END AS quality FROM {OBS}"


def transect_features(spark, d):
    return vector.transect_features(transects(spark, d))


def even_sample(spark, d):
    return ml.even_sample(pixels(spark, d), "scene_id", ["pixel_id"], 20).groupBy("scene_id").agg(F.count("*").alias("n"))


SAMPLE = f"SELECT scene_id, least(count(*), 20)::BIGINT AS n FROM {PIXELS} GROUP BY 1"


def classified(spark, d):
    p = ml.spectral_features(pixels(spark, d)).withColumn("label", (F.col("g") > F.col("swir1")).cast("int"))
    train, test = ml.split(p, ["pixel_id"])
    model = ml.train_classifier(train, ml.TEN, 2, layers=(16,), rounds=40)
    return ml.classify(test, ml.TEN, model).select("pixel_id", "label", F.col("prediction").cast("int").alias("prediction"))


def features20(spark, d):
    t = tiles(spark, d).select("scene_id", "row", "col", *((F.abs(F.col("value") + k / 50) + 0.01).alias(b) for k, b in enumerate(ml.FIVE)))
    return ml.features(t).groupBy("scene_id").agg(F.count("*").alias("n"), *((F.round(F.avg(c), 6) + 0.0).alias(c) for c in ml.TWENTY))


def _features_sql() -> str:
    bands = ", ".join(f"abs(value + {k / 50}::DOUBLE) + 0.01::DOUBLE AS {b}" for k, b in enumerate(ml.FIVE))
    pairs = {"nd_ng": "nir g", "nd_sg": "swir1 g", "nd_nr": "nir r", "nd_sn": "swir1 nir", "nd_br": "b r"}
    differences = ", ".join("({0} - {1}) / ({0} + {1}) AS {2}".format(*v.split(), n) for n, v in pairs.items())
    spread = ", ".join(f"sqrt(greatest(avg(b.{n} * b.{n}) - avg(b.{n}) ** 2, 0)) AS sd_{n}" for n in ml.TEN)
    return f"""WITH p AS (SELECT scene_id, row, col, {bands} FROM {TILES}), f AS MATERIALIZED (SELECT *, {differences} FROM p),
s AS (SELECT a.scene_id, a.row, a.col, {spread} {_AROUND.format(t="f", r=1)})
SELECT scene_id, count(*) AS n, {", ".join(f"round(avg({n}), 6) + 0.0::DOUBLE AS {n}" for n in ml.TWENTY)} FROM f JOIN s USING (scene_id, row, col) GROUP BY 1"""


FEATURES = _features_sql()


def clusters(spark, d):
    return ml.kmeans(observations(spark, d).select("scene_id", "chainage", F.col("quality").cast("double").alias("tide")), ["chainage", "tide"]).groupBy("prediction").agg(F.count("*").alias("n"))


def noise_clusters(spark, d):
    obs = observations(spark, d).select("scene_id", "transect_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 8.64e10).alias("day"), "chainage")
    return ml.dbscan(obs, ["transect_id"], "day", "chainage").groupBy("transect_id", "cluster").agg(F.count("*").alias("n"))


QUERIES = {
    "r13_local_std": local_std, "r27_median_smooth": median_smooth, "r12_opening": opening, "r3_small_objects": small_objects, "r3_diagonal_objects": diagonal_objects, "r4_open_square": open_square, "r16_contour_segments": contour_segments, "r16_linked_contours": linked_contours,
    "r15_resample": resample, "r15_warp": warp, "r25_degrade": degrade, "r6_edge_padding": edge_padding, "r10_stretch": stretch, "r3_f10_cloud_cover": qa_cover, "s38_r23_mosaic": mosaic, "r8_pansharpen": pansharpen,
    "s4_kml_round_trip": kml_round_trip, "s5_page_titles": page_titles, "s26_wide_series": wide_series, "s35_manifest_upsert": manifest_upsert, "s30_transect_features": transect_features, "u6_even_sample": even_sample,
    "l1_m3_classified": classified, "m1_features20": features20, "m10_clusters": clusters, "m6_noise_clusters": noise_clusters,
}
SQL = {
    "r15_warp": WARP,
    "r16_linked_contours": LINKED,
    "r3_small_objects": SMALL, "r3_diagonal_objects": DIAGONAL, "r4_open_square": OPEN_SQUARE,
    "m1_features20": FEATURES,
    "r13_local_std": STD, "r27_median_smooth": MEDIAN, "r12_opening": OPENING, "r16_contour_segments": SEGMENTS, "r15_resample": RESAMPLE, "r25_degrade": DEGRADE, "r6_edge_padding": PADDING,
    "r10_stretch": STRETCH, "r3_f10_cloud_cover": COVER, "s38_r23_mosaic": MOSAIC, "s4_kml_round_trip": KML, "s5_page_titles": TITLES, "s26_wide_series": WIDE, "s35_manifest_upsert": MANIFEST, "u6_even_sample": SAMPLE,
}
