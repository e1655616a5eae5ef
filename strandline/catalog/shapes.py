"""Boxes, outlines, zones, scene choices, spectra and noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes
from ..operators import outlines, research
from ..operators import scenes as sc
from .frames import LONG, OBS, PIXELS, POINTS, TRANSECTS, long_series, observations, pixels, points, read, rounded, transects
from .rasters import TILES, tiles


def _segments(spark, d):
    e = lambda i: F.element_at("embedding", i).cast("double") * 100
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("seg_id"), F.col("label").alias("scene_id"), e(1).alias("x0"), e(2).alias("y0"), e(3).alias("x1"), e(4).alias("y1"))


_SEG = "(SELECT vec_id AS seg_id, label AS scene_id, embedding[1]::DOUBLE * 100 AS x0, embedding[2]::DOUBLE * 100 AS y0, embedding[3]::DOUBLE * 100 AS x1, embedding[4]::DOUBLE * 100 AS y1 FROM embeddings)"
_BOXES = f"(SELECT seg_id AS image_id, scene_id, least(x0, x1) AS x_min, least(y0, y1) AS y_min, greatest(x0, x1) AS x_max, greatest(y0, y1) AS y_max FROM {_SEG})"


def _boxes(spark, d):
    s = _segments(spark, d)
    box = boxes.box_of(F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1"))
    return s.select(F.col("seg_id").alias("image_id"), "scene_id", box.alias("box"))


def clip_lines(spark, d):
    aoi = boxes.box_of(F.lit(-10.0), F.lit(-8.0), F.lit(9.0), F.lit(12.0))
    out = _segments(spark, d).withColumn("part", boxes.clipped(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), aoi)).where("part IS NOT NULL")
    return rounded(out.select("seg_id", "part.x0", "part.y0", "part.x1", "part.y1"), "x0", "y0", "x1", "y1")


CLIP = f"""WITH s AS (SELECT *, x1 - x0 AS dx, y1 - y0 AS dy FROM {_SEG}),
t AS (SELECT *, greatest(0, CASE WHEN dx > 0 THEN (-10 - x0) / dx WHEN dx < 0 THEN (9 - x0) / dx ELSE 0 END, CASE WHEN dy > 0 THEN (-8 - y0) / dy WHEN dy < 0 THEN (12 - y0) / dy ELSE 0 END) AS a,
  least(1, CASE WHEN dx > 0 THEN (9 - x0) / dx WHEN dx < 0 THEN (-10 - x0) / dx ELSE 1 END, CASE WHEN dy > 0 THEN (12 - y0) / dy WHEN dy < 0 THEN (-8 - y0) / dy ELSE 1 END) AS b FROM s
  WHERE NOT (dx = 0 AND (x0 < -10 OR x0 > 9)) AND NOT (dy = 0 AND (y0 < -8 OR y0 > 12)))
SELECT seg_id, round(x0 + a * dx, 6) + 0.0::DOUBLE AS x0, round(y0 + a * dy, 6) + 0.0::DOUBLE AS y0, round(x0 + b * dx, 6) + 0.0::DOUBLE AS x1, round(y0 + b * dy, 6) + 0.0::DOUBLE AS y1 FROM t WHERE a <= b"""


def snap_boxes(spark, d):
    b = _boxes(spark, d)
    g = {"xtr": F.lit(-50.0), "xscale": F.lit(3.0), "ytr": F.lit(50.0), "yscale": F.lit(-3.0)}
    out = b.select("image_id", boxes.snapped_out(F.col("box"), 2.5).alias("s"), boxes.snapped_window(F.col("box"), g).alias("w"))
    names = ("x_min", "y_min", "x_max", "y_max")
    return rounded(out.select("image_id", "s.*", *(F.col(f"w.{c}").alias(f"w_{c}") for c in names)), *names, *(f"w_{c}" for c in names))


SNAP = f"""SELECT image_id, floor(x_min / 2.5::DOUBLE) * 2.5::DOUBLE + 0.0::DOUBLE AS x_min, floor(y_min / 2.5::DOUBLE) * 2.5::DOUBLE + 0.0::DOUBLE AS y_min, ceil(x_max / 2.5::DOUBLE) * 2.5::DOUBLE + 0.0::DOUBLE AS x_max, ceil(y_max / 2.5::DOUBLE) * 2.5::DOUBLE + 0.0::DOUBLE AS y_max,
  -50 + floor((x_min + 50) / 3) * 3 + 0.0::DOUBLE AS w_x_min, 50 - floor((50 - y_min) / 3) * 3 + 0.0::DOUBLE AS w_y_min, -50 + ceil((x_max + 50) / 3) * 3 + 0.0::DOUBLE AS w_x_max, 50 - ceil((50 - y_max) / 3) * 3 + 0.0::DOUBLE AS w_y_max FROM {_BOXES}"""


def circles(spark, d):
    c = boxes.query_circle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 25.0, -20.0, 40.0)
    return rounded(transects(spark, d).select("transect_id", c.alias("c")).select("transect_id", "c.*"), "x", "y", "radius")


CIRCLES = f"""SELECT transect_id, round(x0 + (x1 - x0) / len * (-20 + half), 6) AS x, round(y0 + (y1 - y0) / len * (-20 + half), 6) AS y, round(sqrt(half * half + 625), 6) AS radius
FROM (SELECT *, (len + 60) / 2 AS half FROM (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS len FROM {TRANSECTS}))"""


def image_bounds(spark, d):
    s = _segments(spark, d)
    g = {"xtr": F.col("x0"), "xscale": F.lit(10.0), "xshear": F.lit(0.5), "ytr": F.col("y0"), "yshear": F.lit(0.25), "yscale": F.lit(-10.0)}
    out = s.select("seg_id", boxes.image_box(g, F.col("scene_id") + 5, F.col("scene_id") + 9).alias("b"))
    return rounded(out.select("seg_id", "b.*"), "x_min", "y_min", "x_max", "y_max")


BOUNDS = f"""SELECT seg_id, round(x0, 6) + 0.0::DOUBLE AS x_min, round(y0 - 10 * (scene_id + 5), 6) + 0.0::DOUBLE AS y_min, round(x0 + 10 * (scene_id + 9) + 0.5::DOUBLE * (scene_id + 5), 6) + 0.0::DOUBLE AS x_max, round(y0 + 0.25::DOUBLE * (scene_id + 9), 6) + 0.0::DOUBLE AS y_max FROM {_SEG}"""


def overlaps(spark, d):
    b = _boxes(spark, d)
    window = boxes.box_of(F.lit(-12.0), F.lit(-12.0), F.lit(12.0), F.lit(12.0))
    some = b.select("scene_id", boxes.overlap(F.col("box"), window).alias("part"))
    size = (F.col("part.x_max") - F.col("part.x_min")) * (F.col("part.y_max") - F.col("part.y_min"))
    out = some.groupBy("scene_id").agg(F.count("part").alias("n"), F.sum(size).alias("area"), boxes.common_box(F.col("part")).isNotNull().alias("shared"))
    return rounded(out, "area", digits=4)


OVERLAPS = f"""WITH p AS (SELECT scene_id, greatest(x_min, -12) AS a, greatest(y_min, -12) AS b, least(x_max, 12) AS c, least(y_max, 12) AS e FROM {_BOXES}),
q AS (SELECT * FROM p WHERE a <= c AND b <= e)
SELECT s.scene_id, count(q.a) AS n, round(sum((c - a) * (e - b)), 4) + 0.0::DOUBLE AS area, coalesce(max(a) <= min(c) AND max(b) <= min(e), false) AS shared
FROM (SELECT DISTINCT scene_id FROM p) s LEFT JOIN q USING (scene_id) GROUP BY 1"""


def not_contained(spark, d):
    return outlines.not_contained(_boxes(spark, d), ["scene_id"]).select("image_id")


NOT_CONTAINED = f"""SELECT image_id FROM {_BOXES} i WHERE NOT EXISTS (SELECT 1 FROM {_BOXES} o WHERE o.scene_id = i.scene_id AND o.image_id <> i.image_id
  AND o.x_min <= i.x_min AND o.y_min <= i.y_min AND o.x_max >= i.x_max AND o.y_max >= i.y_max
  AND (o.image_id < i.image_id OR NOT (i.x_min <= o.x_min AND i.y_min <= o.y_min AND i.x_max >= o.x_max AND i.y_max >= o.y_max)))"""


def inside_image(spark, d):
    p = points(spark, d)
    return p.where(boxes.inside_image(F.col("y") + 20, F.col("x") + 20, F.lit(40), F.lit(30))).select("pt_id")


INSIDE = f"SELECT pt_id FROM {POINTS} WHERE x + 20 > 0 AND x + 20 < 30 AND y + 20 > 0 AND y + 20 < 40"


def pixel_lines(spark, d):
    t = tiles(spark, d)
    lines = t.select("scene_id").distinct().withColumn("p", F.explode(boxes.pixel_steps(F.lit(1), F.lit(2), F.lit(6), F.lit(7)))).select("scene_id", "p.*")
    return rounded(t.join(lines, ["scene_id", "row", "col"]).select("scene_id", "row", "value"), "value")


PIXEL_LINES = f"SELECT scene_id, row, round(value, 6) + 0.0::DOUBLE AS value FROM {TILES} WHERE row BETWEEN 1 AND 6 AND col = row + 1"


def centroids(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    xy = e.groupBy("vec_id", F.floor(F.col("i") / 2).cast("int").alias("idx")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("v").cast("double") * 100)).alias("x"), F.max(F.when(F.col("i") % 2 == 1, F.col("v").cast("double") * 100)).alias("y"))
    out = outlines.centroids(xy, ["vec_id"]).where("area > 1")
    return rounded(out.withColumn("x", outlines.east_of_greenwich(F.col("x"))), "x", "y", "area", digits=4)


CENTROIDS = """WITH v AS (SELECT vec_id, k, embedding[2 * k + 1]::DOUBLE * 100 AS x, embedding[2 * k + 2]::DOUBLE * 100 AS y, embedding[2 * ((k + 1) % 32) + 1]::DOUBLE * 100 AS x2, embedding[2 * ((k + 1) % 32) + 2]::DOUBLE * 100 AS y2 FROM embeddings, range(32) r(k)),
s AS (SELECT vec_id, sum(x * y2 - x2 * y) AS a, sum((x + x2) * (x * y2 - x2 * y)) AS sx, sum((y + y2) * (x * y2 - x2 * y)) AS sy FROM v GROUP BY 1)
SELECT vec_id, round(sx / (3 * a) + CASE WHEN sx / (3 * a) < 0 THEN 360 ELSE 0 END, 4) + 0.0::DOUBLE AS x, round(sy / (3 * a), 4) + 0.0::DOUBLE AS y, round(abs(a) / 2, 4) AS area FROM s WHERE abs(a) / 2 > 1"""


def nearest_three(spark, d):
    refs = points(spark, d).groupBy("scene_id").agg(F.min_by("x", "pt_id").alias("x"), F.min_by("y", "pt_id").alias("y"), F.min("pt_id").alias("ref_id"))
    return rounded(outlines.nearest_k(refs, points(spark, d), ["scene_id"], 3).select("ref_id", "pt_id", "rank", "distance"), "distance")


NEAREST_THREE = f"""WITH r AS (SELECT scene_id, min(pt_id) AS ref_id, min_by(x, pt_id) AS rx, min_by(y, pt_id) AS ry FROM {POINTS} GROUP BY 1),
d AS (SELECT ref_id, pt_id, sqrt((x - rx) ** 2 + (y - ry) ** 2) AS distance FROM r JOIN {POINTS} USING (scene_id))
SELECT ref_id, pt_id, rank::INTEGER AS rank, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY distance, pt_id) AS rank FROM d) WHERE rank <= 3"""


def runs_and_zones(spark, d):
    t = tiles(spark, d).select("scene_id", (8 * F.col("row") + F.col("col")).alias("idx"), "value")
    near = outlines.run_along(t, t.select("scene_id", F.col("idx").alias("ref_idx")), ["scene_id"], 2).groupBy("scene_id", "ref_idx").agg(F.count("*").alias("n"))
    zones = outlines.zones_of_points(t, ["scene_id"], "value", -0.1).select("scene_id", F.col("idx").alias("ref_idx"), "zone")
    return zones.join(near, ["scene_id", "ref_idx"])


RUNS = f"""WITH t AS (SELECT scene_id, 8 * row + col AS idx, value < -0.1 AS low FROM {TILES}),
b AS (SELECT scene_id, idx, low AND NOT coalesce(lead(low) OVER (PARTITION BY scene_id ORDER BY idx), false) AS begins FROM t)
SELECT scene_id, idx AS ref_idx, sum(begins::INTEGER) OVER (PARTITION BY scene_id ORDER BY idx)::BIGINT AS zone,
  (least(idx + 2, 63) - greatest(idx - 2, 0))::BIGINT AS n FROM b WHERE least(idx + 2, 63) > greatest(idx - 2, 0)"""


def cloud_range(spark, d):
    clouds = points(spark, d).where("scene_id % 3 = 0")
    return rounded(outlines.cloud_range(transects(spark, d), clouds, 15, 40, -20), "cloud_min", "cloud_max")


CLOUDS = f"""SELECT transect_id, round(min(c) - 15 * 1.414::DOUBLE, 6) AS cloud_min, round(max(c) + 15 * 1.414::DOUBLE, 6) AS cloud_max FROM (
  SELECT transect_id, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / len AS c, ((y - y0) * (x1 - x0) - (x - x0) * (y1 - y0)) / len AS o, sqrt((x - x0) ** 2 + (y - y0) ** 2) AS far, len
  FROM (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS len FROM {TRANSECTS}), {POINTS} WHERE scene_id % 3 = 0) WHERE abs(o) <= 15 AND far <= len + 40 AND c >= -20 GROUP BY 1"""


def usable_pixels(spark, d):
    p = pixels(spark, d).withColumns({"in_buffer": F.col("pixel_id") % 5 != 0, "g": F.when(F.col("g") < 0.2, F.col("g")), "nir": F.when(F.col("nir") < 0.15, F.col("nir"))})
    return outlines.usable_pixels(p, ["g", "nir"]).select("pixel_id")


USABLE = f"SELECT pixel_id FROM {PIXELS} WHERE pixel_id % 5 <> 0 AND NOT cloud AND (g < 0.2::DOUBLE OR nir < 0.15::DOUBLE)"


def scene_choice(spark, d):
    s = observations(spark, d).withColumn("epsg", F.col("quality") % 7)
    first, second = s.where("scene_id % 2 = 0"), s.where("scene_id % 2 <> 0")
    both = sc.with_second_tier(first, second, ("click", "view")).where(sc.outside_zones(F.col("epsg"), [1, 4]))
    made = s.select("scene_id", F.concat(F.lit("im"), F.col("quality")).alias("filename"))
    files = s.where("quality < 40").select(F.concat(F.lit("im"), F.col("quality")).alias("filename")).distinct()
    return sc.without_artefact(both, made, files).select("scene_id")


CHOICE = f"SELECT scene_id FROM {OBS} WHERE (scene_id % 2 = 0 OR satname IN ('click', 'view')) AND quality % 7 NOT IN (1, 4) AND quality >= 40"


def slope_rows(spark, d):
    s = observations(spark, d).withColumn("in_range", F.col("chainage") < 60)
    some = sc.slope_rows(s, "2024-01-10", "2024-01-20", ("click",)).groupBy("satname").agg(F.count("*").alias("some"))
    none = sc.slope_rows(s, "1990-01-10", "1990-01-20", ("click",)).groupBy("satname").agg(F.count("*").alias("everything"))
    return none.join(some, "satname", "left")


SLOPE_ROWS = f"""WITH s AS (SELECT *, ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AS dated FROM {OBS}),
n AS (SELECT count(*) FILTER (dated AND chainage < 60 AND satname <> 'click') AS best, count(*) FILTER (dated) AS next FROM s)
SELECT satname, nullif(count(*) FILTER (CASE WHEN best > 0 THEN dated AND chainage < 60 AND satname <> 'click' WHEN next > 0 THEN dated ELSE true END), 0) AS "some", count(*) AS everything FROM s, n GROUP BY 1"""


def fft_spectrum(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    out = research.fft_spectrum(e, ["vec_id"], "i", "v", 0.5)
    return rounded(out, "frequency", "power", digits=5)


FFT = """WITH v AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i)),
p AS (SELECT vec_id, k, sum(v * cos(2 * pi() * k * i / 64)) AS a, sum(v * sin(2 * pi() * k * i / 64)) AS b FROM v, range(32) s(k) GROUP BY 1, 2)
SELECT vec_id, round(k / 32.0::DOUBLE, 5) AS frequency, round(a * a + b * b, 5) AS power FROM p"""


def seasonal(spark, d):
    s = long_series(spark, d).select("scene_id", research.seasonal(F.col("ts"), 12.0, 1 / 31_557_600).alias("value"))
    return rounded(s, "value", digits=4)


SEASONAL = f"SELECT scene_id, round(12 * sin(2 * pi() / 31557600 * (epoch_us(ts) / 1000000.0::DOUBLE)), 4) + 0.0::DOUBLE AS value FROM {LONG}"


def residuals(spark, d):
    s = long_series(spark, d).withColumn("day", F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000.0)
    z = research.standardised(s, ["transect_id"], "day", "chainage").where("y_std IS NOT NULL")
    r = z.withColumn("gap", research.residual(F.col("y_std"), F.col("x_std"), F.lit(0.0001), F.array(F.lit(-1.0), F.lit(0.5))))
    return rounded(research.skew_test(r, ["transect_id"], "gap"), "skewness", "z", digits=4)


RESIDUALS = f"""WITH s AS (SELECT transect_id, epoch_us(ts) / 86400000000.0::DOUBLE AS day, chainage FROM {LONG}),
z AS (SELECT transect_id, day - (min(day) OVER w + max(day) OVER w) / 2 AS x, (chainage - avg(chainage) OVER w) / stddev_samp(chainage) OVER w AS y FROM s WINDOW w AS (PARTITION BY transect_id)),
g AS (SELECT transect_id, y - (0.0001::DOUBLE * x - 1) AS a, y - (0.0001::DOUBLE * x + 0.5::DOUBLE) AS b FROM z WHERE y IS NOT NULL),
r AS (SELECT transect_id, CASE WHEN abs(b) < abs(a) THEN b ELSE a END AS gap FROM g),
m AS (SELECT transect_id, count(*) AS n, avg(gap) AS mean FROM r GROUP BY 1),
k AS (SELECT transect_id, n, avg((gap - mean) ** 3) / avg((gap - mean) ** 2) ** 1.5::DOUBLE AS g FROM r JOIN m USING (transect_id) GROUP BY 1, 2),
t AS (SELECT *, g * sqrt((n + 1) * (n + 3) / (6.0::DOUBLE * (n - 2))) AS y, 3.0::DOUBLE * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0::DOUBLE) * (n + 5) * (n + 7) * (n + 9)) AS b2 FROM k WHERE n >= 8),
u AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2 FROM t)
SELECT k.transect_id, k.n, round(k.g, 4) + 0.0::DOUBLE AS skewness, round(1 / sqrt(ln(w2) / 2) * asinh(y / sqrt(2 / (w2 - 1))), 4) + 0.0::DOUBLE AS z FROM k LEFT JOIN u USING (transect_id)"""


def signal_to_noise(spark, d):
    t = tiles(spark, d)
    g = research.semivariogram(t, "value", 3)
    noise = research.nugget(g)
    mean = t.groupBy("scene_id").agg(F.avg(F.abs("value")).alias("signal"))
    out = mean.join(noise, "scene_id").join(g.where("lag = 1").select("scene_id", F.col("gamma").alias("gamma_1")), "scene_id")
    return rounded(out.withColumn("add", research.noise_to_add(F.col("signal"), F.lit(20.0), F.lit(10.0))), "signal", "noise", "gamma_1", "add")


_GAMMA = f"SELECT a.scene_id, b.col - a.col AS lag, avg(sqrt(abs(a.value - b.value))) ** 4 / (0.457::DOUBLE + 0.494::DOUBLE / count(*) + 0.045::DOUBLE / (count(*) * count(*))) / 2 AS gamma FROM {TILES} a JOIN {TILES} b ON a.scene_id = b.scene_id AND a.row = b.row AND b.col BETWEEN a.col + 1 AND a.col + 3 GROUP BY 1, 2"
NOISE = f"""WITH g AS ({_GAMMA}), m AS (SELECT scene_id, avg(abs(value)) AS signal FROM {TILES} GROUP BY 1)
SELECT scene_id, round(signal, 6) AS signal, round(sqrt(greatest(regr_intercept(gamma, lag), 0)), 6) AS noise, round(max(gamma) FILTER (lag = 1), 6) AS gamma_1, round(sqrt((signal / 10) ** 2 - (signal / 20) ** 2), 6) AS "add"
FROM g JOIN m USING (scene_id) GROUP BY scene_id, signal"""


def gaussian_noise(spark, d):
    """All tiles of a label as one image each: a label's tiles lie below one another."""
    t = tiles(spark, d).withColumns({"row": F.col("scene_id") * 8 + F.col("row"), "scene_id": F.col("scene_id") % 7})
    fitted = research.gaussian_model(research.semivariogram(t, "value", 7), 20)
    return rounded(fitted.withColumn("noise", F.sqrt("nugget")).drop("misfit"), "reach", "sill", "nugget", "noise", digits=4)


def _fit_sql(source: str, grid: str) -> str:
    return f"""(SELECT scene_id, arg_min(r, (round(misfit, 12), r)) AS r, arg_min(sill, (round(misfit, 12), r)) AS sill, arg_min(nugget, (round(misfit, 12), r)) AS nugget, any_value(step) AS step FROM (
  SELECT *, sgg - 2 * sill * seg - 2 * nugget * sg + sill * sill * see + 2 * sill * nugget * se + n * nugget * nugget AS misfit FROM (
    SELECT *, CASE WHEN c IS NULL OR c < 0 THEN 0 WHEN b < 0 THEN greatest(seg / see, 0) ELSE c END AS sill, CASE WHEN c IS NULL OR c < 0 THEN sg / n WHEN b < 0 THEN 0 ELSE b END AS nugget FROM (
      SELECT *, (sg - c * se) / n AS b FROM (
        SELECT *, (n * seg - se * sg) / nullif(n * see - se * se, 0) AS c FROM (
          SELECT scene_id, r, step, count(*) AS n, sum(e) AS se, sum(gamma) AS sg, sum(e * e) AS see, sum(e * gamma) AS seg, sum(gamma * gamma) AS sgg
          FROM (SELECT scene_id, r, step, gamma, 1 - exp(-((2 * lag / r) ** 2)) AS e FROM {source} JOIN {grid} USING (scene_id)) GROUP BY 1, 2, 3))))) GROUP BY 1)"""


_STACKED = f"(SELECT scene_id % 7 AS scene_id, scene_id * 8 + row AS row, col, value FROM {TILES})"
GAUSSIAN = f"""WITH t AS MATERIALIZED {_STACKED}, g AS MATERIALIZED (
  SELECT a.scene_id, (b.col - a.col)::DOUBLE AS lag, avg(sqrt(abs(a.value - b.value))) ** 4 / (0.457::DOUBLE + 0.494::DOUBLE / count(*) + 0.045::DOUBLE / (count(*)::DOUBLE * count(*))) / 2 AS gamma
  FROM t a JOIN t b ON a.scene_id = b.scene_id AND a.row = b.row AND b.col BETWEEN a.col + 1 AND a.col + 7 GROUP BY 1, 2),
s AS (SELECT scene_id, max(lag) AS top FROM g GROUP BY 1),
k AS MATERIALIZED (SELECT scene_id, top / 20 AS step, n * top / 20 AS r FROM s, range(1, 21) x(n)), f AS MATERIALIZED {_fit_sql("g", "k")},
l AS MATERIALIZED (SELECT scene_id, step, r + n * step / 20 AS r FROM f JOIN s USING (scene_id), range(-19, 20) x(n) WHERE r + n * step / 20 > 0 AND r + n * step / 20 <= top), h AS {_fit_sql("g", "l")}
SELECT scene_id, round(r, 4) AS reach, round(sill, 4) + 0.0::DOUBLE AS sill, round(nugget, 4) + 0.0::DOUBLE AS nugget, round(sqrt(nugget), 4) + 0.0::DOUBLE AS noise FROM h"""


def metric_gates(spark, d):
    p = points(spark, d).withColumn("similarity", F.abs("x") / 20)
    out = p.where(~research.outlying(F.col("y"), -15, 15)).groupBy("scene_id").agg(F.count("*").alias("n"), F.count(research.floored(F.col("similarity"))).alias("alike"))
    return out


GATES = f"SELECT scene_id, count(*) AS n, count(*) FILTER (abs(x) / 20 >= 0.6::DOUBLE) AS alike FROM {POINTS} WHERE y BETWEEN -15 AND 15 GROUP BY 1"


def common_rows(spark, d):
    a = observations(spark, d).select("scene_id", "chainage")
    b = long_series(spark, d).select("scene_id", F.col("chainage").alias("other"))
    return rounded(research.common_rows(a, b, ["scene_id"]), "chainage", "other")


COMMON = f"SELECT scene_id, round(a.chainage, 6) AS chainage, round(b.chainage, 6) AS other FROM {OBS} a JOIN {LONG} b USING (scene_id)"


def utc_times(spark, d):
    o = observations(spark, d)
    return o.select("scene_id", boxes.utc(F.col("ts").cast("timestamp_ntz"), "Australia/Sydney").alias("utc"))


UTC = f"SELECT scene_id, (ts AT TIME ZONE 'Australia/Sydney') AT TIME ZONE 'UTC' AS utc FROM {OBS}"


def image_geometries(spark, d):
    s = _segments(spark, d).select((F.col("seg_id") % 9 * 10.0).alias("xtr"), (F.col("seg_id") % 4 * 10.0 + 1e-9).alias("ytr"), (F.col("scene_id") % 2).alias("epsg"))
    return outlines.geometries(s, ["xtr", "ytr"]).select("xtr", "ytr", "epsg")


GEOMETRIES = f"SELECT DISTINCT (seg_id % 9 * 10)::DOUBLE AS xtr, (seg_id % 4 * 10)::DOUBLE AS ytr, scene_id % 2 AS epsg FROM {_SEG}"

QUERIES = {
    "g6_clip_lines": clip_lines, "g8_g23_snap_boxes": snap_boxes, "g20_query_circles": circles, "g22_image_bounds": image_bounds, "g23_overlaps": overlaps, "g26_not_contained": not_contained,
    "f14_inside_image": inside_image, "g27_pixel_lines": pixel_lines, "g28_centroids": centroids, "g25_nearest_three": nearest_three, "g25_w11_runs_and_zones": runs_and_zones, "j17_cloud_range": cloud_range,
    "f25_usable_pixels": usable_pixels, "f5_f6_f13_scene_choice": scene_choice, "f12_f17_f19_slope_rows": slope_rows, "t17_fft_spectrum": fft_spectrum, "t18_seasonal": seasonal, "m12_residuals": residuals,
    "r26_signal_to_noise": signal_to_noise, "r26_gaussian_noise": gaussian_noise, "f26_f28_metric_gates": metric_gates, "u4_w13_common_rows": common_rows, "c24_utc_times": utc_times, "j16_image_geometries": image_geometries,
}
SQL = {
    "g6_clip_lines": CLIP, "g8_g23_snap_boxes": SNAP, "g20_query_circles": CIRCLES, "g22_image_bounds": BOUNDS, "g23_overlaps": OVERLAPS, "g26_not_contained": NOT_CONTAINED,
    "f14_inside_image": INSIDE, "g27_pixel_lines": PIXEL_LINES, "g28_centroids": CENTROIDS, "g25_nearest_three": NEAREST_THREE, "g25_w11_runs_and_zones": RUNS, "j17_cloud_range": CLOUDS,
    "f25_usable_pixels": USABLE, "f5_f6_f13_scene_choice": CHOICE, "f12_f17_f19_slope_rows": SLOPE_ROWS, "t17_fft_spectrum": FFT, "t18_seasonal": SEASONAL, "m12_residuals": RESIDUALS,
    "r26_signal_to_noise": NOISE, "r26_gaussian_noise": GAUSSIAN, "f26_f28_metric_gates": GATES, "u4_w13_common_rows": COMMON, "c24_utc_times": UTC, "j16_image_geometries": GEOMETRIES,
}
