"""Zones, level sweeps and method evaluation over tiles of 8 x 8 pixels (an embedding each).

The reference line of a scene runs down the tile: point idx at row idx and column
3 + idx % 3. The buffer is columns 1 to 6; every eleventh pixel is cloud.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.spectral import nd
from ..operators import evaluate, thresholds, zones
from .frames import rounded
from .rasters import TILES, tiles
from .space import _otsu_sql

_CLOUD = "(scene_id + row + col) % 11 = 0"


def _pixels(spark, d):
    return tiles(spark, d).withColumns({"in_buffer": F.col("col").between(1, 6), "cloud": F.expr(_CLOUD)})


def _refs(spark, d):
    r = tiles(spark, d).where("col = 0").select("scene_id", F.col("row").alias("idx"))
    return r.withColumns({"row": F.col("idx").cast("double"), "col": (3 + F.col("idx") % 3).cast("double"), "zone": F.floor(F.col("idx") / 3)})


_P = f"(SELECT scene_id, row, col, value, col BETWEEN 1 AND 6 AS in_buffer, {_CLOUD} AS cloud FROM {TILES})"
_R = f"(SELECT scene_id, row AS idx, row::DOUBLE AS r, (3 + row % 3)::DOUBLE AS c, row // 3 AS zone FROM {TILES} WHERE col = 0)"


def zone_indicators(spark, d):
    found = zones.zone_indicators(_pixels(spark, d), _refs(spark, d).drop("zone"), 2, 0.5)
    return rounded(found.select("scene_id", "idx", "statistic", "p_value", "zone"), "statistic", "p_value")


INDICATORS = f"""WITH w AS (
  SELECT p.scene_id, idx, value AS v FROM {_R} f JOIN {_P} p ON p.scene_id = f.scene_id AND in_buffer
    AND p.row BETWEEN r - 2 AND r + 1 AND p.col BETWEEN c - 2 AND c + 1),
u AS (SELECT scene_id, idx, v, 1 AS a, 0 AS b FROM w UNION ALL SELECT scene_id, idx + 1, v, 0, 1 FROM w),
g AS (SELECT scene_id, idx, v, sum(a) AS a, sum(b) AS b FROM u GROUP BY ALL),
d AS (
  SELECT scene_id, idx, sum(a) OVER o AS na, sum(b) OVER o AS nb, abs(sum(a) OVER u / sum(a) OVER o - sum(b) OVER u / sum(b) OVER o) AS d FROM g
  WINDOW u AS (PARTITION BY scene_id, idx ORDER BY v ROWS UNBOUNDED PRECEDING), o AS (PARTITION BY scene_id, idx)),
k AS (SELECT scene_id, idx, max(d) AS s, max(d) * sqrt(any_value(na) * any_value(nb) / (any_value(na) + any_value(nb))) AS x FROM d WHERE na > 0 AND nb > 0 GROUP BY 1, 2),
p AS (
  SELECT scene_id, idx, s, CASE WHEN x < 0.2 THEN 1 WHEN x IS NOT NULL THEN
    least(greatest(2 * list_sum(list_transform(range(1, 41), lambda k: (-1) ** (k - 1) * exp(-2.0::DOUBLE * k * k * x * x))), 0), 1) END AS p
  FROM {_R} LEFT JOIN k USING (scene_id, idx)),
z AS (SELECT *, coalesce(p < 0.5, false) AND NOT coalesce(lead(p) OVER (PARTITION BY scene_id ORDER BY idx) < 0.5, false) AS begins FROM p)
SELECT scene_id, idx, round(s, 6) + 0.0::DOUBLE AS statistic, round(p, 6) + 0.0::DOUBLE AS p_value,
  sum(begins::INTEGER) OVER (PARTITION BY scene_id ORDER BY idx)::BIGINT AS zone FROM z"""


def partition(spark, d):
    return zones.partition_buffer(_pixels(spark, d), _refs(spark, d), 2.0)


_NEAREST = "arg_min({what}, (sqrt((c - {x}) ** 2 + (r - {y}) ** 2), idx))"
PARTITION = f"SELECT scene_id, row, col, {_NEAREST.format(what='zone', x='col', y='row')} AS zone FROM {_P} JOIN {_R} USING (scene_id) WHERE in_buffer GROUP BY ALL"


def extraction(spark, d):
    points, found = zones.zone_contours(_pixels(spark, d), _refs(spark, d), 1.5, size=2.0)
    p = points.groupBy("scene_id", "zone").agg(F.count("*").alias("n"), *(F.sum(F.col(c).cast("decimal(18,9)")).cast("double").alias(f"{c}s") for c in ("row", "col")))
    return rounded(found.join(p, ["scene_id", "zone"], "left"), "threshold", "rows", "cols", digits=5)


_EDGES = """SELECT {by}, r::DOUBLE AS y, k + (level - a) / (b - a) AS x FROM {cells} WHERE (a > level) <> (b > level)
  UNION ALL SELECT {by}, r + (level - b) / (c - b), (k + 1)::DOUBLE FROM {cells} WHERE (b > level) <> (c > level)
  UNION ALL SELECT {by}, (r + 1)::DOUBLE, k + (level - d) / (c - d) FROM {cells} WHERE (d > level) <> (c > level)
  UNION ALL SELECT {by}, r + (level - a) / (d - a), k::DOUBLE FROM {cells} WHERE (a > level) <> (d > level)"""


def _points_sql(cells: str, by: str) -> str:
    return f"(SELECT DISTINCT {by}, round(y, 9) AS y, round(x, 9) AS x FROM ({_EDGES.format(by=by, cells=cells)}))"


def _cells_sql(pixels: str, by: str, value: str = "value") -> str:
    same = " AND ".join(f"{{t}}.{c} = a.{c}" for c in by.split(", "))
    to = lambda t, dr, dc: f"JOIN {pixels} {t} ON {same.format(t=t)} AND {t}.row = a.row + {dr} AND {t}.col = a.col + {dc}"
    own = ", ".join(f"a.{c}" for c in by.split(", "))
    return f"SELECT {own}, a.row AS r, a.col AS k, a.{value} AS a, b.{value} AS b, c.{value} AS c, d.{value} AS d FROM {pixels} a {to('b', 0, 1)} {to('c', 1, 1)} {to('d', 1, 0)}"


_T = "greatest(least(coalesce(((col + 0.5::DOUBLE - x0) * (x1 - x0) + (row + 0.5::DOUBLE - y0) * (y1 - y0)) / nullif((x1 - x0) ** 2 + (y1 - y0) ** 2, 0), 0), 1), 0)"
_ZONED = f"""(SELECT DISTINCT scene_id, zone, row, col, value FROM (
  SELECT scene_id, zone, c AS x0, r AS y0, lead(c) OVER z AS x1, lead(r) OVER z AS y1 FROM {_R} WINDOW z AS (PARTITION BY scene_id, zone ORDER BY idx)) JOIN {_P} USING (scene_id)
  WHERE x1 IS NOT NULL AND NOT cloud AND sqrt((col + 0.5::DOUBLE - x0 - {_T} * (x1 - x0)) ** 2 + (row + 0.5::DOUBLE - y0 - {_T} * (y1 - y0)) ** 2) <= 1.5)"""
_EXACT = lambda sql: sql.replace("round(min_by(c, (-var, bin)), 6) + 0.0::DOUBLE", "min_by(c, (-var, bin))")
EXTRACTION = f"""WITH zp AS MATERIALIZED {_ZONED}, t AS MATERIALIZED ({_EXACT(_otsu_sql("zp", "scene_id, zone", "value", 256))}),
cl AS (SELECT *, threshold AS level FROM ({_cells_sql("zp", "scene_id, zone")}) JOIN t USING (scene_id, zone)),
pt AS {_points_sql("cl", "scene_id, zone")},
own AS (SELECT pt.scene_id, pt.zone, y, x, {_NEAREST.format(what='f.zone', x='x', y='y')} AS held FROM pt JOIN {_R} f ON f.scene_id = pt.scene_id GROUP BY ALL),
s AS (SELECT scene_id, zone, count(*) AS n, sum(y::DECIMAL(18,9))::DOUBLE AS rows, sum(x::DECIMAL(18,9))::DOUBLE AS cols FROM own WHERE zone = held GROUP BY 1, 2)
SELECT scene_id, zone, round(threshold, 5) + 0.0::DOUBLE AS threshold, n, round(rows, 5) AS rows, round(cols, 5) AS cols FROM t LEFT JOIN s USING (scene_id, zone)"""


def local_extraction(spark, d):
    points, found = zones.point_contours(_pixels(spark, d), _refs(spark, d).drop("zone"), 2, lambda df, group, value: thresholds.otsu(df, group, value, 32), 2.0)
    p = points.groupBy("scene_id", "idx").agg(F.count("*").alias("n"), *(F.sum(F.col(c).cast("decimal(18,9)")).cast("double").alias(f"{c}s") for c in ("row", "col")))
    return rounded(found.join(p, ["scene_id", "idx"], "left"), "threshold", "rows", "cols", digits=5)


_WINDOWED = f"""(SELECT p.scene_id, idx, row, col, value FROM {_R} f JOIN {_P} p ON p.scene_id = f.scene_id AND in_buffer AND NOT cloud
  AND p.row BETWEEN r - 2 AND r + 1 AND p.col BETWEEN c - 2 AND c + 1)"""
LOCAL = f"""WITH wp AS MATERIALIZED {_WINDOWED}, t AS MATERIALIZED ({_EXACT(_otsu_sql("wp", "scene_id, idx", "value", 32))}),
cl AS (SELECT *, threshold AS level FROM ({_cells_sql("wp", "scene_id, idx")}) JOIN t USING (scene_id, idx)),
pt AS {_points_sql("cl", "scene_id, idx")},
own AS (SELECT pt.scene_id, pt.idx, y, x, arg_min(f.idx, (sqrt((c - x) ** 2 + (r - y) ** 2), f.idx)) AS held FROM pt JOIN {_R} f ON f.scene_id = pt.scene_id GROUP BY ALL),
s AS (SELECT scene_id, idx, count(*) AS n, sum(y::DECIMAL(18,9))::DOUBLE AS rows, sum(x::DECIMAL(18,9))::DOUBLE AS cols FROM own WHERE idx = held GROUP BY 1, 2)
SELECT scene_id, idx, round(threshold, 5) + 0.0::DOUBLE AS threshold, n, round(rows, 5) AS rows, round(cols, 5) AS cols FROM t LEFT JOIN s USING (scene_id, idx)"""


STEPS = 25


def best_level(spark, d):
    return rounded(zones.optimal_threshold(_pixels(spark, d), _refs(spark, d).drop("zone"), STEPS, 2.0), "level", "error")


BEST_LEVEL = f"""WITH s AS (SELECT scene_id, min(value) AS lo, (max(value) - min(value)) / {STEPS - 1} AS step FROM {_P} WHERE in_buffer GROUP BY 1),
px AS MATERIALIZED (SELECT * FROM {_P} WHERE in_buffer AND NOT cloud),
cl AS MATERIALIZED (SELECT *, lo + n * step AS level FROM ({_cells_sql("px", "scene_id")}) JOIN s USING (scene_id), range({STEPS}) t(n)),
pt AS {_points_sql("cl", "scene_id, n, level")},
near AS (SELECT scene_id, n, level, idx, min(sqrt((c - x) ** 2 + (f.r - y) ** 2)) AS distance FROM pt JOIN {_R} f USING (scene_id) GROUP BY ALL),
e AS (SELECT scene_id, n, level, avg(distance) AS error FROM near GROUP BY ALL)
SELECT scene_id, round(arg_min(level, (round(error, 9), n)), 6) + 0.0::DOUBLE AS level, round(arg_min(error, (round(error, 9), n)), 6) AS error FROM e GROUP BY 1"""


def evaluation(spark, d):
    p = _pixels(spark, d)
    band = lambda k: F.abs(F.col("value") + k / 50) + 0.01
    indices = {"mndwi": nd(band(1), band(4)), "ndwi": nd(band(1), band(3))}
    methods = {"otsu": lambda df, group, value: thresholds.otsu(df, group, value, 64), "zero": zones.zero_threshold}
    found = zones.method_distances(p, _refs(spark, d).drop("zone"), indices, methods, 2.0)
    scores = found.select("method", (F.col("scene_id") * 8 + F.col("idx")).alias("point_id"), "distance")
    return rounded(evaluate.method_summary(scores, 2.0, 1), "mean_without_outliers", "mean", "std", "mean_abs", digits=5)


def _evaluation_sql() -> str:
    band = lambda k: f"(abs(value + {k / 50}::DOUBLE) + 0.01::DOUBLE)"
    stacked = " UNION ALL ".join(f"SELECT scene_id, '{n}' AS i, row, col, ({band(a)} - {band(b)}) / ({band(a)} + {band(b)}) AS value FROM {_P} WHERE in_buffer AND NOT cloud" for n, a, b in (("mndwi", 1, 4), ("ndwi", 1, 3)))
    return f"""WITH px AS MATERIALIZED ({stacked}), o AS MATERIALIZED ({_EXACT(_otsu_sql("px", "scene_id, i", "value", 64))}),
lv AS (SELECT scene_id, i, i || '__otsu' AS method, threshold AS level FROM o UNION ALL SELECT DISTINCT scene_id, i, i || '__zero', 0.0::DOUBLE FROM px),
cl AS MATERIALIZED (SELECT * FROM ({_cells_sql("px", "scene_id, i")}) JOIN lv USING (scene_id, i)),
pt AS {_points_sql("cl", "scene_id, method")},
near AS (SELECT scene_id, method, idx, min(sqrt((c - x) ** 2 + (f.r - y) ** 2)) AS distance FROM pt JOIN {_R} f USING (scene_id) GROUP BY ALL),
odd AS (SELECT scene_id, idx, count(*) FILTER (distance > 2) > 1 AS odd FROM near GROUP BY 1, 2)
SELECT method, round(avg(distance) FILTER (NOT odd), 5) AS mean_without_outliers, round(avg(distance), 5) AS mean, round(stddev_pop(distance), 5) AS std,
  count(*) FILTER (distance > 2) AS n_far, round(avg(distance), 5) AS mean_abs FROM near JOIN odd USING (scene_id, idx) GROUP BY method"""


QUERIES = {
    "il4_zone_indicators": zone_indicators,
    "il5_buffer_partition": partition,
    "il2_zone_extraction": extraction,
    "il1_local_extraction": local_extraction,
    "it6_optimal_threshold": best_level,
    "m13_method_evaluation": evaluation,
}
SQL = {
    "il4_zone_indicators": INDICATORS,
    "il5_buffer_partition": PARTITION,
    "il2_zone_extraction": EXTRACTION,
    "il1_local_extraction": LOCAL,
    "it6_optimal_threshold": BEST_LEVEL,
    "m13_method_evaluation": _evaluation_sql(),
}
