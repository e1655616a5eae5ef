"""Zones along a reference line, each with its own threshold and contour.

refs: scene_id, idx, row, col: points of a reference line, in order, on the pixel
grid. pixels: scene_id, row, col, value, cloud, in_buffer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import distance, segment_distance
from . import thresholds
from .joins import cell, nearest
from .outlines import zones_of_points
from .raster import TILE, cell_pieces, cells, contour_points

LINE = ["scene_id"]
#: Reference points of a scene that are brought to its pixels' rows whole.
FEW = 64


def windows(pixels: DataFrame, refs: DataFrame, half: int) -> DataFrame:
    """scene_id, idx, row, col, value: the buffer's pixels in the square from `half` before each reference point to just before `half` after it.

    A point goes to the cells that its window touches (four at most), so the join
    is an equality on scene and cell.
    """
    size = 2 * half
    over = lambda c: F.explode(F.sequence(cell(F.col(c) - half, size), cell(F.col(c) + half, size)))
    w = refs.select("scene_id", "idx", F.floor("row").alias("_r"), F.floor("col").alias("_c"), F.col("row"), F.col("col")).withColumn("_cr", over("row")).withColumn("_cc", over("col")).drop("row", "col")
    p = pixels.where("in_buffer").select("scene_id", "row", "col", "value").withColumns({"_cr": cell(F.col("row"), size), "_cc": cell(F.col("col"), size)})
    inside = F.col("row").between(F.col("_r") - half, F.col("_r") + half - 1) & F.col("col").between(F.col("_c") - half, F.col("_c") + half - 1)
    return p.join(w, ["scene_id", "_cr", "_cc"]).where(inside).select("scene_id", "idx", "row", "col", "value")


def zone_indicators(pixels: DataFrame, refs: DataFrame, half: int = 50, least: float = 0.05) -> DataFrame:
    """refs plus statistic, p_value and zone.

    Each point's window is held against that of the point before by a two-sample
    Kolmogorov-Smirnov test; a p value under `least` begins a zone, unless the next
    point begins one too. The first point, and points whose windows are empty,
    begin none.
    """
    own = windows(pixels, refs, half)
    before = own.withColumn("idx", F.col("idx") + 1)
    tested = thresholds.ks_test(own, before, ["scene_id", "idx"], "value").where("n_a > 0 AND n_b > 0").select("scene_id", "idx", "statistic", "p_value")
    return zones_of_points(refs.join(tested, ["scene_id", "idx"], "left"), LINE, "p_value", least)


def _parted(refs: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(scene_id, _refs: the columns of all reference points of each scene that has FEW at most; the other scenes' refs, None where there are none)."""
    r = refs.withColumn("_n", F.count("*").over(W.partitionBy("scene_id")))
    few = r.where(F.col("_n") <= FEW).groupBy("scene_id").agg(F.collect_list(F.struct(*columns)).alias("_refs"))
    many = r.where(F.col("_n") > FEW).drop("_n")
    return few, None if refs.groupBy("scene_id").count().where(F.col("count") > FEW).isEmpty() else many


def nearest_reference(points: DataFrame, refs: DataFrame, key: list[str], size: float = 8.0) -> DataFrame:
    """points (scene_id, row, col, key) plus idx, zone and distance of the nearest reference point of their scene, ties to the lesser idx.

    A scene's reference points come to each of its points where they are FEW at
    most; in other scenes they are looked up by growing cells.
    """
    few, many = _parted(refs, ["idx", "zone", "row", "col"])
    gap = lambda r: distance(F.col("col"), F.col("row"), r["col"], r["row"])
    best = F.array_min(F.transform("_refs", lambda r: F.struct(gap(r).alias("distance"), r["idx"].alias("idx"), r["zone"].alias("zone"))))
    out = points.join(few.hint("merge"), "scene_id").withColumn("_best", best).select(*points.columns, "_best.idx", "_best.zone", "_best.distance")
    if many is None:
        return out
    at = lambda df: df.withColumns({"x": F.col("col").cast("double"), "y": F.col("row").cast("double")})
    found = nearest(at(points), at(many), key, "idx", size, LINE).select("scene_id", *key, "idx", "distance")
    return out.unionByName(points.join(found, ["scene_id", *key]).join(many.select("scene_id", "idx", "zone"), ["scene_id", "idx"]))


def partition_buffer(pixels: DataFrame, refs: DataFrame, size: float = 8.0) -> DataFrame:
    """scene_id, row, col, zone of the buffer's pixels: the zone of the nearest reference point."""
    p = pixels.where("in_buffer").select("scene_id", "row", "col")
    return nearest_reference(p, refs, ["row", "col"], size).select("scene_id", "row", "col", "zone")


def zone_pixels(pixels: DataFrame, refs: DataFrame, radius: float = 10.0) -> DataFrame:
    """pixels plus zone, a row for each zone whose line is at most `radius` from the pixel's centre (half a pixel down and right of its index).

    A zone's line joins its reference points in order; a zone of one point has no
    line and no pixels. Zones overlap at their ends.
    """
    w = W.partitionBy("scene_id", "zone").orderBy("idx")
    lines = refs.select("scene_id", "zone", F.col("col").alias("x0"), F.col("row").alias("y0"), F.lead("col").over(w).alias("x1"), F.lead("row").over(w).alias("y1")).where("x1 IS NOT NULL")
    over = lambda a, b: F.explode(F.sequence(cell(F.least(a, b) - radius, radius), cell(F.greatest(a, b) + radius, radius)))
    lines = lines.withColumn("_cx", over("x0", "x1")).withColumn("_cy", over("y0", "y1"))
    placed = pixels.withColumns({"_x": F.col("col") + 0.5, "_y": F.col("row") + 0.5})
    placed = placed.withColumns({"_cx": cell(F.col("_x"), radius), "_cy": cell(F.col("_y"), radius)})
    near = segment_distance(*(F.col(c) for c in ("_x", "_y", "x0", "y0", "x1", "y1"))) <= radius
    met = placed.join(lines, ["scene_id", "_cx", "_cy"]).where(near)
    return met.select(*pixels.columns, "zone").dropDuplicates(["scene_id", "row", "col", "zone"])


def zone_contours(pixels: DataFrame, refs: DataFrame, radius: float = 10.0, threshold: Callable = thresholds.otsu, size: float = 8.0) -> tuple[DataFrame, DataFrame]:
    """(points: scene_id, zone, row, col; thresholds: scene_id, zone, threshold).

    Each zone's threshold comes from its own clear pixels, and its contour is drawn
    in them. Of the contour's points those stay whose nearest reference point is of
    the zone, so that overlapping zones give each stretch of shore once. All zones
    of all scenes are one plan: a zone is a part of the key.
    """
    by = ["scene_id", "zone"]
    inside = zone_pixels(pixels, refs, radius).where("NOT cloud")
    found = threshold(inside, by, "value")
    pieces = cell_pieces(cells(inside, "value", by).join(found, by), F.col("threshold"), by)
    points = contour_points(pieces, by)
    held = nearest_reference(points.withColumnRenamed("zone", "_own"), refs, ["_own", "row", "col"], size)
    return held.where("zone = _own").select("scene_id", "zone", "row", "col"), found


def point_contours(pixels: DataFrame, refs: DataFrame, half: int = 50, threshold: Callable = thresholds.otsu, size: float = 8.0) -> tuple[DataFrame, DataFrame]:
    """(points: scene_id, idx, row, col; thresholds: scene_id, idx, threshold): zone_contours with a square window as each reference point's zone.

    A pixel is in the windows of all points near it; of a window's contour those
    points stay that are nearest to its own reference point.
    """
    by = ["scene_id", "idx"]
    inside = windows(pixels.where("NOT cloud"), refs, half)
    found = threshold(inside, by, "value")
    pieces = cell_pieces(cells(inside, "value", by).join(found, by), F.col("threshold"), by)
    points = contour_points(pieces, by).withColumnRenamed("idx", "_own")
    held = nearest_reference(points, refs.withColumn("zone", F.col("idx")), ["_own", "row", "col"], size)
    return held.where("idx = _own").select("scene_id", "idx", "row", "col"), found


def level_sweep(pixels: DataFrame, refs: DataFrame, steps: int = 200, size: float = 4.0) -> DataFrame:
    """scene_id, step, level, error: the mean distance of the reference points (scene_id, idx, row, col) to the contour at each of `steps` levels.

    Levels are even from the least to the greatest value in the buffer. Each cell
    of the clear buffer gives only the levels between its corners' least and
    greatest value, so all contours come from one pass over the pixels. Levels
    without a contour are absent.
    """
    inside = thresholds.finite(pixels.where("in_buffer"), "value")
    span = inside.groupBy("scene_id").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / (steps - 1)
    least, most = F.least("a", "b", "c", "d"), F.greatest("a", "b", "c", "d")
    number = lambda v: F.try_divide(v - F.col("_lo"), step)
    # a step further on each side: rounding decides nothing, cell_pieces drops levels that don't cross
    first, last = F.greatest(F.floor(number(least)) - 1, F.lit(0)), F.least(F.ceil(number(most)) + 1, F.lit(steps - 1))
    c = cells(inside.where("NOT cloud"), "value", tile=TILE)
    level = F.col("_lo") + F.col("step") * step
    swept = lambda c: c.withColumn("step", F.explode(F.sequence(first.cast("int"), last.cast("int")))).withColumn("level", level)
    by = ["scene_id", "step"]
    found = cell_distances(c, span.where("_hi > _lo"), LINE, swept, F.col("level"), refs, by, size)
    return found.groupBy(*by).agg(F.avg("distance").alias("error")).join(span, "scene_id").select("scene_id", "step", level.alias("level"), "error")


def cell_distances(c: DataFrame, beside: DataFrame, on: list[str], spread: Callable, level: Column, refs: DataFrame, by: list[str], size: float = 4.0) -> DataFrame:
    """by, idx, distance of each reference point to the nearest contour point of each group of its scene.

    c: cells by `on` with their tiles; beside: rows by `on` that each of them gets;
    spread: a function of both that makes the rows of by, each with its level.
    Where a scene's reference points are FEW at most, they come to its tiles, and a
    tile's rows are brought down to the least distances where they lie; in other
    scenes contour points are looked up by growing cells.
    """
    few, many = _parted(refs, ["idx", "row", "col"])
    where = [*on, "_tr", "_tc"]
    tiles = c.select(*where).distinct().join(beside, on).join(few, "scene_id")
    # Spark takes exploded arrays for small: without the hint it may broadcast all cells
    pieces = cell_pieces(spread(c.join(tiles.hint("merge"), where)), level, [*by, "_refs"])
    ends = pieces.select(*by, "_refs", F.explode(F.array("p", "q")).alias("e")).select(*by, "_refs", F.round("e.row", 9).alias("_y"), F.round("e.col", 9).alias("_x"))
    met = ends.select(*by, "_y", "_x", F.explode("_refs").alias("r"))
    out = met.groupBy(*by, "r.idx").agg(F.min(distance(F.col("_x"), F.col("_y"), F.col("r.col"), F.col("r.row"))).alias("distance"))
    if many is None:
        return out
    points = contour_points(cell_pieces(spread(c.join(beside, on)), level, by), by)
    return out.unionByName(point_distances(points, many, by, size))


def point_distances(points: DataFrame, refs: DataFrame, by: list[str], size: float = 4.0) -> DataFrame:
    """by, idx, distance of each reference point to the nearest of the points (by, row, col) of each group of its scene."""
    at = lambda df: df.withColumns({"x": F.col("col").cast("double"), "y": F.col("row").cast("double")})
    asked = at(points.select(*by).distinct().join(refs, "scene_id"))
    return nearest(asked, at(points).withColumn("_at", F.struct("row", "col")), ["idx"], "_at", size, by).select(*by, "idx", "distance")


def optimal_threshold(pixels: DataFrame, refs: DataFrame, steps: int = 200, size: float = 4.0) -> DataFrame:
    """scene_id, level, error: the level of the sweep with the least error, the lowest on ties to 9 digits."""
    swept = level_sweep(pixels, refs, steps, size)
    best = F.struct(F.round("error", 9), "step")
    return swept.groupBy("scene_id").agg(F.min_by("level", best).alias("level"), F.min_by("error", best).alias("error"))


def method_distances(pixels: DataFrame, refs: DataFrame, indices: dict, methods: dict[str, Callable], size: float = 4.0) -> DataFrame:
    """scene_id, method, idx, distance: every index under every threshold method, in one plan over one scan of the pixels.

    indices: names and columns over the pixels' bands. methods: names and functions
    of (frame, group, value) that give group and threshold. A method is named
    index__threshold. Index values are stacked, so each step runs once for all.
    """
    by = ["scene_id", "index_name"]
    stacked = F.explode(F.array(*(F.struct(F.lit(n).alias("index_name"), c.cast("double").alias("value")) for n, c in indices.items()))).alias("i")
    inside = pixels.where("in_buffer AND NOT cloud").select("scene_id", "row", "col", stacked).select("scene_id", "row", "col", "i.*")
    found = None
    for name, method in methods.items():
        one = method(inside, by, "value").select(*by, F.lit(name).alias("threshold_name"), F.col("threshold").cast("double").alias("threshold"))
        found = one if found is None else found.unionByName(one)
    levels = found.select(*by, F.concat_ws("__", "index_name", "threshold_name").alias("method"), "threshold")
    return cell_distances(cells(inside, "value", by, TILE), levels, by, lambda c: c, F.col("threshold"), refs, ["scene_id", "method"], size)


def zero_threshold(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, threshold: 0 for every group."""
    return df.select(*group).distinct().withColumn("threshold", F.lit(0.0))
