"""Polygons, masks along a line, zones and clouds: what stands near what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.boxes import contains
from ..functions.geometry import distance
from .joins import nearest, transect_points


def centroids(vertices: DataFrame, key: list[str]) -> DataFrame:
    """key, x, y, area: centroid of each polygon of vertices (idx, x, y), by shoelace sums.

    The polygon closes itself. Without an area, the mean of its vertices. A
    negative x of degrees can be shifted by the caller (east_of_greenwich).
    """
    w = W.partitionBy(*key).orderBy("idx")
    first = lambda c: F.first(c).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    v = vertices.withColumns({"_x": F.coalesce(F.lead("x").over(w), first("x")), "_y": F.coalesce(F.lead("y").over(w), first("y"))})
    cross = F.col("x") * F.col("_y") - F.col("_x") * F.col("y")
    s = v.groupBy(*key).agg(F.sum(cross).alias("_a"), F.sum((F.col("x") + F.col("_x")) * cross).alias("_sx"), F.sum((F.col("y") + F.col("_y")) * cross).alias("_sy"), F.avg("x").alias("_mx"), F.avg("y").alias("_my"))
    at = lambda total, mean: F.coalesce(F.try_divide(total, 3 * F.col("_a")), mean)
    return s.select(*key, at(F.col("_sx"), F.col("_mx")).alias("x"), at(F.col("_sy"), F.col("_my")).alias("y"), (F.abs("_a") / 2).alias("area"))


def largest_part(parts: DataFrame, key: list[str]) -> DataFrame:
    """Of a multipolygon's parts (with area, x, y) the largest one's centroid, the lesser x on ties."""
    return parts.groupBy(*key).agg(F.max_by(F.struct("x", "y"), F.struct("area", -F.col("x"))).alias("c")).select(*key, "c.x", "c.y")


def east_of_greenwich(lon: Column) -> Column:
    return F.when(lon < 0, lon + 360).otherwise(lon)


def not_contained(images: DataFrame, site: list[str]) -> DataFrame:
    """Images (image_id, unlike inside a site; box) that no other image of their site contains; of equal ones the lesser id stays.

    Each different box is put into the cells, of a size of its own order, that it
    covers (four at most), and looked up at its corner in the cells of each larger
    size that its site has. Images without a box or a site stay.
    """
    own = images.where(F.col("box").isNotNull()).groupBy(*site, "box").agg(F.min("image_id").alias("_least")).dropna(subset=site)
    wide = F.greatest(F.col("box.x_max") - F.col("box.x_min"), F.col("box.y_max") - F.col("box.y_min"), F.lit(1e-9))
    own = own.withColumn("_level", F.ceil(F.log2(wide)).cast("int"))
    at = lambda v: F.floor(F.col(f"box.{v}") / F.pow(F.lit(2.0), F.col("_level"))).cast("long")
    outer = own.withColumn("_cx", F.explode(F.sequence(at("x_min"), at("x_max")))).withColumn("_cy", F.explode(F.sequence(at("y_min"), at("y_max"))))
    sizes = own.groupBy(*site).agg(F.collect_set("_level").alias("_levels"))
    asked = own.join(sizes, site).withColumn("_level", F.explode(F.filter("_levels", lambda n: n >= F.col("_level") - 1)))
    asked = asked.withColumns({"_cx": at("x_min"), "_cy": at("y_min")}).select(*site, "box", "_level", "_cx", "_cy")
    met = asked.join(outer.select(*site, F.col("box").alias("_box"), "_level", "_cx", "_cy"), [*site, "_level", "_cx", "_cy"])
    held = met.where((F.col("_box") != F.col("box")) & contains(F.col("_box"), F.col("box"))).select(*site, "box").distinct()
    known = own.select(*site, "box", "_least").join(held.withColumn("_held", F.lit(True)), [*site, "box"], "left").alias("k")
    i = images.alias("i")
    gone = (F.col("i.box") == F.col("k.box")) & (F.col("k._held").isNotNull() | (F.col("i.image_id") > F.col("k._least")))
    for c in site:
        gone = gone & (F.col(f"i.{c}") == F.col(f"k.{c}"))
    return i.join(known, gone, "left_anti")


def run_along(points: DataFrame, refs: DataFrame, line: list[str], n: int) -> DataFrame:
    """Points (line, idx) within n places of each reference point (line, ref_idx) of their line; the last place doesn't count."""
    size = F.count("*").over(W.partitionBy(*line))
    p = points.withColumn("_size", size)
    near = refs.withColumn("idx", F.explode(F.sequence(F.col("ref_idx") - n, F.col("ref_idx") + n)))
    return near.join(p, [*line, "idx"]).where(F.col("idx") < F.least(F.col("ref_idx") + n, F.col("_size") - 1)).drop("_size")


def nearest_k(refs: DataFrame, points: DataFrame, group: list[str], k: int, size: float = 4.0) -> DataFrame:
    """The k nearest points (pt_id, x, y) of each reference point (ref_id, x, y) of its group, ties to the lesser pt_id.

    By growing cells: see joins.nearest.
    """
    return nearest(refs, points, ["ref_id"], "pt_id", size, group, k).select(*group, "ref_id", "pt_id", "rank", "distance")


def zones_of_points(points: DataFrame, line: list[str], p_value: str, least: float) -> DataFrame:
    """points (line, idx) plus zone: a new one begins where the p value is under `least`, but not where the next point begins one too."""
    w = W.partitionBy(*line).orderBy("idx")
    begins = lambda p: F.coalesce(p < least, F.lit(False))
    alone = begins(F.col(p_value)) & ~begins(F.lead(p_value).over(w))
    p = points.withColumn("_begins", alone.cast("int"))
    return p.withColumn("zone", F.sum("_begins").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_begins")


def cloud_range(transects: DataFrame, clouds: DataFrame, along: float, past: float, least: float, resolution: float = 15.0) -> DataFrame:
    """transect_id, cloud_min, cloud_max: chainages of the cloud pixels (pt_id, x, y) in each transect's rectangle, widened by a pixel's diagonal."""
    c = transect_points(transects, clouds, along=along, past=past, least=least)
    edge = resolution * 1.414
    return c.groupBy("transect_id").agg((F.min("chainage") - edge).alias("cloud_min"), (F.max("chainage") + edge).alias("cloud_max"))


def geometries(images: DataFrame, georef: list[str], epsg: str = "epsg") -> DataFrame:
    """Distinct image geometries (georeference rounded to 6 digits, zone) with a number each: what is computed once an image size."""
    key = [*(F.round(c, 6).alias(c) for c in georef), F.col(epsg)]
    return images.select(*key).distinct().withColumn("geometry_id", F.xxhash64(*georef, epsg))


def usable_pixels(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Pixels in the buffer, not cloudy, with a finite number in one band at least."""
    bad = F.lit(True)
    for b in bands:
        bad = bad & (F.col(b).isNull() | F.isnan(b) | (F.abs(b) == float("inf")))
    return pixels.where(F.col("in_buffer") & ~F.col("cloud") & ~bad)
