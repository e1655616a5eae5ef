"""From pixels to shorelines: thresholds by scene, contours, and what is kept of them.

pixels: scene_id, row, col, value (a water index), cloud, in_buffer and, for the
split by class, label. scenes: scene_id and the georeference columns xtr, xscale,
xshear, ytr, yshear, yscale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import pixel_to_world
from . import thresholds
from .joins import away_from
from .ml import SAND, WATER, even_sample
from .raster import contour_segments, dilate, link_contours
from .selection import contour_lengths, contour_normals


def near_buffer(pixels: DataFrame, radius: int = 5) -> DataFrame:
    """pixels plus near: in the buffer, or at most `radius` rows and columns from it."""
    grown = dilate(pixels, "in_buffer", radius).withColumnRenamed("in_buffer", "near")
    return pixels.join(grown, ["scene_id", "row", "col"], "left")


def global_threshold(pixels: DataFrame) -> DataFrame:
    """scene_id, threshold: Otsu over clear pixels in or near the buffer."""
    return thresholds.otsu(near_buffer(pixels).where("near AND NOT cloud"), ["scene_id"], "value")


def class_threshold(pixels: DataFrame, seed: int = 0) -> DataFrame:
    """scene_id, threshold: Otsu over as many sand as water pixels of the buffer.

    The larger class is sampled by a hash order to the size of the smaller, so runs
    agree.
    """
    used = pixels.where(F.col("in_buffer") & ~F.col("cloud") & F.col("label").isin(SAND, WATER))
    counts = used.groupBy("scene_id").agg(F.count(F.when(F.col("label") == SAND, 1)).alias("_s"), F.count(F.when(F.col("label") == WATER, 1)).alias("_w"))
    w = W.partitionBy("scene_id", "label").orderBy(F.xxhash64("row", "col", F.lit(seed)), "row", "col")
    even = used.withColumn("_r", F.row_number().over(w)).join(counts, "scene_id").where(F.col("_r") <= F.least("_s", "_w"))
    return thresholds.otsu(even, ["scene_id"], "value")


def scene_thresholds(pixels: DataFrame, least_sand: int = 50) -> DataFrame:
    """The class threshold where a scene's buffer has enough sand pixels, else the global one."""
    both = sand_gate(pixels, least_sand).join(global_threshold(pixels).withColumnRenamed("threshold", "_g"), "scene_id", "left").join(class_threshold(pixels).withColumnRenamed("threshold", "_c"), "scene_id", "left")
    return both.select("scene_id", F.when(F.col("by_class"), F.coalesce("_c", "_g")).otherwise(F.col("_g")).alias("threshold"))


def contours(pixels: DataFrame, levels: DataFrame) -> DataFrame:
    """scene_id, contour_id, pt_idx, row, col: lines at each scene's threshold, inside its buffer and off clouds."""
    inside = pixels.where("in_buffer AND NOT cloud").join(levels, "scene_id").withColumn("value", F.col("value") - F.col("threshold"))
    return link_contours(contour_segments(inside, "value", 0.0))


def to_shorelines(lines: DataFrame, scenes: DataFrame, obstacles: DataFrame, least_length: Column | float = 500.0, clear_of: float = 30.0) -> DataFrame:
    """scene_id, contour_id, pt_idx, x, y, nx, ny: contours in metres, long enough, away from obstacles (scene_id, x, y)."""
    turned = contour_normals(lines.withColumnsRenamed({"row": "y", "col": "x"})).withColumnsRenamed({"x": "col", "y": "row"})
    g = {k: F.col(k) for k in ("xtr", "xscale", "xshear", "ytr", "yshear", "yscale")}
    x, y = pixel_to_world(F.col("row"), F.col("col"), g)
    world = turned.join(scenes, "scene_id").withColumns({"x": x, "y": y})
    least = least_length if isinstance(least_length, Column) else F.lit(least_length)
    long = contour_lengths(world).join(scenes, "scene_id").where(F.col("length") >= least).select("scene_id", "contour_id")
    kept = world.join(long, ["scene_id", "contour_id"], "left_semi").select("scene_id", "contour_id", "pt_idx", "x", "y", "nx", "ny")
    return away_from(kept, obstacles, clear_of, ["scene_id"])


def extract(pixels: DataFrame, scenes: DataFrame, least_length: float = 500.0, clear_of: float = 30.0) -> DataFrame:
    """Thresholds, contours and shorelines of all scenes; clouds are the obstacles."""
    g = {k: F.col(k) for k in ("xtr", "xscale", "xshear", "ytr", "yshear", "yscale")}
    x, y = pixel_to_world(F.col("row"), F.col("col"), g)
    clouds = pixels.where("cloud").join(scenes, "scene_id").select("scene_id", x.alias("x"), y.alias("y"))
    return to_shorelines(contours(pixels, scene_thresholds(pixels)), scenes, clouds, least_length, clear_of)


def sand_gate(pixels: DataFrame, least: int = 50) -> DataFrame:
    """scene_id, n_sand, n_water of the buffer, and by_class: whether its sand is enough for the split by class."""
    n = lambda label: F.count(F.when(F.col("in_buffer") & (F.col("label") == label), 1))
    return pixels.groupBy("scene_id").agg(n(SAND).alias("n_sand"), n(WATER).alias("n_water")).withColumn("by_class", F.col("n_sand") >= least)


def class_counts(training: DataFrame) -> DataFrame:
    """label, n, share: how many training pixels a class has, and their share of all."""
    n = training.groupBy("label").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).select("label", "n", (F.col("n") / F.col("_all")).alias("share"))


def training_pixels(by_site: list[DataFrame], most: int | None = None, seed: int = 0) -> DataFrame:
    """Labelled pixels of several sites together; classes of over `most` rows are sampled by a hash."""
    out = by_site[0]
    for df in by_site[1:]:
        out = out.unionByName(df)
    return even_sample(out, "label", ["scene_id", "row", "col"], most, seed) if most else out
