"""Transects cast from a reference line, and candidate places for tides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import crossings


def stations(vertices: DataFrame, spacing: float = 100.0, least: float = 0.0) -> DataFrame:
    """line_id, at, x, y: places every `spacing` metres (0 and the end's last multiple included) along lines of `least` metres or more.

    vertices: line_id, pt_idx, x, y. A segment makes the places that fall on it, so
    long lines are spread over rows.
    """
    w = W.partitionBy("line_id").orderBy("pt_idx")
    v = vertices.withColumns({"_x1": F.lead("x").over(w), "_y1": F.lead("y").over(w)})
    v = v.withColumn("_len", F.sqrt(F.pow(F.col("_x1") - F.col("x"), 2) + F.pow(F.col("_y1") - F.col("y"), 2)))
    v = v.withColumn("_from", F.coalesce(F.sum("_len").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    v = v.withColumn("_whole", F.sum("_len").over(W.partitionBy("line_id"))).where((F.col("_len") > 0) & (F.col("_whole") >= least))
    first, last = F.ceil(F.col("_from") / spacing), F.ceil((F.col("_from") + F.col("_len")) / spacing) - 1
    closes = F.abs(F.col("_from") + F.col("_len") - F.col("_whole")) < 1e-9
    last = F.when(closes, F.floor(F.col("_whole") / spacing)).otherwise(last)
    v = v.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last)))
    t = (F.col("_k") * spacing - F.col("_from")) / F.col("_len")
    return v.select("line_id", (F.col("_k") * spacing).alias("at"), (F.col("x") + t * (F.col("_x1") - F.col("x"))).alias("x"), (F.col("y") + t * (F.col("_y1") - F.col("y"))).alias("y"))


def normals(places: DataFrame, reach: int = 1) -> DataFrame:
    """places plus nx, ny: the chord between the stations `reach` before and after (clamped at the ends), turned by 90 degrees."""
    w = W.partitionBy("line_id").orderBy("at")
    back, ahead = w.rowsBetween(-reach, 0), w.rowsBetween(0, reach)
    dx, dy = F.last("x").over(ahead) - F.first("x").over(back), F.last("y").over(ahead) - F.first("y").over(back)
    n = F.sqrt(dx * dx + dy * dy)
    return places.withColumns({"nx": F.try_divide(-dy, n), "ny": F.try_divide(dx, n)})


def cast(places: DataFrame, segments: DataFrame, length: float, least: float = 50.0, size: float | None = None) -> DataFrame:
    """transect_id, x0, y0, x1, y1: transects across the line at places with normals, seaward against the normal.

    One that meets another segment nearer than `least` is left out; one that meets
    a segment farther off ends at half the way. transect_id numbers those left in
    order of line and place.
    """
    p = places.where("nx IS NOT NULL").withColumn("ray_id", F.struct("line_id", "at"))
    ray = lambda s: p.select("ray_id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + s * length * F.col("nx")).alias("x1"), (F.col("y") + s * length * F.col("ny")).alias("y1"))
    hits = crossings(ray(1).unionByName(ray(-1)), segments, size or length).where(F.col("along") > 1e-6)
    near = hits.groupBy("ray_id").agg(F.min("along").alias("hit"))
    t = p.join(near, "ray_id", "left").where(F.col("hit").isNull() | (F.col("hit") >= least))
    reach = F.least(F.lit(length), F.coalesce(F.col("hit") / 2, F.lit(length)))
    t = t.select("line_id", "at", *((F.col(c) + s * reach * F.col(f"n{c}")).alias(f"{c}{k}") for c in "xy" for k, s in ((0, 1), (1, -1))))
    number = F.row_number().over(W.orderBy("line_id", "at"))
    return t.select(F.format_string("transect_%03d", number).alias("transect_id"), "x0", "y0", "x1", "y1")


def best_tide_place(candidates: DataFrame) -> DataFrame:
    """The candidate (site, place, x, y and four quality flags f1..f4) with the best flags: 4 throughout, then 3, 2, 1; none where a site has no flag above 0."""
    worst = F.least("f1", "f2", "f3", "f4")
    used = candidates.where(worst > 0)
    return used.groupBy("site").agg(F.min_by(F.struct("place", "x", "y"), F.struct(-worst, F.col("place"))).alias("b")).select("site", "b.*")
