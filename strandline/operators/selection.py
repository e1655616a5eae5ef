"""Which shoreline points of a transect and scene count: rule sets over gap clusters.

points: scene_id, transect_id, chainage and, for rules by direction, along_normal
(the dot product of the contour's normal and the transect's direction).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .series import dispersion_check, gap_clusters, pair_statistics

PAIR = ["scene_id", "transect_id"]
#: Why a scene gives a transect no position.
NO_SEAWARD, SEVERAL_CLUSTERS, DISPERSION, NO_POINTS = 1, 2, 3, 4


def contour_normals(vertices: DataFrame) -> DataFrame:
    """Adds nx, ny: unit normals at contour vertices (scene_id, contour_id, pt_idx, x, y).

    A segment's normal is its direction turned by 90 degrees; inner vertices take
    the mean of both segments, ends that of theirs.
    """
    w = W.partitionBy("scene_id", "contour_id").orderBy("pt_idx")

    def unit(dx: Column, dy: Column) -> tuple[Column, Column]:
        n = F.sqrt(dx * dx + dy * dy)
        return F.try_divide(-dy, n), F.try_divide(dx, n)

    ahead = unit(F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y"))
    back = unit(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w))
    v = vertices.withColumns({"_ax": ahead[0], "_ay": ahead[1], "_bx": back[0], "_by": back[1]})
    sx, sy = (F.coalesce(F.col(f"_a{c}"), F.lit(0.0)) + F.coalesce(F.col(f"_b{c}"), F.lit(0.0)) for c in "xy")
    n = F.sqrt(sx * sx + sy * sy)
    return v.withColumns({"nx": F.try_divide(sx, n), "ny": F.try_divide(sy, n)}).drop("_ax", "_ay", "_bx", "_by")


def contour_lengths(vertices: DataFrame) -> DataFrame:
    """Length of each contour, over the vertices that aren't missing."""
    w = W.partitionBy("scene_id", "contour_id").orderBy("pt_idx")
    v = vertices.where("x IS NOT NULL AND y IS NOT NULL")
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    return v.withColumn("_s", step).groupBy("scene_id", "contour_id").agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("length"), F.count("*").alias("n_points"))


def select_by_direction(points: DataFrame, gap: float = 20) -> DataFrame:
    """Per pair: rejection (1: none faces the sea, 2: several clusters, NULL) and the chainages kept."""
    pairs = points.select(*PAIR).distinct()
    facing = gap_clusters(points.where("along_normal > 0"), PAIR, "chainage", gap)
    stats = facing.groupBy(*PAIR).agg(F.max("cluster").alias("_last"))
    out = pairs.join(stats, PAIR, "left")
    reason = F.when(F.col("_last").isNull(), NO_SEAWARD).when(F.col("_last") > 0, SEVERAL_CLUSTERS)
    return out.select(*PAIR, reason.alias("rejection"), (F.col("_last") + 1).alias("n_clusters"))


def positions(points: DataFrame, gap: float = 20, max_std: float = 15, max_range: float = 30, least: int = 3) -> DataFrame:
    """Per pair: n, median, chainage (NULL where rejected) and rejection."""
    chosen = select_by_direction(points, gap)
    stats = pair_statistics(points.where("along_normal > 0"), PAIR, "chainage")
    checked = dispersion_check(stats, max_std, max_range, least)
    both = chosen.join(checked, PAIR, "left")
    reason = F.coalesce("rejection", F.when(F.col("chainage").isNull() & F.col("median").isNotNull(), DISPERSION))
    return both.select(*PAIR, "n_clusters", F.coalesce("n", F.lit(0)).alias("n"), "median", F.when(F.col("rejection").isNull(), F.col("chainage")).alias("chainage"), reason.alias("rejection"))


def select_by_class(points: DataFrame, classes: DataFrame, gap: float = 20, far: float = 15) -> DataFrame:
    """Of one or two clusters, the one that the transect's labelled places agree with.

    classes: PAIR, at_origin, at_middle, at_end (1 land, 0 water, -1 unknown) and
    length. The first labelled place over `far` from every cluster's mean decides:
    sea at a place means the line lies landward of it, land seaward. reason 5: over
    two clusters, 6: no place can tell.
    """
    means = gap_clusters(points, PAIR, "chainage", gap).groupBy(*PAIR, "cluster").agg(F.avg("chainage").alias("mean"))
    sets = means.groupBy(*PAIR).agg(F.sort_array(F.collect_list("mean")).alias("means"))
    p = sets.join(classes, PAIR, "left")
    places = {"at_origin": F.lit(0.0), "at_middle": F.col("length") / 2, "at_end": F.col("length")}
    label, where = F.lit(None).cast("int"), F.lit(None).cast("double")

    def clear_of(at: Column) -> Column:
        return F.forall("means", lambda m: F.abs(m - at) > far)

    for name, at in reversed(places.items()):
        free = (F.col(name) >= 0) & clear_of(at)
        label, where = F.when(free, F.col(name)).otherwise(label), F.when(free, at).otherwise(where)
    p = p.withColumns({"_label": label, "_at": where})
    side = F.when(F.col("_label") == 0, F.filter("means", lambda m: m < F.col("_at"))).otherwise(F.filter("means", lambda m: m > F.col("_at")))
    chosen = F.when(F.size("means") == 1, F.element_at("means", 1)).when((F.size("means") == 2) & F.col("_label").isNotNull(), F.when(F.col("_label") == 0, F.array_max(side)).otherwise(F.array_min(side)))
    reason = F.when(F.size("means") > 2, 5).when((F.size("means") == 2) & chosen.isNull(), 6)
    return p.select(*PAIR, F.size("means").alias("n_clusters"), chosen.alias("chainage"), reason.alias("rejection"))


def label_choice(means: Column, classes: list[Column], length: Column, far: float = 15) -> Column:
    """struct(place, at): the first of origin, middle and end (0, 1, 2) that is labelled and over `far` from every mean; (-1, 0) if none is.

    classes: the labels of the three places, -1 where unknown.
    """
    made = lambda i, at: F.struct(F.lit(i).alias("place"), at.alias("at"))
    out = made(-1, F.lit(0.0))
    for i, at in reversed(list(enumerate((F.lit(0.0), length / 2, length.cast("double"))))):
        out = F.when((classes[i] != -1) & _clear(means, at, far), made(i, at)).otherwise(out)
    return out


def _clear(means: Column, at: Column, far: float) -> Column:
    return F.forall(means, lambda m: F.abs(at - m) > far)


def cluster_agrees(mean: Column, on_water: Column) -> Column:
    """Whether a single line (its mean relative to the labelled place) faces as the transect does: behind a place on water, ahead of one on land."""
    return (on_water & (mean < 0)) | (~on_water & (mean > 0))


def cluster_of_two(means: Column, on_water: Column) -> Column:
    """0 or 1: which of two ascending means faces as the transect does, each change of side turning the answer."""
    between = (F.get(means, 0) > 0) != (F.get(means, 1) > 0)
    return (on_water != between).cast("int")


def cluster_of_three(means: Column, on_water: Column) -> Column:
    """0, 1 or 2 of three ascending means, the middle one a cloud's stand-in or a line: the pair around the labelled place decides; 0 and 2 are ambiguous."""
    ahead = F.get(means, 1) > 0
    return F.when(ahead, cluster_of_two(F.slice(means, 1, 2), on_water)).otherwise(cluster_of_two(F.slice(means, 2, 2), on_water) + 1)


def whole_vertices(vertices: DataFrame) -> DataFrame:
    """Vertices without a missing coordinate (NULL or NaN); a line that had some and keeps fewer than two goes."""
    bad = F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")
    key = ["scene_id", "contour_id"]
    lost = vertices.groupBy(*key).agg(F.count(F.when(bad, 1)).alias("_bad"), F.count(F.when(~bad, 1)).alias("_good")).where("_bad > 0 AND _good < 2")
    return vertices.where(~bad).join(lost, key, "left_anti")
