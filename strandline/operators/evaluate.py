"""Scores of detections against truth, and of methods against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .fill import ahead, behind
from .lineage import cut


def error_statistics(pairs: DataFrame, group: list[str], measured: str, truth: str, least: int = 8) -> DataFrame:
    """r2, rmse, mean, std (population), q90 of the absolute error; none under `least` pairs."""
    e = F.col(measured) - F.col(truth)
    used = pairs.where(F.col(measured).isNotNull() & F.col(truth).isNotNull())
    out = used.groupBy(*group).agg(
        F.count("*").alias("n"), F.regr_r2(F.col(measured), F.col(truth)).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), F.percentile(F.abs(e), 0.9).alias("q90"),
    )
    return out.where(F.col("n") >= least)


def satellite_errors(pairs: DataFrame, measured: str, truth: str, by: str = "satname") -> DataFrame:
    """Per satellite: the median error, the quartiles and whiskers of its box plot, and n; missing values count nowhere.

    A whisker ends at the farthest error within 1.5 quartile distances of the box.
    """
    used = pairs.select(by, (F.col(measured) - F.col(truth)).alias("_e")).where("_e IS NOT NULL")
    boxes = used.groupBy(by).agg(F.percentile("_e", [0.25, 0.5, 0.75]).alias("_q"), F.count("*").alias("n"))
    boxes = boxes.select(by, *(F.element_at("_q", i + 1).alias(n) for i, n in enumerate(("q25", "median", "q75"))), "n")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = used.join(F.broadcast(boxes), by).where(F.col("_e").between(F.col("q25") - reach, F.col("q75") + reach))  # a row a satellite
    return inside.groupBy(by, "q25", "median", "q75", "n").agg(F.min("_e").alias("low"), F.max("_e").alias("high"))


def median_distances(transects: DataFrame, found: DataFrame, truth: DataFrame, by: list[str]) -> DataFrame:
    """by, distance: the median chainage found less the true one's; NULL where either has none, and for transects without rows."""
    middle = lambda df, name: df.groupBy(*by).agg(F.median("chainage").alias(name))
    both = transects.select(*by).distinct().join(middle(found, "_f"), by, "left").join(middle(truth, "_t"), by, "left")
    return both.select(*by, (F.col("_f") - F.col("_t")).alias("distance"))


def linear_fit(df: DataFrame, group: list[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Per group: n, slope, intercept, r2 of the least-squares line y(x), and the slope's standard error; none under `least` pairs."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    sums = df.groupBy(*group).agg(F.count(a + b).alias("n"), F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.regr_r2(b, a).alias("r2"), F.regr_sxx(b, a).alias("_sxx"), F.regr_syy(b, a).alias("_syy"))
    error = F.sqrt(F.try_divide((1 - F.col("r2")) * F.col("_syy"), F.col("_sxx") * (F.col("n") - 2)))
    return sums.where(F.col("n") >= least).withColumn("slope_std", error).drop("_sxx", "_syy")


def normality(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Mean, population std, skewness and excess kurtosis (population), for a normality test."""
    return df.groupBy(*group).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis"))


def method_summary(scores: DataFrame, far: float = 25, most_methods: int = 10) -> DataFrame:
    """scores (method, point_id, distance): per method the mean without outlier points, mean, std, count over `far`, mean of absolutes.

    An outlier point is one that more than most_methods methods miss by over far.
    """
    over = (F.col("distance") > far).cast("int")
    odd = scores.groupBy("point_id").agg(F.sum(over).alias("_n")).select("point_id", (F.col("_n") > most_methods).alias("_odd"))
    s = scores.join(odd, "point_id")
    return s.groupBy("method").agg(
        F.avg(F.when(~F.col("_odd"), F.col("distance"))).alias("mean_without_outliers"), F.avg("distance").alias("mean"), F.stddev_pop("distance").alias("std"),
        F.sum(over).cast("long").alias("n_far"), F.avg(F.abs("distance")).alias("mean_abs"),
    )


def ranked(summary: DataFrame, by: str) -> DataFrame:
    """Methods in ascending order, missing last. A summary has a row a method."""
    return summary.withColumn("rank", F.row_number().over(W.orderBy(F.col(by).asc_nulls_last(), "method")))


def best_method_counts(scores: DataFrame) -> DataFrame:
    """How often each method is nearest (ties to the lesser name)."""
    best = scores.where("distance IS NOT NULL").groupBy("point_id").agg(F.min_by("method", F.struct("distance", "method")).alias("method"))
    return best.groupBy("method").agg(F.count("*").alias("n"))


def _positions(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each value of the column and its place (from 0) in their order: places inside sorted ranges, and the ranges' sizes before."""
    ranged = cut(df.select(column).distinct().repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(column)) - 1
    return ranged.withColumn("_at", inside).join(F.broadcast(starts), "_range").select(column, (F.col("_start") + F.col("_at")).alias(name))


def _intervals(place: Column, levels: int, odd: bool) -> Column:
    """Intervals (level, number) of 2^level places with an even number: those that hold the place, or, if odd, those that make up all places before it.

    Where a place's number at a level is odd, the even interval beside it is part of
    what comes before; these parts, one a set bit, are all of it.
    """
    at = lambda level: F.call_function("shiftright", place, level)
    own = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda i: F.struct(i.alias("level"), at(i).alias("n")))
    return F.transform(F.filter(own, lambda x: x["n"] % 2 == int(odd)), lambda x: F.struct(x["level"], (x["n"] - int(odd)).alias("n")))


def pareto_front(rows: DataFrame, metrics: list[str], probes: int = 64) -> DataFrame:
    """Rows that no other beats strictly in every metric (lower is better); rows with a missing metric stay.

    What one of `probes` rows of a small scaled sum beats goes first. Of the rest,
    each row asks for the least last metric among rows before it in every other
    one: the intervals of places before it are looked up, whose least values are
    one aggregation. So a front of any size takes rows x log^(metrics - 1), and no
    pairs.
    """
    names = [f"_m{i}" for i in range(max(2, len(metrics)))]
    chosen = metrics if len(metrics) > 1 else metrics * 2
    typed = [F.col(m).cast("double").alias(n) for m, n in zip(chosen, names, strict=True)]
    values = rows.select(*typed).dropna().distinct()
    low = values.agg(*(F.min(n).alias(f"_l{n}") for n in names), *(F.max(n).alias(f"_h{n}") for n in names))
    share = sum(F.coalesce(F.try_divide(F.col(n) - F.col(f"_l{n}"), F.col(f"_h{n}") - F.col(f"_l{n}")), F.lit(0.0)) for n in names)
    best = values.crossJoin(F.broadcast(low)).orderBy(share, *names).limit(probes).select(*(F.col(n).alias(f"_b{n}") for n in names))
    beaten = F.lit(True)
    for n in names:
        beaten = beaten & (F.col(f"_b{n}") < F.col(n))
    left = cut(values.join(F.broadcast(best), beaten, "left_anti"))

    placed, keys = left, []
    for n in names[:-1]:
        placed = placed.join(_positions(left, n, f"_p{n}"), n)
    placed = cut(placed)
    levels = max(1, max((placed.agg(*(F.max(f"_p{n}") for n in names[:-1])).first()[i] or 0) for i in range(len(names) - 1)).bit_length())
    held = asked = placed
    for n in names[:-1]:
        held = held.withColumn(f"_i{n}", F.explode(_intervals(F.col(f"_p{n}"), levels, odd=False)))
        asked = asked.withColumn(f"_i{n}", F.explode(_intervals(F.col(f"_p{n}"), levels, odd=True)))
        keys.append(f"_i{n}")
    least = held.groupBy(*keys).agg(F.min(names[-1]).alias("_least"))
    lost = asked.join(least, keys).where(F.col("_least") < F.col(names[-1])).select(*names).distinct()
    front = left.join(lost, names, "left_anti")
    same, whole = F.lit(True), F.lit(True)
    for m, n in zip(chosen, names, strict=True):
        value = F.col(m).cast("double")
        same, whole = same & (value == F.col(n)), whole & value.isNotNull() & ~F.isnan(value)
    return rows.where(~whole).unionByName(rows.where(whole).join(front, same, "left_semi"))


def confusion(df: DataFrame, truth: str, predicted: str, classes: list) -> DataFrame:
    return df.groupBy(truth).pivot(predicted, classes).count().na.fill(0)


def cluster_share(pairs: DataFrame) -> DataFrame:
    """Per transect: 100 * pairs of two clusters / pairs with any."""
    return pairs.groupBy("transect_id").agg(F.try_divide(100.0 * F.count(F.when(F.col("n_clusters") == 2, 1)), F.count("n_clusters")).alias("two_cluster_pct"))


def level_position(profiles: DataFrame, level: float = 0.7) -> DataFrame:
    """profile_id, date, position: chainage where a profile's elevation meets the level (NULL out of its range).

    Elevations sorted ascending, linear between neighbours.
    """
    w = W.partitionBy("profile_id", "date").orderBy("elevation", "chainage")
    p = profiles.where("elevation IS NOT NULL AND chainage IS NOT NULL").withColumns({"_e": F.lead("elevation").over(w), "_c": F.lead("chainage").over(w)})
    hit = (F.col("elevation") <= level) & (F.col("_e") >= level)
    at = F.col("chainage") + F.coalesce(F.try_divide(level - F.col("elevation"), F.col("_e") - F.col("elevation")), F.lit(0.0)) * (F.col("_c") - F.col("chainage"))
    return p.withColumn("_at", F.when(hit, at)).groupBy("profile_id", "date").agg(F.min("_at").alias("position"))


def trend_records(corrected: DataFrame, trends: DataFrame, slopes: DataFrame, transects: DataFrame) -> DataFrame:
    """One record a transect: trend, its error, slope (and its interval where given), images used and total, share the tide filter removed, geometry."""
    n = corrected.groupBy("transect_id").agg(F.count("corrected").alias("images_used"), F.count("*").alias("total_images"), F.count(F.when(F.col("chainage").isNotNull() & ~F.coalesce("in_range", F.lit(False)), 1)).alias("removed"), F.count("chainage").alias("_had"))
    geometry = F.concat_ws("", F.lit("LINESTRING ("), F.concat_ws(", ", F.concat_ws(" ", "x0", "y0"), F.concat_ws(" ", "x1", "y1")), F.lit(")"))
    out = transects.select("transect_id", geometry.alias("geometry_wkt")).join(n, "transect_id", "left")
    out = out.join(trends.select("transect_id", "trend", "unexplained_var", "trend_std"), "transect_id", "left").join(slopes.select("transect_id", "slope", *(c for c in ("ci_lo", "ci_hi") if c in slopes.columns)), "transect_id", "left")
    return out.withColumn("tide_filter_removed_pct", F.try_divide(100.0 * F.col("removed"), F.col("_had"))).drop("removed", "_had")


def coverage_records(corrected: DataFrame, trends: DataFrame, slopes: DataFrame, transects: DataFrame, images: DataFrame, default_slope: float = 0.1) -> DataFrame:
    """One record a transect: trend, slope, images used of its own series, coverage and gap in percent of it, images of the site.

    corrected: transect_id, corrected. A transect without a slope takes the default;
    one without observations has NULL shares. images: a row a scene of the site.
    """
    n = corrected.groupBy("transect_id").agg(F.count("corrected").alias("images_used"), F.count("*").alias("_n"))
    out = transects.select("transect_id").join(n, "transect_id", "left").join(trends.select("transect_id", "trend"), "transect_id", "left")
    out = out.join(slopes.select("transect_id", F.col("slope").alias("_s")), "transect_id", "left").crossJoin(F.broadcast(images.agg(F.count("*").alias("images_total"))))
    share = F.try_divide(100.0 * F.col("images_used"), F.col("_n"))
    return out.select(
        "transect_id", "trend", F.coalesce("_s", F.lit(default_slope)).alias("slope"), "images_total", F.coalesce("images_used", F.lit(0)).alias("images_used"),
        share.alias("coverage_pct"), (100 - share).alias("data_gap_pct"),
    )


def mean_area_distance(a: DataFrame, b: DataFrame, group: list[str]) -> DataFrame:
    """Mean distance of two lines y(x): the area between them over their common x range, by trapezia.

    Both lines are evaluated at the union of their vertices; crossings inside a
    step count with their sign's absolute mean of the ends.
    """
    u = a.select(*group, "x", F.col("y").alias("ya"), F.lit(None).cast("double").alias("yb")).unionByName(b.select(*group, "x", F.lit(None).cast("double").alias("ya"), F.col("y").alias("yb")))
    u = u.groupBy(*group, "x").agg(F.avg("ya").alias("ya"), F.avg("yb").alias("yb"))

    def along(c: str) -> Column:
        at = F.when(F.col(c).isNotNull(), F.struct("x", F.col(c).alias("y")))
        p, q = behind(at, group, [F.col("x")]), ahead(at, group, [F.col("x").desc()])
        return p["y"] + F.coalesce(F.try_divide(F.col("x") - p["x"], q["x"] - p["x"]), F.lit(0.0)) * (q["y"] - p["y"])

    u = u.withColumn("gap", F.abs(along("ya") - along("yb"))).where("gap IS NOT NULL")
    w = W.partitionBy(*group).orderBy("x")
    step = F.lead("x").over(w) - F.col("x")
    u = u.withColumns({"_w": step, "_a": step * (F.col("gap") + F.lead("gap").over(w)) / 2})
    return u.groupBy(*group).agg(F.try_divide(F.sum("_a"), F.sum("_w")).alias("distance"))
