"""Observation series: averages, trends, clusters, dispersion, outliers.

series: transect_id, scene_id, ts (timestamp without zone), chainage (NULL: missing).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

YEAR_DAYS = 365.2425


def moving_average(series: DataFrame, days: int = 180, least: int = 1) -> DataFrame:
    """Adds `average` over the window (t - days/2, t + days/2]: the lower end is out."""
    half = days // 2
    w = f"OVER (PARTITION BY transect_id ORDER BY ts RANGE BETWEEN INTERVAL '{half - 1} 23:59:59.999999' DAY TO SECOND PRECEDING AND INTERVAL '{half} 00:00:00' DAY TO SECOND FOLLOWING)"
    return series.withColumn("average", F.expr(f"CASE WHEN count(chainage) {w} >= {least} THEN avg(chainage) {w} END"))


def years(ts: Column, first: Column) -> Column:
    return F.datediff(ts.cast("date"), first.cast("date")) / YEAR_DAYS


def trend(series: DataFrame, least: int = 10, key: list[str] | None = None) -> DataFrame:
    """Least squares of chainage on years, for keys with more than `least` observations.

    trend (a year), intercept, unexplained_var (1 - r squared), trend_std (standard
    error; 0 for two points), images_used.
    """
    key = key or ["transect_id"]
    used = series.where("chainage IS NOT NULL")
    # days since a fixed day keep one pass; the intercept moves to the key's first day afterwards
    x = F.datediff(F.col("ts").cast("date"), F.lit("2000-01-01").cast("date")) / YEAR_DAYS
    y = F.col("chainage")
    a = used.groupBy(*key).agg(
        F.count("*").alias("images_used"), F.regr_slope(y, x).alias("trend"), F.regr_intercept(y, x).alias("_b"), F.min(x).alias("_x0"),
        F.regr_r2(y, x).alias("_r2"), F.regr_syy(y, x).alias("_syy"), F.regr_sxx(y, x).alias("_sxx"),
    )
    rest = 1 - F.col("_r2")
    std = F.when(F.col("images_used") == 2, 0.0).otherwise(F.sqrt(F.try_divide(F.greatest(rest, F.lit(0.0)) * F.col("_syy"), F.col("_sxx") * (F.col("images_used") - 2))))
    return a.where(F.col("images_used") > least).select(*key, "images_used", "trend", (F.col("_b") + F.col("trend") * F.col("_x0")).alias("intercept"), rest.alias("unexplained_var"), std.alias("trend_std"))


def seasonal_average(series: DataFrame) -> DataFrame:
    """Mean by DJF, MAM, JJA, SON; December counts to the next year, if that year has data."""
    used = series.where("chainage IS NOT NULL")
    seen = used.select("transect_id", F.year("ts").alias("year")).distinct()
    shifted = F.expr("ts + INTERVAL '1' MONTH")
    by = used.groupBy("transect_id", F.year(shifted).alias("year"), F.quarter(shifted).alias("season")).agg(F.avg("chainage").alias("average"))
    label = F.make_date(F.col("year"), (F.col("season") - 1) * 3 + 1, F.lit(1))
    return by.join(seen, ["transect_id", "year"], "left_semi").select("transect_id", "year", "season", label.cast("timestamp_ntz").alias("ts"), "average")


def monthly_average(series: DataFrame) -> DataFrame:
    """Mean by month, dated the 15th, up to the month whose 15th is at most 30 days before the last observation... of the transect."""
    used = series.where("chainage IS NOT NULL")
    last = used.groupBy("transect_id").agg(F.max("ts").alias("_last"))
    month = F.date_trunc("month", "ts").cast("timestamp_ntz")
    by = used.groupBy("transect_id", (month + F.expr("INTERVAL '14' DAY")).alias("ts")).agg(F.avg("chainage").alias("average"))
    return by.join(last, "transect_id").where(F.expr("ts <= _last - INTERVAL '30' DAY")).drop("_last")


def gap_clusters(points: DataFrame, group: list[str], value: str, gap: float = 20) -> DataFrame:
    """Adds `cluster` (from 0): a new one begins where the sorted value steps by more than gap."""
    w = W.partitionBy(*group).orderBy(value)
    step = (F.col(value) - F.lag(value).over(w) > gap).cast("int")
    return points.withColumn("_s", F.coalesce(step, F.lit(0))).withColumn("cluster", F.sum("_s").over(w)).drop("_s")


def pair_statistics(points: DataFrame, group: list[str], value: str) -> DataFrame:
    return points.groupBy(*group).agg(F.stddev_pop(value).alias("std"), F.median(value).alias("median"), F.max(value).alias("max"), F.min(value).alias("min"), F.count(value).alias("n"))


def dispersion_check(stats: DataFrame, max_std: float = 15, max_range: float = 30, least: int = 3) -> DataFrame:
    """Adds chainage: the median where spread is small and points are enough, else NULL."""
    good = (F.col("std") <= max_std) & (F.col("max") - F.col("min") <= max_range) & (F.col("n") >= least)
    return stats.withColumn("chainage", F.when(good, F.col("median")))


def threshold_gate(series: DataFrame, low: float = -0.5, high: float = 0.0) -> DataFrame:
    """Observations whose scene threshold lies in the window."""
    return series.where(F.col("threshold").between(low, high))


def demean(series: DataFrame) -> DataFrame:
    """Adds `anomaly`: chainage less the series' median."""
    mid = series.groupBy("transect_id").agg(F.median("chainage").alias("_m"))
    return series.join(mid, "transect_id").withColumn("anomaly", F.col("chainage") - F.col("_m")).drop("_m")


def symmetric_range(series: DataFrame, value: str, group: list[str], centred: bool = False) -> DataFrame:
    """group, low, high: the least range around 0 that holds all values, or all less the median of their transect where centred."""
    if centred:
        mid = series.groupBy("transect_id").agg(F.median(value).alias("_m"))
        series = series.join(mid, "transect_id").withColumn(value, F.col(value) - F.col("_m"))
    far = series.groupBy(*group).agg(F.max(F.abs(value)).alias("high"))
    return far.select(*group, (-F.col("high")).alias("low"), "high")


def time_steps(series: DataFrame, group: list[str]) -> DataFrame:
    """Adds `step_days` since the observation before."""
    w = W.partitionBy(*group).orderBy("ts", "scene_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    return series.withColumn("step_days", micros / 86_400_000_000)


def _first_spike(x: np.ndarray, most: float) -> int | None:
    """Place of the first spike before the last value, by the signed steps around each value."""
    step = np.diff(x)
    far, very, sign = np.abs(step) > most, np.abs(step) > 1.5 * most, np.sign(step)
    hit = np.zeros(len(x), bool)
    hit[0] = far[0]
    # into and out of a value by opposite steps
    hit[1:-1] = far[:-1] & far[1:] & (sign[:-1] == -sign[1:])
    if len(x) >= 5:
        into, out = slice(1, -2), slice(3, None)  # steps before and two after the values 2 .. n-3
        early, next_out = slice(0, -3), slice(2, -1)
        hit[2:-2] |= far[into] & far[out] & (sign[into] == -sign[out])  # the first of two
        hit[2:-2] |= far[next_out] & far[early] & (sign[next_out] == -sign[early])  # the second of two
        hit[2:-2] |= very[early] & very[out] & ~far[into] & ~far[next_out] & (sign[early] == -sign[out])  # between two
    at = np.flatnonzero(hit[:-1])
    return int(at[0]) if len(at) else None


def _spikes(values: np.ndarray, most: float) -> np.ndarray:
    """Places of the values that stay: spikes go one at a time, each followed by a new scan.

    A scan that meets none before the last value removes that one if it is far from
    its neighbour, and ends. A series of one value left ends up empty.
    """
    keep = np.arange(len(values))
    while len(keep) > 1:
        at = _first_spike(values[keep], most)
        if at is None:
            far = abs(values[keep[-1]] - values[keep[-2]]) > most
            return keep[:-1] if far else keep
        keep = np.delete(keep, at)
    return keep[:0]


def despike(series: DataFrame, most: float = 40) -> DataFrame:
    """Observations left after spikes of over `most` metres are removed, transect by transect.

    Order-dependent removal needs a transect's rows together: one small Arrow
    group each (a transect has a few thousand scenes at most).
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["chainage"].notna()].sort_values(["ts", "scene_id"], ignore_index=True)
        return pdf.iloc[_spikes(pdf["chainage"].to_numpy(), most)] if len(pdf) > 1 else pdf

    return series.groupBy("transect_id").applyInPandas(one, series.schema)


def reject_outliers(series: DataFrame, low: float = -0.5, high: float = 0.0, most: float = 40) -> DataFrame:
    """series plus outcome: missing, threshold, spike or good."""
    gated = threshold_gate(series.where("chainage IS NOT NULL"), low, high)
    good = despike(gated, most).select("transect_id", "scene_id", F.lit(True).alias("_good"))
    outcome = F.when(F.col("chainage").isNull(), "missing").when(F.col("_good"), "good").when(F.col("threshold").between(low, high), "spike").otherwise("threshold")
    return series.join(good, ["transect_id", "scene_id"], "left").withColumn("outcome", outcome).drop("_good")


def rejection_counts(pairs: DataFrame) -> DataFrame:
    """Rejections by (transect, reason) and by (scene, reason): two grouping sets in one pass."""
    used = pairs.where("rejection IS NOT NULL")
    return used.groupingSets([["transect_id", "rejection"], ["scene_id", "rejection"]], "transect_id", "scene_id", "rejection").agg(F.count("*").alias("n"))
