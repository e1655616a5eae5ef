"""Tides: harmonic series, as-of matching, percentile filters and corrections.

tides: site, ts, tide. series: transect_id, scene_id, site, ts, chainage.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.missing import or_default
from .fill import ahead


def next_value(left: DataFrame, right: DataFrame, by: list[str], value: str, out: str | None = None, days: int = 30) -> DataFrame:
    """left plus the value of the first row of right strictly after its ts (NULL past the end).

    Of repeated timestamps on the right the first row by value counts. Both sides
    are sorted streams of a key's `days` each, so that a long series isn't one
    task; past a stream's last value comes the first one of the next stream that
    has any, carried back over a row a stream.
    """
    out = out or value
    columns, width = left.columns, days * 86_400
    stream = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / width)
    one = right.where(F.col("ts").isNotNull()).groupBy(*by, "ts").agg(F.min(value).alias("_v")).withColumns({"_kind": F.lit(1), "_stream": stream})
    rows = left.withColumns({"_kind": F.lit(0), "_v": F.lit(None).cast(right.schema[value].dataType), "_stream": stream})
    key = [*by, "_stream"]
    # backwards; at one time left rows come first, as they never meet their own instant
    order = [F.col("ts").desc(), F.col("_kind")]
    both = rows.unionByName(one, allowMissingColumns=True).withColumn("_here", ahead("_v", key, order, own=False))
    heads = one.groupBy(*key).agg(F.min_by("_v", F.when(F.col("_v").isNotNull(), F.col("ts"))).alias("_first"))
    every = rows.select(*key, F.col("_v").alias("_first")).unionByName(heads)
    streams = every.groupBy(*key).agg(F.max("_first").alias("_first"))
    later = streams.withColumn("_later", ahead("_first", by, [F.col("_stream").desc()], own=False)).drop("_first")
    joined = both.where("_kind = 0").join(later, key, "left")
    return joined.withColumn(out, F.coalesce("_here", "_later")).select(*columns, out)


def tide_bounds(tides: DataFrame, low: float = 5, high: float = 95) -> DataFrame:
    """Percentiles of each site's whole series, by linear interpolation."""
    return tides.groupBy("site").agg(F.percentile("tide", low / 100).alias("tide_low"), F.percentile("tide", high / 100).alias("tide_high"))


def within_bounds(matched: DataFrame, tides: DataFrame, low: float = 5, high: float = 95) -> DataFrame:
    """matched plus in_range: its tide lies between the percentiles, both ends included."""
    b = tide_bounds(tides, low, high)
    return matched.join(b, "site", "left").withColumn("in_range", F.col("tide").between(F.col("tide_low"), F.col("tide_high"))).drop("tide_low", "tide_high")


def correct(chainage: Column, tide: Column, slope: Column, reference: float = 0.0, default_slope: float = 0.1) -> Column:
    """Chainage moved to the reference level along the slope (default where NULL or 0)."""
    return chainage + (tide - reference) / or_default(slope, default_slope)


def correct_series(series: DataFrame, tides: DataFrame, slope: float = 0.1, reference: float = 0.0, low: float = 5, high: float = 95, centre: bool = True, slopes: DataFrame | None = None) -> DataFrame:
    """Tide correction from a tide table: match, filter on raw levels, centre on the table's mean, correct.

    slopes: transect_id, slope; transects without one take `slope`.

    Adds tide, in_range and corrected (NULL outside the percentiles).
    """
    matched = next_value(series, tides, ["site"], "tide")
    ranged = within_bounds(matched, tides, low, high)
    mean = tides.groupBy("site").agg((F.avg("tide") if centre else F.lit(0.0)).alias("_mean"))
    out = ranged.join(mean, "site", "left")
    own = F.lit(slope)
    if slopes is not None:
        out = out.join(slopes.select("transect_id", F.col("slope").alias("_slope")), "transect_id", "left")
        own = F.coalesce("_slope", F.lit(slope))
    corrected = correct(F.col("chainage"), F.col("tide") - F.col("_mean"), own, reference)
    return out.withColumn("corrected", F.when(F.col("in_range"), corrected)).drop("_mean", "_slope")


def correct_over(matched: DataFrame, slopes: list[float]) -> DataFrame:
    """matched (with chainage and tide) once for each slope: slope, corrected = chainage + tide / slope.

    For the curves themselves; slopes.band_energy finds the best one without these rows.
    """
    if not slopes or 0 in slopes:
        raise ValueError("slopes must be given, and none may be 0")
    each = matched.withColumn("slope", F.explode(F.array(*map(F.lit, slopes))))
    return each.withColumn("corrected", F.col("chainage") + F.col("tide") / F.col("slope"))


def filter_statistics(corrected: DataFrame) -> DataFrame:
    """Per transect: observations, those the tide filter removed, and their share."""
    total, gone = F.count("chainage"), F.count(F.when(F.col("chainage").isNotNull() & ~F.coalesce("in_range", F.lit(False)), 1))
    return corrected.groupBy("transect_id").agg(total.alias("total"), gone.alias("removed"), F.try_divide(100.0 * gone, total).alias("removed_pct"))


def time_grid(spark: SparkSession, start: str, end: str, seconds: int = 900) -> DataFrame:
    """ts from start to end, both included, made on the executors."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    n = spark.range(1).select(F.floor((F.unix_timestamp(last) - F.unix_timestamp(first)) / seconds)).first()[0]
    return spark.range(n + 1).select(F.timestamp_seconds(F.unix_timestamp(first) + F.col("id") * seconds).cast("timestamp_ntz").alias("ts"))


def harmonic_tide(times: DataFrame, constituents: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """times plus tide: the sum of amplitude * cos(2 pi (t / period - phase)) over a small table.

    constituents: amplitude (m), period_h, phase (turns); broadcast.
    """
    keys = keys or ["ts"]
    hours = F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000
    term = F.col("amplitude") * F.cos(2 * pi * (hours / F.col("period_h") - F.col("phase")))
    return times.crossJoin(F.broadcast(constituents)).groupBy(*keys).agg(F.sum(term).alias("tide"))


def tidal_range(tides: DataFrame) -> DataFrame:
    """Mean of positive peaks less mean of negative troughs, by site."""
    w = W.partitionBy("site").orderBy("ts")
    t, before, after = F.col("tide"), F.lag("tide").over(w), F.lead("tide").over(w)
    peaks = tides.withColumn("_high", (t > before) & (t > after) & (t > 0)).withColumn("_low", (t < before) & (t < after) & (t < 0))
    return peaks.groupBy("site").agg(F.round(F.avg(F.when(F.col("_high"), t)) - F.avg(F.when(F.col("_low"), t)), 3).alias("tidal_range"))


def profile_to_zero(x: Column, z: Column, lower: Column, upper: Column, z0: Column) -> Column:
    """Position at elevation 0 from a point (x, z) of a profile whose slope changes at elevation z0."""
    own, other = F.when(z < z0, lower).otherwise(upper), F.when(z < z0, upper).otherwise(lower)
    return x + F.when((z < z0) == (F.lit(0.0) < z0), -z / own).otherwise((z0 - z) / own - z0 / other)
