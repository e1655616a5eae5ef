"""Beach slopes: the slope whose tide correction leaves least energy in the tidal band.

For each transect a least-squares spectrum with a free mean is evaluated at the
band's frequencies. All slopes share the sums of cos, sin and their products, and a
corrected series is linear in 1 / slope, so one pass over observations x
frequencies gives the moments of every slope.
"""

from __future__ import annotations

from math import ceil, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def slope_grid(low: float = 0.005, high: float = 0.4, step: float = 0.005) -> list[float]:
    """low, low + step, ... up to the first value at or over high, rounded to the decimals of step."""
    decimals = len(f"{step:.10f}".rstrip("0").split(".")[1])
    out = [low]
    while out[-1] < high - 1e-12:
        out.append(round(low + len(out) * step, decimals))
    return out


def frequency_grid(days: float, least_days: float = 8, oversample: int = 50) -> list[float]:
    """Frequencies in 1/s for a record of `days`: from 1 / T to 1 / (2 least_days) in steps of 1 / (oversample T)."""
    seconds = 86_400.0
    t, top = days * seconds, 1 / (2 * least_days * seconds)
    df = 1 / (oversample * t)
    return [1 / t + k * df for k in range(ceil((top - 1 / t) / df))]


def spectrum(series: DataFrame, group: list[str], value: str, frequencies: DataFrame) -> DataFrame:
    """group, f, power: floating-mean least-squares periodogram, as half the sum of squares explained.

    frequencies: f (1/s), a broadcast table.
    """
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    s = series.where(F.col(value).isNotNull())
    origin = s.groupBy(*group).agg(F.min(t).alias("_t0"), F.avg(value).alias("_y0"))
    s = s.join(origin, group).select(*group, (t - F.col("_t0")).alias("_t"), (F.col(value) - F.col("_y0")).alias("_y"))
    return _power(_moments(s.crossJoin(F.broadcast(frequencies)), [*group, "f"], {"y": F.col("_y")}), [*group, "f"], "y").select(*group, "f", "power")


def _moments(rows: DataFrame, key: list[str], values: dict[str, Column]) -> DataFrame:
    a = 2 * pi * F.col("f") * F.col("_t")
    rows = rows.withColumns({"_c": F.cos(a), "_s": F.sin(a)})
    sums = [F.avg(F.col("_c")).alias("c"), F.avg(F.col("_s")).alias("s"), F.avg(F.col("_c") * F.col("_c")).alias("cc"), F.avg(F.col("_s") * F.col("_s")).alias("ss"), F.avg(F.col("_c") * F.col("_s")).alias("cs"), F.count("*").alias("n")]
    for name, v in values.items():
        sums += [F.avg(v).alias(f"m_{name}"), F.avg(v * F.col("_c")).alias(f"c_{name}"), F.avg(v * F.col("_s")).alias(f"s_{name}")]
    return rows.groupBy(*key).agg(*sums)


def _power(m: DataFrame, key: list[str], name: str) -> DataFrame:
    """Explained sum of squares at a frequency from moments about the mean, halved."""
    cc, ss, cs = F.expr("cc - c * c"), F.expr("ss - s * s"), F.expr("cs - c * s")
    yc, ys = F.expr(f"c_{name} - m_{name} * c"), F.expr(f"s_{name} - m_{name} * s")
    det = cc * ss - cs * cs
    return m.withColumn("power", F.try_divide(F.col("n") * (yc * yc * ss - 2 * yc * ys * cs + ys * ys * cc), 2 * det))


def band_energy(series: DataFrame, band: DataFrame, slopes: list[float]) -> DataFrame:
    """transect_id, slope, energy: power over the band (f, weight) of chainage + tide / slope.

    series: transect_id, ts, chainage, tide. With weights of an integration rule
    the energy is the integral. The moments of chainage and tide are enough: the
    corrected series' are theirs plus 1 / slope times the tide's.
    """
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    s = series.where("chainage IS NOT NULL AND tide IS NOT NULL")
    origin = s.groupBy("transect_id").agg(F.min(t).alias("_t0"), F.avg("chainage").alias("_x0"), F.avg("tide").alias("_z0"))
    s = s.join(origin, "transect_id").select("transect_id", (t - F.col("_t0")).alias("_t"), (F.col("chainage") - F.col("_x0")).alias("_x"), (F.col("tide") - F.col("_z0")).alias("_z"))
    m = _moments(s.crossJoin(F.broadcast(band)), ["transect_id", "f", "weight"], {"x": F.col("_x"), "z": F.col("_z")})
    m = m.withColumn("slope", F.explode(F.array(*map(F.lit, slopes))))
    m = m.withColumns({f"{k}_y": F.col(f"{k}_x") + F.col(f"{k}_z") / F.col("slope") for k in ("m", "c", "s")})
    return _power(m, ["transect_id", "f"], "y").groupBy("transect_id", "slope").agg(F.sum(F.col("weight") * F.col("power")).alias("energy"))


def best_slope(energy: DataFrame, share: float = 1.05, default: float = 0.1) -> DataFrame:
    """transect_id, slope (least energy, the smallest on ties), ci_lo, ci_hi, is_default.

    The interval spans the slopes with an energy of at most share times the least.
    """
    low = W.partitionBy("transect_id")
    e = energy.withColumn("_m", F.min("energy").over(low))
    inside = F.when(F.col("energy") <= F.col("_m") * share, F.col("slope"))
    out = e.groupBy("transect_id").agg(F.min_by("slope", F.struct("energy", "slope")).alias("_s"), F.min(inside).alias("_lo"), F.max(inside).alias("_hi"), F.min("energy").alias("_e"))
    bad = F.col("_e").isNull()
    return out.select("transect_id", F.when(bad, default).otherwise(F.col("_s")).alias("slope"), F.when(~bad, F.col("_lo")).alias("ci_lo"), F.when(~bad, F.col("_hi")).alias("ci_hi"), bad.alias("is_default"))


def tidal_peak(power: DataFrame, group: list[str], least_f: float = 1 / (30 * 86_400), margin: float = 1e-8) -> DataFrame:
    """group, f, low, high: the band around the highest spectral peak over least_f and off the last frequency."""
    w = W.partitionBy(*group).orderBy("f")
    p = power.withColumns({"_b": F.lag("power").over(w), "_a": F.lead("power").over(w), "_top": F.max("f").over(W.partitionBy(*group))})
    p = p.where((F.col("power") > F.col("_b")) & (F.col("power") > F.col("_a")) & (F.col("f") > least_f) & (F.col("f") < F.col("_top") - margin))
    return p.groupBy(*group).agg(F.max_by("f", F.struct("power", -F.col("f"))).alias("f")).withColumns({"low": F.col("f") - margin, "high": F.col("f") + margin})


