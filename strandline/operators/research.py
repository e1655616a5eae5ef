"""Spectra, seasons, shared slopes, residuals and noise of series and images."""

from __future__ import annotations

from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage import cut


def seasonal(ts: Column, amplitude: float, per_second: float) -> Column:
    """amplitude * sin(2 pi f t), t in seconds since 1970."""
    return amplitude * F.sin(2 * pi * per_second * (F.unix_micros(ts.cast("timestamp")) / 1_000_000))


def fft_spectrum(series: DataFrame, key: list[str], order: str, value: str, step: float) -> DataFrame:
    """key, frequency, power: |FFT|^2 at the frequencies from 0, of evenly spaced values (a series a group)."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*key).schema.fields)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(order)[value].to_numpy(np.float64)
        f = np.fft.fftfreq(len(y), step)
        p = np.abs(np.fft.fft(y)) ** 2
        at = np.flatnonzero(f >= 0)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] * len(at) for k in key}, "frequency": f[at], "power": p[at]})

    return series.groupBy(*key).applyInPandas(one, f"{kinds}, frequency double, power double")


def standardised(series: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """series plus x from the middle of its range and y in standard deviations (of a sample) from its mean; rows without y go."""
    known = series.where(F.col(y).isNotNull())
    s = known.groupBy(*key).agg(((F.min(x) + F.max(x)) / 2).alias("_mid"), F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_sd"))
    return known.join(s, key).withColumns({"x_std": F.col(x) - F.col("_mid"), "y_std": F.try_divide(F.col(y) - F.col("_mean"), F.col("_sd"))}).drop("_mid", "_mean", "_sd")


def sheared(y: Column, x: Column, slope: Column) -> Column:
    """y with a slope's share taken out."""
    return y - slope * x


def residual(y: Column, x: Column, slope: Column, biases: Column) -> Column:
    """Signed distance from the nearest of the lines slope * x + bias."""
    gaps = F.transform(biases, lambda b: y - (slope * x + b))
    return F.aggregate(gaps, F.lit(None).cast("double"), lambda a, g: F.when(a.isNull() | (F.abs(g) < F.abs(a)), g).otherwise(a))


def skew_test(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, n, skewness, z: D'Agostino's test of a normal skewness (NULL under 8 values)."""
    s = rows.where(F.col(value).isNotNull()).groupBy(*key).agg(F.count("*").alias("n"), F.skewness(value).alias("skewness"))
    n, g = F.col("n").cast("double"), F.col("skewness")
    y = g * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    delta, a = 1 / F.sqrt(F.log(w2) / 2), F.sqrt(2 / (w2 - 1))
    z = delta * F.log(y / a + F.sqrt((y / a) * (y / a) + 1))
    return s.withColumn("z", F.when(F.col("n") >= 8, z))


def shared_slope_lines(series: DataFrame, key: list[str], x: str, y: str, lines: int = 2, rho: float = 5.0, rounds: int = 750, rate: float = 0.01) -> DataFrame:
    """key, slope, biases, loss: parallel lines through points that belong to one or another of them (a series a group).

    The mean of each point's squared errors, weighed by a soft minimum over the
    lines, is lessened by Adam over all points of the group; lines begin flat, at
    the least and greatest y and evenly between.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*key).schema.fields)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.dropna(subset=[x, y]).sort_values([x, y])
        u, v = p[x].to_numpy(np.float64), p[y].to_numpy(np.float64)
        if not len(u):
            return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in key}, "slope": [None], "biases": [None], "loss": [None]})
        w = np.r_[0.0, np.linspace(v.min(), v.max(), lines) if lines > 1 else v.mean()]
        m, s, loss = np.zeros(lines + 1), np.zeros(lines + 1), np.inf
        for t in range(1, rounds + 1):
            gap = w[0] * u[:, None] + w[None, 1:] - v[:, None]
            e = gap**2
            share = np.exp(-rho * (e - e.min(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
            mean = (e * share).sum(axis=1, keepdims=True)
            loss = float(mean.mean())
            slope = share * (1 - rho * (e - mean)) * 2 * gap / len(u)
            g = np.r_[(slope * u[:, None]).sum(), slope.sum(axis=0)]
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in key}, "slope": [w[0]], "biases": [w[1:].tolist()], "loss": [loss]})

    return series.groupBy(*key).applyInPandas(one, f"{kinds}, slope double, biases array<double>, loss double")


def semivariogram(pixels: DataFrame, value: str, most: int, axis: str = "col") -> DataFrame:
    """scene_id, lag, n, gamma: Cressie's estimate of half the variance of differences, along rows or columns.

    Each pixel meets the ones up to `most` further along its own line, in a frame
    of that width over the line in order: one shuffle of the pixels, and nothing is
    joined or broadcast. A pixel without a place is left out.
    """
    line = "row" if axis == "col" else "col"
    p = pixels.where(F.col(value).isNotNull() & ~F.isnan(value)).select("scene_id", F.col(line).alias("_line"), F.col(axis).alias("_at"), F.col(value).cast("double").alias("_v")).dropna()
    w = W.partitionBy("scene_id", "_line").orderBy("_at").rangeBetween(1, most)
    met = p.withColumn("_next", F.collect_list(F.struct("_at", "_v")).over(w)).withColumn("_next", F.explode("_next"))
    d = met.groupBy("scene_id", (F.col("_next._at") - F.col("_at")).cast("int").alias("lag")).agg(F.count("*").alias("n"), F.avg(F.sqrt(F.abs(F.col("_v") - F.col("_next._v")))).alias("_m"))
    n = F.col("n").cast("double")
    return d.select("scene_id", "lag", "n", (F.pow("_m", 4) / (0.457 + 0.494 / n + 0.045 / (n * n)) / 2).alias("gamma"))


def gaussian_model(g: DataFrame, steps: int = 100) -> DataFrame:
    """scene_id, reach, sill, nugget, misfit: the Gaussian variogram model that fits gamma at the lags best, by least squares.

    gamma = nugget + sill (1 - exp(-(2 lag / reach)^2)), sill and nugget 0 or more,
    reach at most the largest lag. For a given reach the model is linear, so sill
    and nugget follow from sums over the scene's lags; reach is taken from an even
    grid of `steps`, and then from one as fine between its neighbours. A scene has a
    row a lag, and every candidate is summed beside the others. g is read four times,
    so it is made once before.
    """
    g, lag = cut(g), F.col("lag").cast("double")
    span = g.groupBy("scene_id").agg(F.max(lag).alias("_top"))

    def best(grid: DataFrame) -> DataFrame:
        e = 1 - F.exp(-F.pow(2 * lag / F.col("reach"), 2))
        x = g.join(grid, "scene_id").withColumn("_e", e).groupBy("scene_id", "_step", "reach")
        x = x.agg(F.count("*").alias("n"), *(F.sum(v).alias(k) for k, v in {"se": F.col("_e"), "sg": F.col("gamma"), "see": F.col("_e") * F.col("_e"), "seg": F.col("_e") * F.col("gamma"), "sgg": F.col("gamma") * F.col("gamma")}.items()))
        slope = F.try_divide(F.expr("n * seg - se * sg"), F.expr("n * see - se * se"))
        x = x.withColumn("_c", slope).withColumn("_b", (F.col("sg") - F.col("_c") * F.col("se")) / F.col("n"))
        flat, rising = F.col("_c").isNull() | (F.col("_c") < 0), F.col("_b") < 0
        x = x.withColumns({"sill": F.when(flat, 0.0).when(rising, F.greatest(F.try_divide("seg", "see"), F.lit(0.0))).otherwise(F.col("_c")), "nugget": F.when(flat, F.col("sg") / F.col("n")).when(rising, 0.0).otherwise(F.col("_b"))})
        misfit = F.expr("sgg - 2 * sill * seg - 2 * nugget * sg + sill * sill * see + 2 * sill * nugget * se + n * nugget * nugget")
        x = x.withColumn("misfit", misfit)
        kept = F.struct("_step", "reach", "sill", "nugget", "misfit")
        return x.groupBy("scene_id").agg(F.min_by(kept, F.struct(F.round("misfit", 12), "reach")).alias("m")).select("scene_id", "m.*")

    coarse = span.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select("scene_id", (F.col("_top") / steps).alias("_step"), (F.col("_k") * F.col("_top") / steps).alias("reach"))
    first = best(coarse)
    near = first.withColumn("_k", F.explode(F.sequence(F.lit(1 - steps), F.lit(steps - 1)))).select("scene_id", "_step", (F.col("reach") + F.col("_k") * F.col("_step") / steps).alias("reach"))
    fine = best(near.join(span, "scene_id").where("reach > 0 AND reach <= _top").drop("_top"))
    return fine.drop("_step")


def nugget(gammas: DataFrame) -> DataFrame:
    """scene_id, noise: the root of the variogram's value at lag 0, on the line through its lags."""
    s = gammas.groupBy("scene_id").agg(F.regr_intercept("gamma", "lag").alias("_c"))
    return s.select("scene_id", F.sqrt(F.greatest("_c", F.lit(0.0))).alias("noise"))


def noise_to_add(value: Column, source: Column, target: Column) -> Column:
    """Standard deviation of the noise that takes a value from one signal-to-noise ratio to a lower one; 0 where it isn't lower."""
    return F.when(source > target, F.sqrt(F.pow(value / target, 2) - F.pow(value / source, 2))).otherwise(0.0)


def outlying(metric: Column, low: float, high: float) -> Column:
    return (metric < low) | (metric > high)


def floored(similarity: Column, least: float = 0.6) -> Column:
    """NULL under the least similarity."""
    return F.when(similarity >= least, similarity)


def common_rows(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a whose key b has too, with b's other columns: series cut to what both have."""
    return a.join(b, key)
