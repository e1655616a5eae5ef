"""Water indices of a pixel's bands; NULL where a denominator is 0 or a band is missing.

Coefficients are fixed values of the published indices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = ["b", "g", "r", "nir", "swir1", "swir2"]


def nd(a: Column, b: Column) -> Column:
    """Normalised difference (a - b) / (a + b)."""
    return F.try_divide(a - b, a + b)


def indices() -> dict[str, Column]:
    """Every index by name, over columns b, g, r, nir, swir1, swir2."""
    b, g, r, n, s1, s2 = (F.col(c) for c in BANDS)
    total = b + g + r
    return {
        "mndwi": nd(g, s1),
        "ndwi": nd(g, n),
        "awei_sh": b + 2.5 * g - 1.5 * (n + s1) - 0.25 * s2,
        "awei_ns": 4 * (g - s1) - (0.25 * n + 2.75 * s2),
        "scowi": b + 2 * (g - n) - 0.75 * s1 - 0.5 * s2,
        "wi2015": 1.7204 + 171 * g + 3 * r - 70 * n - 45 * s1 - 71 * s2,
        "andwi": nd(b + g + r, n + s1 + s2),
        "wri": F.try_divide(g + r, n + s1),
        "ewi": nd(b, r + n),
        "nwi": nd(b, n + s1 + s2),
        "wi2019": F.try_divide(1.75 * g - r - 1.08 * s1, g + s1),
        "tct_wetness": -(0.1511 * b + 0.1973 * g + 0.3283 * r + 0.3407 * n + 0.7117 * s1 + 0.4559 * s2),
        "ddwi": g - n,
    }


def land_water(pixels: DataFrame) -> DataFrame:
    """Per scene: share of land and water among finite clear pixels, and their number.

    (g - swir1) / (g + swir1), a zero sum read as 1e-6; water where over 0.
    """
    total = F.col("g") + F.col("swir1")
    v = (F.col("g") - F.col("swir1")) / F.when(total == 0, F.lit(1e-6)).otherwise(total)
    clear = pixels.where("NOT cloud AND g IS NOT NULL AND swir1 IS NOT NULL").select("scene_id", v.alias("v"))
    return clear.groupBy("scene_id").agg(F.avg((F.col("v") > 0).cast("double")).alias("water_fraction"), F.avg((F.col("v") <= 0).cast("double")).alias("land_fraction"), F.count("*").alias("valid_pixels"))


def candidate_signature(pixels: DataFrame, thresholds: DataFrame, value: str, bands: list[str]) -> DataFrame:
    """scene_id, bands: the mean of each band over the clear pixels of the buffer whose index `value` is under the scene's threshold: what water looks like."""
    water = pixels.where("in_buffer AND NOT cloud").join(thresholds, "scene_id").where(F.col(value) < F.col("threshold"))
    return water.groupBy("scene_id").agg(*(F.avg(b).alias(b) for b in bands))


def _long(pixels: DataFrame, names: list[str], key: list[str]) -> DataFrame:
    return pixels.unpivot(key, names, "index_name", "value")


def ensemble_mean(pixels: DataFrame, names: list[str], key: list[str], threshold) -> DataFrame:
    """Mean over indices of each one, scaled to 0..1 over its scene, less its threshold.

    threshold(frame, group columns, value column) gives group columns and `threshold`.
    """
    group = ["scene_id", "index_name"]
    long = _long(pixels, names, key)
    span = long.groupBy(*group).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    scaled = long.join(span, group).withColumn("u", F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")))
    return scaled.join(threshold(scaled, group, "u"), group).groupBy(*key).agg(F.avg(F.col("u") - F.col("threshold")).alias("ensemble"))


def ensemble_vote(pixels: DataFrame, names: list[str], key: list[str], threshold) -> DataFrame:
    """Share of indices under their scene's threshold."""
    group = ["scene_id", "index_name"]
    long = _long(pixels, names, key)
    return long.join(threshold(long, group, "value"), group).groupBy(*key).agg(F.avg((F.col("value") < F.col("threshold")).cast("double")).alias("ensemble"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two spectra (arrays)."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def capped_share(a: Column, land: Column, water: Column) -> Column:
    """Place of a spectrum on the line from a land to a water signature, capped to 0..1."""
    diff = F.zip_with(water, land, lambda p, q: p - q)
    off = F.zip_with(a, land, lambda p, q: p - q)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return F.greatest(F.least(F.try_divide(dot(off, diff), dot(diff, diff)), F.lit(1.0)), F.lit(0.0))


def standardize(pixels: DataFrame, value: str, group: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """pixels with `value` scaled from its span in the group to low..high; NULL where the span is 0. NaN counts as missing."""
    whole = pixels.withColumn(value, F.when(~F.isnan(value), F.col(value)))
    span = whole.groupBy(*group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    share = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return whole.join(span, group, "left").withColumn(value, low + (high - low) * share).drop("_lo", "_hi")
