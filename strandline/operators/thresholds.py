"""Histogram thresholds as aggregates: Otsu, local minima, matching, Kolmogorov-Smirnov.

A histogram has at most `bins` rows a group, so windows over it are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .fill import ahead, behind


def finite(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number."""
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))


def _counted(df: DataFrame, group: list[str], value: str, bins: int) -> DataFrame:
    """group, bin, n and the bins' origin and width, for bins that hold a row."""
    v = finite(df, value)
    span = v.groupBy(*group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.floor(F.coalesce(F.try_divide(F.col(value) - F.col("_lo"), width), F.lit(0.0))), F.lit(bins - 1)).cast("int")
    h = v.join(span, group) if group else v.crossJoin(F.broadcast(span))
    return h.groupBy(*group, at.alias("bin"), "_lo", width.alias("_w")).agg(F.count("*").alias("n"))


def _centre() -> Column:
    return F.col("_lo") + (F.col("bin") + 0.5) * F.col("_w")


def histogram(df: DataFrame, group: list[str], value: str, bins: int = 256) -> DataFrame:
    """group, bin, n, centre: equal bins between the group's least and greatest value; missing values and NaN are left out."""
    return _counted(df, group, value, bins).select(*group, "bin", "n", _centre().alias("centre"))


def full_histogram(df: DataFrame, group: list[str], value: str, bins: int = 256) -> DataFrame:
    """The same with the empty bins between; a group of one value has one bin."""
    h = _counted(df, group, value, bins)
    span = h.groupBy(*group).agg(F.first("_lo").alias("_lo"), F.first("_w").alias("_w"), F.max("bin").alias("_last"))
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    met = grid.join(h.select(*group, "bin", "n"), [*group, "bin"], "left")
    return met.select(*group, "bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"), _centre().alias("centre"))


def fixed_histogram(df: DataFrame, group: list[str], value: Column, low: float, width: float, bins: int) -> DataFrame:
    """group, bin, n for bins of a given width from low; the last one includes its upper end, others fall out."""
    b = F.when(value == low + width * bins, bins - 1).otherwise(F.floor((value - low) / width)).cast("int")
    kept = df.where(~F.isnan(value.cast("double")))
    return kept.select(*group, b.alias("bin")).where(F.col("bin").between(0, bins - 1)).groupBy(*group, "bin").agg(F.count("*").alias("n"))


def otsu(df: DataFrame, group: list[str], value: str, bins: int = 256) -> DataFrame:
    """group, threshold: the bin centre that parts the histogram with the greatest variance between classes (first on ties).

    A group of one value has that value as its threshold.
    """
    h = histogram(df, group, value, bins)
    up = W.partitionBy(*group).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*group)
    m = F.col("n") * F.col("centre")
    s = h.withColumns({"_w1": F.sum("n").over(up), "_m1": F.sum(m).over(up), "_w": F.sum("n").over(whole), "_m": F.sum(m).over(whole)})
    w2 = F.col("_w") - F.col("_w1")
    gap = F.col("_m1") / F.col("_w1") - F.try_divide(F.col("_m") - F.col("_m1"), w2)
    s = s.withColumn("_v", F.coalesce(F.round(F.col("_w1") * w2 * gap * gap, 6), F.lit(-1.0)))
    return s.groupBy(*group).agg(F.min_by("centre", F.struct(-F.col("_v"), F.col("bin"))).alias("threshold"))


def peaks(h: DataFrame, group: list[str]) -> DataFrame:
    """Of a full histogram (group, bin, n, centre) the bins higher than what is on either side.

    A run of equal bins is one peak, in its middle (the lower of two); a run that
    touches an end of the histogram is none.
    """
    w = W.partitionBy(*group).orderBy("bin")
    changed = F.when(F.lag("n").over(w) == F.col("n"), 0).otherwise(1)
    runs = h.withColumn("_new", changed).withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.groupBy(*group, "_run").agg(F.floor((F.min("bin") + F.max("bin")) / 2).cast("int").alias("bin"), F.first("n").alias("_n"))
    by = W.partitionBy(*group).orderBy("_run")
    top = runs.withColumns({"_b": F.lag("_n").over(by), "_a": F.lead("_n").over(by)}).where("_n > _b AND _n > _a")
    return h.join(top.select(*group, "bin"), [*group, "bin"], "left_semi")


def local_minimum(df: DataFrame, group: list[str], value: str, bins: int = 256) -> DataFrame:
    """group, threshold: the emptiest bin between the highest peaks on either side of the Otsu threshold.

    Where a side has no peak, the Otsu threshold bounds the valley; where no bin
    lies between, it is the result. The first of equal peaks and of equal bins.
    """
    h, o = full_histogram(df, group, value, bins), otsu(df, group, value, bins)
    best = lambda side: F.max_by("centre", F.when(side, F.struct("n", -F.col("bin"))))
    sides = peaks(h, group).join(o, group).groupBy(*group).agg(best(F.col("centre") < F.col("threshold")).alias("_l"), best(F.col("centre") >= F.col("threshold")).alias("_r"))
    bounds = o.join(sides, group, "left").withColumns({"_l": F.coalesce("_l", "threshold"), "_r": F.coalesce("_r", "threshold")})
    valley = h.join(bounds, group).where("centre > _l AND centre < _r").groupBy(*group).agg(F.min_by("centre", F.struct("n", "bin")).alias("_v"))
    return o.join(valley, group, "left").select(*group, F.coalesce("_v", "threshold").alias("threshold"))


def left_peak(df: DataFrame, group: list[str], value: str, bins: int = 256) -> DataFrame:
    """group, threshold: the highest peak under the Otsu threshold (the first of equal ones), or that threshold where there is none."""
    h, o = full_histogram(df, group, value, bins), otsu(df, group, value, bins)
    low = peaks(h, group).join(o, group).where("centre < threshold").groupBy(*group).agg(F.max_by("centre", F.struct("n", -F.col("bin"))).alias("_l"))
    return o.join(low, group, "left").select(*group, F.coalesce("_l", "threshold").alias("threshold"))


def match_histogram(source: DataFrame, template: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, value, matched: each distinct source value at the template's value of the same quantile, linear between.

    Quantiles of both sides are merged in one sorted stream a group.
    """
    def quantiles(df: DataFrame) -> DataFrame:
        c = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
        up = W.partitionBy(*group).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
        return c.select(*group, F.col(value).alias("_v"), (F.sum("n").over(up) / F.sum("n").over(W.partitionBy(*group))).alias("_q"))

    s = quantiles(source).withColumn("_kind", F.lit(1))
    t = quantiles(template).withColumn("_kind", F.lit(0))
    both = s.unionByName(t)
    tq, tv = F.when(F.col("_kind") == 0, F.col("_q")), F.when(F.col("_kind") == 0, F.col("_v"))
    up, down = [F.col("_q"), F.col("_kind"), F.col("_v")], [F.col("_q").desc(), F.col("_kind"), F.col("_v").desc()]
    both = both.withColumns({"_q0": behind(tq, group, up), "_v0": behind(tv, group, up), "_q1": ahead(tq, group, down), "_v1": ahead(tv, group, down)})
    share = F.coalesce(F.try_divide(F.col("_q") - F.col("_q0"), F.col("_q1") - F.col("_q0")), F.lit(0.0))
    matched = F.coalesce(F.col("_v0") + share * (F.col("_v1") - F.col("_v0")), "_v0", "_v1")
    return both.where("_kind = 1").select(*group, F.col("_v").alias(value), matched.alias("matched"))


def ks_test(a: DataFrame, b: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, statistic, n_a, n_b, p_value: two-sample Kolmogorov-Smirnov test; equal values step together.

    The p value is the limiting distribution's, by its alternating series; 1 where
    the scaled statistic is under 0.2 (there it differs from 1 by less than 1e-12).
    """
    both = a.select(*group, F.col(value).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*group, F.col(value).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    c = finite(both, "v").groupBy(*group, "v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    up, whole = W.partitionBy(*group).orderBy("v").rowsBetween(W.unboundedPreceding, 0), W.partitionBy(*group)
    share = lambda x: F.try_divide(F.sum(x).over(up), F.sum(x).over(whole))
    d = c.select(*group, "a", "b", F.abs(share("a") - share("b")).alias("d"))
    d = d.groupBy(*group).agg(F.max("d").alias("statistic"), F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    scaled = F.col("statistic") * F.sqrt(F.try_divide(F.col("n_a") * F.col("n_b"), F.col("n_a") + F.col("n_b")))
    return d.withColumn("p_value", F.when(scaled < 0.2, 1.0).when(scaled.isNotNull(), kolmogorov(scaled)))


def kolmogorov(x: Column, terms: int = 40) -> Column:
    """P(K > x) of Kolmogorov's distribution, for x of 0.2 or more."""
    total = F.lit(0.0)
    for k in range(1, terms + 1):
        total = total + (-1) ** (k - 1) * 2.0 * F.exp(-2.0 * k * k * x * x)
    return F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0))


def ks_statistic(a: DataFrame, b: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, statistic: greatest gap of two empirical distributions."""
    return ks_test(a, b, group, value).select(*group, "statistic")
