"""Pixel classifier, features and clustering with pyspark.ml."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.spectral import nd
from .raster import KEY, focal

#: Class codes.
OTHER, SAND, WHITEWATER, WATER = 0, 1, 2, 3
FIVE = ["b", "g", "r", "nir", "swir1"]


def spectral_features(pixels: DataFrame) -> DataFrame:
    """pixels plus the five normalised differences of the classifier."""
    c = {b: F.col(b) for b in FIVE}
    pairs = {"nd_ng": ("nir", "g"), "nd_sg": ("swir1", "g"), "nd_nr": ("nir", "r"), "nd_sn": ("swir1", "nir"), "nd_br": ("b", "r")}
    return pixels.withColumns({n: nd(c[a], c[b]) for n, (a, b) in pairs.items()})


TEN = [*FIVE, "nd_ng", "nd_sg", "nd_nr", "nd_sn", "nd_br"]
TWENTY = [*TEN, *(f"sd_{n}" for n in TEN)]


def features(pixels: DataFrame) -> DataFrame:
    """KEY and the 20 features: bands, differences, and the local spread of each; missing ones are 1e-9."""
    base = spectral_features(pixels).select(*KEY, *TEN)
    spread = focal(base, 1, {f"sd_{n}": (n, "std") for n in TEN})
    return base.join(spread, KEY, "left").na.fill(1e-9, TWENTY)


def assemble(df: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def split(df: DataFrame, key: list[str], share: float = 0.7, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key: the same rows on any cluster."""
    u = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(10_000)) / 10_000.0
    return df.where(u < share), df.where(u >= share)


def train_classifier(df: DataFrame, names: list[str], classes: int, layers: tuple[int, ...] = (100, 50), rounds: int = 100):
    """Multilayer perceptron over standardised features; df has label."""
    raw = VectorAssembler(inputCols=names, outputCol="raw", handleInvalid="skip").transform(df)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(raw)
    mlp = MultilayerPerceptronClassifier(layers=[len(names), *layers, classes], maxIter=rounds, seed=0, blockSize=128)
    return scaler, mlp.fit(scaler.transform(raw).withColumn("label", F.col("label").cast("double")))


def classify(df: DataFrame, names: list[str], model) -> DataFrame:
    scaler, mlp = model
    raw = VectorAssembler(inputCols=names, outputCol="raw", handleInvalid="skip").transform(df)
    return mlp.transform(scaler.transform(raw)).drop("raw", "features", "rawPrediction", "probability")


def accuracy(predicted: DataFrame) -> float:
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predicted.withColumn("label", F.col("label").cast("double")))


def cross_validate(df: DataFrame, names: list[str], classes: int, key: list[str], folds: int = 10, **kw) -> list[float]:
    fold = F.pmod(F.xxhash64(*key), F.lit(folds))
    out = []
    for k in range(folds):
        model = train_classifier(df.where(fold != k), names, classes, **kw)
        out.append(accuracy(classify(df.where(fold == k), names, model)))
    return out


def even_sample(df: DataFrame, label: str, key: list[str], n: int, seed: int = 0) -> DataFrame:
    """At most n rows of each class, by a hash order."""
    w = W.partitionBy(label).orderBy(F.xxhash64(*key, F.lit(seed)), *key)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def components(df: DataFrame, names: list[str], k: int = 2) -> DataFrame:
    v = assemble(df, names)
    return PCA(k=k, inputCol="features", outputCol="pca").fit(v).transform(v).drop("features")


def kmeans(df: DataFrame, names: list[str], k: int = 2, seed: int = 0) -> DataFrame:
    v = assemble(df, names)
    return KMeans(k=k, seed=seed).fit(v).transform(v).drop("features")


def _one_gaussian(df: DataFrame, names: list[str]) -> float:
    """Log likelihood of one normal distribution with the rows' own mean and covariance."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    r = df.agg(F.count("*").alias("n"), *(F.covar_pop(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs))).first()
    c = np.zeros((len(names), len(names)))
    for k, (a, b) in enumerate(pairs):
        i, j = names.index(a), names.index(b)
        c[i, j] = c[j, i] = r[f"c{k}"]
    return -0.5 * r.n * (len(names) * (np.log(2 * np.pi) + 1) + np.linalg.slogdet(c)[1])


def best_mixture(df: DataFrame, names: list[str], most: int = 2, seed: int = 0) -> tuple[int, dict[int, float]]:
    """Number of Gaussian components (1 to most) with the least BIC, and each BIC."""
    v = assemble(df, names).cache()
    n, d = v.count(), len(names)
    bic = {}
    for k in range(1, most + 1):
        free = k * (d + d * (d + 1) / 2) + k - 1
        fit = _one_gaussian(df, names) if k == 1 else GaussianMixture(k=k, seed=seed).fit(v).summary.logLikelihood
        bic[k] = float(free * np.log(n) - 2 * fit)
    v.unpersist()
    return min(bic, key=bic.get), bic


def dbscan(df: DataFrame, group: list[str], x: str, y: str, eps: float = 10.0, least: int = 5) -> DataFrame:
    """df plus cluster (-1: noise), group by group (a series each); distances within a sorted window of x."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([x, y], ignore_index=True)
        p = pdf[[x, y]].to_numpy(np.float64)
        lo = np.searchsorted(p[:, 0], p[:, 0] - eps)
        hi = np.searchsorted(p[:, 0], p[:, 0] + eps, side="right")
        near = [np.arange(a, b)[((p[a:b] - q) ** 2).sum(axis=1) <= eps * eps] for a, b, q in zip(lo, hi, p, strict=True)]
        label, k = np.full(len(p), -1), 0
        for i in range(len(p)):
            if label[i] >= 0 or len(near[i]) < least:
                continue
            stack = [i]
            while stack:
                j = stack.pop()
                if label[j] < 0:
                    label[j] = k
                    if len(near[j]) >= least:
                        stack.extend(near[j])
            k += 1
        return pdf.assign(cluster=label)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.groupBy(*group).applyInPandas(one, f"{schema}, cluster int")
