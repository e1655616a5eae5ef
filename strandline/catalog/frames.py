"""The driver's tables under the operators' column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spectral import BANDS


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def observations(spark: SparkSession, d: str) -> DataFrame:
    """events: scene_id, transect_id, satname, ts, chainage, quality."""
    quality = F.get_json_object("props", "$.k").cast("int")
    return read(spark, d, "events").select(F.col("event_id").alias("scene_id"), F.col("user_id").alias("transect_id"), F.col("event_type").alias("satname"), "ts", F.col("value").alias("chainage"), quality.alias("quality"))


def long_series(spark: SparkSession, d: str) -> DataFrame:
    """orders: scene_id, transect_id, ts, chainage."""
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("scene_id"), F.col("o_custkey").alias("transect_id"), F.col("o_orderdate").alias("ts"), (F.col("o_totalprice") / 7).alias("chainage"))


def points(spark: SparkSession, d: str, scale: float = 100.0) -> DataFrame:
    """embeddings: pt_id, scene_id (label), x, y."""
    e = lambda i: F.element_at("embedding", i).cast("double") * scale
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("pt_id"), F.col("label").alias("scene_id"), e(1).alias("x"), e(2).alias("y"))


def transects(spark: SparkSession, d: str) -> DataFrame:
    """nation: 25 transects in a fan."""
    k = F.col("n_nationkey").cast("double")
    return read(spark, d, "nation").select(F.col("n_nationkey").alias("transect_id"), (k * 4 - 50).alias("x0"), (k * 2 - 30).alias("y0"), (k * 4 - 20).alias("x1"), (k * 3 - 20).alias("y1"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """embeddings: pixel_id, scene_id (label), bands b .. swir2 as |element| + 0.01, cloud."""
    bands = [(F.abs(F.element_at("embedding", i + 1).cast("double")) + 0.01).alias(b) for i, b in enumerate(BANDS)]
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("pixel_id"), F.col("label").alias("scene_id"), *bands, (F.col("vec_id") % 7 == 0).alias("cloud"))


def tides(spark: SparkSession, d: str) -> DataFrame:
    """The error events as one tide table: site, ts, tide."""
    return read(spark, d, "events").where("event_type = 'error'").select(F.lit("site").alias("site"), "ts", (F.col("value") / 100).alias("tide"))


def at_site(spark: SparkSession, d: str) -> DataFrame:
    """All other events as observations of that site."""
    return observations(spark, d).where("satname <> 'error'").withColumn("site", F.lit("site"))


#: The same frames in SQL.
OBS = "(SELECT event_id AS scene_id, user_id AS transect_id, event_type AS satname, ts, value AS chainage, CAST(json_extract_string(props, '$.k') AS INTEGER) AS quality FROM events)"
LONG = "(SELECT o_orderkey AS scene_id, o_custkey AS transect_id, o_orderdate AS ts, o_totalprice / 7 AS chainage FROM orders)"
POINTS = "(SELECT vec_id AS pt_id, label AS scene_id, embedding[1]::DOUBLE * 100.0::DOUBLE AS x, embedding[2]::DOUBLE * 100.0::DOUBLE AS y FROM embeddings)"
TRANSECTS = "(SELECT n_nationkey AS transect_id, n_nationkey::DOUBLE * 4 - 50 AS x0, n_nationkey::DOUBLE * 2 - 30 AS y0, n_nationkey::DOUBLE * 4 - 20 AS x1, n_nationkey::DOUBLE * 3 - 20 AS y1 FROM nation)"
PIXELS = "(SELECT vec_id AS pixel_id, label AS scene_id, " + ", ".join(f"abs(embedding[{i + 1}]::DOUBLE) + 0.01::DOUBLE AS {b}" for i, b in enumerate(BANDS)) + ", vec_id % 7 = 0 AS cloud FROM embeddings)"
TIDES = "(SELECT 'site' AS site, ts, value / 100 AS tide FROM events WHERE event_type = 'error')"
AT_SITE = f"(SELECT *, 'site' AS site FROM {OBS} WHERE satname <> 'error')"


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Doubles rounded (and -0 as 0), so that engines which add in another order agree."""
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names})
