"""Scene listings as nested JSON: flattening, matching, file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FEATURES = "id string, bands array<struct<id:string, crs:string>>, properties map<string,string>"


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A row a feature of JSON lines: image_id, satname stays with the caller's folder layout."""
    return flatten(spark.read.schema(FEATURES).json(path))


def flatten(features: DataFrame) -> DataFrame:
    """image_id, ts, cloud_cover, epsg, tile, acc_georef_m, acc_georef_flag, im_quality.

    Cover and tile have one of two names each; a missing error counts as 12 m; the
    accuracy is a number or a word.
    """
    p = lambda *names: F.coalesce(*(F.try_element_at("properties", F.lit(n)) for n in names))
    epsg = F.regexp_extract(F.try_element_at("bands", F.lit(1))["crs"], r"(\d+)$", 1).try_cast("int")
    tile = F.coalesce(p("MGRS_TILE"), F.format_string("%03d%03d", p("WRS_PATH").try_cast("int"), p("WRS_ROW").try_cast("int")))
    accuracy = F.coalesce(p("GEOMETRIC_RMSE_MODEL", "GEOMETRIC_QUALITY_FLAG", "GEOMETRIC_QUALITY"), F.lit("12"))
    return features.select(
        F.col("id").alias("image_id"), F.timestamp_millis(p("system:time_start").try_cast("bigint")).cast("timestamp_ntz").alias("ts"),
        p("CLOUD_COVER", "CLOUDY_PIXEL_PERCENTAGE").try_cast("double").alias("cloud_cover"), epsg.alias("epsg"), tile.alias("tile"),
        accuracy.try_cast("double").alias("acc_georef_m"), F.when(accuracy.try_cast("double").isNull(), accuracy).alias("acc_georef_flag"),
        p("IMAGE_QUALITY", "IMAGE_QUALITY_OLI").alias("im_quality"),
    )


def in_period(scenes: DataFrame, start: str, end: str) -> DataFrame:
    """Scenes from start on and before end."""
    return scenes.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))


def with_cloud_probability(scenes: DataFrame, clouds: DataFrame, key: str = "system_index") -> DataFrame:
    """scenes plus the first matching cloud image (NULL without one). clouds: key, cloud_id."""
    return scenes.join(clouds.groupBy(key).agg(F.min("cloud_id").alias("cloud_id")), key, "left")


def file_names(scenes: DataFrame, site: str) -> DataFrame:
    """scenes plus filename: time, satellite, tile and site; repeated names get _dup1, _dup2 in the order of image_id."""
    base = F.concat_ws("_", F.date_format("ts", "yyyy-MM-dd-HH-mm-ss"), "satname", "tile", F.lit(site), F.lit("ms"))
    w = W.partitionBy("_base").orderBy("image_id")
    out = scenes.withColumn("_base", base).withColumn("_k", F.row_number().over(w) - 1)
    return out.withColumn("filename", F.concat(F.col("_base"), F.when(F.col("_k") > 0, F.concat(F.lit("_dup"), F.col("_k").cast("string"))).otherwise(F.lit("")), F.lit(".tif"))).drop("_base", "_k")
