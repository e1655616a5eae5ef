"""Tables as text: scene metadata, tides, surveys, wide series, manifests, settings."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """filename, satname, ts, tile, epsg, acc_georef_m, acc_georef_flag, im_quality, width, height.

    A file holds a property and its value a line, parted by a tab. The time is in
    the name's first 19 characters; a missing tile is NA; accuracy is a number or
    a word.
    """
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.split("value", "\t").alias("p"))
    wide = raw.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct(F.col("p")[0], F.coalesce(F.get("p", F.lit(1)), F.lit(""))))).alias("m"))
    m = lambda k: F.try_element_at("m", F.lit(k))
    name = F.coalesce(m("filename"), F.element_at(F.split("file", "/"), -1))
    accuracy = m("acc_georef")
    return wide.select(
        name.alias("filename"), F.split(name, "_")[1].alias("satname"), F.to_timestamp_ntz(F.substring(name, 1, 19), F.lit("yyyy-MM-dd-HH-mm-ss")).alias("ts"),
        F.coalesce(m("tile"), F.lit("NA")).alias("tile"), m("epsg").try_cast("int").alias("epsg"), accuracy.try_cast("double").alias("acc_georef_m"),
        F.when(accuracy.try_cast("double").isNull(), accuracy).alias("acc_georef_flag"), m("image_quality").alias("im_quality"),
        m("im_width").try_cast("int").alias("width"), m("im_height").try_cast("int").alias("height"),
    )


def read_tides(spark: SparkSession, path: str, site: str = "site") -> DataFrame:
    """site, ts, tide from a CSV with the columns dates and tide; times without a zone are UTC."""
    raw = spark.read.csv(path, header=True)
    if missing := {"dates", "tide"} - set(raw.columns):
        raise ValueError(f"no column {', '.join(sorted(missing))} in {path}")
    return raw.select(F.lit(site).alias("site"), F.to_timestamp("dates").cast("timestamp_ntz").alias("ts"), F.col("tide").cast("double").alias("tide"))


def write_tides(tides: DataFrame, path: str) -> None:
    """CSV of ISO dates and six decimals."""
    out = tides.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dates"), F.format_string("%.6f", "tide").alias("tide"))
    out.write.mode("overwrite").csv(path, header=True)


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """profile_id, date, chainage, elevation."""
    raw = spark.read.csv(path, header=True)
    return raw.select(F.col("Profile ID").alias("profile_id"), F.to_timestamp("Date").cast("timestamp_ntz").alias("date"), F.col("Chainage").cast("double").alias("chainage"), F.col("Elevation").cast("double").alias("elevation"))


def wide_series(series: DataFrame, transects: list[str], value: str = "chainage") -> DataFrame:
    """A row a time and scene, a column a transect; the columns are given, so no pass looks for them."""
    out = series.groupBy("ts", "scene_id").pivot("transect_id", transects).agg(F.first(value))
    return out.select("ts", "scene_id", *(F.col(f"`{t}`").alias(f"Transect {t}") for t in transects))


def write_wide(series: DataFrame, transects: list[str], path: str, value: str = "chainage") -> None:
    wide_series(series, transects, value).orderBy("ts", "scene_id").drop("scene_id").write.mode("overwrite").csv(path, header=True)


def upsert_manifest(old: DataFrame, new: DataFrame, key: str = "scene_id") -> DataFrame:
    """Entries of new replace those of old; entries without an id are left out."""
    kept = old.where(F.col(key).isNotNull()).join(new.select(key), key, "left_anti")
    return kept.unionByName(new.where(F.col(key).isNotNull()), allowMissingColumns=True)


def scene_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON manifest keyed by scene id."""
    raw = spark.read.text(path, wholetext=True)
    schema = "map<string, struct<satellite:string, date:string, cloud_cover:double, cloud_cover_combined:double, total_pixels:bigint, valid_pixels:bigint, land_fraction:double, water_fraction:double, skipped:boolean, skip_reason:string>>"
    return raw.select(F.explode(F.from_json("value", schema)).alias("scene_id", "m")).select("scene_id", "m.*")


def batch_report(runs: DataFrame) -> DataFrame:
    """Runs with those that ended well first, and the counts of both."""
    w = W.partitionBy()
    return runs.withColumns({"n_success": F.sum(F.col("ok").cast("int")).over(w), "n_failed": F.sum((~F.col("ok")).cast("int")).over(w)}).orderBy(F.desc("ok"), "site")


@dataclass(frozen=True)
class Settings:
    """A site's settings; paths are absolute."""

    sitename: str
    output_epsg: int
    aoi_path: str | None = None
    reference_shoreline: str | None = None
    transects: str | None = None
    tide_csv_path: str | None = None
    fes_config: str | None = None
    reference_elevation: float = 0.0
    beach_slope: float = 0.1
    lower_percentile: float = 5.0
    upper_percentile: float = 95.0
    extra: dict = field(default_factory=dict)

    @property
    def tide_mode(self) -> str:
        return "csv" if self.tide_csv_path else "fes" if self.fes_config else "none"


PATHS = ("aoi_path", "reference_shoreline", "transects", "tide_csv_path", "fes_config")


def tide_filter(value) -> tuple[float, float]:
    """Bounds from {lower_percentile, upper_percentile} or a pair; both in 0..100, in order."""
    low, high = (value.get("lower_percentile", 5), value.get("upper_percentile", 95)) if isinstance(value, dict) else value or (5, 95)
    if not 0 <= low < high <= 100:
        raise ValueError(f"tide filter out of order: {low}, {high}")
    return float(low), float(high)


def read_settings(path: str) -> Settings:
    """Settings from JSON; relative paths start at the file's folder; output_epsg must be there."""
    with open(path) as f:
        raw = json.load(f)
    if "output_epsg" not in raw:
        raise ValueError("output_epsg is missing")
    inputs, here = raw.get("inputs", {}), os.path.dirname(os.path.abspath(path))
    at = {k: os.path.normpath(os.path.join(here, inputs[k])) for k in PATHS if inputs.get(k)}
    low, high = tide_filter(raw.get("tide_filter"))
    known = {"inputs", "output_epsg", "tide_filter"}
    return Settings(
        sitename=inputs.get("sitename", "site"), output_epsg=int(raw["output_epsg"]), **at, reference_elevation=float(inputs.get("reference_elevation") or 0.0), beach_slope=float(inputs.get("beach_slope") or 0.1),
        lower_percentile=low, upper_percentile=high, extra={k: v for k, v in raw.items() if k not in known},
    )
