"""The site pipeline: stages that add frames, each written once and resumable.

A stage is a function of (frames, settings) that returns new frames by name. A run
writes them as Parquet under `folder`, one folder a stage, with a marker when all
are there; a resumed run reads finished stages back instead of running them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, joins, scenes, selection, series, slopes, tides
from ..operators.lineage import cut
from ..sources.tables import Settings

Frames = dict[str, DataFrame]


def clean(f: Frames, s: Settings) -> Frames:
    """Scenes that are clear, accurate and not doubled."""
    keep = scenes.clear_enough(F.col("cloud_cover") * 100) & scenes.accurate(F.col("acc_georef_flag"), F.col("acc_georef_m")) & scenes.before_retirement(F.col("satname"), F.col("ts"))
    return {"scenes_kept": scenes.drop_close(f["scenes"].where(keep))}


def intersect(f: Frames, s: Settings) -> Frames:
    """Positions by scene and transect."""
    points = f["points"].join(f["scenes_kept"].select("scene_id"), "scene_id", "left_semi")
    near = joins.transect_points(f["transects"], points)
    ux, uy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    length = F.sqrt(ux * ux + uy * uy)
    near = near.join(f["transects"], "transect_id").withColumn("along_normal", (F.col("nx") * ux + F.col("ny") * uy) / length)
    pos = selection.positions(near).join(f["scenes_kept"].select("scene_id", "ts", "satname", "threshold"), "scene_id")
    return {"positions": pos, "rejections": series.rejection_counts(pos)}


def searches_slopes(s: Settings) -> bool:
    """Slopes are searched with model tides, or where the settings ask for it; a tide table alone goes with the site's slope."""
    return bool(s.extra.get("slope_search", s.tide_mode == "fes"))


def estimate_slopes(f: Frames, s: Settings) -> Frames:
    """A beach slope for each transect, with its interval, and the site's tidal band.

    Observations of the settled period and within the tide filter, without noisy
    missions, are used (with the fallbacks of slope_rows). The band lies around the
    highest peak in the spectrum of the tides at the images' dates; the slope is
    the one whose correction leaves least energy there. Where the search isn't
    asked for, or finds nothing for a transect, the site's slope stands.
    """
    spark, given = f["transects"].sparkSession, f["transects"].select("transect_id")
    site = F.lit(s.sitename).alias("site")
    constant = given.select("transect_id", F.lit(s.beach_slope).alias("slope"), *(F.lit(None).cast("double").alias(c) for c in ("ci_lo", "ci_hi")), F.lit(True).alias("is_default"))
    no_band = spark.createDataFrame([], "site string, f double, low double, high double")
    if not searches_slopes(s):
        return {"slopes": constant, "tidal_band": no_band}
    table = f["tides"].drop("site").select("*", site)
    matched = tides.within_bounds(tides.next_value(f["positions"].select("*", site), table, ["site"], "tide"), table, s.lower_percentile, s.upper_percentile)
    period = s.extra.get("slope_period", ("2020-01-01", "2025-01-01"))
    used = cut(scenes.slope_rows(matched, *period, tuple(s.extra.get("slope_without", ("S2",)))))
    dated = used.where("tide IS NOT NULL").groupBy("site", "scene_id").agg(F.first("ts").alias("ts"), F.first("tide").alias("tide"))
    days = dated.agg((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 86_400_000_000).first()[0]
    grid = slopes.frequency_grid(days, s.extra.get("slope_least_days", 8)) if days else []
    if not grid:
        return {"slopes": constant, "tidal_band": no_band}
    step = grid[1] - grid[0] if len(grid) > 1 else 0.0
    frequencies = spark.range(len(grid)).select((F.lit(grid[0]) + F.col("id") * step).alias("f"))
    power = slopes.spectrum(dated, ["site"], "tide", frequencies)
    band = slopes.tidal_peak(power, ["site"], margin=max(1e-8, 1.5 * step))
    wide = frequencies.join(F.broadcast(band.select("low", "high")), (F.col("f") >= F.col("low")) & (F.col("f") <= F.col("high")))  # a row a site
    weighed = wide.select("f", F.lit(step).alias("weight"))
    low, high, by = s.extra.get("slope_grid", (0.01, 0.2, 0.005))
    found = slopes.best_slope(slopes.band_energy(used, weighed, slopes.slope_grid(low, high, by)), default=s.beach_slope)
    both = given.join(found, "transect_id", "left")
    kept = both.select("transect_id", F.coalesce("slope", F.lit(s.beach_slope)).alias("slope"), "ci_lo", "ci_hi", F.coalesce("is_default", F.lit(True)).alias("is_default"))
    return {"slopes": kept, "tidal_band": band}


def correct(f: Frames, s: Settings) -> Frames:
    """Positions corrected for the tide by each transect's slope."""
    site = f["positions"].withColumn("site", F.lit(s.sitename))
    table = f["tides"].withColumn("site", F.lit(s.sitename))
    return {"corrected": tides.correct_series(site, table, s.beach_slope, s.reference_elevation, s.lower_percentile, s.upper_percentile, slopes=f["slopes"])}


def summarise(f: Frames, s: Settings) -> Frames:
    """Good observations, their averages and trends."""
    x = f["corrected"].select("transect_id", "scene_id", "ts", F.col("corrected").alias("chainage"), "threshold")
    good = series.reject_outliers(x).where("outcome = 'good'").drop("outcome")
    trend = series.trend(good)
    records = evaluate.trend_records(f["corrected"], trend, f["slopes"], f["transects"])
    return {"series": good, "seasonal": series.seasonal_average(good), "monthly": series.monthly_average(good), "trends": records}


STAGES: list[tuple[str, Callable[[Frames, Settings], Frames]]] = [("clean", clean), ("intersect", intersect), ("slopes", estimate_slopes), ("correct", correct), ("summarise", summarise)]


def run(spark: SparkSession, frames: Frames, settings: Settings, folder: str, first: str | None = None, stages=STAGES) -> Frames:
    """All frames; from `first` on stages run anew, earlier ones are read back where finished."""
    names = [n for n, _ in stages]
    if first is not None and first not in names:
        raise ValueError(f"no stage {first}; there are {', '.join(names)}")
    out, timing = dict(frames), {}
    for at, (name, stage) in enumerate(stages):
        done = f"{folder}/{name}/_frames"
        if first is not None and at < names.index(first):
            try:
                made = [r.value for r in spark.read.text(done).collect()]
            except Exception as e:
                raise ValueError(f"stage {name} has no results in {folder}") from e
            out |= {k: spark.read.parquet(f"{folder}/{name}/{k}") for k in json.loads(made[0])}
            continue
        began = time.time()
        made = stage(out, settings)
        for k, df in made.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}/{k}")
            out[k] = spark.read.parquet(f"{folder}/{name}/{k}")
        spark.createDataFrame([(json.dumps(sorted(made)),)], "value string").coalesce(1).write.mode("overwrite").text(done)
        timing[name] = round(time.time() - began, 1)
        print(f"PROGRESS: {100 * (at + 1) // len(stages)}% {name} {timing[name]} s")
    return out
