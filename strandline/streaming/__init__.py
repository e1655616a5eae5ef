"""Streams of observations: late data, duplicates, windows and despiking state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_scenes(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Each (scene_id, ts) once; what comes later than the delay is dropped by the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["scene_id"])


def windowed(stream: DataFrame, width: str = "30 days", slide: str | None = None, delay: str = "10 days") -> DataFrame:
    """Mean position and count by transect and window."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    agg = stream.withWatermark("ts", delay).groupBy(w.alias("w"), "transect_id").agg(F.avg("chainage").alias("average"), F.count("chainage").alias("n"))
    return agg.select(F.col("w.start").alias("window_start"), "transect_id", "average", "n")


def steps(stream: DataFrame) -> DataFrame:
    """transect_id, scene_id, step: change since the transect's last position, kept as state (one number a transect)."""

    def one(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "scene_id"])
        rows = rows[rows["chainage"].notna()]
        out = []
        for scene, x in zip(rows["scene_id"], rows["chainage"], strict=True):
            out.append((key[0], scene, None if last is None else x - last))
            last = x
        if last is not None:
            state.update((float(last),))
        yield pd.DataFrame(out, columns=["transect_id", "scene_id", "step"]).astype({"transect_id": "int64", "scene_id": "int64", "step": "float64"})

    return stream.groupBy("transect_id").applyInPandasWithState(one, "transect_id long, scene_id long, step double", "last double", "append", "NoTimeout")
