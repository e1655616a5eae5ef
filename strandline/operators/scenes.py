"""Scene lists: filters, duplicates, merges and upserts.

scenes: scene_id, satname, ts (timestamp without zone, UTC), and what a filter names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def clear_enough(cover: Column, most: float = 95) -> Column:
    """Scenes that aren't nearly all cloud."""
    return cover <= most


def in_months(ts: Column, months: list[int]) -> Column:
    return F.month(ts).isin(*months)


def before_retirement(satname: Column, ts: Column, name: str = "L7", year: int = 2022) -> Column:
    """All but the scenes of one satellite from `year` on."""
    return ~((satname == name) & (F.year(ts) >= year))


def before_line_failure(satname: Column, ts: Column, name: str = "L7", day: str = "2003-05-31") -> Column:
    return ~((satname == name) & (ts >= F.lit(day).cast("timestamp_ntz")))


def accurate(flag: Column, metres: Column, most: float = 10) -> Column:
    """Georeference passed, or its error is known and small."""
    return (flag == "PASSED") | F.coalesce(metres <= most, F.lit(False))


def quality_tolerance(scene: dict, ref: dict, base: Column, cap: float = 0.5) -> Column:
    """Land and water shares near the reference's; a missing figure keeps the scene."""
    tolerance = F.least(F.lit(cap), base * F.greatest(ref["valid"] / F.greatest(scene["valid"], F.lit(1)), F.lit(1.0)))
    far = (F.abs(scene["land"] - ref["land"]) > tolerance) | (F.abs(scene["water"] - ref["water"]) > tolerance)
    return ~F.coalesce(far, F.lit(False))


def extraction_counts(scenes: DataFrame, most_cloud: float, most_empty: float) -> DataFrame:
    """Per satellite: scenes kept, and those left for cloud, for empty pixels, by an error or by the user, each scene by its first reason.

    scenes: satname, cloud_cover, empty_share, failed, accepted. A missing figure
    is an error of reading; a missing decision accepts.
    """
    figures = F.col("cloud_cover").isNull() | F.col("empty_share").isNull() | F.coalesce("failed", F.lit(False))
    reason = F.when(figures, "error").when(F.col("cloud_cover") > most_cloud, "cloud").when(F.col("empty_share") > most_empty, "empty").when(~F.coalesce("accepted", F.lit(True)), "user").otherwise("kept")
    counts = [F.count(F.when(F.col("_why") == k, 1)).alias(k) for k in ("kept", "cloud", "empty", "error", "user")]
    return scenes.withColumn("_why", reason).groupBy("satname").agg(F.count("*").alias("total"), *counts)


def merge(*by_satellite: DataFrame) -> DataFrame:
    """Union of satellites' scenes in the order of time; ties by scene_id."""
    out = by_satellite[0]
    for df in by_satellite[1:]:
        out = out.unionByName(df)
    return out.orderBy("ts", "scene_id")


def not_yet(catalog: DataFrame, have: DataFrame) -> DataFrame:
    """Catalog scenes whose second isn't there yet for their satellite."""
    second = lambda df: df.withColumn("_s", F.date_trunc("second", "ts"))
    return second(catalog).join(second(have).select("satname", "_s"), ["satname", "_s"], "left_anti").drop("_s")


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Upsert: the last row of each key; rows with a NULL key go."""
    known = rows.where(" AND ".join(f"{k} IS NOT NULL" for k in key))
    w = W.partitionBy(*key).orderBy(*(F.col(c).desc() for c in order))
    return known.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def repeated_times(scenes: DataFrame) -> DataFrame:
    """Groups of scenes of one satellite that share a second."""
    return scenes.groupBy("satname", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("second")).agg(F.count("*").alias("n"), F.min("scene_id").alias("first_scene")).where("n > 1")


def drop_close(scenes: DataFrame, seconds: int = 300, site: list[str] | None = None) -> DataFrame:
    """Of scenes at most `seconds` apart, the poorer one goes.

    Each scene meets the first later one. Both without a line (n_points < 2): both
    go. One without: that one. L7 with L9: L7. Else the shorter line, the later on
    a tie. Columns: scene_id, satname, ts, n_points, sl_length; site: the columns
    of a series (none: one series of all rows, which Spark sorts in one task; name
    the site on large inputs).
    """
    w = W.partitionBy(*(site or [])).orderBy("ts", "scene_id")
    nxt = F.lead(F.struct("scene_id", "satname", "ts", "n_points", "sl_length")).over(w)
    pairs = scenes.withColumn("n", nxt).where(F.expr(f"n.ts <= ts + INTERVAL {seconds} SECONDS"))
    empty, other = F.col("n_points") < 2, F.col("n.n_points") < 2
    seven = lambda a, b: (F.col(a) == "L7") & (F.col(b) == "L9")
    mine, theirs = F.array("scene_id"), F.array("n.scene_id")
    losers = (
        F.when(empty & other, F.array("scene_id", "n.scene_id"))
        .when(empty, mine)
        .when(other, theirs)
        .when(seven("satname", "n.satname"), mine)
        .when(seven("n.satname", "satname"), theirs)
        .when(F.col("sl_length") < F.col("n.sl_length"), mine)
        .otherwise(theirs)
    )
    gone = pairs.select(F.explode(losers).alias("scene_id")).distinct()
    return scenes.join(gone, "scene_id", "left_anti")


def one_zone(scenes: DataFrame, site: list[str], hours: int = 24, most: int = 2) -> DataFrame:
    """Of a site's scenes in several zones: its most frequent zone's (lowest code on ties) near each seed, `most` at most.

    The first scene in the order of time is a seed. Of all scenes less than `hours`
    from a seed, those of other zones go and so do the main zone's after the first
    `most`; the next seed is the first scene that no seed has covered. Sites of one
    zone and scenes without a time stay as they are.

    Every scene follows a seed by less than `hours`, so no other zone's scene stays,
    and a main zone's stays where fewer than `most` of its kind came before it since
    `hours` before its seed. A site is read in the order of time with its seed and
    its last `most` times alone: sites are no groups in memory, and a batch has many.
    """
    count = scenes.groupBy(*site, "epsg").agg(F.count("*").alias("_n"))
    rank = F.row_number().over(W.partitionBy(*site).orderBy(F.desc("_n"), "epsg"))
    main = count.withColumns({"_r": rank, "_zones": F.count("*").over(W.partitionBy(*site))}).where("_r = 1 AND _zones > 1").select(*site, F.col("epsg").alias("_main"))
    tagged = scenes.join(main, site).withColumn("_own", F.col("epsg").eqNullSafe(F.col("_main"))).drop("_main")
    begins = F.row_number().over(W.partitionBy(*site).orderBy("ts", "scene_id")) == 1
    tagged = tagged.withColumn("_begins", begins).sortWithinPartitions(*site, "ts", "scene_id")
    columns, span = scenes.columns, hours * 3_600_000_000

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, taken, last = None, 0, deque(maxlen=most)
        for b in batches:
            kept = []
            for begins, own, t in zip(b["_begins"].to_pylist(), b["_own"].to_pylist(), b["ts"].cast(pa.int64()).to_pylist(), strict=True):
                if begins:
                    seed = None
                    last.clear()
                if t is None:
                    kept.append(True)
                    continue
                if seed is None or t >= seed + span:
                    seed, taken = t, sum(x > t - span for x in last)
                kept.append(own and taken < most)
                if own:
                    taken += 1
                    last.append(t)
            yield b.filter(pa.array(kept, pa.bool_())).select(columns)

    return scenes.join(main, site, "left_anti").select(columns).unionByName(tagged.mapInArrow(thin, scenes.schema))


def outside_zones(epsg: Column, excluded: list[int]) -> Column:
    """Scenes whose zone isn't listed."""
    return ~epsg.isin(*excluded) if excluded else F.lit(True)


def with_second_tier(first: DataFrame, second: DataFrame, satellites: tuple[str, ...] = ("L5", "L7", "L8")) -> DataFrame:
    """The first tier's scenes and, of these satellites, the second tier's."""
    return first.unionByName(second.where(F.col("satname").isin(*satellites)))


def without_artefact(scenes: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Scenes that aren't in the manifest (scene_id, filename), or whose file isn't there (files: filename)."""
    made = manifest.join(files, "filename", "left_semi").select("scene_id")
    return scenes.join(made, "scene_id", "left_anti")


def first_that_leaves_any(rows: DataFrame, conditions: list[Column]) -> DataFrame:
    """Rows that meet the first of the conditions which any row meets; all rows where none is met.

    The conditions are counted in one pass.
    """
    counts = rows.agg(*(F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(conditions))).first()
    for i, c in enumerate(conditions):
        if counts[i]:
            return rows.where(c)
    return rows


def slope_rows(rows: DataFrame, start: str, end: str, satellites: tuple[str, ...] = ("S2",)) -> DataFrame:
    """Observations for slopes: in the dates, in the tide range and not of these satellites; else in the dates; else all."""
    dated = F.col("ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return first_that_leaves_any(rows, [dated & F.col("in_range") & ~F.col("satname").isin(*satellites), dated])
