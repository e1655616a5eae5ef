"""Spatial and temporal joins over grid cells and sorted streams; no unbounded cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import distance, in_frame, segment_distance
from .fill import ahead, behind
from .lineage import cut


def cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def _around(df: DataFrame, size: float, steps: int = 1) -> DataFrame:
    """A row for each cell at most `steps` away."""
    near = lambda c: F.explode(F.sequence(cell(F.col(c), size) - steps, cell(F.col(c), size) + steps))
    return df.withColumn("_cx", near("x")).withColumn("_cy", near("y"))


def _cells_of_box(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> tuple[Column, Column]:
    return F.sequence(cell(x0, size), cell(x1, size)), F.sequence(cell(y0, size), cell(y1, size))


def transect_points(transects: DataFrame, points: DataFrame, along: float = 35, past: float = 300, least: float | Column = -150, size: float | None = None) -> DataFrame:
    """Points inside each transect's rectangle: their columns, transect_id, chainage and offset.

    A point counts within `along` of the transect's line, at most the transect's
    length and `past` from its origin, and at a chainage of `least` or more.
    Transects go to the grid cells of the rectangle's bounding box, so the join is
    an equality on cells.
    """
    size = size or max(2 * along, past)
    t = transects.withColumn("_len", distance(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).where("_len > 0")
    ux, uy = (F.col("x1") - F.col("x0")) / F.col("_len"), (F.col("y1") - F.col("y0")) / F.col("_len")
    ax, ay = F.col("x0") + least * ux, F.col("y0") + least * uy
    bx, by = F.col("x0") + (F.col("_len") + past) * ux, F.col("y0") + (F.col("_len") + past) * uy
    xs, ys = _cells_of_box(F.least(ax, bx) - along, F.least(ay, by) - along, F.greatest(ax, bx) + along, F.greatest(ay, by) + along, size)
    t = t.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))
    p = points.withColumn("_cx", cell(F.col("x"), size)).withColumn("_cy", cell(F.col("y"), size))
    chainage, offset = in_frame(F.col("x"), F.col("y"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    out = p.join(t, ["_cx", "_cy"]).withColumns({"chainage": chainage, "offset": offset})
    close = (F.abs("offset") <= along) & (distance(F.col("x"), F.col("y"), F.col("x0"), F.col("y0")) <= F.col("_len") + past) & (F.col("chainage") >= least)
    return out.where(close).select(*points.columns, "transect_id", "chainage", "offset")


def transect_chainages(transects: DataFrame, points: DataFrame, by: list[str], along: float = 35, past: float = 300, least: float = -150, size: float | None = None) -> DataFrame:
    """transect_points with the points landward of `least` kept, their chainage NULL.

    by: the columns of a series' place, such as scene_id and transect_id; one that
    has landward points alone has no rows.
    """
    near = transect_points(transects, points, along, past, -(F.col("_len") + past), size)
    kept = near.withColumn("chainage", F.when(F.col("chainage") >= least, F.col("chainage")))
    some = kept.where("chainage IS NOT NULL").select(*by).distinct()
    return kept.join(some, by, "left_semi")


def away_from(points: DataFrame, obstacles: DataFrame, d: float, by: list[str]) -> DataFrame:
    """Points with no obstacle of their scene nearer than d."""
    o = _around(obstacles.select(*by, "x", "y"), d).select(*by, "_cx", "_cy", F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    p = points.withColumn("_cx", cell(F.col("x"), d)).withColumn("_cy", cell(F.col("y"), d))
    near = [F.col(f"p.{k}") == F.col(f"o.{k}") for k in [*by, "_cx", "_cy"]] + [distance(F.col("p.x"), F.col("p.y"), F.col("o._ox"), F.col("o._oy")) < d]
    cond = near[0]
    for c in near[1:]:
        cond = cond & c
    return p.alias("p").join(o.alias("o"), cond, "left_anti").drop("_cx", "_cy")


def near_segments(points: DataFrame, segments: DataFrame, d: float) -> DataFrame:
    """Points at most d from a segment (x0, y0, x1, y1): the buffer of a reference line."""
    xs, ys = _cells_of_box(F.least("x0", "x1") - d, F.least("y0", "y1") - d, F.greatest("x0", "x1") + d, F.greatest("y0", "y1") + d, d)
    s = segments.select("x0", "y0", "x1", "y1").withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))
    p = points.withColumn("_cx", cell(F.col("x"), d)).withColumn("_cy", cell(F.col("y"), d))
    inside = segment_distance(*(F.col(c) for c in ("x", "y", "x0", "y0", "x1", "y1"))) <= d
    return p.alias("p").join(s.alias("s"), (F.col("p._cx") == F.col("s._cx")) & (F.col("p._cy") == F.col("s._cy")) & inside, "left_semi").drop("_cx", "_cy")


def nearest(left: DataFrame, right: DataFrame, key: list[str], right_id: str, size: float, group: list[str] | None = None, k: int = 1, rounds: int = 12) -> DataFrame:
    """group, key, rank, right_id, distance: each left row's k nearest right rows of its group, ties to the lesser right_id.

    Fewer where the group has fewer; no row where it has none. A round joins the
    3 x 3 cells around each left point, an equality on group and cell; what has its
    k-th within the cell size has all that could be nearer, and is settled. The rest
    goes on with cells four times as large.
    """
    group = group or []
    n = right.groupBy(*group).agg(F.count("*").alias("_n")) if group else right.agg(F.count("*").alias("_n"))
    todo = left.select(*group, *key, "x", "y")
    todo = cut((todo.join(n, group) if group else todo.crossJoin(F.broadcast(n))).where("_n > 0").withColumn("_want", F.least(F.lit(k), F.col("_n"))))
    own = right.select(*group, F.col(right_id).alias("_id"), F.col("x").alias("_rx"), F.col("y").alias("_ry"))
    w, out = W.partitionBy(*group, *key).orderBy("distance", "_id"), None
    for r in range(rounds):
        s = size * 4**r
        placed = own.withColumns({"_cx": cell(F.col("_rx"), s), "_cy": cell(F.col("_ry"), s)})
        met = _around(todo, s).join(placed, [*group, "_cx", "_cy"])
        near = met.withColumn("distance", distance(F.col("x"), F.col("y"), F.col("_rx"), F.col("_ry"))).where(F.col("distance") <= s)
        if k == 1:
            # the least of a row: put together before the shuffle
            best = near.groupBy(*group, *key).agg(F.min(F.struct("distance", "_id")).alias("_b"))
            settled = cut(best.select(*group, *key, F.lit(1).alias("rank"), F.col("_b._id").alias(right_id), "_b.distance"))
            out, todo = _goes_on(out, todo, settled, [*group, *key])
            if todo.isEmpty():
                return out
            continue
        ranked = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col("_want"))
        full = ranked.withColumn("_have", F.count("*").over(W.partitionBy(*group, *key))).where("_have = _want")
        settled = cut(full.select(*group, *key, "rank", F.col("_id").alias(right_id), "distance"))
        out, todo = _goes_on(out, todo, settled, [*group, *key])
        if todo.isEmpty():
            return out
    raise RuntimeError(f"points without a neighbour after {rounds} rounds: begin with larger cells than {size}")


def _goes_on(out: DataFrame | None, todo: DataFrame, settled: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    return settled if out is None else out.unionByName(settled), cut(todo.join(settled.where("rank = 1").select(*key), key, "left_anti"))


def nearest_distance(left: DataFrame, right: DataFrame, key: list[str], size: float, rounds: int = 12) -> DataFrame:
    """key and the distance to the nearest row of right, by growing grid cells; no row where right is empty."""
    own = right.select("x", "y", F.lit(0).alias("_right"))
    return nearest(left, own, key, "_right", size, rounds=rounds).select(*key, F.col("distance").alias("nearest"))


def crossings(rays: DataFrame, segments: DataFrame, size: float) -> DataFrame:
    """Where rays (ray_id, x0, y0, x1, y1) cross segments: ray_id, x, y, along (distance from the ray's origin)."""
    def spread(df: DataFrame, names: list[str]) -> DataFrame:
        a, b, c, d = (F.col(n) for n in names)
        xs, ys = _cells_of_box(F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d), size)
        return df.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))

    s = spread(segments.select(F.col("x0").alias("sx0"), F.col("y0").alias("sy0"), F.col("x1").alias("sx1"), F.col("y1").alias("sy1")), ["sx0", "sy0", "sx1", "sy1"])
    both = spread(rays, ["x0", "y0", "x1", "y1"]).join(s, ["_cx", "_cy"])
    rx, ry, sx, sy = F.expr("x1 - x0"), F.expr("y1 - y0"), F.expr("sx1 - sx0"), F.expr("sy1 - sy0")
    det = rx * sy - ry * sx
    t = F.try_divide((F.col("sx0") - F.col("x0")) * sy - (F.col("sy0") - F.col("y0")) * sx, det)
    u = F.try_divide((F.col("sx0") - F.col("x0")) * ry - (F.col("sy0") - F.col("y0")) * rx, det)
    hit = both.withColumns({"_t": t, "_u": u}).where("_t BETWEEN 0 AND 1 AND _u BETWEEN 0 AND 1")
    hit = hit.select("ray_id", (F.col("x0") + F.col("_t") * rx).alias("x"), (F.col("y0") + F.col("_t") * ry).alias("y"), (F.col("_t") * F.sqrt(rx * rx + ry * ry)).alias("along"))
    return hit.distinct()


def nearest_crossing(rays: DataFrame, segments: DataFrame, size: float, least: float = 1e-6) -> DataFrame:
    return crossings(rays, segments, size).where(F.col("along") > least).groupBy("ray_id").agg(F.min_by("x", "along").alias("x"), F.min_by("y", "along").alias("y"), F.min("along").alias("along"))


def raster_at(points: DataFrame, pixels: DataFrame, column: str, by: list[str]) -> DataFrame:
    """points (row, col fractional) plus the pixel's value, rounding half to even; NULL outside."""
    p = points.withColumns({"_r": F.bround("row", 0).cast("int"), "_c": F.bround("col", 0).cast("int")})
    x = pixels.select(*by, F.col("row").cast("int").alias("_r"), F.col("col").cast("int").alias("_c"), column)
    return p.join(x, [*by, "_r", "_c"], "left").drop("_r", "_c")


def survey_match(series: DataFrame, survey: DataFrame, most_days: float = 10, least_days: float = 3) -> DataFrame:
    """series plus survey: the survey's position at each observation.

    NULL where the nearest survey is over most_days away; its value where under
    least_days (the earlier on ties); else linear between the surveys around, NULL
    at the ends. Both sides are one sorted stream per transect.
    """
    b = survey.groupBy("transect_id", "ts").agg(F.min("position").alias("_v")).withColumns({"_kind": F.lit(0), "_t": F.col("ts")})
    a = series.withColumn("_kind", F.lit(1))
    both = a.unionByName(b, allowMissingColumns=True)
    key, up, down = ["transect_id"], [F.col("ts"), F.col("_kind")], [F.col("ts").desc(), F.col("_kind")]
    both = both.withColumns({"_pt": behind("_t", key, up), "_pv": behind("_v", key, up), "_nt": ahead("_t", key, down), "_nv": ahead("_v", key, down)})
    days = lambda x, y: (F.unix_micros(F.col(y).cast("timestamp")) - F.unix_micros(F.col(x).cast("timestamp"))) / 86_400_000_000
    out = both.where("_kind = 1").withColumns({"_before": days("_pt", "ts"), "_after": days("ts", "_nt")})
    nearest = F.least("_before", "_after")
    value = F.when(F.col("_after").isNull() | (F.col("_before") <= F.col("_after")), F.col("_pv")).otherwise(F.col("_nv"))
    between = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * F.try_divide(F.col("_before"), F.col("_before") + F.col("_after"))
    matched = F.when(nearest > most_days, None).when(nearest < least_days, value).otherwise(between)
    return out.withColumn("survey", matched).select(*series.columns, "survey")
