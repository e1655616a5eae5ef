"""Raster operators. What a pixel needs from itself is a column expression; what it
needs from a window around it is computed by numpy over tiles, to which only the
pixels of a narrow margin are copied. Connected objects are found in tiles and
united over their borders; component analysis is a grouped kernel, a scene each.

pixels: scene_id, row, col, and bands or a value.
"""

from __future__ import annotations

import functools
import warnings
from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.geometry import pixel_to_world, world_to_pixel
from .components import connected
from .lineage import cut
from .thresholds import finite

KEY = ["scene_id", "row", "col"]


def qa_cloud(qa: Column, satname: Column) -> Column:
    """Cloud flags: S2 values 1024 and 2048; other missions any of bits 1 to 3."""
    return F.when(satname == "S2", qa.isin(1024, 2048)).otherwise(qa.bitwiseAND(0b1110) != 0)


def nodata(bands: list[str]) -> Column:
    """Any band missing or -inf, or green, near infrared and short-wave infrared all 0."""
    bad = F.lit(False)
    for b in bands:
        bad = bad | F.col(b).isNull() | F.isnan(b) | (F.col(b) == float("-inf"))
    return bad | ((F.col("g") == 0) & (F.col("nir") == 0) & (F.col("swir1") == 0))


def cloud_cover(pixels: DataFrame) -> DataFrame:
    """Per scene: share of cloud in all pixels, and of cloud that isn't nodata in those with data."""
    only = F.col("cloud") & ~F.col("nodata")
    return pixels.groupBy("scene_id").agg(F.avg(F.col("cloud").cast("double")).alias("cloud_cover_combined"), F.try_divide(F.sum(only.cast("double")), F.sum((~F.col("nodata")).cast("int"))).alias("cloud_cover"), F.count("*").alias("total_pixels"))


def edge_padding(pixels: DataFrame, band: str = "swir1") -> DataFrame:
    """pixels plus padding: outside the rows and columns where the band has data."""
    on = F.col(band) != 0
    box = pixels.where(on).groupBy("scene_id").agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    inside = F.col("row").between(F.col("_r0"), F.col("_r1")) & F.col("col").between(F.col("_c0"), F.col("_c1"))
    return pixels.join(box, "scene_id", "left").withColumn("padding", ~F.coalesce(inside, F.lit(False))).drop("_r0", "_r1", "_c0", "_c1")


def stretch(pixels: DataFrame, band: str, pct: float = 99.0) -> DataFrame:
    """band cut to [0, its percentile over clear pixels of the scene] and scaled to 0..1."""
    top = pixels.where("NOT cloud").groupBy("scene_id").agg(F.percentile(band, pct / 100).alias("_top"))
    scaled = F.try_divide(F.greatest(F.least(F.col(band), F.col("_top")), F.lit(0.0)), F.col("_top"))
    return pixels.join(top, "scene_id", "left").withColumn(band, scaled).drop("_top")


def mask(pixels: DataFrame, bands: list[str], where: Column) -> DataFrame:
    """bands set to 0 where the mask holds."""
    return pixels.withColumns({b: F.when(where, F.lit(0.0)).otherwise(F.col(b)) for b in bands})


TILE = 128


def _windows(grid: np.ndarray, radius: int, side: int) -> Iterator[np.ndarray]:
    """Views of grid (a tile of `side` with its margin), shifted to each place of the window."""
    for dr in range(2 * radius + 1):
        for dc in range(2 * radius + 1):
            yield grid[dr : dr + side, dc : dc + side]


def _spread(grid: np.ndarray, radius: int, side: int) -> np.ndarray:
    n, total, squares = np.zeros((side, side)), np.zeros((side, side)), np.zeros((side, side))
    for x in _windows(grid, radius, side):
        there = ~np.isnan(x)
        v = np.where(there, x, 0.0)
        n += there
        total += v
        squares += v * v
    with np.errstate(invalid="ignore"):
        return np.where(np.isnan(grid[radius : radius + side, radius : radius + side]), np.nan, np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0)))


def _median(grid: np.ndarray, radius: int, side: int) -> np.ndarray:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # windows without a value
        return np.nanmedian(np.stack(list(_windows(grid, radius, side))), axis=0)


#: What a window is reduced to; NaN stands for missing pixels and values.
KERNELS = {
    "max": lambda g, r, n: functools.reduce(np.fmax, _windows(g, r, n)),
    "min": lambda g, r, n: functools.reduce(np.fmin, _windows(g, r, n)),
    "median": _median,
    "std": _spread,
}


def focal(pixels: DataFrame, radius: int, wanted: dict[str, tuple[str, str]], tile: int = TILE) -> DataFrame:
    """KEY and, for each name in wanted, (column, kernel) over the window of `radius` rows and columns around.

    One shuffle, in which a pixel goes to its tile and to the tiles it is at most
    `radius` from: about 1 + 4 radius / tile copies, whatever the number of columns.
    A pixel's key is taken to be in the table once.
    """
    columns = sorted({c for c, _ in wanted.values()})
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius) / tile), F.floor((F.col(c) + radius) / tile)))
    placed = pixels.select(*KEY, *(F.col(c).cast("double").alias(c) for c in columns)).withColumn("_tr", near("row")).withColumn("_tc", near("col"))

    def one(table: pa.Table) -> pa.Table:
        top, left = table["_tr"][0].as_py() * tile, table["_tc"][0].as_py() * tile
        row, col = table["row"].to_numpy() - top, table["col"].to_numpy() - left
        own = (row >= 0) & (row < tile) & (col >= 0) & (col < tile)
        if not own.any():
            return empty
        # a grid as large as what is there
        r0, c0 = row[own].min(), col[own].min()
        side = int(max(row[own].max() - r0, col[own].max() - c0)) + 1
        inside = (row >= r0 - radius) & (row < r0 + side + radius) & (col >= c0 - radius) & (col < c0 + side + radius)
        out = {k: table[k].filter(own) for k in KEY}
        grids = {}
        for c in columns:
            grids[c] = np.full((side + 2 * radius, side + 2 * radius), np.nan)
            grids[c][row[inside] - r0 + radius, col[inside] - c0 + radius] = table[c].to_numpy(zero_copy_only=False)[inside]
        for name, (c, kernel) in wanted.items():
            found = KERNELS[kernel](grids[c], radius, side)[row[own] - r0, col[own] - c0]
            out[name] = pa.array(found, pa.float64(), from_pandas=True)
        return pa.table(out)

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pixels.select(*KEY).schema.fields), *(f"`{n}` double" for n in wanted)])
    empty = to_arrow_schema(pixels.select(*KEY, *(F.lit(None).cast("double").alias(n) for n in wanted)).schema).empty_table()
    return placed.groupBy("scene_id", "_tr", "_tc").applyInArrow(one, kinds)


def local_std(pixels: DataFrame, value: str, radius: int = 1) -> DataFrame:
    """KEY and sqrt(mean(x^2) - mean(x)^2) over the window; edges use the pixels there are; missing centres are left out."""
    return focal(pixels.where(F.col(value).isNotNull()), radius, {"std": (value, "std")})


def dilate(pixels: DataFrame, flag: str, radius: int) -> DataFrame:
    return focal(pixels, radius, {flag: (flag, "max")}).withColumn(flag, F.col(flag) > 0)


def erode(pixels: DataFrame, flag: str, radius: int) -> DataFrame:
    """Pixels whose whole window is set; outside the image counts as set."""
    return focal(pixels, radius, {flag: (flag, "min")}).withColumn(flag, F.col(flag) > 0)


def opening(pixels: DataFrame, flag: str, radius: int) -> DataFrame:
    return dilate(erode(pixels, flag, radius), flag, radius)


def median_smooth(pixels: DataFrame, value: str, radius: int = 1) -> DataFrame:
    return focal(pixels, radius, {value: (value, "median")})


def gaussian_weights(from_m: float, to_m: float) -> tuple[int, dict[int, float]]:
    """Window step and one-dimensional weights that blur a resolution to a coarser one (its width at half maximum)."""
    step = max(1, round(to_m / from_m))
    sd = step / (2 * sqrt(2 * log(2)))
    reach = ceil(3 * sd)
    w = {k: float(np.exp(-(k**2) / (2 * sd * sd))) for k in range(-reach, reach + 1)}
    total = sum(w.values())
    return step, {k: v / total for k, v in w.items()}


def degrade(pixels: DataFrame, value: str, from_m: float, to_m: float) -> DataFrame:
    """Blur and sample every step-th pixel whose window lies in the image: rows, then columns."""
    step, w = gaussian_weights(from_m, to_m)
    reach = max(w)
    table = F.create_map(*(F.lit(x) for kv in w.items() for x in kv))

    def along(df: DataFrame, axis: str) -> DataFrame:
        moved = df.withColumn("_k", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn(axis, F.col(axis) + F.col("_k"))
        moved = moved.where(F.pmod(F.col(axis) - reach, F.lit(step)) == 0)
        return moved.groupBy(*KEY).agg(F.sum(F.col(value) * F.element_at(table, F.col("_k"))).alias(value), F.count(value).alias("_n")).where(F.col("_n") == len(w)).drop("_n")

    return along(along(pixels.select(*KEY, value), "row"), "col")


def cells(pixels: DataFrame, value: str, by: list[str] | None = None, tile: int | None = None) -> DataFrame:
    """by, r0, c0 and the corner values a, b, c, d (clockwise from the first) of each cell of four pixels with values.

    One shuffle: each pixel is a corner of four cells, and corners that lie
    together are put together before it. With `tile`, the cells of a tile of that
    size lie in one partition, and its number (_tr, _tc) is in the rows.
    """
    by = by or ["scene_id"]
    v = finite(pixels, value).select(*by, "row", "col", F.col(value).cast("double").alias("_v"))
    corners = [(0, 0, "a"), (0, 1, "b"), (1, 1, "c"), (1, 0, "d")]
    place = lambda dr, dc, name: F.struct((F.col("row") - dr).alias("r0"), (F.col("col") - dc).alias("c0"), F.lit(name).alias("corner"))
    spread = v.select(*by, "_v", F.explode(F.array(*(place(*x) for x in corners))).alias("_p")).select(*by, "_p.*", "_v")
    where = []
    if tile:
        where = ["_tr", "_tc"]
        spread = spread.withColumns({"_tr": F.floor(F.col("r0") / tile), "_tc": F.floor(F.col("c0") / tile)})
        # as many partitions as set: what follows is more work than its bytes tell adaptive execution
        spread = spread.repartition(int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, *where)
    met = spread.groupBy(*by, *where, "r0", "c0").agg(*(F.max(F.when(F.col("corner") == n, F.col("_v"))).alias(n) for _, _, n in corners))
    return met.where("a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL")


def resample(pixels: DataFrame, value: str, factor: float) -> DataFrame:
    """Bilinear values on a grid of 1 / factor pixels: rows (scene_id, row, col) of the finer grid inside the image."""
    inside = lambda c: F.explode(F.sequence(F.ceil(F.col(c) * factor).cast("int"), F.ceil((F.col(c) + 1) * factor).cast("int") - 1))
    g = cells(pixels, value).withColumn("row", inside("r0")).withColumn("col", inside("c0"))
    u, v = F.col("row") / factor - F.col("r0"), F.col("col") / factor - F.col("c0")
    out = (1 - u) * ((1 - v) * F.col("a") + v * F.col("b")) + u * ((1 - v) * F.col("d") + v * F.col("c"))
    return g.select(*KEY, out.alias(value))


GEOREFERENCE = ("xtr", "xscale", "xshear", "ytr", "yshear", "yscale")


def warp(pixels: DataFrame, value: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """KEY and value on the target grid: bilinear between the source pixels around each target pixel's centre.

    source: scene_id and its georeference; target: the same with height and width.
    Both in one reference system; shears are allowed. Source pixels without a value
    leave their weight to the others; a target pixel whose nearest source pixel has
    none is absent. Target rows are dealt to tasks before their columns are made,
    and each target pixel asks for four source pixels by an equality join.
    """
    own = lambda prefix: {g: F.col(f"{prefix}{g}") for g in GEOREFERENCE}
    to = target.select("scene_id", "height", "width", *(F.col(g).alias(f"_t{g}") for g in GEOREFERENCE))
    grid = to.join(source.select("scene_id", *(F.col(g).alias(f"_s{g}") for g in GEOREFERENCE)), "scene_id")
    grid = grid.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("height") - 1))).repartition("scene_id", "row")
    grid = grid.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    x, y = pixel_to_world(F.col("row") + 0.5, F.col("col") + 0.5, own("_t"))
    r, c = world_to_pixel(x, y, own("_s"))
    at = grid.select(*KEY, (r - 0.5).alias("_r"), (c - 0.5).alias("_c"))
    corners = []
    for dr in (0, 1):
        for dc in (0, 1):
            sr, sc = F.floor("_r") + dr, F.floor("_c") + dc
            nearest = (sr == F.floor(F.col("_r") + 0.5)) & (sc == F.floor(F.col("_c") + 0.5))
            corners.append(F.struct(sr.alias("r"), sc.alias("c"), ((1 - F.abs(F.col("_r") - sr)) * (1 - F.abs(F.col("_c") - sc))).alias("w"), nearest.alias("near")))
    asked = at.select(*KEY, F.explode(F.array(*corners)).alias("k")).select(*KEY, "k.*")
    have = finite(pixels, value).select("scene_id", F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), F.col(value).cast("double").alias("_v"))
    met = asked.join(have, ["scene_id", "r", "c"]).groupBy(*KEY).agg(F.sum(F.col("w") * F.col("_v")).alias("_t"), F.sum("w").alias("_w"), F.max("near").alias("_near"))
    return met.where("_near").select(*KEY, (F.col("_t") / F.col("_w")).alias(value))


def cell_pieces(c: DataFrame, level: Column, keep: list[str]) -> DataFrame:
    """Marching squares: keep, r0, c0 and both ends (row, col) of each line piece of cells (see cells()) at a level.

    Saddles are parted by the mean of their corners.
    """
    code = sum((F.when(F.col(n) > level, 1 << k).otherwise(0) for k, n in enumerate("bcd", 1)), F.when(F.col("a") > level, 1).otherwise(0))
    c = c.withColumns({"_level": level, "code": code}).where("code NOT IN (0, 15)")
    part = lambda p, q: (F.col("_level") - F.col(p)) / (F.col(q) - F.col(p))
    r, k = F.col("r0"), F.col("c0")
    point = lambda x, y: F.struct(x.cast("double").alias("row"), y.cast("double").alias("col"))
    top, right = point(r, k + part("a", "b")), point(r + part("b", "c"), k + 1)
    bottom, left = point(r + 1, k + part("d", "c")), point(r + part("a", "d"), k)
    piece = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    high = (F.col("a") + F.col("b") + F.col("c") + F.col("d")) / 4 > F.col("_level")
    one = {(1, 14): (left, top), (2, 13): (top, right), (4, 11): (right, bottom), (8, 7): (bottom, left), (3, 12): (left, right), (6, 9): (top, bottom)}
    pieces = F.array().cast(c.select(F.array(piece(top, left)).alias("x")).schema["x"].dataType)
    for codes, (p, q) in one.items():
        pieces = F.when(F.col("code").isin(*codes), F.array(piece(p, q))).otherwise(pieces)
    joined, parted = F.array(piece(left, bottom), piece(top, right)), F.array(piece(left, top), piece(right, bottom))
    pieces = F.when(F.col("code") == 5, F.when(high, joined).otherwise(parted)).when(F.col("code") == 10, F.when(high, parted).otherwise(joined)).otherwise(pieces)
    return c.select(*keep, "r0", "c0", F.explode(pieces).alias("s")).select(*keep, "r0", "c0", "s.p", "s.q")


def contour_segments(pixels: DataFrame, value: str, level: float, by: list[str] | None = None) -> DataFrame:
    """by, r0, c0 (the cell) and both ends (row, col) of each line piece at the level; a cell with a missing corner gives none."""
    by = by or ["scene_id"]
    return cell_pieces(cells(pixels, value, by), F.lit(float(level)), by)


def contour_points(pieces: DataFrame, by: list[str]) -> DataFrame:
    """by, row, col: the distinct ends of line pieces, to 9 digits."""
    ends = pieces.select(*by, F.explode(F.array("p", "q")).alias("e"))
    return ends.select(*by, F.round("e.row", 9).alias("row"), F.round("e.col", 9).alias("col")).distinct()


def _chains(segments: list[tuple]) -> list[list[tuple]]:
    """Points of the lines that segments (pairs of points) make, cut where other than two meet; loops repeat their first point."""
    ends: dict[tuple, list[int]] = {}
    for i, s in enumerate(segments):
        for e in s:
            ends.setdefault(e, []).append(i)
    used, out = set(), []
    for start in [e for e in sorted(ends) if len(ends[e]) != 2] + sorted(ends):
        for first in ends[start]:
            chain, here, segment = [start], start, first
            while segment not in used:
                used.add(segment)
                a, b = segments[segment]
                here = b if a == here else a
                chain.append(here)
                if len(ends[here]) != 2 or here == start:
                    break
                segment = next((i for i in ends[here] if i not in used), segment)
            if len(chain) > 1:
                out.append(chain)
    return out


def contour_chains(segments: DataFrame, by: list[str], tile: int = TILE) -> DataFrame:
    """by, chain, idx, row, col: the lines inside each tile of cells; points to 9 digits.

    Tiles are read one after the other from sorted partitions: one tile's pieces are
    held at a time, and a batch has many tiles.
    """
    s = segments.select(*by, F.floor(F.col("r0") / tile).alias("_tr"), F.floor(F.col("c0") / tile).alias("_tc"), *(F.round(F.col(c), 9).alias(f"_{c[0]}{c[2]}") for c in ("p.row", "p.col", "q.row", "q.col")))
    schema = s.select(*by, F.lit(0).cast("long").alias("chain"), F.lit(0).alias("idx"), F.col("_pr").alias("row"), F.col("_pc").alias("col")).schema
    key = [*by, "_tr", "_tc"]

    def lines(tile_of: tuple, pieces: set[tuple]) -> list[tuple]:
        own, tr, tc = tile_of[:-2], *tile_of[-2:]
        base = (tr % (1 << 20) << 20 | tc % (1 << 20)) << 20
        return [(*own, base + k, i, *p) for k, chain in enumerate(_chains(sorted(pieces))) for i, p in enumerate(chain)]

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces, rows, kinds = None, set(), [], to_arrow_schema(schema)
        table = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
        for batch in batches:
            columns = [batch[c].to_pylist() for c in (*key, "_pr", "_pc", "_qr", "_qc")]
            for at, *ends in zip(zip(*columns[:-4], strict=True), *columns[-4:], strict=True):
                if at != now:
                    if pieces:
                        rows += lines(now, pieces)
                    now, pieces = at, set()
                p, q = tuple(ends[:2]), tuple(ends[2:])
                if p != q:
                    pieces.add((p, q) if p < q else (q, p))
            if rows:
                yield table()
                rows = []
        if pieces:
            rows = lines(now, pieces)
            yield table()

    # as many partitions as set: a row is more work than its bytes tell adaptive execution
    dealt = s.repartition(int(s.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(many, schema)


def _ranked(preds: DataFrame, by: list[str], rounds: int = 40) -> DataFrame:
    """by, node, head, off of lists: preds gives each node's predecessor (itself for the first) and its length; by pointer doubling.

    After k rounds a node knows the lengths of 2^k predecessors, so rounds go with
    the logarithm of the longest list.
    """
    now = cut(preds)
    for _ in range(rounds):
        after = now.select(*by, F.col("node").alias("head"), F.col("head").alias("_head"), F.col("off").alias("_off"))
        new = cut(now.join(after, [*by, "head"]).select(*by, "node", F.col("head").alias("_was"), F.col("_head").alias("head"), (F.col("off") + F.col("_off")).alias("off")))
        now = new.drop("_was")
        if new.where("_was != head").isEmpty():
            return now
    raise RuntimeError(f"lists did not settle in {rounds} rounds")


def link_contours(segments: DataFrame, by: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """by, contour_id, pt_idx, row, col: line pieces of a scene joined end to end; closed lines repeat their first point.

    Lines are built in tiles, and tiles' lines with a common end are put in order by
    list ranking: each line, read in either direction, points to the one before it,
    and pointers are doubled until all know the first one and the points up to them.
    Rings are cut at their least line. A line ends where other than two pieces meet.
    No group is larger than a tile, whatever the scene. Of its two directions a
    contour takes that from the lesser end.
    """
    by = by or ["scene_id"]
    chains = cut(contour_chains(segments, by, tile))
    end = lambda agg: agg(F.struct("row", "col"), "idx")
    lines = cut(chains.groupBy(*by, "chain").agg(F.max("idx").cast("long").alias("segs"), end(F.min_by).alias("e0"), end(F.max_by).alias("e1")))
    ends = lines.where("e0 != e1").select(*by, F.posexplode(F.array(*(F.struct("chain", F.col(e).alias("at")) for e in ("e0", "e1")))).alias("end", "x"))
    met = ends.groupBy(*by, "x.at").agg(F.count("*").alias("n"), F.min(F.struct("x.chain", "end")).alias("u"), F.max(F.struct("x.chain", "end")).alias("v"))
    pairs = cut(met.where("n = 2 AND u.chain != v.chain").select(*by, F.col("u.chain").alias("a"), F.col("u.end").alias("x"), F.col("v.chain").alias("b"), F.col("v.end").alias("y")))
    roots = cut(connected(pairs, by).withColumnRenamed("node", "chain"))
    # a component with as many links as lines is a ring
    links = pairs.join(roots.withColumnRenamed("chain", "a"), [*by, "a"])
    rings = links.groupBy(*by, "root").agg(F.count("*").alias("_l")).join(roots.groupBy(*by, "root").agg(F.count("*").alias("_n")), [*by, "root"]).where("_l = _n").select(*by, "root", F.lit(True).alias("ring"))
    opened = links.join(rings, [*by, "root"], "left").where("NOT coalesce(ring, false) OR NOT ((a = root AND x = 0) OR (b = root AND y = 0))")
    # node 2 * chain + d: the line read from its end d; before it comes a line read towards its joined end
    to = lambda c, e, d, f: F.struct((2 * F.col(c) + F.col(e)).alias("node"), (2 * F.col(d) + 1 - F.col(f)).alias("head"), F.col(d).alias("_chain"))
    preds = opened.select(*by, F.explode(F.array(to("a", "x", "b", "y"), to("b", "y", "a", "x"))).alias("p")).select(*by, "p.*")
    preds = preds.join(lines.select(*by, F.col("chain").alias("_chain"), F.col("segs").alias("off")), [*by, "_chain"]).drop("_chain")
    nodes = lines.select(*by, "chain", "segs", F.posexplode(F.array("e0", "e1")).alias("d", "at")).withColumn("node", 2 * F.col("chain") + F.col("d"))
    placed = nodes.join(preds, [*by, "node"], "left").withColumns({"head": F.coalesce("head", "node"), "off": F.coalesce("off", F.lit(0).cast("long"))})
    ranked = _ranked(placed.select(*by, "node", "head", "off"), by)
    whole = nodes.join(ranked, [*by, "node"]).join(roots, [*by, "chain"], "left").withColumn("root", F.coalesce("root", "chain"))
    first = whole.where("node = head").groupBy(*by, "root").agg(F.min(F.struct("at", "node")).alias("_s")).select(*by, F.col("_s.node").alias("head"), F.col("_s.at").alias("_at"))
    # a row a contour
    w = W.partitionBy(*by).orderBy("_at", "head")
    first = first.withColumn("contour_id", (F.row_number().over(w) - 1).cast("int")).drop("_at")
    kept = whole.join(first, [*by, "head"]).select(*by, "chain", "segs", "d", "off", "contour_id")
    out = chains.join(kept, [*by, "chain"]).withColumn("_pos", F.when(F.col("d") == 0, F.col("idx")).otherwise(F.col("segs") - F.col("idx")))
    return out.where("_pos > 0 OR off = 0").select(*by, "contour_id", (F.col("off") + F.col("_pos")).cast("int").alias("pt_idx"), "row", "col")


def _objects(on: np.ndarray, diagonal: bool = False) -> np.ndarray:
    """A number for each connected object of a grid (where on), by least labels that spread and jump: the object's first pixel."""
    label = np.where(on, np.arange(on.size).reshape(on.shape), on.size)
    while True:
        wide = np.pad(label, 1, constant_values=on.size)
        least = functools.reduce(np.minimum, (wide[1 + r : 1 + r + on.shape[0], 1 + c : 1 + c + on.shape[1]] for r in (-1, 0, 1) for c in (-1, 0, 1) if diagonal or not (r and c)))
        flat = np.append(np.where(on, least, on.size).ravel(), on.size)
        # a label's own pixel may know a lesser one: all its pixels follow
        np.minimum.at(flat, np.append(label.ravel(), on.size), flat.copy())
        flat = flat[flat]
        new = flat[:-1].reshape(on.shape)
        if (new == label).all():
            return label
        label = new


def tile_objects(pixels: DataFrame, flag: str, diagonal: bool = False, tile: int = TILE) -> DataFrame:
    """KEY, flag and part: the object of its tile that a set pixel belongs to (row * 2^32 + col of the object's first pixel there); NULL elsewhere.

    A group is a tile of `tile` rows and columns, however large the scene.
    """
    placed = pixels.select(*KEY, F.coalesce(F.col(flag), F.lit(False)).alias(flag)).withColumns({"_tr": F.floor(F.col("row") / tile), "_tc": F.floor(F.col("col") / tile)})
    schema = placed.select(*KEY, flag, F.lit(None).cast("long").alias("part")).schema

    def one(table: pa.Table) -> pa.Table:
        row, col = table["row"].to_numpy().astype(np.int64), table["col"].to_numpy().astype(np.int64)
        top, left = row.min(), col.min()
        on = np.zeros((row.max() - top + 1, col.max() - left + 1), bool)
        on[row - top, col - left] = table[flag].to_numpy(zero_copy_only=False)
        first_row, first_col = np.divmod(_objects(on, diagonal)[row - top, col - left], on.shape[1])
        part = pa.array((first_row + top) << 32 | (first_col + left), mask=~on[row - top, col - left])
        return pa.table({**{k: table[k] for k in [*KEY, flag]}, "part": part})

    return placed.groupBy("scene_id", "_tr", "_tc").applyInArrow(one, schema)


def object_parts(parts: DataFrame, diagonal: bool = False, tile: int = TILE) -> DataFrame:
    """scene_id, part, object, size: which object of the scene each tile's part belongs to (its least part), and the object's pixels.

    Only pixels on the borders of tiles are joined, with their neighbours across.
    """
    p = parts.where("part IS NOT NULL")
    sizes = p.groupBy("scene_id", "part").agg(F.count("*").alias("_n"))
    ends = (0, tile - 1)
    at_row, at_col = F.pmod(F.col("row"), F.lit(tile)).isin(*ends), F.pmod(F.col("col"), F.lit(tile)).isin(*ends)
    border = p.where(at_row | at_col).select("scene_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "part")
    steps = [(-1, 0), (0, -1), *([(-1, -1), (-1, 1)] if diagonal else [])]
    to = F.explode(F.array(*(F.struct((F.col("row") + r).alias("row"), (F.col("col") + c).alias("col")) for r, c in steps))).alias("_to")
    asked = border.select("scene_id", F.col("part").alias("a"), to).select("scene_id", "a", "_to.*")
    links = asked.join(border.withColumnRenamed("part", "b"), ["scene_id", "row", "col"]).where("a != b").select("scene_id", "a", "b").distinct()
    roots = connected(links, ["scene_id"]).select("scene_id", F.col("node").alias("part"), "root")
    named = sizes.join(roots, ["scene_id", "part"], "left").select("scene_id", "part", F.coalesce("root", "part").alias("object"), "_n")
    whole = named.groupBy("scene_id", "object").agg(F.sum("_n").alias("size"))
    return named.join(whole, ["scene_id", "object"]).select("scene_id", "part", "object", "size")


def objects(pixels: DataFrame, flag: str, diagonal: bool = False, tile: int = TILE) -> DataFrame:
    """KEY, object, size of each set pixel: 4-connected objects of a scene, or 8-connected ones.

    Objects are found in tiles, and parts that meet over a border are united by
    components of the borders' links, so a scene may be of any size.
    """
    parts = cut(tile_objects(pixels, flag, diagonal, tile))
    return parts.where("part IS NOT NULL").join(object_parts(parts, diagonal, tile), ["scene_id", "part"]).select(*KEY, "object", "size")


def drop_small_objects(pixels: DataFrame, flag: str, least: int, diagonal: bool = False, tile: int = TILE) -> DataFrame:
    """KEY and flag without objects of fewer than `least` pixels; a missing flag isn't set."""
    parts = cut(tile_objects(pixels, flag, diagonal, tile))
    large = object_parts(parts, diagonal, tile).where(F.col("size") >= least).select("scene_id", "part", F.lit(True).alias("_large"))
    return parts.join(large, ["scene_id", "part"], "left").select(*KEY, F.coalesce("_large", F.lit(False)).alias(flag))


def _opened(grid: np.ndarray, radius: int, side: int, size: int) -> np.ndarray:
    """Opening by a square of `size`; beyond the image counts as set, but no square is anchored there."""
    before = size // 2
    there, on = ~np.isnan(grid), np.isnan(grid) | (grid > 0)
    padded = np.pad(on, size, constant_values=True)
    n = len(grid)
    fits = there & functools.reduce(np.logical_and, (padded[size - before + r : size - before + r + n, size - before + c : size - before + c + n] for r in range(size) for c in range(size)))
    held = np.pad(fits, size)
    found = functools.reduce(np.logical_or, (held[size + before - r : size + before - r + n, size + before - c : size + before - c + n] for r in range(size) for c in range(size)))
    return found[radius : radius + side, radius : radius + side].astype(float)


def open_square(pixels: DataFrame, flag: str, size: int) -> DataFrame:
    """KEY and flag after opening by a square of `size` rows and columns, even ones too."""
    return focal(pixels, size - 1, {flag: (flag, f"open{size}")}).withColumn(flag, F.col(flag) > 0)


KERNELS |= {f"open{n}": functools.partial(_opened, size=n) for n in range(2, 12)}


def pansharpen(pixels: DataFrame, bands: list[str], pan: str = "pan", most_cloud: float = 0.95) -> DataFrame:
    """bands sharpened by their first principal component, replaced by pan at the component's mean and spread (a scene a group).

    Unchanged where nearly all is cloud; NULL at cloudy pixels otherwise.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        clear = ~pdf["cloud"].to_numpy() & pdf[[*bands, pan]].notna().all(axis=1).to_numpy()
        if clear.mean() < 1 - most_cloud or clear.sum() < 2:
            return pdf
        x = pdf.loc[clear, bands].to_numpy(np.float64)
        mean = x.mean(axis=0)
        _, vectors = np.linalg.eigh(np.cov((x - mean).T))
        vectors = vectors[:, ::-1]
        vectors[:, 0] *= np.sign(vectors[:, 0].sum()) or 1.0
        pcs = (x - mean) @ vectors
        p = pdf.loc[clear, pan].to_numpy(np.float64)
        spread = p.std() or 1.0
        pcs[:, 0] = (p - p.mean()) / spread * pcs[:, 0].std() + pcs[:, 0].mean()
        out = pdf.copy()
        out[bands] = np.nan
        out.loc[clear, bands] = pcs @ vectors.T + mean
        return out

    return pixels.groupBy("scene_id").applyInPandas(one, pixels.schema)


def mosaic(tiles: DataFrame) -> DataFrame:
    """tiles (order, row, col, value, valid): at each place the last valid value in the order."""
    w = W.partitionBy("row", "col").orderBy(F.col("order").desc())
    return tiles.where("valid AND value IS NOT NULL").withColumn("_n", F.row_number().over(w)).where("_n = 1").select("row", "col", "value")
