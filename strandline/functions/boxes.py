"""Rectangles and segments on columns: clipping, snapping, overlaps, windows, sampling.

A box is a struct of x_min, y_min, x_max, y_max.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box_of(x_min: Column, y_min: Column, x_max: Column, y_max: Column) -> Column:
    return F.struct(x_min.alias("x_min"), y_min.alias("y_min"), x_max.alias("x_max"), y_max.alias("y_max"))


def clipped(x0: Column, y0: Column, x1: Column, y1: Column, box: Column) -> Column:
    """The part of a segment inside a box as a struct (x0, y0, x1, y1); NULL where none is. Touching counts.

    Each side bounds the segment's parameter from below or above, or excludes a
    segment that runs beside it (Liang and Barsky).
    """
    dx, dy = x1 - x0, y1 - y0
    enter, leave, out = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for step, room in ((-dx, x0 - box["x_min"]), (dx, box["x_max"] - x0), (-dy, y0 - box["y_min"]), (dy, box["y_max"] - y0)):
        enter.append(F.when(step < 0, room / step))
        leave.append(F.when(step > 0, room / step))
        out = out | ((step == 0) & (room < 0))
    a, b = F.greatest(*enter), F.least(*leave)
    part = F.struct((x0 + a * dx).alias("x0"), (y0 + a * dy).alias("y0"), (x0 + b * dx).alias("x1"), (y0 + b * dy).alias("y1"))
    return F.when(~out & (a <= b), part)


def snapped_out(box: Column, size: float = 1.0) -> Column:
    """The least box of whole pixels (of `size`, from 0) that holds a box."""
    down = lambda c: F.floor(box[c] / size).cast("double") * size
    up = lambda c: F.ceil(box[c] / size).cast("double") * size
    return box_of(down("x_min"), down("y_min"), up("x_max"), up("y_max"))


def snapped_window(box: Column, g: dict) -> Column:
    """A box moved to the pixel edges of a georeference g (xtr, xscale, ytr, yscale < 0): outward, as rows count downward."""
    x, y = lambda n: g["xtr"] + n * g["xscale"], lambda n: g["ytr"] + n * g["yscale"]
    left, right = F.floor((box["x_min"] - g["xtr"]) / g["xscale"]), F.ceil((box["x_max"] - g["xtr"]) / g["xscale"])
    top, bottom = F.ceil((box["y_max"] - g["ytr"]) / g["yscale"]), F.floor((box["y_min"] - g["ytr"]) / g["yscale"])
    return box_of(x(left), y(bottom), x(right), y(top))


def image_box(g: dict, height: Column, width: Column) -> Column:
    """The bounds of an image: of its corners under the affine georeference."""
    xs = [g["xtr"] + g["xscale"] * c + g["xshear"] * r for r in (F.lit(0), height) for c in (F.lit(0), width)]
    ys = [g["ytr"] + g["yshear"] * c + g["yscale"] * r for r in (F.lit(0), height) for c in (F.lit(0), width)]
    return box_of(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))


def overlap(a: Column, b: Column) -> Column:
    """What two boxes share; NULL where they don't meet."""
    both = box_of(F.greatest(a["x_min"], b["x_min"]), F.greatest(a["y_min"], b["y_min"]), F.least(a["x_max"], b["x_max"]), F.least(a["y_max"], b["y_max"]))
    return F.when((both["x_min"] <= both["x_max"]) & (both["y_min"] <= both["y_max"]), both)


def common_box(box: Column) -> Column:
    """Aggregate: what all boxes share; NULL where nothing is."""
    b = box_of(F.max(box["x_min"]), F.max(box["y_min"]), F.min(box["x_max"]), F.min(box["y_max"]))
    return F.when((b["x_min"] <= b["x_max"]) & (b["y_min"] <= b["y_max"]), b)


def contains(outer: Column, inner: Column) -> Column:
    return (outer["x_min"] <= inner["x_min"]) & (outer["y_min"] <= inner["y_min"]) & (outer["x_max"] >= inner["x_max"]) & (outer["y_max"] >= inner["y_max"])


def inside_image(row: Column, col: Column, height: Column, width: Column) -> Column:
    """Strictly between the edges."""
    return (col > 0) & (col < width) & (row > 0) & (row < height)


def pixel_steps(row0: Column, col0: Column, row1: Column, col1: Column) -> Column:
    """Array of (row, col): whole steps of one in both axes at once, from the first to the last pixel."""
    rows, cols = F.sequence(row0.cast("int"), row1.cast("int")), F.sequence(col0.cast("int"), col1.cast("int"))
    return F.filter(F.arrays_zip(rows.alias("row"), cols.alias("col")), lambda p: p["row"].isNotNull() & p["col"].isNotNull())


def query_circle(x0: Column, y0: Column, x1: Column, y1: Column, along: float, before: float, past: float) -> Column:
    """Centre and radius (x, y, radius) of the circle around a transect's rectangle, from `before` (negative: behind the origin) to `past` the end."""
    length = F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))
    half = (length + past - before) / 2
    reach = (before + half) / length
    return F.struct((x0 + reach * (x1 - x0)).alias("x"), (y0 + reach * (y1 - y0)).alias("y"), F.sqrt(half * half + along * along).alias("radius"))


def utc(ts: Column, zone: Column | str = "UTC") -> Column:
    """A time without zone, meant in `zone`, as UTC without zone; of a time with a zone, its instant in UTC."""
    return F.convert_timezone(F.lit(zone) if isinstance(zone, str) else zone, F.lit("UTC"), ts)
