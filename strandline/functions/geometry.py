"""Planar geometry on columns. Points are (x, y) in metres or (row, col) in pixels."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixel_to_world(row: Column, col: Column, g: dict) -> tuple[Column, Column]:
    """Affine georeference g: xtr, xscale, xshear, ytr, yshear, yscale."""
    return g["xtr"] + g["xscale"] * col + g["xshear"] * row, g["ytr"] + g["yshear"] * col + g["yscale"] * row


def world_to_pixel(x: Column, y: Column, g: dict, swap: bool = True) -> tuple[Column, Column]:
    """The inverse: (row, col), or (col, row) without swap."""
    det = g["xscale"] * g["yscale"] - g["xshear"] * g["yshear"]
    dx, dy = x - g["xtr"], y - g["ytr"]
    col, row = (g["yscale"] * dx - g["xshear"] * dy) / det, (g["xscale"] * dy - g["yshear"] * dx) / det
    return (row, col) if swap else (col, row)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))


def in_frame(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """Chainage along the transect (x0, y0) to (x1, y1), and offset to its left."""
    length = distance(x0, y0, x1, y1)
    ux, uy = (x1 - x0) / length, (y1 - y0) / length
    return (x - x0) * ux + (y - y0) * uy, (y - y0) * ux - (x - x0) * uy


def segment_distance(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point from a segment; from its point where both ends agree."""
    dx, dy = x1 - x0, y1 - y0
    t = F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.least(t, F.lit(1.0)), F.lit(0.0))
    return distance(x, y, x0 + t * dx, y0 + t * dy)


def transect_end(x0: Column, y0: Column, orientation: Column, length: Column) -> tuple[Column, Column]:
    """Sea end of a transect by its orientation in degrees from north."""
    phi = (90 - orientation) * pi / 180
    return x0 + length * F.cos(phi), y0 + length * F.sin(phi)


def points_along(length: Column, delta: float) -> Column:
    """Distances 0, delta, ... up to a line's length, and the length itself."""
    return F.array_distinct(F.concat(F.transform(F.sequence(F.lit(0), F.floor(length / delta).cast("int")), lambda i: i * delta), F.array(length)))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


#: NAD83(CSRS) zones of the supported range, by zone number.
UTM_EPSG = {7: 3154, 8: 3155, 9: 3156, 10: 3157, 11: 2955, 12: 2956, 13: 2957, 14: 3158, 15: 3159, 16: 3160, 17: 2958, 18: 2959, 19: 2960, 20: 2961, 21: 2962, 22: 3761}


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the zone; NULL outside zones 7 to 22 or latitudes 38 to 84."""
    table = F.create_map(*(F.lit(v) for kv in UTM_EPSG.items() for v in kv))
    return F.when((lat >= 38) & (lat <= 84), F.try_element_at(table, utm_zone(lon)))


def box(xs: Column, ys: Column) -> Column:
    """Envelope of arrays of coordinates."""
    return F.struct(F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max"))


def wkt_line(points: Column) -> Column:
    """LINESTRING text of an array of structs (x, y)."""
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))


def collider(x0: Column, y0: Column, x1: Column, y1: Column, along: float, before: float, past: float) -> Column:
    """Corners of the rectangle around a transect: `along` to each side, `before` the origin, `past` the end."""
    length = distance(x0, y0, x1, y1)
    ux, uy = (x1 - x0) / length, (y1 - y0) / length
    ax, ay = x0 - before * ux, y0 - before * uy
    bx, by = x1 + past * ux, y1 + past * uy
    corner = lambda x, y, s: F.struct((x - s * along * uy).alias("x"), (y + s * along * ux).alias("y"))
    return F.array(corner(ax, ay, 1), corner(bx, by, 1), corner(bx, by, -1), corner(ax, ay, -1))


def on_transect(x0: Column, y0: Column, x1: Column, y1: Column, chainage: Column) -> tuple[Column, Column]:
    """The point at a chainage of the transect; NULL where both ends agree."""
    length = distance(x0, y0, x1, y1)
    return x0 + chainage * F.try_divide(x1 - x0, length), y0 + chainage * F.try_divide(y1 - y0, length)


def axis_box(x0: Column, y0: Column, x1: Column, y1: Column, buffer: float) -> Column:
    """Upright box around both ends of a transect, `buffer` wider on each side."""
    return F.struct(
        (F.least(x0, x1) - buffer).alias("x_min"), (F.least(y0, y1) - buffer).alias("y_min"),
        (F.greatest(x0, x1) + buffer).alias("x_max"), (F.greatest(y0, y1) + buffer).alias("y_max"),
    )


def inside_convex(x: Column, y: Column, corners: Column) -> Column:
    """Whether a point lies strictly inside a convex polygon (corners in either direction): on one side of every edge."""
    n = F.size(corners)
    turn = F.transform(corners, lambda p, i: _turn(p, F.get(corners, (i + 1) % n), x, y))
    return F.forall(turn, lambda v: v > 0) | F.forall(turn, lambda v: v < 0)


def _turn(p: Column, q: Column, x: Column, y: Column) -> Column:
    return (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])


def window_bounds(col: Column, row: Column, buffer: float, width: Column, height: Column) -> Column:
    """Rows and columns (ends excluded) of the square window around a pixel, cut to the image; bounds round half to even."""
    bound = lambda v: F.rint(v).cast("int")
    return F.struct(
        F.greatest(bound(row - buffer), F.lit(0)).alias("row_min"), F.least(bound(row + buffer), height).alias("row_max"),
        F.greatest(bound(col - buffer), F.lit(0)).alias("col_min"), F.least(bound(col + buffer), width).alias("col_max"),
    )


def lerp(x0: Column, y0: Column, x1: Column, y1: Column, x: Column) -> Column:
    """y at x on the segment from (x0, y0) to (x1, y1); NULL outside it or where it is upright."""
    share = F.try_divide(x - x0, x1 - x0)
    return F.when((x >= x0) & (x <= x1), y0 * (1 - share) + y1 * share)


def slope_intercept(x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """The line through two points as y = slope * x + intercept; NULL where it is upright."""
    slope = F.try_divide(y1 - y0, x1 - x0)
    return slope, y0 - x0 * slope


def line_crossing(p: tuple[Column, Column], q: tuple[Column, Column]) -> tuple[Column, Column]:
    """Where two lines (slope, intercept) meet; NULL where they are parallel."""
    x = F.try_divide(q[1] - p[1], p[0] - q[0])
    return x, p[0] * x + p[1]
