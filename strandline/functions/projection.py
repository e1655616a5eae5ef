"""Transverse Mercator (UTM) by Krueger's series to the sixth order, as column expressions."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import UTM_EPSG

#: GRS80 axis and flattening, UTM scale and false easting.
AXIS, FLATTENING, SCALE, EASTING = 6_378_137.0, 1 / 298.257222101, 0.9996, 500_000.0
_N = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
_E = sqrt(FLATTENING * (2 - FLATTENING))
#: The series' coefficients in powers of n (first power first), forward and inverse.
FORWARD = [
    [1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800],
    [0, 13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360],
    [0, 0, 61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440],
    [0, 0, 0, 49561 / 161280, -179 / 168, 6601661 / 7257600],
    [0, 0, 0, 0, 34729 / 80640, -3418889 / 1995840],
    [0, 0, 0, 0, 0, 212378941 / 319334400],
]
INVERSE = [
    [1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800],
    [0, 1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720],
    [0, 0, 17 / 480, -37 / 840, -209 / 4480, 5569 / 90720],
    [0, 0, 0, 4397 / 161280, -11 / 504, -830251 / 7257600],
    [0, 0, 0, 0, 4583 / 161280, -108847 / 3991680],
    [0, 0, 0, 0, 0, 20648693 / 638668800],
]


def _series(rows: list[list[float]]) -> list[float]:
    return [sum(c * _N ** (k + 1) for k, c in enumerate(r)) for r in rows]


_ALPHA, _BETA = _series(FORWARD), _series(INVERSE)


def _atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def to_utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing in a northern zone."""
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(_atanh(s) - _E * _atanh(_E * s))
    xi, eta = F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for k, a in enumerate(_ALPHA, 1):
        x, y = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta), y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return EASTING + SCALE * _RADIUS * x, SCALE * _RADIUS * y


def from_utm(x: Column, y: Column, zone: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a northern zone's easting and northing."""
    xi, eta = y / (SCALE * _RADIUS), (x - EASTING) / (SCALE * _RADIUS)
    p, q = xi, eta
    for k, b in enumerate(_BETA, 1):
        p, q = p - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta), q - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(p) / F.cosh(q))
    # the conformal latitude's inverse by fixed-point steps, which shrink by e^2 each
    goal, phi = _atanh(F.sin(chi)), chi
    for _ in range(6):
        phi = F.asin(F.tanh(goal + _E * _atanh(_E * F.sin(phi))))
    lam = F.atan2(F.sinh(q), F.cos(p))
    return F.degrees(lam) + zone * 6 - 183, phi * (180 / pi)


#: Codes of plain degrees and of the web map's projection.
DEGREES, WEB = (4326, 4269, 4258), 3857


def zone_of(epsg: int) -> tuple[int, bool]:
    """UTM zone of a code (WGS 84, NAD 83, ETRS 89, or the national ones of UTM_EPSG), and whether it is a southern one."""
    for first, last, south in ((32601, 32660, False), (32701, 32760, True), (26901, 26923, False), (25828, 25838, False)):
        if first <= epsg <= last:
            return epsg % 100, south
    for zone, code in UTM_EPSG.items():
        if code == epsg:
            return zone, False
    raise ValueError(f"no projection for EPSG {epsg}")


def to_degrees(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude of coordinates under a code."""
    if epsg in DEGREES:
        return x, y
    if epsg == WEB:
        return F.degrees(x / AXIS), F.degrees(2 * F.atan(F.exp(y / AXIS)) - pi / 2)
    zone, south = zone_of(epsg)
    return from_utm(x, y - 10_000_000 if south else y, F.lit(zone))


def from_degrees(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    if epsg in DEGREES:
        return lon, lat
    if epsg == WEB:
        return AXIS * F.radians(lon), AXIS * F.log(F.tan(pi / 4 + F.radians(lat) / 2))
    zone, south = zone_of(epsg)
    x, y = to_utm(lon, lat, F.lit(zone))
    return x, y + 10_000_000 if south else y


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates under one code as those under another: degrees, the web map, and UTM zones (datums taken as one)."""
    if source == target:
        return x, y
    return from_degrees(*to_degrees(x, y, source), target)
