"""Reprojection between UTM and geographic coordinates, affine pixel maps, hashes and plant ids."""

from __future__ import annotations

import math

import numpy as np

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions.indices import _c
from furrow.functions.rounding import nearest

# Fixed values of the WGS84 ellipsoid and the UTM grid.
A, FLAT, K0, FALSE_EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_N = FLAT / (2 - FLAT)
_E2 = FLAT * (2 - FLAT)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Kruger's series in the third flattening, to the fourth order.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)


def _meridian(zone: int) -> float:
    return math.radians(6 * zone - 183)


def to_utm(lat: str | Column, lon: str | Column, zone: int) -> tuple[Column, Column]:
    """(x, y) in metres of the northern UTM zone, by the transverse Mercator series (sub-millimetre inside the zone)."""
    phi, lam = F.radians(_c(lat)), F.radians(_c(lon)) - _meridian(zone)
    e = math.sqrt(_E2)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    x = eta + sum((a * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, a in enumerate(_ALPHA)), F.lit(0.0))
    y = xi + sum((a * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, a in enumerate(_ALPHA)), F.lit(0.0))
    return FALSE_EAST + K0 * _RECT * x, K0 * _RECT * y


def to_latlon(x: str | Column, y: str | Column, zone: int) -> tuple[Column, Column]:
    """(lat, lon) in degrees of a point in the northern UTM zone."""
    xi, eta = _c(y) / (K0 * _RECT), (_c(x) - FALSE_EAST) / (K0 * _RECT)
    u = xi - sum((b * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, b in enumerate(_BETA)), F.lit(0.0))
    v = eta - sum((b * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, b in enumerate(_BETA)), F.lit(0.0))
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi + sum((d * F.sin(2 * (j + 1) * chi) for j, d in enumerate(_DELTA)), F.lit(0.0))
    return F.degrees(phi), F.degrees(F.atan2(F.sinh(v), F.cos(u)) + _meridian(zone))


def latlon_arrays(x: np.ndarray, y: np.ndarray, zone: int) -> tuple[np.ndarray, np.ndarray]:
    """to_latlon of arrays, for what is worked out beside the rows, such as a raster's bounds."""
    xi, eta = y / (K0 * _RECT), (x - FALSE_EAST) / (K0 * _RECT)
    u = xi - sum(b * np.sin(2 * (j + 1) * xi) * np.cosh(2 * (j + 1) * eta) for j, b in enumerate(_BETA))
    v = eta - sum(b * np.cos(2 * (j + 1) * xi) * np.sinh(2 * (j + 1) * eta) for j, b in enumerate(_BETA))
    chi = np.arcsin(np.sin(u) / np.cosh(v))
    phi = chi + sum(d * np.sin(2 * (j + 1) * chi) for j, d in enumerate(_DELTA))
    return np.degrees(phi), np.degrees(np.arctan2(np.sinh(v), np.cos(u)) + _meridian(zone))


#: An affine map (a, b, c, d, e, f): x = a*col + b*row + c, y = d*col + e*row + f.
Affine = tuple[float, float, float, float, float, float]


def inverse(t: Affine) -> Affine:
    a, b, c, d, e, f = t
    det = a * e - b * d
    return (e / det, -b / det, (b * f - e * c) / det, -d / det, a / det, (d * c - a * f) / det)


def compose(outer: Affine, inner: Affine) -> Affine:
    """The map that applies ``inner`` first."""
    a, b, c, d, e, f = outer
    g, h, i, j, k, m = inner
    return (a * g + b * j, a * h + b * k, a * i + b * m + c, d * g + e * j, d * h + e * k, d * i + e * m + f)


def apply_affine(t: Affine, u: str | Column, v: str | Column, shift: float = 0.0) -> tuple[Column, Column]:
    """The map at (u, v); a shift of 0.5 takes the pixel's centre."""
    u, v = _c(u) + F.lit(shift), _c(v) + F.lit(shift)
    return t[0] * u + t[1] * v + t[2], t[3] * u + t[4] * v + t[5]


def pixel_of(t: Affine, x: str | Column, y: str | Column, how: str = "floor") -> tuple[Column, Column]:
    """(col, row) of a point: ``floor`` or ``rint`` (half to even); the two differ from call to call, so name one."""
    c, r = apply_affine(inverse(t), x, y)
    f = F.floor if how == "floor" else F.rint
    return f(c).cast("int"), f(r).cast("int")


def geo_hash(x: str | Column, y: str | Column) -> Column:
    """Six characters of the MD5 of "x,y", in four decimals (the exact binary value rounded) without trailing zeros but one."""
    part = lambda c: F.regexp_replace(F.format_string("%.4f", nearest(c, 4)), r"(\.\d+?)0+$", "$1")
    return F.upper(F.substring(F.md5(F.concat_ws(",", part(x), part(y)).cast("binary")), 1, 6))


def sector_label(sector: str | Column) -> Column:
    return F.when(_c(sector) >= 0, F.format_string("S%02d", _c(sector))).otherwise("NOISE")


def plant_id(label: str | Column, row: str | Column, col: str | Column, hash_: str | Column) -> Column:
    """PLT-S02-R014-C007-A3F2C1; a null row or column is shown as 000."""
    return F.format_string("PLT-%s-R%03d-C%03d-%s", _c(label), F.coalesce(_c(row), F.lit(0)), F.coalesce(_c(col), F.lit(0)), _c(hash_))
