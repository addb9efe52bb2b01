"""The national grid: an oblique conformal conic projection of the Bessel ellipsoid, and the shift between it and global coordinates.

Everything is an expression of a row; equations without a closed solution are solved by a fixed number of fixed-point steps, each far below
a millimetre at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hustings.functions.text import let

# The ellipsoids (half axis, eccentricity squared), the projection's parameters, and the shift from the grid's datum to the global one.
BESSEL = (6377397.155, 1 - (1 - 1 / 299.1528128) ** 2)
WGS84 = (6378137.0, 1 - (1 - 1 / 298.257223563) ** 2)
CENTRE, ORIGIN, TILT, PARALLEL, SCALE = math.radians(49.5), math.radians(24 + 50 / 60), math.radians(30 + 17 / 60 + 17.30311 / 3600), math.radians(78.5), 0.9999
#: Metres along the axes, seconds of arc around them, and parts of a million.
SHIFT = (485.0, 169.5, 483.8, 7.786, 4.398, 4.103, 0.0)
STEPS = 8

_A, _E2 = BESSEL
_E = math.sqrt(_E2)
_RADIUS = _A * math.sqrt(1 - _E2) / (1 - _E2 * math.sin(CENTRE) ** 2)
_B = math.sqrt(1 + _E2 * math.cos(CENTRE) ** 4 / (1 - _E2))
_N = math.sin(PARALLEL)


def _bend(s: float) -> float:
    return ((1 + _E * s) / (1 - _E * s)) ** (_E * _B / 2)


_T0 = math.tan(math.pi / 4 + math.asin(math.sin(CENTRE) / _B) / 2) * _bend(math.sin(CENTRE)) / math.tan(math.pi / 4 + CENTRE / 2) ** _B
_R0 = SCALE * _RADIUS / math.tan(PARALLEL)
_TOP = math.tan(math.pi / 4 + PARALLEL / 2)
_QUARTER = math.pi / 4


def _pair(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def project(lon: Column, lat: Column) -> Column:
    """(x, y) in metres, east and north (both below 0), of a place on the Bessel ellipsoid in degrees."""
    phi, turn = F.radians(lat), _B * (ORIGIN - F.radians(lon))
    wave = F.pow((1 + _E * F.sin(phi)) / (1 - _E * F.sin(phi)), F.lit(_E * _B / 2))
    sphere = 2 * (F.atan(_T0 * F.pow(F.tan(phi / 2 + _QUARTER), F.lit(_B)) / wave) - _QUARTER)

    def tilted(u: Column) -> Column:
        t = F.asin(math.cos(TILT) * F.sin(u) + math.sin(TILT) * F.cos(u) * F.cos(turn))
        return let(F.struct(t.alias("t"), F.asin(F.cos(u) * F.sin(turn) / F.cos(t)).alias("d")), lambda s: _on_cone(s["t"], s["d"]))

    return let(sphere, tilted)


def _on_cone(t: Column, d: Column) -> Column:
    r = _R0 * F.pow(_TOP / F.tan(t / 2 + _QUARTER), F.lit(_N))
    return _pair(-r * F.sin(_N * d), -r * F.cos(_N * d))


def unproject(x: Column, y: Column) -> Column:
    """(x, y): longitude and latitude in degrees on the Bessel ellipsoid of a place on the grid."""
    r, d = F.sqrt(x * x + y * y), F.atan2(-x, -y) / _N
    t = 2 * (F.atan(F.pow(_R0 / r, F.lit(1 / _N)) * _TOP) - _QUARTER)

    def turned(s: Column) -> Column:
        u = F.asin(math.cos(TILT) * F.sin(s["t"]) - math.sin(TILT) * F.cos(s["t"]) * F.cos(s["d"]))
        return let(F.struct(u.alias("u"), F.asin(F.cos(s["t"]) * F.sin(s["d"]) / F.cos(u)).alias("v")), found)

    def found(s: Column) -> Column:
        base = F.pow(F.tan(s["u"] / 2 + _QUARTER) / _T0, F.lit(1 / _B))
        step = lambda phi, _: 2 * (F.atan(base * F.pow((1 + _E * F.sin(phi)) / (1 - _E * F.sin(phi)), F.lit(_E / 2))) - _QUARTER)
        return _pair(F.degrees(ORIGIN - s["v"] / _B), F.degrees(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), s["u"], step)))

    return let(F.struct(t.alias("t"), d.alias("d")), turned)


def _in_space(lon: Column, lat: Column, ellipsoid: tuple[float, float]) -> Column:
    """The place at height 0 as (x, y, z) from the ellipsoid's centre."""
    a, e2 = ellipsoid
    s = F.sin(F.radians(lat))
    n = a / F.sqrt(1 - e2 * s * s)
    return F.struct((n * F.cos(F.radians(lat)) * F.cos(F.radians(lon))).alias("x"), (n * F.cos(F.radians(lat)) * F.sin(F.radians(lon))).alias("y"), (n * (1 - e2) * s).alias("z"))


def _on_ellipsoid(place: Column, ellipsoid: tuple[float, float]) -> Column:
    a, e2 = ellipsoid

    def of(p: Column) -> Column:
        out = F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])
        step = lambda phi, _: F.atan2(p["z"] + e2 * a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi)) * F.sin(phi), out)
        first = F.atan2(p["z"], out * (1 - e2))
        return _pair(F.degrees(F.atan2(p["y"], p["x"])), F.degrees(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, step)))

    return let(place, of)


def _turned(p: Column, shift: tuple[float, ...]) -> list[Column]:
    """What the shift's rotations add to a place."""
    rx, ry, rz = (math.radians(v / 3600) for v in shift[3:6])
    return [ry * p["z"] - rz * p["y"], rz * p["x"] - rx * p["z"], rx * p["y"] - ry * p["x"]]


def to_grid(lon: Column, lat: Column, shift: tuple[float, ...] = SHIFT) -> Column:
    """(x, y) on the national grid of a place in global degrees; null in, null out."""
    scale = 1 + shift[6] / 1e6

    def moved(p: Column) -> Column:
        start = F.struct(*(((p[c] - t) / scale).alias(c) for c, t in zip("xyz", shift, strict=False)))
        # the rotations are undone by fixed-point steps
        step = lambda q, _: F.struct(*(((p[c] - t) / scale - r).alias(c) for c, t, r in zip("xyz", shift[:3], _turned(q, shift), strict=True)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, step)

    local = _on_ellipsoid(let(_in_space(lon, lat, WGS84), moved), BESSEL)
    return F.when(lon.isNotNull() & lat.isNotNull(), let(local, lambda p: project(p["x"], p["y"])))


def from_grid(x: Column, y: Column, shift: tuple[float, ...] = SHIFT) -> Column:
    """(x, y): global longitude and latitude in degrees of a place on the national grid; null in, null out."""
    scale = 1 + shift[6] / 1e6
    moved = lambda p: F.struct(*((t + scale * (p[c] + r)).alias(c) for c, t, r in zip("xyz", shift[:3], _turned(p, shift), strict=True)))
    space = let(unproject(x, y), lambda g: _in_space(g["x"], g["y"], BESSEL))
    return F.when(x.isNotNull() & y.isNotNull(), _on_ellipsoid(let(space, moved), WGS84))
