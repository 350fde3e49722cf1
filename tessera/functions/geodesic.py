"""Distances on the sphere in metres as a SQL function (F24, F25, J08), with unit vectors: no pole and no +-180 degree
line needs a case of its own.

Edges are arcs of great circles.  Where two geometries meet in longitude and latitude, their distance is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import relate as R
from .geometry import _c

#: Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6371008.8


def unit(lon: Column, lat: Column) -> Column:
    """The unit vector of a place in degrees."""
    lo, la = F.radians(lon), F.radians(lat)
    return F.struct((F.cos(la) * F.cos(lo)).alias("x"), (F.cos(la) * F.sin(lo)).alias("y"), F.sin(la).alias("z"))


def _unit(x: str, y: str) -> str:
    return f"named_struct('x', cos(radians({y})) * cos(radians({x})), 'y', cos(radians({y})) * sin(radians({x})), 'z', sin(radians({y})))"


def _dot(a: str, b: str) -> str:
    return f"({a}.x * {b}.x + {a}.y * {b}.y + {a}.z * {b}.z)"


def _cross(a: str, b: str) -> str:
    return f"named_struct('x', {a}.y * {b}.z - {a}.z * {b}.y, 'y', {a}.z * {b}.x - {a}.x * {b}.z, 'z', {a}.x * {b}.y - {a}.y * {b}.x)"


def _angle(a: str, b: str) -> str:
    chord = f"sqrt(pow({a}.x - {b}.x, 2) + pow({a}.y - {b}.y, 2) + pow({a}.z - {b}.z, 2))"
    return f"2 * asin(least({chord} / 2, 1D))"


def _to_arc(p: str, e: str) -> str:
    """Angle from a vector to an arc (a, b, normal n): to its great circle where the foot lies on it, else to an end."""
    n = f"{e}.n"
    ahead = R.let(_cross(n, f"{e}.a"), lambda v: _dot(v, p))
    behind = R.let(_cross(n, f"{e}.b"), lambda v: _dot(v, p))
    across = R.let(f"sqrt({_dot(n, n)})", lambda m: f"CASE WHEN {m} > 0 AND {ahead} >= 0 AND {behind} <= 0 THEN abs(asin(least(greatest({_dot(p, n)} / {m}, -1D), 1D))) END")
    return f"coalesce({across}, least({_angle(p, f'{e}.a')}, {_angle(p, f'{e}.b')}))"


def _on_sphere(o: str) -> str:
    """Vectors and arcs of an outline."""
    ends = lambda e: f"named_struct('a', {_unit(f'{e}.x1', f'{e}.y1')}, 'b', {_unit(f'{e}.x2', f'{e}.y2')})"
    arcs = R.each("transform", f"{o}.edges", lambda e: R.let(ends(e), lambda v: f"named_struct('a', {v}.a, 'b', {v}.b, 'n', {_cross(f'{v}.a', f'{v}.b')})"))
    vectors = R.each("transform", f"{o}.points", lambda p: _unit(f"{p}.x", f"{p}.y"))
    return f"named_struct('points', {vectors}, 'arcs', {arcs}, 'dim', {o}.dim)"


def _body() -> tuple[str, str]:
    def one(s, t):  # the points of one to the arcs or points of the other
        to_points = lambda p: R.fold(f"{t}.points", "pi()", lambda m, q: f"least({m}, {_angle(p, q)})")
        to_arcs = lambda p: R.fold(f"{t}.arcs", "pi()", lambda m, e: f"least({m}, {_to_arc(p, e)})")
        return R.fold(f"{s}.points", "pi()", lambda m, p: f"least({m}, CASE WHEN {t}.dim = 0 THEN {to_points(p)} ELSE {to_arcs(p)} END)")

    def known(a, b, tol):
        apart = R.let(f"named_struct('s', {_on_sphere(a)}, 't', {_on_sphere(b)})", lambda v: f"least({one(f'{v}.s', f'{v}.t')}, {one(f'{v}.t', f'{v}.s')})")
        return f"CASE WHEN {R.meets(a, b, tol)} THEN 0D ELSE {EARTH_RADIUS_M!r}D * {apart} END"

    return "double", R.outlines(known)


def metres(a, b) -> Column:
    """Distance in metres of two geometry columns in degrees, 0 where they meet; null where one is null."""
    return F.call_function(R.define("metres", _body), _c(a), _c(b))


def chord(metres: float) -> float:
    """The chord of an arc on the unit sphere."""
    return 2 * math.sin(min(metres / EARTH_RADIUS_M, math.pi) / 2)


def cap_box(geom, pad_m: float = 0.0) -> list[Column]:
    """Lowest and highest x, y, z of a box around a geometry grown by ``pad_m`` metres.

    All places of an envelope lie within half its diagonal of its centre, and so do the arcs between
    them (a cap up to a half sphere is convex); beyond that the box is the whole sphere."""
    g = _c(geom)
    reach = F.radians(F.sqrt((g["maxx"] - g["minx"]) ** 2 + (g["maxy"] - g["miny"]) ** 2)) / 2
    pad = chord(pad_m) * (1 + 1e-9) + 1e-12
    radius = F.when(reach < math.pi / 2, 2 * F.sin(reach / 2)).otherwise(2.0) + F.lit(pad)
    centre = unit((g["minx"] + g["maxx"]) / 2, (g["miny"] + g["maxy"]) / 2)
    return [c for d in "xyz" for c in (centre[d] - radius, centre[d] + radius)]
