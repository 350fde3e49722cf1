"""Relations of two geometries of any kind as SQL functions.

Both geometries are cut where they meet: every edge of one is split at its crossings with the other.  The
vertices, the crossings, the middles of the pieces between them and one inner point of every area are
located in the other geometry (interior, boundary, exterior).  Between two crossings an edge keeps its
side, so these places decide which cells of the intersection matrix are filled, and with them every
predicate.  All of it is array functions over the rows' own coordinates: no Python and no shuffle.

The expressions are written as SQL text and registered as temporary SQL functions of the session (``tessera_within``
and so on, also for use in SQL), which Spark inlines: a Column of some thousand nodes would take seconds to build.
"""

from __future__ import annotations

from itertools import count
from typing import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .geometry import GEOMETRY_T, _c

EXTERIOR, BOUNDARY, INTERIOR = 0, 1, 2
#: Bit of a mask: some piece of a line runs along the other geometry.
ALONG = 9
#: Relative width within which a place counts as on an edge (crossings are rounded).
EPSILON = "1e-12D"
_names = count()
Text = Callable[[str], str]


def each(function: str, array: str, fn: Text) -> str:
    """A higher-order function over an array."""
    v = f"v{next(_names)}"
    return f"{function}({array}, {v} -> {fn(v)})"


def let(value: str, fn: Text) -> str:
    """``fn`` of a value that is worked out once."""
    return f"get({each('transform', f'array({value})', fn)}, 0)"


def indexed(array: str, fn: Callable[[str, str], str]) -> str:
    v, i = f"v{next(_names)}", f"i{next(_names)}"
    return f"transform({array}, ({v}, {i}) -> {fn(v, i)})"


def fold(array: str, start: str, fn: Callable[[str, str], str]) -> str:
    m, v = f"m{next(_names)}", f"v{next(_names)}"
    return f"aggregate({array}, {start}, ({m}, {v}) -> {fn(m, v)})"


# --------------------------------------------------------------------------
# outlines
# --------------------------------------------------------------------------
def _ring_edges(ring: str) -> str:
    return indexed(f"slice({ring}, 1, greatest(size({ring}) - 1, 0))", lambda p, i: (
        f"named_struct('x1', {p}.x, 'y1', {p}.y, 'x2', get({ring}, {i} + 1).x, 'y2', get({ring}, {i} + 1).y)"))


def _part_edges(part: str) -> str:
    return f"flatten({each('transform', part, _ring_edges)})"


def _crossing_x(e: str, y: str) -> str:
    return f"({e}.x1 + ({y} - {e}.y1) * ({e}.x2 - {e}.x1) / ({e}.y2 - {e}.y1))"


def _straddles(e: str, y: str) -> str:
    return f"(({e}.y1 > {y}) <> ({e}.y2 > {y}))"


def _inner_point(part: str) -> str:
    """A point inside an area: the middle of the widest stretch on the scan line through the largest gap of vertex heights."""
    def on_line(y):
        cut = each("filter", _part_edges(part), lambda e: _straddles(e, y))
        xs = f"array_sort({each('transform', cut, lambda e: _crossing_x(e, y))})"
        return let(xs, lambda v: "array_max({})".format(each("transform", f"sequence(0, greatest(size({v}) - 2, 0), 2)", lambda i: (
            f"named_struct('w', get({v}, {i} + 1) - get({v}, {i}), 'x', (get({v}, {i} + 1) + get({v}, {i})) / 2, 'y', {y})"))))

    def gap(ys):
        return "array_max({})".format(indexed(f"slice({ys}, 2, greatest(size({ys}) - 1, 0))", lambda y, i: f"named_struct('w', {y} - get({ys}, {i}), 'y', ({y} + get({ys}, {i})) / 2)"))

    heights = f"array_sort(array_distinct({each('transform', f'flatten({part})', lambda p: f'{p}.y')}))"
    best = let(let(heights, gap) + ".y", on_line)
    return let(best, lambda q: f"named_struct('x', {q}.x, 'y', {q}.y)")


def outline(g: str) -> str:
    """What the relations need of a geometry: dimension, edges, points, the boundary points of lines, inner points of
    areas, and the largest coordinate.  Null for a null geometry."""
    dim = f"CASE WHEN {g}.kind IN ('Point', 'MultiPoint') THEN 0 WHEN {g}.kind IN ('LineString', 'MultiLineString') THEN 1 ELSE 2 END"
    none = "CAST(array() AS array<struct<x: double, y: double>>)"

    def known(flat):
        tips = "flatten({})".format(each("transform", each("filter", flat, lambda r: f"get({r}, 0) <> element_at({r}, -1)"), lambda r: f"array(get({r}, 0), element_at({r}, -1))"))
        odd = let(tips, lambda t: each("filter", f"array_distinct({t})", lambda p: f"size({each('filter', t, lambda q: f'{q} = {p}')}) % 2 = 1"))
        edges = f"flatten({each('transform', f'{g}.parts', _part_edges)})"
        return (f"named_struct('dim', {dim}, 'edges', {edges}, 'points', flatten({flat}), 'ends', CASE WHEN {dim} = 1 THEN {odd} ELSE {none} END, "
                f"'inner', CASE WHEN {dim} = 2 THEN {each('transform', f'{g}.parts', _inner_point)} ELSE {none} END, "
                f"'reach', greatest(1.0D, abs({g}.minx), abs({g}.miny), abs({g}.maxx), abs({g}.maxy)))")
    return f"CASE WHEN {g}.parts IS NOT NULL THEN {let(f'flatten({g}.parts)', known)} END"


def outlines(fn: Callable[[str, str, str], str]) -> str:
    """``fn`` of the outlines of the arguments a and b and the width of an edge; null where a geometry is null."""
    def known(p):
        return f"CASE WHEN {p}.a IS NOT NULL AND {p}.b IS NOT NULL THEN {fn(f'{p}.a', f'{p}.b', f'(greatest({p}.a.reach, {p}.b.reach) * {EPSILON})')} END"
    return let("named_struct('a', a, 'b', b)", lambda g: let(f"named_struct('a', {outline(f'{g}.a')}, 'b', {outline(f'{g}.b')})", known))


# --------------------------------------------------------------------------
# places and where they lie
# --------------------------------------------------------------------------
def _cross(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def _length(e: str) -> str:
    return f"greatest(hypot({e}.x2 - {e}.x1, {e}.y2 - {e}.y1), 1e-300D)"


def _on(e: str, x: str, y: str, tol: str) -> str:
    return (f"({x} >= least({e}.x1, {e}.x2) - {tol} AND {x} <= greatest({e}.x1, {e}.x2) + {tol} AND {y} >= least({e}.y1, {e}.y2) - {tol} "
            f"AND {y} <= greatest({e}.y1, {e}.y2) + {tol} AND abs({_cross(e, x, y)}) <= {tol} * {_length(e)})")


def _inside(o: str, x: str, y: str) -> str:
    """Ray parity over all rings of an outline."""
    return fold(f"{o}.edges", "false", lambda odd, e: f"{odd} <> ({_straddles(e, y)} AND {x} < {_crossing_x(e, y)})")


def _locate(o: str, x: str, y: str, tol: str) -> str:
    """Where a place lies in an outline: EXTERIOR, BOUNDARY or INTERIOR."""
    at_point = each("exists", f"{o}.points", lambda p: f"abs({p}.x - {x}) <= {tol} AND abs({p}.y - {y}) <= {tol}")
    at_end = each("exists", f"{o}.ends", lambda p: f"{p}.x = {x} AND {p}.y = {y}")
    kind = lambda on: (f"CASE WHEN {o}.dim = 1 THEN CASE WHEN NOT {on} THEN {EXTERIOR} WHEN {at_end} THEN {BOUNDARY} ELSE {INTERIOR} END "  # noqa: E731
                       f"WHEN {on} THEN {BOUNDARY} WHEN {_inside(o, x, y)} THEN {INTERIOR} ELSE {EXTERIOR} END")
    return (f"CASE WHEN {o}.dim = 0 THEN CASE WHEN {at_point} THEN {INTERIOR} ELSE {EXTERIOR} END "
            f"ELSE {let(each('exists', f'{o}.edges', lambda e: _on(e, x, y, tol)), kind)} END")


def _meetings(e: str, o: str) -> str:
    """Positions (0 to 1) on an edge at which an outline's edges or points meet it, both ends included, ascending."""
    none = "CAST(array() AS array<double>)"

    def with_edge(r, f):
        def solved(v):
            crossing = let(f"named_struct('t', ({v}.qx * {v}.sy - {v}.qy * {v}.sx) / {v}.den, 'u', {v}.side / {v}.den)",
                           lambda c: f"CASE WHEN {c}.t BETWEEN 0 AND 1 AND {c}.u BETWEEN 0 AND 1 THEN array({c}.t) ELSE {none} END")
            t0 = f"({v}.qx * {r}.x + {v}.qy * {r}.y) / {r}.rr"
            clipped = lambda c: each("transform", f"array({c}.t0, {c}.t1)", lambda t: f"least(greatest({t}, 0D), 1D)")
            along = let(f"named_struct('t0', {t0}, 't1', {t0} + ({v}.sx * {r}.x + {v}.sy * {r}.y) / {r}.rr)",
                        lambda c: f"CASE WHEN greatest({c}.t0, {c}.t1) >= 0 AND least({c}.t0, {c}.t1) <= 1 THEN {clipped(c)} ELSE {none} END")
            return f"CASE WHEN {v}.den <> 0 THEN {crossing} WHEN {v}.side = 0 AND {r}.rr > 0 THEN {along} ELSE {none} END"

        return let(f"named_struct('sx', {f}.x2 - {f}.x1, 'sy', {f}.y2 - {f}.y1, 'qx', {f}.x1 - {e}.x1, 'qy', {f}.y1 - {e}.y1)", lambda b: let(
            f"named_struct('sx', {b}.sx, 'sy', {b}.sy, 'qx', {b}.qx, 'qy', {b}.qy, 'den', {r}.x * {b}.sy - {r}.y * {b}.sx, 'side', {b}.qx * {r}.y - {b}.qy * {r}.x)", solved))

    def with_point(r, p):
        t = f"(({p}.x - {e}.x1) * {r}.x + ({p}.y - {e}.y1) * {r}.y) / {r}.rr"
        inside = each("filter", f"array({t})", lambda v: f"{v} BETWEEN 0 AND 1")
        return f"CASE WHEN {r}.rr > 0 AND {_cross(e, f'{p}.x', f'{p}.y')} = 0 THEN {inside} ELSE {none} END"

    def all_met(r):
        points, edges = each("transform", f"{o}.points", lambda p: with_point(r, p)), each("transform", f"{o}.edges", lambda f: with_edge(r, f))
        return f"flatten(CASE WHEN {o}.dim = 0 THEN {points} ELSE {edges} END)"

    line = let(f"named_struct('x', {e}.x2 - {e}.x1, 'y', {e}.y2 - {e}.y1)", lambda r: f"named_struct('x', {r}.x, 'y', {r}.y, 'rr', {r}.x * {r}.x + {r}.y * {r}.y)")
    met = each("transform", let(line, all_met), lambda t: f"CASE WHEN {t} = 0 THEN 0D ELSE {t} END")  # -0.0 is not another position
    return f"array_sort(array_distinct(concat(array(0D, 1D), {met})))"


def _places(a: str, b: str) -> str:
    """The places of ``a`` to locate in ``b``: coordinates, where they lie in ``a`` itself, and whether between crossings."""
    place = lambda p, own, between="false": f"named_struct('x', {p}.x, 'y', {p}.y, 'own', {own}, 'between', {between})"

    def of_edge(e):
        on_edge = lambda t: (f"named_struct('x', CASE WHEN {t} = 1 THEN {e}.x2 ELSE {e}.x1 + {t} * ({e}.x2 - {e}.x1) END, "  # noqa: E731
                             f"'y', CASE WHEN {t} = 1 THEN {e}.y2 ELSE {e}.y1 + {t} * ({e}.y2 - {e}.y1) END)")
        at_end = lambda p: each("exists", f"{a}.ends", lambda q: f"{q}.x = {p}.x AND {q}.y = {p}.y")
        corner = lambda p: place(p, f"CASE WHEN {a}.dim = 2 OR {at_end(p)} THEN {BOUNDARY} ELSE {INTERIOR} END")
        middle = lambda p: place(p, f"CASE WHEN {a}.dim = 2 THEN {BOUNDARY} ELSE {INTERIOR} END", "true")
        return let(_meetings(e, b), lambda ts: "concat({}, {})".format(
            each("transform", ts, lambda t: let(on_edge(t), corner)),
            indexed(f"slice({ts}, 2, size({ts}) - 1)", lambda t, i: let(f"({t} + get({ts}, {i})) / 2", lambda m: let(on_edge(m), middle)))))

    inner = each("transform", f"CASE WHEN {a}.dim = 0 THEN {a}.points ELSE {a}.inner END", lambda p: place(p, str(INTERIOR)))
    return f"concat(flatten({each('transform', f'{a}.edges', of_edge)}), {inner})"


def _mask(a: str, b: str, tol: str) -> str:
    """Bit own * 3 + location for every place of ``a`` located in ``b``, and ALONG."""
    def bits(p):
        return let(_locate(b, f"{p}.x", f"{p}.y", tol), lambda at: f"shiftleft(1, {p}.own * 3 + {at}) | CASE WHEN {p}.between AND {at} > {EXTERIOR} THEN {1 << ALONG} ELSE 0 END")
    return fold(_places(a, b), "0", lambda m, p: f"{m} | {bits(p)}")


# --------------------------------------------------------------------------
# rules: what the masks (of a in b, and of b in a) and dimensions say
# --------------------------------------------------------------------------
def _any(mask: str, *cells: tuple[int, int]) -> str:
    bits = 0
    for own, at in cells:
        bits |= 1 << own * 3 + at
    return f"(({mask} & {bits}) <> 0)"


def _interiors(ma, mb, da, db):
    return (f"({_any(ma, (INTERIOR, INTERIOR))} OR {_any(mb, (INTERIOR, INTERIOR))} OR "
            f"{da} = 2 AND {db} = 2 AND ({_any(ma, (BOUNDARY, INTERIOR))} OR {_any(mb, (BOUNDARY, INTERIOR))}))")


def _sticks_out(ma, mb, da, db):
    """The first reaches the exterior of the second."""
    return (f"({_any(ma, (INTERIOR, EXTERIOR))} OR {da} = 2 AND {_any(ma, (BOUNDARY, EXTERIOR))} OR {da} = 2 AND {db} = 2 AND {_any(mb, (BOUNDARY, INTERIOR))})")


def _covered(ma, mb, da, db):
    """The first within the second."""
    return (f"({da} <= {db} AND NOT ({_any(ma, (INTERIOR, EXTERIOR), (BOUNDARY, EXTERIOR))} OR {da} = 2 AND {_any(mb, (BOUNDARY, INTERIOR))}) "
            f"AND {_interiors(ma, mb, da, db)})")


def _meet(ma, mb, da, db):
    held = [(own, at) for own in (BOUNDARY, INTERIOR) for at in (BOUNDARY, INTERIOR)]
    return f"({_any(ma, *held)} OR {_any(mb, *held)})"


def _crossing(ma, mb, da, db):
    along = f"({ma} & {1 << ALONG}) <> 0"
    return (f"CASE WHEN {da} < {db} THEN {_interiors(ma, mb, da, db)} AND {_sticks_out(ma, mb, da, db)} "
            f"WHEN {da} > {db} THEN {_interiors(ma, mb, da, db)} AND {_sticks_out(mb, ma, db, da)} WHEN {da} = 1 THEN {_interiors(ma, mb, da, db)} AND NOT {along} ELSE false END")


def _overlap(ma, mb, da, db):
    return (f"({da} = {db} AND ({da} <> 1 OR ({ma} & {1 << ALONG}) <> 0) AND {_interiors(ma, mb, da, db)} "
            f"AND {_sticks_out(ma, mb, da, db)} AND {_sticks_out(mb, ma, db, da)})")


_RULES: dict[str, Callable[[str, str, str, str], str]] = {
    "within": _covered, "contains": lambda ma, mb, da, db: _covered(mb, ma, db, da),
    "equals": lambda ma, mb, da, db: f"{_covered(ma, mb, da, db)} AND {_covered(mb, ma, db, da)}",
    "touches": lambda ma, mb, da, db: f"({da} > 0 OR {db} > 0) AND {_meet(ma, mb, da, db)} AND NOT {_interiors(ma, mb, da, db)}",
    "crosses": _crossing, "overlaps": _overlap,
}


def _edges_hit(e: str, f: str, tol: str) -> str:
    """Closed segments meet: each lies on both sides of, or on, the other's line."""
    def side(s, x, y):
        return let(_cross(s, x, y), lambda c: f"CASE WHEN abs({c}) <= {tol} * {_length(s)} THEN 0D ELSE signum({c}) END")

    boxes = " AND ".join(f"least({e}.{d}1, {e}.{d}2) <= greatest({f}.{d}1, {f}.{d}2) + {tol} AND greatest({e}.{d}1, {e}.{d}2) >= least({f}.{d}1, {f}.{d}2) - {tol}" for d in "xy")
    return (f"{boxes} AND {side(e, f'{f}.x1', f'{f}.y1')} * {side(e, f'{f}.x2', f'{f}.y2')} <= 0 "
            f"AND {side(f, f'{e}.x1', f'{e}.y1')} * {side(f, f'{e}.x2', f'{e}.y2')} <= 0")


def meets(a: str, b: str, tol: str) -> str:
    """An edge of one meets an edge of the other, or a point of one lies in the other."""
    crossing = each("exists", f"{a}.edges", lambda e: each("exists", f"{b}.edges", lambda f: _edges_hit(e, f, tol)))
    lies = lambda p, o: each("exists", f"{p}.points", lambda q: f"{_locate(o, f'{q}.x', f'{q}.y', tol)} > {EXTERIOR}")
    # a line meets a line by edges only; two point sets are compared once
    return (f"({crossing} OR CASE WHEN {a}.dim > 0 AND {b}.dim = 1 THEN false ELSE {lies(a, b)} END "
            f"OR CASE WHEN {b}.dim > 0 AND {a}.dim = 1 OR {a}.dim = 0 AND {b}.dim = 0 THEN false ELSE {lies(b, a)} END)")


def _to_edge(p: str, e: str) -> str:
    def known(d):
        t = f"CASE WHEN {d}.x <> 0 OR {d}.y <> 0 THEN least(greatest((({p}.x - {e}.x1) * {d}.x + ({p}.y - {e}.y1) * {d}.y) / ({d}.x * {d}.x + {d}.y * {d}.y), 0D), 1D) ELSE 0D END"
        return let(t, lambda v: f"hypot({p}.x - ({e}.x1 + {v} * {d}.x), {p}.y - ({e}.y1 + {v} * {d}.y))")
    return let(f"named_struct('x', {e}.x2 - {e}.x1, 'y', {e}.y2 - {e}.y1)", known)


def _apart(a: str, b: str) -> str:
    """Smallest distance of the points of one to the edges (or points) of the other."""
    far = "double('Infinity')"

    def one(p, o):
        to_points = lambda q: fold(f"{o}.points", far, lambda m, r: f"least({m}, hypot({q}.x - {r}.x, {q}.y - {r}.y))")
        to_edges = lambda q: fold(f"{o}.edges", far, lambda m, e: f"least({m}, {_to_edge(q, e)})")
        return fold(f"{p}.points", far, lambda m, q: f"least({m}, CASE WHEN {o}.dim = 0 THEN {to_points(q)} ELSE {to_edges(q)} END)")
    return f"least({one(a, b)}, {one(b, a)})"


def _ruled(rule: Callable) -> str:
    return outlines(lambda a, b, tol: let(f"named_struct('a', {_mask(a, b, tol)}, 'b', {_mask(b, a, tol)})", lambda m: rule(f"{m}.a", f"{m}.b", f"{a}.dim", f"{b}.dim")))


def _body(name: str) -> tuple[str, str]:
    """SQL type and text of a function of geometries a and b."""
    if name == "intersects":
        return "boolean", outlines(meets)
    if name == "distance":
        return "double", outlines(lambda a, b, tol: f"CASE WHEN {meets(a, b, tol)} THEN 0D ELSE {_apart(a, b)} END")
    return "boolean", _ruled(_RULES[name])


_DEFINED: set[tuple[str, str]] = set()


def define(name: str, body: Callable[[], tuple[str, str]], params: str | None = None) -> str:
    """The name of the session's temporary SQL function (of geometries a and b, unless ``params`` says otherwise), created
    when first asked for; ``body`` gives its type and text."""
    spark, full = SparkSession.active(), f"tessera_{name}"
    key = (str(spark._jsparkSession.sessionUUID()), full)
    if key not in _DEFINED:
        kind, text = body()
        g = GEOMETRY_T.simpleString()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({params or f'a {g}, b {g}'}) RETURNS {kind} RETURN {text}")
        _DEFINED.add(key)
    return full


def relate(name: str, a, b) -> Column:
    """A predicate of two geometry columns (null where one is null): intersects, disjoint, within, contains, equals,
    touches, crosses or overlaps; or their planar distance, 0 where they meet."""
    name = name.lower()
    if name == "disjoint":
        return ~relate("intersects", a, b)
    return F.call_function(define(name, lambda: _body(name)), _c(a), _c(b))


def intersects(a, b) -> Column:
    return relate("intersects", a, b)


def distance(a, b) -> Column:
    return relate("distance", a, b)
