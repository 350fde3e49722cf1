"""Spatial predicates as Spark columns.

Every predicate is a boolean ``Column`` that is never null (two-valued logic),
so ``~pred`` behaves.

Plan shape: each predicate is ``envelope test AND exact test``.  The envelope
test reads only ``geom.minx/miny/maxx/maxy``; its null guard is IS NOT NULL, so
Parquet gets all of it as pushed filters and skips row groups.  The exact test is native column math where the shape allows it
(points against boxes, literal polygons and literal lines), array functions over the coordinates of the
rows that survived the envelope test otherwise (``relate``, ``geodesic``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geodesic, regions, relate
from .geometry import Geom, _c

# Distance units to metres.
UNIT_TO_METRES = {
    "m": 1.0, "metre": 1.0, "meter": 1.0, "metres": 1.0, "meters": 1.0,
    "km": 1000.0, "kilometer": 1000.0, "kilometers": 1000.0, "kilometre": 1000.0, "kilometres": 1000.0,
    "mm": 0.001, "millimeter": 0.001, "millimeters": 0.001,
    "mi": 1609.344, "miles": 1609.344,
    "nm": 1852.0, "NM": 1852.0, "nautical miles": 1852.0,
    "ft": 0.3048, "feet": 0.3048,
    "in": 0.0254, "inches": 0.0254,
}
EARTH_RADIUS_M = geodesic.EARTH_RADIUS_M
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0


def to_metres(distance: float, unit: str | None) -> float:
    if unit is None:
        return float(distance)
    key = unit if unit in UNIT_TO_METRES else unit.lower()
    if key not in UNIT_TO_METRES:
        raise ValueError(f"unknown distance unit {unit!r}")
    return float(distance) * UNIT_TO_METRES[key]


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _known(cond: Column, *operands: Column) -> Column:
    """False where an operand is null, in a form that sources accept as a filter."""
    return reduce(lambda a, b: a & b.isNotNull(), operands, cond)


def _bounds(g: Column) -> list[Column]:
    return [g["minx"], g["miny"], g["maxx"], g["maxy"]]


# --------------------------------------------------------------------------
# envelope tests
# --------------------------------------------------------------------------
def envelope_intersects(geom, x1: float, y1: float, x2: float, y2: float) -> Column:
    """Closed envelope-vs-box test (F15 loose BBOX)."""
    g = _c(geom)
    x1, x2 = min(x1, x2), max(x1, x2)
    y1, y2 = min(y1, y2), max(y1, y2)
    return _known((g["minx"] <= F.lit(x2)) & (g["maxx"] >= F.lit(x1))
                  & (g["miny"] <= F.lit(y2)) & (g["maxy"] >= F.lit(y1)), *_bounds(g))


def envelopes_intersect(a, b) -> Column:
    a, b = _c(a), _c(b)
    return _false_if_null((a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"])
                          & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"]))


def _is_point(geom) -> Column:
    return _c(geom)["kind"] == F.lit("Point")


# --------------------------------------------------------------------------
# native point tests against literal geometries
# --------------------------------------------------------------------------
def point_in_literal_polygon(x, y, poly: Geom, boundary: bool = True) -> Column:
    """Ray casting unrolled over the literal's edges (closed if ``boundary``)."""
    x, y = _c(x), _c(y)
    crossings = [F.when(((F.lit(y1) > y) != (F.lit(y2) > y))
                        & (x < F.lit(x2 - x1) * (y - F.lit(y1)) / F.lit(y2 - y1) + F.lit(x1)), 1).otherwise(0)
                 for (x1, y1, x2, y2) in poly.edges() if y1 != y2]
    inside = (reduce(lambda a, b: a + b, crossings, F.lit(0)) % 2) == 1
    on_edge = point_on_literal_edges(x, y, poly)
    res = (inside | on_edge) if boundary else (inside & ~on_edge)
    return _false_if_null(res)


def point_on_literal_edges(x, y, g: Geom) -> Column:
    x, y = _c(x), _c(y)
    conds = []
    for (x1, y1, x2, y2) in g.edges():
        cross = (F.lit(x2 - x1) * (y - F.lit(y1))) - (F.lit(y2 - y1) * (x - F.lit(x1)))
        conds.append((cross == 0) & x.between(min(x1, x2), max(x1, x2)) & y.between(min(y1, y2), max(y1, y2)))
    return _false_if_null(reduce(lambda a, b: a | b, conds, F.lit(False)))


def point_literal_distance(x, y, g: Geom) -> Column:
    """Planar distance from point columns to a literal geometry's vertices / segments."""
    x, y = _c(x), _c(y)
    terms = []
    if g.dimension == 0:
        for part in g.parts:
            px, py = part[0][0]
            terms.append(F.sqrt((x - F.lit(px)) ** 2 + (y - F.lit(py)) ** 2))
    else:
        for (x1, y1, x2, y2) in g.edges():
            terms.append(_point_segment_distance(x, y, x1, y1, x2, y2))
    d = terms[0] if len(terms) == 1 else F.least(*terms)
    if g.dimension == 2:
        d = F.when(point_in_literal_polygon(x, y, g), F.lit(0.0)).otherwise(d)
    return d


def _point_segment_distance(x, y, x1, y1, x2, y2) -> Column:
    dx, dy = x2 - x1, y2 - y1
    ll = dx * dx + dy * dy
    if ll == 0:
        return F.sqrt((x - F.lit(x1)) ** 2 + (y - F.lit(y1)) ** 2)
    t = ((x - F.lit(x1)) * F.lit(dx) + (y - F.lit(y1)) * F.lit(dy)) / F.lit(ll)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.sqrt((x - (F.lit(x1) + t * F.lit(dx))) ** 2 + (y - (F.lit(y1) + t * F.lit(dy))) ** 2)


def haversine(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres between two lon/lat points."""
    lon1, lat1, lon2, lat2 = (F.radians(_c(v) if not isinstance(v, (int, float)) else F.lit(float(v)))
                              for v in (lon1, lat1, lon2, lat2))
    a = F.sin((lat2 - lat1) / 2) ** 2 + F.cos(lat1) * F.cos(lat2) * F.sin((lon2 - lon1) / 2) ** 2
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


# --------------------------------------------------------------------------
# native point-in-polygon for a polygon *column* (spatial joins)
# --------------------------------------------------------------------------
def _edges_of(geom) -> Column:
    g = _c(geom)
    # a ring of n vertices has n - 1 edges; a point has none
    return F.flatten(F.flatten(F.transform(g["parts"], lambda part: F.transform(
        part, lambda ring: F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
                                       lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"),
                                                             F.get(ring, i + 1)["x"].alias("x2"),
                                                             F.get(ring, i + 1)["y"].alias("y2")))))))


def point_in_polygon_column(x, y, poly, boundary: bool = True) -> Column:
    """Point columns inside a polygon geometry column (holes honoured)."""
    x, y = _c(x), _c(y)
    edges = _edges_of(poly)
    inside = F.aggregate(edges, F.lit(False), lambda acc, e: acc != (
        ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])))
    on_edge = _on_edges(x, y, edges)
    res = (inside | on_edge) if boundary else (inside & ~on_edge)
    return _false_if_null(res)


def _on_edges(x: Column, y: Column, edges: Column) -> Column:
    return F.exists(edges, lambda e: (((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])) == 0)
                    & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                    & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def point_in_geometry_column(x, y, geom, pred: str) -> Column:
    """Point columns that intersect / lie within a geometry column of any kind:
    ray casting for areas, on-segment for lines (``within`` leaves out the ends of
    open lines), equality for points."""
    x, y = _c(x), _c(y)
    g = _c(geom)
    on_line = _on_edges(x, y, _edges_of(g))
    if pred == "within":
        last = lambda ring: F.element_at(ring, -1)
        at_end = F.exists(g["parts"], lambda part: F.exists(part, lambda r: ((F.get(r, 0)["x"] != last(r)["x"]) | (F.get(r, 0)["y"] != last(r)["y"]))
                          & (((F.get(r, 0)["x"] == x) & (F.get(r, 0)["y"] == y)) | ((last(r)["x"] == x) & (last(r)["y"] == y)))))
        on_line = on_line & ~at_end
    at_vertex = F.exists(F.flatten(F.flatten(g["parts"])), lambda p: (p["x"] == x) & (p["y"] == y))
    return _false_if_null(F.when(g["kind"].isin("Polygon", "MultiPolygon"), point_in_polygon_column(x, y, g, boundary=(pred == "intersects")))
                          .when(g["kind"].isin("LineString", "MultiLineString"), on_line).otherwise(at_vertex))


def _vertices(g: Column) -> Column:
    return F.flatten(F.flatten(g["parts"]))


def shape_intersects_box(geom, x1: float, y1: float, x2: float, y2: float) -> Column:
    """A geometry column of any kind against a closed box (numbers or columns): a vertex in the box,
    an edge that the box clips (Liang-Barsky), or the box inside an area."""
    g = _c(geom)
    x1, y1, x2, y2 = (v if isinstance(v, Column) else F.lit(float(v)) for v in (x1, y1, x2, y2))

    def clipped(e):
        def slab(d, p, lo, hi):
            still = F.when((p >= lo) & (p <= hi), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
            return (F.when(d > 0, (lo - p) / d).when(d < 0, (hi - p) / d).otherwise(still),
                    F.when(d > 0, (hi - p) / d).when(d < 0, (lo - p) / d).otherwise(-still))

        ex, lx = slab(e["x2"] - e["x1"], e["x1"], x1, x2)
        ey, ly = slab(e["y2"] - e["y1"], e["y1"], y1, y2)
        return F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))

    vertex = F.exists(_vertices(g), lambda p: p["x"].between(x1, x2) & p["y"].between(y1, y2))
    covers = g["kind"].isin("Polygon", "MultiPolygon") & point_in_polygon_column(x1, y1, g)
    return _false_if_null(vertex | F.exists(_edges_of(g), clipped) | covers)


def shape_inside_box(geom, x1: float, y1: float, x2: float, y2: float) -> Column:
    """Whether a geometry whose envelope lies in the closed box also reaches its interior (a box
    is convex: a vertex or the middle of an edge then lies strictly inside)."""
    g = _c(geom)
    inner = lambda x, y: (x > F.lit(x1)) & (x < F.lit(x2)) & (y > F.lit(y1)) & (y < F.lit(y2))
    area = g["kind"].isin("Polygon", "MultiPolygon")
    vertex = F.exists(_vertices(g), lambda p: inner(p["x"], p["y"]))
    middle = F.exists(_edges_of(g), lambda e: inner((e["x1"] + e["x2"]) / 2, (e["y1"] + e["y2"]) / 2))
    return _false_if_null(area | vertex | middle)


def point_distance_column(x, y, geom) -> Column:
    """Planar distance from point columns to a geometry column (min over its
    segments; points: to its vertices; 0 inside polygons), native HOFs."""
    x, y = _c(x), _c(y)
    g = _c(geom)
    edges = _edges_of(g)
    pts = F.flatten(F.flatten(g["parts"]))

    def seg(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        ll = dx * dx + dy * dy
        t = F.when(ll > 0, F.least(F.greatest(((x - e["x1"]) * dx + (y - e["y1"]) * dy) / ll, F.lit(0.0)),
                                   F.lit(1.0))).otherwise(F.lit(0.0))
        return F.sqrt((x - (e["x1"] + t * dx)) ** 2 + (y - (e["y1"] + t * dy)) ** 2)

    vert = F.aggregate(pts, F.lit(float("inf")), lambda acc, p: F.least(acc, F.sqrt((x - p["x"]) ** 2 + (y - p["y"]) ** 2)))
    segd = F.aggregate(edges, F.lit(float("inf")), lambda acc, e: F.least(acc, seg(e)))
    is_area = g["kind"].isin("Polygon", "MultiPolygon")
    d = F.when(g["kind"].isin("Point", "MultiPoint"), vert).otherwise(segd)
    return F.when(is_area & point_in_polygon_column(x, y, g, boundary=True), F.lit(0.0)).otherwise(d)


# --------------------------------------------------------------------------
# OGC predicates against a literal geometry
# --------------------------------------------------------------------------
def _env_pad(g: Geom, pad: float = 0.0):
    x1, y1, x2, y2 = g.envelope()
    return x1 - pad, y1 - pad, x2 + pad, y2 + pad


def bbox(geom, x1: float, y1: float, x2: float, y2: float, loose: bool = False,
         point_layer: bool = False) -> Column:
    """Geometry intersects the box (closed on all sides)."""
    env = envelope_intersects(geom, x1, y1, x2, y2)
    if loose or point_layer:
        return env
    return intersects(geom, Geom.box(x1, y1, x2, y2))


def intersects(geom, other: Geom, point_layer: bool = False) -> Column:
    """F16.  ``point_layer`` promises every row is a Point: fully native plan."""
    g = _c(geom)
    env = envelope_intersects(g, *other.envelope())
    if point_layer:
        return env & _point_vs_literal(g["minx"], g["miny"], other, "intersects")
    if other.is_rectangle():
        return env & shape_intersects_box(g, *other.envelope())
    if other.kind == "Point":
        px, py = other.parts[0][0][0]
        return env & point_in_geometry_column(F.lit(px), F.lit(py), g, "intersects")
    return env & _exact(g, other, "intersects")


def disjoint(geom, other: Geom, point_layer: bool = False) -> Column:
    """no envelope prefilter (it would drop true rows)."""
    return _false_if_null(_c(geom)["kind"].isNotNull()) & ~intersects(geom, other, point_layer)


def contains(geom, other: Geom, point_layer: bool = False) -> Column:
    """the row geometry contains the literal."""
    g = _c(geom)
    x1, y1, x2, y2 = other.envelope()
    env = _known((g["minx"] <= x1) & (g["miny"] <= y1) & (g["maxx"] >= x2) & (g["maxy"] >= y2), *_bounds(g))
    if point_layer:
        # a point contains only an equal point
        if other.kind == "Point":
            return env
        return F.lit(False)
    if other.kind == "Point":
        px, py = other.parts[0][0][0]
        return env & point_in_geometry_column(F.lit(px), F.lit(py), g, "within")
    return env & _exact(g, other, "contains")


def within(geom, other: Geom, point_layer: bool = False) -> Column:
    """the row geometry is within the literal (boundary excluded for points)."""
    g = _c(geom)
    x1, y1, x2, y2 = other.envelope()
    env = _known((g["minx"] >= x1) & (g["miny"] >= y1) & (g["maxx"] <= x2) & (g["maxy"] <= y2), *_bounds(g))
    if point_layer:
        return env & _point_vs_literal(g["minx"], g["miny"], other, "within")
    if other.is_rectangle():
        return env & shape_inside_box(g, x1, y1, x2, y2)
    return env & _exact(g, other, "within")


def equals(geom, other: Geom, point_layer: bool = False) -> Column:
    """topological equality."""
    g = _c(geom)
    x1, y1, x2, y2 = other.envelope()
    env = _known((g["minx"] == x1) & (g["miny"] == y1) & (g["maxx"] == x2) & (g["maxy"] == y2), *_bounds(g))
    if point_layer:
        return env if other.kind == "Point" else F.lit(False)
    return env & _exact(g, other, "equals")


def crosses(geom, other: Geom) -> Column:
    return envelope_intersects(geom, *other.envelope()) & _exact(_c(geom), other, "crosses")


def overlaps(geom, other: Geom) -> Column:
    return envelope_intersects(geom, *other.envelope()) & _exact(_c(geom), other, "overlaps")


def touches(geom, other: Geom, point_layer: bool = False) -> Column:
    g = _c(geom)
    env = envelope_intersects(g, *other.envelope())
    if point_layer:
        return env & _point_vs_literal(g["minx"], g["miny"], other, "touches")
    return env & _exact(g, other, "touches")


def dwithin(geom, other: Geom, distance: float, unit: str | None = None, geodetic: bool = False,
            point_layer: bool = False) -> Column:
    """distance <= d.  Geodetic layers take a unit and compare metres
    (haversine for points, arcs of great circles otherwise)."""
    g = _c(geom)
    if geodetic:
        metres = to_metres(distance, unit)
        _, gy1, _, gy2 = other.envelope()
        dlat = metres / METRES_PER_DEGREE * 1.001
        lat_max = max(abs(gy1), abs(gy2)) + dlat
        # a window that holds a pole spans all longitudes
        dlon = dlat / math.cos(math.radians(lat_max)) if lat_max < 89.9 else 360.0
        x1, y1, x2, y2 = other.envelope()
        env = envelope_intersects(g, x1 - dlon, y1 - dlat, x2 + dlon, y2 + dlat)
        # the window goes on across the antimeridian
        if x1 - dlon < -180.0:
            env = env | envelope_intersects(g, x1 - dlon + 360.0, y1 - dlat, x2 + dlon + 360.0, y2 + dlat)
        if x2 + dlon > 180.0:
            env = env | envelope_intersects(g, x1 - dlon - 360.0, y1 - dlat, x2 + dlon - 360.0, y2 + dlat)
        if point_layer and other.kind == "Point":
            px, py = other.parts[0][0][0]
            return env & _false_if_null(haversine(g["minx"], g["miny"], px, py) <= F.lit(metres))
        return env & _false_if_null(geodesic.metres(g, other.to_column()) <= F.lit(metres))
    d = float(distance)
    env = envelope_intersects(g, *_env_pad(other, d))
    if point_layer:
        return env & _false_if_null(point_literal_distance(g["minx"], g["miny"], other) <= F.lit(d))
    return env & _false_if_null(relate.distance(g, other.to_column()) <= F.lit(d))


def beyond(geom, other: Geom, distance: float, unit: str | None = None, geodetic: bool = False,
           point_layer: bool = False) -> Column:
    """distance > d (no prefilter; complement of DWithin on non-null rows)."""
    return _false_if_null(_c(geom)["kind"].isNotNull()) & ~dwithin(geom, other, distance, unit, geodetic,
                                                                    point_layer)


def distance(geom, other: Geom, point_layer: bool = False) -> Column:
    """Planar distance column to a literal geometry."""
    g = _c(geom)
    if point_layer:
        return point_literal_distance(g["minx"], g["miny"], other)
    return relate.distance(g, other.to_column())


def _point_vs_literal(x, y, other: Geom, pred: str) -> Column:
    if other.kind in ("Point", "MultiPoint"):
        hit = reduce(lambda a, b: a | b, [(x == F.lit(p[0][0][0])) & (y == F.lit(p[0][0][1])) for p in other.parts])
        if pred == "touches":
            return F.lit(False)
        if pred == "within" and other.kind == "Point":
            return _false_if_null(hit)
        return _false_if_null(hit)
    if other.dimension == 1:
        on = point_on_literal_edges(x, y, other)
        if pred == "intersects":
            return on
        ends = []
        for part in other.parts:
            ring = part[0]
            if ring[0] != ring[-1]:
                ends.extend([ring[0], ring[-1]])
        at_end = reduce(lambda a, b: a | b, [(x == F.lit(p[0])) & (y == F.lit(p[1])) for p in ends], F.lit(False))
        if pred == "touches":
            return on & at_end
        return on & ~at_end  # within: on the line's interior
    if other.is_rectangle():
        x1, y1, x2, y2 = other.envelope()
        inside = (x > x1) & (x < x2) & (y > y1) & (y < y2)
        closed = x.between(x1, x2) & y.between(y1, y2)
        return {"intersects": closed, "within": inside, "touches": closed & ~inside}[pred]
    if pred == "intersects":
        return point_in_literal_polygon(x, y, other, boundary=True)
    if pred == "within":
        return point_in_literal_polygon(x, y, other, boundary=False)
    return point_on_literal_edges(x, y, other)


def _exact(g: Column, other: Geom, pred: str) -> Column:
    return _false_if_null(relate.relate(pred, g, other.to_column()))


def relate_columns(name: str, a, b, a_points: bool = False, distance: float | None = None) -> Column:
    """OGC predicate between two geometry columns of the same row.
    Envelope test first (none for disjoint / beyond), point-in-geometry when ``a`` holds points, else the
    general relation on the surviving rows."""
    name = name.lower()
    A, Bc = _c(a), _c(b)
    if name in ("disjoint", "beyond"):
        inner = relate_columns("intersects" if name == "disjoint" else "dwithin", a, b, a_points, distance)
        return _false_if_null(A["kind"].isNotNull() & Bc["kind"].isNotNull()) & ~inner
    if name == "dwithin":
        d = F.lit(float(distance))
        env = _false_if_null((A["minx"] - d <= Bc["maxx"]) & (A["maxx"] + d >= Bc["minx"])
                             & (A["miny"] - d <= Bc["maxy"]) & (A["maxy"] + d >= Bc["miny"]))
        if a_points:
            return env & _false_if_null(point_distance_column(A["minx"], A["miny"], Bc) <= d)
        return env & _false_if_null(relate.distance(A, Bc) <= d)
    env = envelopes_intersect(A, Bc)
    if a_points and name in ("intersects", "within"):
        return env & point_in_geometry_column(A["minx"], A["miny"], Bc, name)
    return env & _false_if_null(relate.relate(name, A, Bc))


def clip_to_world(region: Geom) -> Geom | None:
    """a geodetic query region of any kind clipped to the world box; None when nothing is left."""
    return regions.cut_to_box(region, *regions.WORLD)


def geodetic_filter(name: str, geom, region: Geom, **kw) -> Column:
    """whole world -> TRUE, empty -> FALSE (TRUE for disjoint), otherwise the predicate on the clipped region.

    Where the region is cut into quadrants, rows meet it if they meet one of them, so each has its own envelope test;
    predicates about the region as a whole take it uncut."""
    name = name.lower()
    clipped = clip_to_world(region)
    if clipped is None:
        return F.lit(name == "disjoint")
    if clipped.is_rectangle() and clipped.envelope() == regions.WORLD and name in ("bbox", "intersects"):
        return _false_if_null(_c(geom)["kind"].isNotNull())
    if name in ("bbox", "intersects", "disjoint"):
        meets = reduce(lambda a, b: a | b, [spatial_predicate("intersects" if name == "disjoint" else name, geom, part, **kw) for part in regions.quadrants(clipped)])
        return _false_if_null(_c(geom)["kind"].isNotNull()) & ~meets if name == "disjoint" else meets
    return spatial_predicate(name, geom, clipped, **kw)


def spatial_predicate(name: str, geom, other: Geom, **kw) -> Column:
    """Dispatch by OGC name (used by query builders and F28 tests)."""
    table = {"bbox": lambda: bbox(geom, *other.envelope(), **kw), "intersects": lambda: intersects(geom, other, **kw),
             "disjoint": lambda: disjoint(geom, other, **kw), "contains": lambda: contains(geom, other, **kw),
             "within": lambda: within(geom, other, **kw), "equals": lambda: equals(geom, other, **kw),
             "crosses": lambda: crosses(geom, other), "overlaps": lambda: overlaps(geom, other),
             "touches": lambda: touches(geom, other, **kw), "dwithin": lambda: dwithin(geom, other, **kw),
             "beyond": lambda: beyond(geom, other, **kw)}
    return table[name.lower()]()
