"""Queries on lines and areas: relations of shapes (F16, F18-F25, F28, J08), joins of mixed sizes,
distances in metres (F24, J08).  The oracles are written by hand from the layers' formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.geometry import Geom, box, from_parts, point
from ..operators import joins as J
from ..operators import sort as W
from ..session import spread
from . import sqlviews as V
from .layers import HEXAGON, poi, road, shape, table
from .registry import register

SHAPES = V.with_(V.SHAPE_ENV)
#: The literal hexagon beside the layers' grid, so that no vertex lies on an edge, and its edges as rows.
HEXAGON = Geom.polygon([(x + 3.37e-5, y + 1.71e-5) for x, y in HEXAGON.parts[0][0]])
_HEX_EDGES = "hex(ax, ay, zx, zy) AS (VALUES " + ", ".join(f"({a!r}e0, {b!r}e0, {c!r}e0, {d!r}e0)" for a, b, c, d in HEXAGON.edges()) + ")"


def cross(ax, ay, zx, zy, x, y):
    return f"(({zx} - {ax}) * ({y} - {ay}) - ({zy} - {ay}) * ({x} - {ax}))"


def hits(a, b):
    """Two closed segments (ax, ay, zx, zy) meet."""
    (ax, ay, zx, zy), (cx, cy, dx, dy) = a, b
    return f"""(greatest({ax}, {zx}) >= least({cx}, {dx}) AND least({ax}, {zx}) <= greatest({cx}, {dx})
   AND greatest({ay}, {zy}) >= least({cy}, {dy}) AND least({ay}, {zy}) <= greatest({cy}, {dy})
   AND sign({cross(ax, ay, zx, zy, cx, cy)}) * sign({cross(ax, ay, zx, zy, dx, dy)}) <= 0
   AND sign({cross(cx, cy, dx, dy, ax, ay)}) * sign({cross(cx, cy, dx, dy, zx, zy)}) <= 0)"""


#: Edges of the shape layer (points are edges without length), and its vertices.
_EDGES = """edge AS (
  SELECT fid, k, minx AS ax, miny AS ay, maxx AS zx, maxy AS zy FROM shape_env WHERE k = 1
  UNION ALL SELECT fid, k, minx, miny, minx, miny FROM shape_env WHERE k IN (0, 3)
  UNION ALL SELECT fid, k, maxx, maxy, maxx, maxy FROM shape_env WHERE k = 3
  UNION ALL SELECT fid, k, minx, miny, maxx, miny FROM shape_env WHERE k = 2
  UNION ALL SELECT fid, k, maxx, miny, minx, maxy FROM shape_env WHERE k = 2
  UNION ALL SELECT fid, k, minx, maxy, minx, miny FROM shape_env WHERE k = 2),
vertex AS (SELECT DISTINCT fid, k, ax AS x, ay AS y FROM edge UNION SELECT fid, k, zx, zy FROM edge)"""
_IN_HEX = """(SELECT count(*) % 2 = 1 FROM hex h WHERE (h.ay > {y}) <> (h.zy > {y}) AND {x} < h.ax + ({y} - h.ay) * (h.zx - h.ax) / (h.zy - h.ay))"""


@register("f16_shapes_in_hexagon", SHAPES + f", {_HEX_EDGES}, {_EDGES}" + f"""
SELECT DISTINCT fid, k FROM edge e WHERE EXISTS (SELECT 1 FROM hex h WHERE {hits(('e.ax', 'e.ay', 'e.zx', 'e.zy'), ('h.ax', 'h.ay', 'h.zx', 'h.zy'))})
UNION SELECT fid, k FROM vertex v WHERE {_IN_HEX.format(x='v.x', y='v.y')}""")
def f16_shapes_in_hexagon(spark, sf):
    """Points, lines, areas and point sets that meet a region without right angles (none holds the whole region)."""
    return shape(spark, sf).where(P.intersects("geom", HEXAGON)).select("fid", (F.col("fid") % 4).alias("k"))


@register("f19_f23_shapes_and_hexagon", SHAPES + f", {_HEX_EDGES}, {_EDGES}, " + f"""
met AS (SELECT fid, true AS cut FROM edge e WHERE EXISTS (SELECT 1 FROM hex h WHERE {hits(('e.ax', 'e.ay', 'e.zx', 'e.zy'), ('h.ax', 'h.ay', 'h.zx', 'h.zy'))}) GROUP BY fid),
side AS (SELECT fid, k, bool_and(inside) AS all_in, bool_or(inside) AS any_in FROM (SELECT fid, k, {_IN_HEX.format(x='v.x', y='v.y')} AS inside FROM vertex v) t GROUP BY fid, k)
SELECT s.fid, all_in AND cut IS NULL AS within, coalesce(cut, false) AND k = 1 OR k = 3 AND any_in AND NOT all_in AS crosses,
  coalesce(cut, false) AND k = 2 AS overlaps, false AS touches, NOT any_in AND cut IS NULL AS disjoint
FROM side s LEFT JOIN met m ON m.fid = s.fid""")
def f19_f23_shapes_and_hexagon(spark, sf):
    """The relations of every shape to the hexagon; no shape only touches it."""
    rel = lambda fn: fn("geom", HEXAGON)
    return spread(shape(spark, sf)).select("fid", rel(P.within).alias("within"), rel(P.crosses).alias("crosses"), rel(P.overlaps).alias("overlaps"),
                                   rel(P.touches).alias("touches"), rel(P.disjoint).alias("disjoint"))


@register("f18_contains_literal_shape", SHAPES + """
SELECT fid FROM shape_env WHERE k = 2 AND maxx - minx > 0.0025e0""")
def f18_contains_literal_shape(spark, sf):
    """Triangles moved to one place that contain a small literal triangle (which the smallest do not)."""
    s = shape(spark, sf).where(F.col("fid") % 4 == 2)
    side = F.col("geom")["maxx"] - F.col("geom")["minx"]
    moved = s.select("fid", _triangle(F.lit(10.0), F.lit(20.0), F.round(side, 6)).alias("geom"))
    return moved.where(P.contains("geom", Geom.polygon([(10.001, 20.001), (10.0015, 20.001), (10.001, 20.0015)]))).select("fid")


def _triangle(x, y, s):
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return from_parts(F.lit("Polygon"), F.array(F.array(F.array(p(x, y), p(x + s, y), p(x, y + s), p(x, y)))))


@register("f20_equals_shapes", SHAPES + "SELECT fid FROM shape_env WHERE k = 2 AND round(maxx - minx, 6) = 0.01e0")
def f20_equals_shapes(spark, sf):
    """Triangles equal to a literal one written from another corner and the other way round."""
    s = shape(spark, sf).where(F.col("fid") % 4 == 2)
    side = F.round(F.col("geom")["maxx"] - F.col("geom")["minx"], 6)
    moved = s.select("fid", _triangle(F.lit(0.0), F.lit(0.0), side).alias("geom"))
    return moved.where(P.equals("geom", Geom.polygon([(0.01, 0.0), (0.0, 0.0), (0.0, 0.01)]))).select("fid")


# ---------------------------------------------------------------- joins
_ROADS = V.with_(V.SHAPE_ENV, V.ROAD)


@register("j08_shapes_cross_roads", _ROADS + f", {_EDGES}" + f"""
SELECT DISTINCT e.fid, r.fid AS road FROM edge e JOIN road r
  ON e.zx >= least(r.x1, r.x2) AND e.ax <= greatest(r.x1, r.x2) + 1e0 AND {hits(('e.ax', 'e.ay', 'e.zx', 'e.zy'), ('r.x1', 'r.y1', 'r.x2', 'r.y2'))}
WHERE e.k IN (1, 2)""")
def j08_shapes_cross_roads(spark, sf):
    """Lines and triangles of up to 0.05 degrees against roads of a degree (no road lies within a triangle)."""
    s = shape(spark, sf).where((F.col("fid") % 4).isin(1, 2)).select("fid", "geom")
    r = road(spark, sf).select(F.col("fid").alias("road"), F.col("geom").alias("rgeom"))
    return J.spatial_join(s, r, "intersects", right_geom="rgeom", left_key="fid", right_key="road").select("fid", "road")


_TINY = "(SELECT o_orderkey AS key, 100.5e0 + ((o_orderkey * 6007) % 32000) / 1e3 AS x, 20.5e0 + ((o_orderkey * 3571) % 40000) / 1e3 AS y FROM orders)"
_HUGE = """(SELECT c_custkey AS big, 90e0 + (c_custkey % 23) AS x, 15e0 + (c_custkey % 19) AS y, CASE c_custkey % 3 WHEN 0 THEN 30e0 WHEN 1 THEN 2e0 ELSE 0.25e0 END AS s
  FROM customer WHERE c_custkey % 10 = 1)"""


@register("j08_mixed_sizes", f"""
SELECT b.big, count(*) AS n, min(t.key) AS first_key, max(t.key) AS last_key FROM {_TINY} t JOIN {_HUGE} b
  ON t.x <= b.x + b.s AND t.x + 0.001e0 >= b.x AND t.y <= b.y + b.s AND t.y + 0.001e0 >= b.y GROUP BY b.big""")
def j08_mixed_sizes(spark, sf):
    """Boxes of 0.001 degrees against boxes of 30, 2 and 0.25 degrees."""
    t = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.expr("100.5e0 + ((o_orderkey * 6007) % 32000) / 1e3").alias("x"),
                                          F.expr("20.5e0 + ((o_orderkey * 3571) % 40000) / 1e3").alias("y"))
    t = t.select("key", box("x", "y", F.col("x") + F.lit(0.001), F.col("y") + F.lit(0.001)).alias("geom"))
    k = F.col("c_custkey")
    b = table(spark, sf, "customer").where(k % 10 == 1).select(
        k.alias("big"), (F.lit(90.0) + k % 23).alias("x"), (F.lit(15.0) + k % 19).alias("y"), F.expr("CASE c_custkey % 3 WHEN 0 THEN 30e0 WHEN 1 THEN 2e0 ELSE 0.25e0 END").alias("s"))
    b = b.select("big", box("x", "y", F.col("x") + F.col("s"), F.col("y") + F.col("s")).alias("bgeom"))
    j = J.spatial_join(t, b, "intersects", right_geom="bgeom", left_key="key", right_key="big")
    return j.groupBy("big").agg(F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@register("j08_shapes_within_distance", _ROADS + f", {_EDGES}, " + """
near AS (SELECT e.fid, r.fid AS road,
  least(greatest(((e.ax - r.x1) * (r.x2 - r.x1) + (e.ay - r.y1) * (r.y2 - r.y1)) / ((r.x2 - r.x1) * (r.x2 - r.x1) + (r.y2 - r.y1) * (r.y2 - r.y1)), 0e0), 1e0) AS t, e.ax AS x, e.ay AS y, r.x1, r.y1, r.x2, r.y2
  FROM edge e JOIN road r ON e.k IN (0, 3) AND e.ax BETWEEN least(r.x1, r.x2) - 0.01e0 AND greatest(r.x1, r.x2) + 0.01e0)
SELECT DISTINCT fid, road FROM near WHERE sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2)) <= 0.002e0""")
def j08_shapes_within_distance(spark, sf):
    """Points and point sets at most 0.002 degrees from a road."""
    s = shape(spark, sf).where((F.col("fid") % 4).isin(0, 3)).select("fid", "geom")
    r = road(spark, sf).select(F.col("fid").alias("road"), F.col("geom").alias("rgeom"))
    return J.spatial_join(s, r, "dwithin", right_geom="rgeom", distance=0.002, left_key="fid", right_key="road").select("fid", "road")


@register("f28_line_pairs", V.with_(V.ROAD) + f"""
SELECT a.fid, {hits(('a.x1', 'a.y1', 'a.x2', 'a.y2'), ('b.x1', 'b.y1', 'b.x2', 'b.y2'))} AS meets,
  a.x1 = b.x1 AND a.x2 = b.x2 AS equal,
  (a.x1 - b.x1) * (a.x2 - b.x2) < 0e0 AS crosses, (a.x1 = b.x1) <> (a.x2 = b.x2) AS touches
FROM road a JOIN road b ON b.fid = a.fid + 89""")
def f28_line_pairs(spark, sf):
    """Each road against the one 89 keys on: they share an end, cross, are equal or lie apart."""
    r = road(spark, sf)
    b = r.select((F.col("fid") - 89).alias("fid"), F.col("geom").alias("other"))
    rel = lambda n: P.relate_columns(n, "geom", "other").alias({"intersects": "meets", "equals": "equal"}.get(n, n))
    return r.join(b, "fid").select("fid", rel("intersects"), rel("equals"), rel("crosses"), rel("touches"))


# ---------------------------------------------------------------- metres
#: Places all over the world, many near the poles and the +-180 line.
_WORLD = "(SELECT {key} AS {name}, (({key} * 6007) % 3600) / 10e0 - 180e0 AS x, greatest(least((({key} * 3571) % 200) - 100e0, 89.95e0), -89.95e0) AS y FROM {table})"
_ARC = "(12742017.6e0 * asin(sqrt(least(1e0, pow(sin(radians({b}.y - {a}.y) / 2), 2) + cos(radians({a}.y)) * cos(radians({b}.y)) * pow(sin(radians({b}.x - {a}.x) / 2), 2)))))"


def _world(spark, sf, name, key):
    x, y = F.expr(f"(({key} * 6007) % 3600) / 10e0 - 180e0"), F.expr(f"greatest(least((({key} * 3571) % 200) - 100e0, 89.95e0), -89.95e0)")
    return table(spark, sf, name).select(F.col(key), point(x, y).alias("geom"))


@register("j08_dwithin_metres", f"""
SELECT c, count(*) AS n, sum(CASE WHEN abs(a.x - b.x) > 300 THEN 1 ELSE 0 END) AS across, sum(CASE WHEN abs(a.x - b.x) BETWEEN 30 AND 300 THEN 1 ELSE 0 END) AS polar
FROM {_WORLD.format(key='c_custkey', name='c', table='customer')} a JOIN {_WORLD.format(key='s_suppkey', name='s', table='supplier')} b
  ON {_ARC.format(a='a', b='b')} <= 150000.5e0 GROUP BY c""")
def j08_dwithin_metres(spark, sf):
    """Pairs at most 150 km apart, among them pairs across +-180 degrees and across a pole."""
    a = _world(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "c")
    b = _world(spark, sf, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("s"), F.col("geom").alias("geom_r"))
    j = J.metres_join(a, b, 150_000.5, left_key="c", right_key="s")
    gap = F.abs(F.col("geom")["minx"] - F.col("geom_r")["minx"])
    return j.groupBy("c").agg(F.count("*").alias("n"), F.sum((gap > 300).cast("int")).alias("across"), F.sum(gap.between(30, 300).cast("int")).alias("polar"))


_VEC = "cos(radians({y})) * cos(radians({x})) AS {p}x, cos(radians({y})) * sin(radians({x})) AS {p}y, sin(radians({y})) AS {p}z"


@register("f24_geodetic_roads", V.with_(V.ROAD) + f""",
v AS (SELECT fid, {_VEC.format(x='116.4e0', y='39.9e0', p='p')}, {_VEC.format(x='x1', y='y1', p='a')}, {_VEC.format(x='x2', y='y2', p='q')} FROM road),
w AS (SELECT *, ay * qz - az * qy AS nx, az * qx - ax * qz AS ny, ax * qy - ay * qx AS nz FROM v),
d AS (SELECT fid, CASE WHEN (ny * az - nz * ay) * px + (nz * ax - nx * az) * py + (nx * ay - ny * ax) * pz >= 0
      AND (ny * qz - nz * qy) * px + (nz * qx - nx * qz) * py + (nx * qy - ny * qx) * pz <= 0
    THEN abs(asin((px * nx + py * ny + pz * nz) / sqrt(nx * nx + ny * ny + nz * nz)))
    ELSE least(2 * asin(sqrt(pow(px - ax, 2) + pow(py - ay, 2) + pow(pz - az, 2)) / 2), 2 * asin(sqrt(pow(px - qx, 2) + pow(py - qy, 2) + pow(pz - qz, 2)) / 2)) END * 6371008.8e0 AS m FROM w)
SELECT fid, m <= 20000.5e0 AS near, m > 35000.5e0 AS beyond FROM d""")
def f24_geodetic_roads(spark, sf):
    """Roads at most 20 km, and farther than 35 km, from a place on the sphere."""
    at = Geom.point(116.4, 39.9)
    return road(spark, sf).select("fid", P.dwithin("geom", at, 20_000.5, unit="m", geodetic=True).alias("near"),
                                  P.beyond("geom", at, 35_000.5, unit="m", geodetic=True).alias("beyond"))


# ---------------------------------------------------------------- nearest
@register("w05_knn_join_dense", """
WITH c AS (SELECT o_orderkey AS id, 116e0 + ((o_orderkey * 6007) % 9973) / 1e9 AS x, 39e0 + ((o_orderkey * 3571) % 9967) / 1e9 AS y FROM orders
  UNION ALL SELECT -1 - n_nationkey, n_nationkey * 2e0, n_nationkey * 1e0 FROM nation),
d AS (SELECT a.c_custkey AS fid, c.id AS fid_r, sqrt(pow(a.x - c.x, 2) + pow(a.y - c.y, 2)) AS dist
  FROM (SELECT c_custkey, 116e0 + ((c_custkey * 7919) % 9949) / 1e9 AS x, 39e0 + ((c_custkey * 104729) % 9941) / 1e9 AS y FROM customer WHERE c_custkey % 10 = 1) a JOIN c ON true)
SELECT fid, fid_r, dist, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY dist, fid_r) AS rank FROM d) t WHERE rank <= 3""")
def w05_knn_join_dense(spark, sf):
    """All orders within 1e-5 degrees of each other, and a few places far away."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("fid_r"), point(F.expr("116e0 + ((o_orderkey * 6007) % 9973) / 1e9"), F.expr("39e0 + ((o_orderkey * 3571) % 9967) / 1e9")).alias("geom_r"))
    far = table(spark, sf, "nation").select((-1 - F.col("n_nationkey")).cast("long").alias("fid_r"), point(F.col("n_nationkey") * F.lit(2.0), F.col("n_nationkey") * F.lit(1.0)).alias("geom_r"))
    c = table(spark, sf, "customer").where(F.col("c_custkey") % 10 == 1).select(
        F.col("c_custkey").alias("fid"), point(F.expr("116e0 + ((c_custkey * 7919) % 9949) / 1e9"), F.expr("39e0 + ((c_custkey * 104729) % 9941) / 1e9")).alias("geom"))
    return W.knn_join(c, o.unionByName(far), 3)


@register("w05_knn_roads", V.with_(V.POI, V.ROAD) + """,
t AS (SELECT p.fid, r.fid AS road, p.lon AS x, p.lat AS y, x1, y1, x2, y2, least(greatest(((p.lon - x1) * (x2 - x1) + (p.lat - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0e0), 1e0) AS t
  FROM poi p JOIN road r ON p.fid % 5 = 0),
d AS (SELECT fid, road, round(sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2)), 7) AS dist FROM t),
k AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY dist, road) AS rank FROM d)
SELECT fid, CAST(rank AS INTEGER) AS rank, dist FROM k WHERE rank <= 3""")
def w05_knn_roads(spark, sf):
    """The distances of the three nearest roads (lines) of every fifth point; equal roads make the ids ambiguous."""
    p = poi(spark, sf).where(F.col("fid") % 5 == 0).select("fid", "geom")
    r = road(spark, sf).select(F.col("fid").alias("road"), F.col("geom").alias("geom_r"))
    return W.knn_join(p, r, 3, right_id="road").select("fid", "rank", F.round("dist", 7).alias("dist"))


# ---------------------------------------------------------------- regions beyond the world
#: A concave region beyond the world on three sides and over 180 degrees wide.
_BEYOND = Geom.polygon([(-250.0, -60.0), (-40.0, -120.0), (10.0, -20.5), (60.0, -120.0), (250.0, -60.0), (190.0, 10.5), (250.0, 60.0), (0.5, 80.0), (-250.0, 60.0)],
                       [(-30.5, 20.5), (30.5, 20.5), (30.5, 50.5), (-30.5, 50.5)])
_BEYOND_EDGES = "far(ax, ay, zx, zy) AS (VALUES " + ", ".join(f"({a!r}e0, {b!r}e0, {c!r}e0, {d!r}e0)" for a, b, c, d in _BEYOND.edges()) + ")"


@register("f27_world_clip", f"""
WITH {_BEYOND_EDGES}, p AS (SELECT o_orderkey, ((o_orderkey * 6007) % 4400) / 10e0 - 220e0 AS x, ((o_orderkey * 3571) % 2200) / 10e0 - 110e0 AS y FROM orders),
q AS (SELECT *, x BETWEEN -180 AND 180 AND y BETWEEN -90 AND 90 AS world,
  (SELECT count(*) % 2 = 1 FROM far h WHERE (h.ay > y) <> (h.zy > y) AND x < h.ax + (y - h.ay) * (h.zx - h.ax) / (h.zy - h.ay)) AS inside FROM p)
SELECT o_orderkey, world AND inside AS meets, NOT (world AND inside) AS apart FROM q""")
def f27_world_clip(spark, sf):
    """Points up to 40 degrees outside the world against the region; no point lies on its edges."""
    x, y = F.expr("((o_orderkey * 6007) % 4400) / 10e0 - 220e0"), F.expr("((o_orderkey * 3571) % 2200) / 10e0 - 110e0")
    p = table(spark, sf, "orders").select("o_orderkey", point(x, y).alias("geom"))
    return p.select("o_orderkey", P.geodetic_filter("intersects", "geom", _BEYOND, point_layer=True).alias("meets"),
                    P.geodetic_filter("disjoint", "geom", _BEYOND, point_layer=True).alias("apart"))
