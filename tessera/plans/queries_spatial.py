"""Spatial queries: predicates (F14-F28), cells (C01-C06), spatial joins
(J08), nearest (W05), bounds (A10), projection (P07, P08, P10)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import cells as C
from ..functions import predicates as P
from ..functions.geometry import Geom, box, point
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import projection as PR
from ..operators import sort as W
from . import sqlgen as G
from . import sqlviews as V
from .layers import HEXAGON, poi, road, shape, zone
from .registry import register

BOX = (116.25, 39.25, 116.65, 39.6)
BX = Geom.box(*BOX)
IN_BOX = G.box("lon", "lat", *BOX)
POI = V.with_(V.POI)
CENTER = (116.5, 39.5)


def _poi(spark, sf):
    return poi(spark, sf, with_geom=True)


# ---------------------------------------------------------------- predicates on points
@register("f14_bbox_points", POI + f"SELECT fid, name FROM poi WHERE {IN_BOX}")
def f14_bbox_points(spark, sf):
    return _poi(spark, sf).where(P.bbox("geom", *BOX, point_layer=True)).select("fid", "name")


@register("f16_intersects_hexagon", POI + f"""
SELECT fid FROM poi WHERE {G.box('lon', 'lat', *HEXAGON.envelope())} AND {G.point_in_polygon('lon', 'lat', HEXAGON)}""")
def f16_intersects_hexagon(spark, sf):
    return _poi(spark, sf).where(P.intersects("geom", HEXAGON, point_layer=True)).select("fid")


@register("f17_disjoint_hexagon", POI + f"""
SELECT fid FROM poi WHERE NOT ({G.box('lon', 'lat', *HEXAGON.envelope())} AND {G.point_in_polygon('lon', 'lat', HEXAGON)})""")
def f17_disjoint_hexagon(spark, sf):
    return _poi(spark, sf).where(P.disjoint("geom", HEXAGON, point_layer=True)).select("fid")


@register("f19_within_hexagon", POI + f"""
SELECT fid FROM poi WHERE {G.box('lon', 'lat', *HEXAGON.envelope())} AND {G.point_in_polygon('lon', 'lat', HEXAGON, boundary=False)}""")
def f19_within_hexagon(spark, sf):
    return _poi(spark, sf).where(P.within("geom", HEXAGON, point_layer=True)).select("fid")


_EQ_KEY = 42
_EQ_X = 116e0 + ((_EQ_KEY * 6007) % 10000) / 1e4
_EQ_Y = 39e0 + ((_EQ_KEY * 3571) % 10000) / 1e4


@register("f20_equals_point", POI + f"SELECT fid FROM poi WHERE lon = {V.dbl(_EQ_X)} AND lat = {V.dbl(_EQ_Y)}")
def f20_equals_point(spark, sf):
    return _poi(spark, sf).where(P.equals("geom", Geom.point(_EQ_X, _EQ_Y), point_layer=True)).select("fid")


@register("f24_dwithin_planar", POI + f"""
SELECT fid, sqrt(pow(lon - {V.dbl(CENTER[0])}, 2) + pow(lat - {V.dbl(CENTER[1])}, 2)) AS dist FROM poi
WHERE sqrt(pow(lon - {V.dbl(CENTER[0])}, 2) + pow(lat - {V.dbl(CENTER[1])}, 2)) <= 0.05e0""")
def f24_dwithin_planar(spark, sf):
    c = Geom.point(*CENTER)
    df = _poi(spark, sf).where(P.dwithin("geom", c, 0.05, point_layer=True))
    return df.select("fid", P.distance("geom", c, point_layer=True).alias("dist"))


_HAV = ("2.0e0 * 6371008.8e0 * asin(sqrt(pow(sin((lat * 0.017453292519943295 - 39.5e0 * 0.017453292519943295) / 2), 2)"
        " + cos(39.5e0 * 0.017453292519943295) * cos(lat * 0.017453292519943295)"
        " * pow(sin((lon * 0.017453292519943295 - 116.5e0 * 0.017453292519943295) / 2), 2)))")


@register("f24_f26_dwithin_geodetic_km", POI + f"SELECT fid FROM poi WHERE {_HAV} <= 5000.0e0")
def f24_f26_dwithin_geodetic_km(spark, sf):
    return _poi(spark, sf).where(P.dwithin("geom", Geom.point(*CENTER), 5, unit="km", geodetic=True,
                                           point_layer=True)).select("fid")


@register("f25_beyond_count", POI + f"SELECT count(*) AS n FROM poi WHERE NOT ({_HAV} <= 5000.0e0)")
def f25_beyond_count(spark, sf):
    df = _poi(spark, sf).where(P.beyond("geom", Geom.point(*CENTER), 5, unit="km", geodetic=True, point_layer=True))
    return df.agg(F.count(F.lit(1)).alias("n"))


_ROAD = Geom.line([(116.10, 39.20), (116.45, 39.55), (116.80, 39.60)])


@register("f24_dwithin_polyline", POI + f"""
SELECT fid FROM poi WHERE {G.box('lon', 'lat', 116.10 - 0.02, 39.20 - 0.02, 116.80 + 0.02, 39.60 + 0.02)}
AND {G.point_geom_distance('lon', 'lat', _ROAD)} <= 0.02e0""")
def f24_dwithin_polyline(spark, sf):
    return _poi(spark, sf).where(P.dwithin("geom", _ROAD, 0.02, point_layer=True)).select("fid")


# ---------------------------------------------------------------- predicates on mixed shapes
SHAPES = V.with_(V.SHAPE_ENV)
_SX1, _SY1, _SX2, _SY2 = 116.2, 39.2, 116.5, 39.45

_SHAPE_INTERSECTS_BOX = f"""
(k = 0 AND minx BETWEEN {_SX1}e0 AND {_SX2}e0 AND miny BETWEEN {_SY1}e0 AND {_SY2}e0)
OR (k = 3 AND ((minx BETWEEN {_SX1}e0 AND {_SX2}e0 AND miny BETWEEN {_SY1}e0 AND {_SY2}e0)
            OR (maxx BETWEEN {_SX1}e0 AND {_SX2}e0 AND maxy BETWEEN {_SY1}e0 AND {_SY2}e0)))
OR (k = 1 AND greatest(({_SX1}e0 - minx) / (maxx - minx), ({_SY1}e0 - miny) / (maxy - miny), 0.0e0)
           <= least(({_SX2}e0 - minx) / (maxx - minx), ({_SY2}e0 - miny) / (maxy - miny), 1.0e0))
OR (k = 2 AND minx <= {_SX2}e0 AND maxx >= {_SX1}e0 AND miny <= {_SY2}e0 AND maxy >= {_SY1}e0
           AND (greatest({_SX1}e0, minx) - minx) + (greatest({_SY1}e0, miny) - miny) <= (maxx - minx))"""


@register("f15_loose_bbox_shapes", SHAPES + f"""
SELECT fid FROM shape_env WHERE minx <= {_SX2}e0 AND maxx >= {_SX1}e0 AND miny <= {_SY2}e0 AND maxy >= {_SY1}e0""")
def f15_loose_bbox_shapes(spark, sf):
    return shape(spark, sf).where(P.bbox("geom", _SX1, _SY1, _SX2, _SY2, loose=True)).select("fid")


@register("f14_f16_exact_bbox_shapes", SHAPES + f"SELECT fid, k FROM shape_env WHERE {_SHAPE_INTERSECTS_BOX}")
def f14_f16_exact_bbox_shapes(spark, sf):
    df = shape(spark, sf).where(P.bbox("geom", _SX1, _SY1, _SX2, _SY2))
    return df.select("fid", (F.col("fid") % 4).alias("k"))


@register("f19_within_box_shapes", SHAPES + f"""
SELECT fid FROM shape_env WHERE
  (k = 0 AND minx > {_SX1}e0 AND minx < {_SX2}e0 AND miny > {_SY1}e0 AND miny < {_SY2}e0)
  OR (k IN (1, 2) AND minx >= {_SX1}e0 AND maxx <= {_SX2}e0 AND miny >= {_SY1}e0 AND maxy <= {_SY2}e0)
  OR (k = 3 AND minx >= {_SX1}e0 AND maxx <= {_SX2}e0 AND miny >= {_SY1}e0 AND maxy <= {_SY2}e0
      AND ((minx > {_SX1}e0 AND minx < {_SX2}e0 AND miny > {_SY1}e0 AND miny < {_SY2}e0)
        OR (maxx > {_SX1}e0 AND maxx < {_SX2}e0 AND maxy > {_SY1}e0 AND maxy < {_SY2}e0)))""")
def f19_within_box_shapes(spark, sf):
    return shape(spark, sf).where(P.within("geom", Geom.box(_SX1, _SY1, _SX2, _SY2))).select("fid")


@register("f18_contains_point_shapes", SHAPES + """
SELECT fid FROM shape_env WHERE k = 2
  AND 116.45e0 > minx AND 39.35e0 > miny AND (116.45e0 - minx) + (39.35e0 - miny) < (maxx - minx)""")
def f18_contains_point_shapes(spark, sf):
    df = shape(spark, sf).where(P.contains("geom", Geom.point(116.45, 39.35)))
    return df.select("fid")


# ---------------------------------------------------------------- cells
_S2_POI = POI + ",\n" + G.s2_ctes("poi", "lat", "lon", (10, 12)) + "\n"


@register("c01_c02_cell_tokens", _S2_POI + "SELECT fid, token10, token12 FROM s2")
def c01_c02_cell_tokens(spark, sf):
    df = C.with_leaf_cell(_poi(spark, sf), "lat", "lon", "leaf")
    return df.select("fid", C.token(C.parent("leaf", 10)).alias("token10"),
                     C.token(C.parent("leaf", 12)).alias("token12"))


@register("a18_features_per_block", _S2_POI + "SELECT token10 AS block, count(*) AS rows, 0 AS multi_cell_rows FROM s2 GROUP BY token10")
def a18_features_per_block(spark, sf):
    from ..sources.cellstore import layer_cells

    cells = layer_cells(_poi(spark, sf), "geom", 10, point_layer=True)
    return A.features_per_cell(cells)


@register("c06_box_query_by_cell_ranges", POI + f"SELECT fid, name FROM poi WHERE {IN_BOX}")
def c06_box_query_by_cell_ranges(spark, sf):
    df = _poi(spark, sf).withColumn("cell", C.leaf_cell("lat", "lon"))
    cov = C.covering(BX, 10, min_level=6)
    df = df.where(C.in_ranges("cell", C.cell_ranges(cov), computed=True))
    return df.where(P.bbox("geom", *BOX, point_layer=True)).select("fid", "name")  # a point has one cell


@register("c05_min_level_covering_keeps_all", V.with_(V.TRACK) + """
SELECT count(*) AS points, count(DISTINCT id) AS trips FROM track WHERE """ + G.box("lon", "lat", 116.21, 39.33, 116.58, 39.71))
def c05_min_level_covering_keeps_all(spark, sf):
    """Every point of a region smaller than the layer lies in a cell of the region's
    covering, and the covering leaves out points far from it (an error here)."""
    from .layers import track

    t = track(spark, sf).withColumn("cell", C.leaf_cell("lat", "lon"))
    b = (116.21, 39.33, 116.58, 39.71)
    cov = C.covering(Geom.box(*b), 12, min_level=8)
    kept = t.where(C.in_ranges("cell", C.cell_ranges(cov), computed=True))
    x, y = F.col("lon"), F.col("lat")
    far = (x < b[0] - 0.1) | (x > b[2] + 0.1) | (y < b[1] - 0.1) | (y > b[3] + 0.1)
    kept = kept.where(F.when(far, F.raise_error(F.lit("a cell far from the region"))).otherwise(F.lit(True)))
    kept = kept.where(x.between(b[0], b[2]) & y.between(b[1], b[3]))
    return kept.agg(F.count(F.lit(1)).alias("points"), F.count_distinct("id").alias("trips"))


# ---------------------------------------------------------------- spatial joins
_ZONE_POI = V.with_(V.POI, V.ZONE)


@register("j08_points_in_zones", _ZONE_POI + """
SELECT p.fid, z.zone_id FROM poi p JOIN zone z
  ON p.lon >= z.minx AND p.lon <= z.maxx AND p.lat >= z.miny AND p.lat <= z.maxy""")
def j08_points_in_zones(spark, sf):
    z = zone(spark, sf).select("zone_id", F.col("geom").alias("zgeom"))
    j = J.spatial_join(_poi(spark, sf).select("fid", "geom"), z, "intersects", right_geom="zgeom",
                       left_points=True, cell_size=0.1)
    return j.select("fid", "zone_id")


@register("j08_j10_count_per_zone", _ZONE_POI + """
SELECT z.zone_id, count(p.fid) AS n, round(sum(p.balance), 2) AS balance FROM poi p JOIN zone z
  ON p.lon >= z.minx AND p.lon <= z.maxx AND p.lat >= z.miny AND p.lat <= z.maxy GROUP BY z.zone_id""")
def j08_j10_count_per_zone(spark, sf):
    z = zone(spark, sf).select("zone_id", F.col("geom").alias("zgeom"))
    j = J.spatial_join(_poi(spark, sf).select("fid", "balance", "geom"), z, "intersects", right_geom="zgeom",
                       left_points=True, cell_size=0.1)
    return j.groupBy("zone_id").agg(F.count("fid").alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@register("j08_left_join_zones_in_hexagon", _ZONE_POI + """
SELECT p.fid, z.zone_id FROM poi p LEFT JOIN
  (SELECT zone_id, minx, miny, minx + 0.1e0 AS maxx, miny + 0.1e0 AS maxy FROM zone) z
  ON p.lon >= z.minx AND p.lon <= z.maxx AND p.lat >= z.miny AND p.lat <= z.maxy""")
def j08_left_join_zones_in_hexagon(spark, sf):
    """Quarter zones, so that most points stay unmatched."""
    z = zone(spark, sf).withColumns({"x2": F.col("minx") + F.lit(0.1), "y2": F.col("miny") + F.lit(0.1)})
    z = z.select("zone_id", box("minx", "miny", "x2", "y2").alias("zgeom"))
    p = _poi(spark, sf).select("fid", "geom")
    j = J.spatial_join(p, z, "intersects", right_geom="zgeom", left_points=True, how="left", left_key="fid")
    return j.select("fid", "zone_id")


_POI_ROAD = V.with_(V.POI, V.ROAD)
_SEG_T = "least(greatest(((p.lon - r.x1) * (r.x2 - r.x1) + (p.lat - r.y1) * (r.y2 - r.y1)) / " \
         "((r.x2 - r.x1) * (r.x2 - r.x1) + (r.y2 - r.y1) * (r.y2 - r.y1)), 0.0e0), 1.0e0)"
_SEG_D = f"sqrt(pow(p.lon - (r.x1 + {_SEG_T} * (r.x2 - r.x1)), 2) + pow(p.lat - (r.y1 + {_SEG_T} * (r.y2 - r.y1)), 2))"


@register("j08_dwithin_poi_roads", _POI_ROAD + f"""
SELECT r.fid AS road, count(*) AS n FROM poi p JOIN road r
  ON p.lon >= least(r.x1, r.x2) - 0.01e0 AND p.lon <= greatest(r.x1, r.x2) + 0.01e0
 AND p.lat >= r.y1 - 0.01e0 AND p.lat <= r.y2 + 0.01e0
WHERE {_SEG_D} <= 0.01e0 GROUP BY r.fid""")
def j08_dwithin_poi_roads(spark, sf):
    r = road(spark, sf).select(F.col("fid").alias("road"), F.col("geom").alias("rgeom"))
    j = J.spatial_join(_poi(spark, sf).select("fid", "geom"), r, "dwithin", right_geom="rgeom", distance=0.01,
                       left_points=True, cell_size=0.05)
    return j.groupBy("road").agg(F.count(F.lit(1)).alias("n"))


_SHAPE_ZONE = V.with_(V.SHAPE_ENV, V.ZONE)


def _shape_box_sql(x1, y1, x2, y2):
    return f"""(
 (s.k = 0 AND s.minx BETWEEN {x1} AND {x2} AND s.miny BETWEEN {y1} AND {y2})
 OR (s.k = 3 AND ((s.minx BETWEEN {x1} AND {x2} AND s.miny BETWEEN {y1} AND {y2})
               OR (s.maxx BETWEEN {x1} AND {x2} AND s.maxy BETWEEN {y1} AND {y2})))
 OR (s.k = 1 AND greatest(({x1} - s.minx) / (s.maxx - s.minx), ({y1} - s.miny) / (s.maxy - s.miny), 0.0e0)
              <= least(({x2} - s.minx) / (s.maxx - s.minx), ({y2} - s.miny) / (s.maxy - s.miny), 1.0e0))
 OR (s.k = 2 AND s.minx <= {x2} AND s.maxx >= {x1} AND s.miny <= {y2} AND s.maxy >= {y1}
              AND (greatest({x1}, s.minx) - s.minx) + (greatest({y1}, s.miny) - s.miny) <= (s.maxx - s.minx)))"""


@register("j08_shapes_intersect_zones", _SHAPE_ZONE + f"""
SELECT s.fid, z.zone_id FROM shape_env s JOIN zone z
  ON s.minx <= z.maxx AND s.maxx >= z.minx AND s.miny <= z.maxy AND s.maxy >= z.miny
WHERE {_shape_box_sql('z.minx', 'z.miny', 'z.maxx', 'z.maxy')}""")
def j08_shapes_intersect_zones(spark, sf):
    z = zone(spark, sf).select("zone_id", F.col("geom").alias("zgeom"))
    j = J.spatial_join(shape(spark, sf).select("fid", "geom"), z, "intersects", right_geom="zgeom", left_key="fid", right_key="zone_id")
    return j.select("fid", "zone_id")


# ---------------------------------------------------------------- nearest / bounds / projection
@register("w05_nearest_k", POI + f"""
SELECT fid, sqrt(pow(lon - {V.dbl(CENTER[0])}, 2) + pow(lat - {V.dbl(CENTER[1])}, 2)) AS dist FROM poi
ORDER BY dist, fid LIMIT 10""")
def w05_nearest_k(spark, sf):
    return W.nearest(_poi(spark, sf), "geom", Geom.point(*CENTER), 10, point_layer=True).select("fid", "dist")


@register("w05_nearest_k_filtered", POI + f"""
SELECT fid, sqrt(pow(lon - {V.dbl(CENTER[0])}, 2) + pow(lat - {V.dbl(CENTER[1])}, 2)) AS dist FROM poi
WHERE segment = 'MACHINERY' ORDER BY dist, fid LIMIT 5""")
def w05_nearest_k_filtered(spark, sf):
    from ..functions.filters import eq

    return W.nearest(_poi(spark, sf), "geom", Geom.point(*CENTER), 5, cond=eq("segment", "MACHINERY"),
                     point_layer=True).select("fid", "dist")


@register("a10_bounds_filtered", POI + f"""
SELECT min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM poi WHERE {IN_BOX}""")
def a10_bounds_filtered(spark, sf):
    return A.bounds(_poi(spark, sf), ["geom"], P.bbox("geom", *BOX, point_layer=True))


@register("a10_bounds_merged_columns", SHAPES + """
SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM shape_env""")
def a10_bounds_merged_columns(spark, sf):
    s = shape(spark, sf)
    s = s.withColumn("anchor", point(F.col("geom")["minx"], F.col("geom")["miny"]))
    return A.bounds(s, ["geom", "anchor"])


_TOL = 0.02


@register("p07_small_shape_reduction", SHAPES + f"""
SELECT fid,
  CASE WHEN k <> 0 AND (maxx - minx) < {_TOL}e0 AND (maxy - miny) < {_TOL}e0
       THEN (CASE WHEN (maxx - minx) = 0 AND (maxy - miny) = 0 THEN 'Point'
                  WHEN (maxx - minx) = 0 OR (maxy - miny) = 0 THEN 'LineString' ELSE 'Polygon' END)
       ELSE (CASE k WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' WHEN 2 THEN 'Polygon' ELSE 'MultiPoint' END) END AS kind,
  minx, miny, maxx, maxy FROM shape_env""")
def p07_small_shape_reduction(spark, sf):
    g = PR.reduce_small("geom", _TOL)
    df = shape(spark, sf).select("fid", g.alias("g"))
    return df.select("fid", F.col("g.kind").alias("kind"), F.col("g.minx").alias("minx"),
                     F.col("g.miny").alias("miny"), F.col("g.maxx").alias("maxx"), F.col("g.maxy").alias("maxy"))


_PX = (116.0, 39.0, 117.0, 40.0, 64, 64)
_PXW, _PXH = (_PX[2] - _PX[0]) / _PX[4], (_PX[3] - _PX[1]) / _PX[5]


@register("p08_screen_thinning", POI + f"""
SELECT min(fid) AS fid FROM poi
GROUP BY floor((lon - {V.dbl(_PX[0])}) / {V.dbl(_PXW)}), floor((lat - {V.dbl(_PX[1])}) / {V.dbl(_PXH)})""")
def p08_screen_thinning(spark, sf):
    return PR.screen_thin(_poi(spark, sf), "geom", *_PX).select("fid")


@register("p10_reproject_3857", POI + f"""
SELECT fid, round(radians(lon) * 6378137.0e0, 3) AS x,
       round(ln(tan({V.dbl(math.pi / 4)} + radians(lat) / 2)) * 6378137.0e0, 3) AS y FROM poi""")
def p10_reproject_3857(spark, sf):
    df = PR.reproject(_poi(spark, sf), "geom", 4326, 3857)
    return df.select("fid", F.round(F.col("geom")["minx"], 3).alias("x"), F.round(F.col("geom")["miny"], 3).alias("y"))



@register("w05_knn_join_road_starts", V.with_(V.POI, V.ROAD) + """
SELECT road, fid_r, dist, CAST(rank AS INTEGER) AS rank FROM (
  SELECT r.fid AS road, p.fid AS fid_r, sqrt(pow(r.x1 - p.lon, 2) + pow(r.y1 - p.lat, 2)) AS dist,
         row_number() OVER (PARTITION BY r.fid ORDER BY sqrt(pow(r.x1 - p.lon, 2) + pow(r.y1 - p.lat, 2)), p.fid) AS rank
  FROM road r JOIN poi p ON true) t WHERE rank <= 3""")
def w05_knn_join_road_starts(spark, sf):
    starts = road(spark, sf).select(F.col("fid").alias("road"), point("x1", "y1").alias("geom"))
    pts = _poi(spark, sf).select(F.col("fid").alias("fid_r"), F.col("geom").alias("geom_r"))
    return W.knn_join(starts, pts, 3, left_id="road", right_id="fid_r")


@register("f28_point_within_own_zone", _ZONE_POI + """
SELECT p.fid, z.zone_id FROM poi p JOIN zone z ON p.nationkey = z.zone_id
WHERE p.lon > z.minx AND p.lon < z.maxx AND p.lat > z.miny AND p.lat < z.maxy""")
def f28_point_within_own_zone(spark, sf):
    z = zone(spark, sf).select("zone_id", F.col("geom").alias("zgeom"))
    p = _poi(spark, sf).select("fid", "nationkey", "geom")
    j = p.join(z, p["nationkey"] == z["zone_id"])
    return j.where(P.relate_columns("within", "geom", "zgeom", a_points=True)).select("fid", "zone_id")
