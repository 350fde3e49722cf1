"""Trajectory queries (T01-T05, X16, X17, A17) on the ``track`` layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import Geom
from ..operators import trajectory as TR
from . import sqlgen as G
from .layers import HEXAGON, QUERY_BOX, QUERY_T1, QUERY_T2, track
from .registry import register
from .sqlviews import TRACK, dbl, ts, with_

BOX = Geom.box(*QUERY_BOX)
X1, Y1, X2, Y2 = QUERY_BOX
TIME = f"ts BETWEEN {ts(QUERY_T1)} AND {ts(QUERY_T2)}"
IN_BOX = G.box("lon", "lat", X1, Y1, X2, Y2)

# A polyline road for T03 and its tolerance (degrees).
ROAD_LINE = Geom.line([(116.10, 39.20), (116.45, 39.55), (116.80, 39.60)])
ROAD_TOL = 0.01


@register("t02_trips_in_box", with_(TRACK) + f"""
SELECT count(DISTINCT id) AS trips, count(*) AS points FROM track WHERE {TIME} AND {IN_BOX}""")
def t02_trips_in_box(spark, sf):
    return TR.trips_in_region(track(spark, sf), BOX, QUERY_T1, QUERY_T2)


@register("t02_trips_in_box_half_open", with_(TRACK) + f"""
SELECT count(DISTINCT id) AS trips, count(*) AS points FROM track
WHERE ts >= {ts(QUERY_T1)} AND ts < {ts(QUERY_T2)} AND {IN_BOX}""")
def t02_trips_in_box_half_open(spark, sf):
    return TR.trips_in_region(track(spark, sf), BOX, QUERY_T1, QUERY_T2, half_open=True)


_HEX_ENV = G.box("lon", "lat", *HEXAGON.envelope())


@register("t02_trips_in_hexagon", with_(TRACK) + f"""
SELECT count(DISTINCT id) AS trips, count(*) AS points FROM track
WHERE {TIME} AND {_HEX_ENV} AND {G.point_in_polygon('lon', 'lat', HEXAGON)}""")
def t02_trips_in_hexagon(spark, sf):
    return TR.trips_in_region(track(spark, sf), HEXAGON, QUERY_T1, QUERY_T2)


@register("t01_last_position_in_box", with_(TRACK) + f"""
SELECT id, max(ts) AS ts, arg_max(lon, ts) AS lon, arg_max(lat, ts) AS lat FROM track
WHERE ts BETWEEN TIMESTAMP '2024-01-12 17:30:00' AND {ts(QUERY_T2)} AND {IN_BOX}
GROUP BY id""")
def t01_last_position_in_box(spark, sf):
    return TR.vehicles_at(track(spark, sf), BOX, QUERY_T2, window_seconds=3600)


@register("t03_trips_along_road", with_(TRACK) + f"""
SELECT count(DISTINCT id) AS trips, count(*) AS points FROM track
WHERE {TIME}
  AND {G.box('lon', 'lat', ROAD_LINE.envelope()[0] - ROAD_TOL, ROAD_LINE.envelope()[1] - ROAD_TOL,
             ROAD_LINE.envelope()[2] + ROAD_TOL, ROAD_LINE.envelope()[3] + ROAD_TOL)}
  AND {G.point_geom_distance('lon', 'lat', ROAD_LINE)} <= {dbl(ROAD_TOL)}""")
def t03_trips_along_road(spark, sf):
    return TR.trips_along_road(track(spark, sf), ROAD_LINE, QUERY_T1, QUERY_T2, ROAD_TOL)


@register("t04_trajectories", with_(TRACK) + f"""
SELECT id, ts, lon, lat FROM track WHERE {TIME} ORDER BY id, ts""")
def t04_trajectories(spark, sf):
    return TR.trajectory(track(spark, sf), QUERY_T1, QUERY_T2)


@register("t05_trajectory_in_hexagon", with_(TRACK) + f"""
SELECT id, ts, lon, lat FROM track
WHERE {_HEX_ENV} AND {G.point_in_polygon('lon', 'lat', HEXAGON)} ORDER BY id, ts""")
def t05_trajectory_in_hexagon(spark, sf):
    return TR.trajectory_in_region(track(spark, sf), HEXAGON)


@register("x16_points_per_hour_in_box", with_(TRACK) + f"""
SELECT epoch, count(*) AS points, count(DISTINCT id) AS trips FROM track
WHERE {TIME} AND {IN_BOX} GROUP BY epoch""")
def x16_points_per_hour_in_box(spark, sf):
    pts = TR.region_time_points(track(spark, sf), BOX, QUERY_T1, QUERY_T2)
    return pts.groupBy("epoch").agg(F.count(F.lit(1)).alias("points"), F.count_distinct("id").alias("trips"))


@register("x17_hours_touched_per_trip", with_(TRACK) + f"""
SELECT id, min(ts) AS first_ts, max(ts) AS last_ts,
       CAST(date_diff('hour', date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) + 1 AS INTEGER) AS hours
FROM track GROUP BY id""")
def x17_hours_touched_per_trip(spark, sf):
    from ..functions.scalar import hours_between

    per = track(spark, sf).groupBy("id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return per.withColumn("hours", F.size(hours_between("first_ts", "last_ts")))
