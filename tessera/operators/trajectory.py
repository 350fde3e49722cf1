"""Trajectory queries (T01-T06) over a point track layer.

A track layer has columns ``id`` (vehicle / trip), ``ts``, ``lon``, ``lat``
and, when it comes from the cell store, ``epoch`` (hour partition) and
``cell`` (leaf id, files sorted by it).  Region + time queries add, on top of
the exact filter, the pruning filters the layout allows:

* ``day`` and ``epoch BETWEEN hour(t1) AND hour(t2)`` -> partition and row-group pruning;
* ``cell BETWEEN lo AND hi`` for the region's covering -> row-group pruning;
* ``ts BETWEEN t1 AND t2`` and the lon/lat box -> pushed Parquet filters.

Aggregates are partial + final hash aggregates (map-side combine), so a
vehicle holding a third of all points is pre-aggregated before the shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells as C
from ..functions.filters import _v
from ..functions.geometry import Geom
from ..functions.predicates import point_in_literal_polygon, point_literal_distance
from ..session import stored

TRACK_LEVEL = 12  # block level of the trajectory store (as in the reference)


def _ts(t) -> Column:
    if isinstance(t, str):
        t = _dt.datetime.fromisoformat(t)
    return _v(t)


def hour_of(t: str | _dt.datetime) -> str:
    """The hour bucket of an instant; buckets sort as text."""
    return (_dt.datetime.fromisoformat(t) if isinstance(t, str) else t).strftime("%Y%m%d%H")


def hours(t1: str | _dt.datetime, t2: str | _dt.datetime) -> list[str]:
    """Hour buckets of [t1, t2], both end hours included (X17; driver side,
    the two instants are literals)."""
    a = _dt.datetime.fromisoformat(t1) if isinstance(t1, str) else t1
    b = _dt.datetime.fromisoformat(t2) if isinstance(t2, str) else t2
    cur = a.replace(minute=0, second=0, microsecond=0)
    out = []
    while cur <= b:
        out.append(cur.strftime("%Y%m%d%H"))
        cur += _dt.timedelta(hours=1)
    return out


def _in_box(region: Geom, lon: str = "lon", lat: str = "lat") -> Column:
    """Closed box test on the stored columns: pushed to the scan as it stands."""
    x1, y1, x2, y2 = region.envelope()
    x, y = F.col(lon), F.col(lat)
    return (x >= x1) & (x <= x2) & (y >= y1) & (y <= y2) & x.isNotNull() & y.isNotNull()


def in_region(region: Geom, lon: str = "lon", lat: str = "lat") -> Column:
    """Exact closed point-in-region test: envelope, then ray casting for
    non-rectangular regions (native columns)."""
    env = _in_box(region, lon, lat)
    if region.is_rectangle():
        return env
    return env & point_in_literal_polygon(F.col(lon), F.col(lat), region, boundary=True)


def prune(df: DataFrame, region: Geom | None = None, t1=None, t2=None, level: int = TRACK_LEVEL,
          max_cells: int = 512, grow: float = 0.0) -> DataFrame:
    """Layout-aware pruning filters (no effect on the result, only on I/O)."""
    cols = set(df.columns)
    if t1 is not None and t2 is not None and "epoch" in cols:
        first, last = hour_of(t1), hour_of(t2)
        if "day" in cols:
            df = df.where(F.col("day").between(first[:8], last[:8]))
        df = df.where(F.col("epoch").between(first, last))
    if region is not None and "cell" in cols:
        cov = C.covering(region, level, min_level=max(0, level - 4), max_cells=max_cells, grow=grow)
        df = df.where(C.in_ranges("cell", C.cell_ranges(cov)))
    return df


def region_time_points(df: DataFrame, region: Geom, t1, t2, exact: bool = True,
                       half_open: bool = False) -> DataFrame:
    """Points in region during [t1, t2] (``half_open``: [t1, t2)).
    ``exact=False``: every point of the region's covering cells at TRACK_LEVEL, whether the
    cell is stored or computed here."""
    df = prune(df, region if exact else None, t1, t2)
    if not exact:
        ranges = C.cell_ranges(C.covering(region, TRACK_LEVEL, min_level=TRACK_LEVEL - 4))
        stored = "cell" in df.columns
        df = df.where(C.in_ranges(F.col("cell") if stored else C.leaf_cell("lat", "lon"), ranges, computed=not stored))
    tcond = (F.col("ts") >= _ts(t1)) & ((F.col("ts") < _ts(t2)) if half_open else (F.col("ts") <= _ts(t2)))
    df = df.where(tcond)
    if exact:
        df = df.where(in_region(region))
    return df


def trips_in_region(df: DataFrame, region: Geom, t1, t2, exact: bool = True, half_open: bool = False) -> DataFrame:
    """T02 (+A17): distinct trips and point count in region during [t1, t2]."""
    pts = region_time_points(df, region, t1, t2, exact, half_open)
    return pts.agg(F.count_distinct("id").alias("trips"), F.count(F.lit(1)).alias("points"))


def vehicles_at(df: DataFrame, region: Geom, t, window_seconds: float = 0.0) -> DataFrame:
    """Vehicles in region at instant ``t`` -> last position per vehicle.

    ``window_seconds=0`` is the reference's equality on the instant; a positive
    window takes the last position in [t - window, t]."""
    if window_seconds:
        t_end = _dt.datetime.fromisoformat(t) if isinstance(t, str) else t
        t_start = t_end - _dt.timedelta(seconds=window_seconds)
        pts = region_time_points(df, region, t_start, t_end)
    else:
        pts = region_time_points(df, region, t, t)
    # ties on ts: the largest (lon, lat)
    last = F.max(F.struct("ts", "lon", "lat"))
    return pts.groupBy("id").agg(last.alias("p")).select("id", F.col("p.ts").alias("ts"), F.col("p.lon").alias("lon"),
                                                         F.col("p.lat").alias("lat"))


def points_along_line(df: DataFrame, line: Geom, t1, t2, tolerance: float, exact: bool = True) -> DataFrame:
    """Points within ``tolerance`` (degrees) of a polyline during [t1, t2]."""
    x1, y1, x2, y2 = line.envelope()
    pad = Geom.box(x1 - tolerance, y1 - tolerance, x2 + tolerance, y2 + tolerance)
    df = prune(df, line, t1, t2, grow=tolerance)  # the cells along the line, not those of its box
    df = df.where((F.col("ts") >= _ts(t1)) & (F.col("ts") <= _ts(t2)))
    df = df.where(_in_box(pad))
    if exact:
        df = df.where(point_literal_distance(F.col("lon"), F.col("lat"), line) <= F.lit(float(tolerance)))
    return df


def trips_along_road(df: DataFrame, line: Geom, t1, t2, tolerance: float, exact: bool = True) -> DataFrame:
    """Trips and points along a road during [t1, t2]."""
    pts = points_along_line(df, line, t1, t2, tolerance, exact)
    return pts.agg(F.count_distinct("id").alias("trips"), F.count(F.lit(1)).alias("points"))


def trajectory(df: DataFrame, t1, t2, ids: list | None = None) -> DataFrame:
    """Ordered (id, ts, lon, lat) of the vehicles in [t1, t2].

    The order is a global sort on (id, ts): Spark range-partitions on both
    keys, so one vehicle with a huge track is split over many tasks."""
    df = prune(df, None, t1, t2).where((F.col("ts") >= _ts(t1)) & (F.col("ts") <= _ts(t2)))
    if ids is not None:
        df = df.where(F.col("id").isin(list(ids)))
    return df.select("id", "ts", "lon", "lat").orderBy("id", "ts")


def trajectory_in_region(df: DataFrame, region: Geom, ids: list | None = None) -> DataFrame:
    """Trajectory points inside a region, ordered by (id, ts)."""
    df = prune(df, region)
    if ids is not None:
        df = df.where(F.col("id").isin(list(ids)))
    return df.where(in_region(region)).select("id", "ts", "lon", "lat").orderBy("id", "ts")


#: State of a trip copy: rows and a checksum of every source day when it was last copied.
_STATE = "version long, day string, n long, sum decimal(38,0)"


def _days(df: DataFrame) -> DataFrame:
    row = F.xxhash64("id", "ts", "lon", "lat").cast("decimal(38,0)")
    return df.groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.count("*").alias("n"), F.sum(row).alias("sum"))


def _state(spark, path: str) -> DataFrame:
    """The newest state; empty for a new copy."""
    from ..operators.snapshots import Folder

    if not Folder(spark, f"{path}/_state").names():
        return spark.createDataFrame([], _STATE)
    log = spark.read.schema(_STATE).parquet(f"{path}/_state")
    return log.join(log.agg(F.max("version").alias("version")), "version", "left_semi")


def refresh_trip_copy(df: DataFrame, path: str, buckets: int = 64) -> list[str]:
    """Second copy of the track keyed by trip, brought up to date with ``df`` (id, ts, lon, lat): days whose rows
    changed since the last refresh (late, altered or removed ones) are copied again, the others stay.  Returns these days.

    The copy lies by day and by a hash of ``id``, files sorted by (id, ts).  Range partitioning spreads one
    huge trip over many writer tasks.  A refresh that failed is repeated: days are replaced whole, and the
    state follows the data."""
    spark = df.sparkSession
    before = _state(spark, path)
    version = (before.agg(F.max("version")).first()[0] or 0) + 1
    now = stored(_days(df), "trip-days")
    old = before.select("day", F.col("n").alias("n0"), F.col("sum").alias("sum0"))
    changed = sorted(r["day"] for r in now.join(old, "day", "left").where(~(F.col("n").eqNullSafe(F.col("n0")) & F.col("sum").eqNullSafe(F.col("sum0")))).select("day").collect())  # a row a day
    if changed:
        rows = df.withColumn("day", F.date_format("ts", "yyyyMMdd")).where(F.col("day").isin(changed))
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
        (rows.repartitionByRange("day", "bucket", "id", "ts").sortWithinPartitions("day", "bucket", "id", "ts").write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "bucket").parquet(f"{path}/trips"))
    if changed or now.count() != old.count():
        now.select(F.lit(version).cast("long").alias("version"), "day", "n", "sum").write.mode("append").parquet(f"{path}/_state")
    return changed


def read_trip_copy(spark, path: str, ids: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """Rows of the copy (of the days that the source has); with ``ids`` (a column ``id``, any number of rows) those of
    these trips: a left-semi join on bucket and id."""
    df = spark.read.parquet(f"{path}/trips").withColumn("day", F.col("day").cast("string"))
    df = df.join(_state(spark, path).select("day"), "day", "left_semi")
    if ids is not None:
        keys = ids.select(F.col("id").cast(df.schema["id"].dataType).alias("id")).distinct()  # a hash depends on the type
        df = df.join(keys.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")), ["bucket", "id"], "left_semi")
    return df
