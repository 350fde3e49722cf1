"""Feature layers derived from the driver's tables.

The driver's tables hold no coordinates, so the spatial layers are derived by
fixed formulas (the same ones the DuckDB oracles use, see FIXTURES.md).  Every
layer is a lazy DataFrame over the Parquet scan, so filters on the source
columns (``ts``, keys) still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Geom, box, from_parts, line2, point
from ..functions.scalar import hour_bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def track(spark: SparkSession, sf_dir: str, with_geom: bool = False) -> DataFrame:
    """Trajectory points: one row per event (id = vehicle, fid = event id)."""
    ev = table(spark, sf_dir, "events")
    df = ev.select(
        F.col("event_id").alias("fid"),
        F.col("user_id").alias("id"),
        F.col("ts"),
        F.expr("116e0 + ((event_id * 7919) % 10000) / 1e4").alias("lon"),
        F.expr("39e0 + ((event_id * 104729) % 10000) / 1e4").alias("lat"),
        hour_bucket("ts").alias("epoch"),
    )
    if with_geom:
        df = df.withColumn("geom", point("lon", "lat"))
    return df


def poi(spark: SparkSession, sf_dir: str, with_geom: bool = True) -> DataFrame:
    """Point layer from customer."""
    c = table(spark, sf_dir, "customer")
    df = c.select(
        F.col("c_custkey").alias("fid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nationkey"),
        F.expr("116e0 + ((c_custkey * 6007) % 10000) / 1e4").alias("lon"),
        F.expr("39e0 + ((c_custkey * 3571) % 10000) / 1e4").alias("lat"),
    )
    if with_geom:
        df = df.withColumn("geom", point("lon", "lat"))
    return df


def zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 boxes on a 5x5 grid (0.2 degree), one per nation."""
    n = table(spark, sf_dir, "nation")
    df = n.select(
        F.col("n_nationkey").alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        F.col("n_regionkey").alias("regionkey"),
        F.expr("116e0 + (n_nationkey % 5) * 0.2e0").alias("minx"),
        F.expr("39e0 + (n_nationkey div 5) * 0.2e0").alias("miny"),
    ).withColumn("maxx", F.col("minx") + F.lit(0.2)).withColumn("maxy", F.col("miny") + F.lit(0.2))
    return df.withColumn("geom", box("minx", "miny", "maxx", "maxy"))


def road(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-point lines from supplier."""
    s = table(spark, sf_dir, "supplier")
    df = s.select(
        F.col("s_suppkey").alias("fid"),
        F.col("s_name").alias("name"),
        F.expr("116e0 + (s_suppkey % 97) / 1e2").alias("x1"),
        F.lit(39.0).alias("y1"),
        F.expr("116e0 + (s_suppkey % 89) / 1e2").alias("x2"),
        F.lit(40.0).alias("y2"),
    )
    return df.withColumn("geom", line2("x1", "y1", "x2", "y2"))


SHAPE_KINDS = ("Point", "LineString", "Polygon", "MultiPoint")


def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed kinds from part: kind by key % 4, anchor from key * 7919, side p_size/1e3.

    Point (ax, ay); LineString (ax, ay)-(ax+s, ay+s); Polygon = triangle
    (ax, ay), (ax+s, ay), (ax, ay+s); MultiPoint (ax, ay), (ax+s, ay+s).
    """
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.col("p_partkey").alias("fid"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("size"),
        (F.col("p_partkey") % 4).alias("k"),
        F.expr("116e0 + ((p_partkey * 7919) % 10000) / 1e4").alias("ax"),
        F.expr("39e0 + ((p_partkey * 7919) % 9973) / 1e4").alias("ay"),
        F.expr("p_size / 1e3").alias("s"),
    )

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ax, ay, s = F.col("ax"), F.col("ay"), F.col("s")
    kind = F.element_at(F.array(*[F.lit(k) for k in SHAPE_KINDS]), (F.col("k") + 1).cast("int"))
    parts = (F.when(F.col("k") == 0, F.array(F.array(F.array(pt(ax, ay)))))
             .when(F.col("k") == 1, F.array(F.array(F.array(pt(ax, ay), pt(ax + s, ay + s)))))
             .when(F.col("k") == 2, F.array(F.array(F.array(pt(ax, ay), pt(ax + s, ay), pt(ax, ay + s), pt(ax, ay)))))
             .otherwise(F.array(F.array(F.array(pt(ax, ay))), F.array(F.array(pt(ax + s, ay + s))))))
    return base.withColumn("geom", from_parts(kind, parts)).select("fid", "name", "size", "geom")


# The literal non-box query region (six vertices, lon/lat).
HEXAGON = Geom.polygon([(116.30, 39.50), (116.50, 39.35), (116.70, 39.50),
                        (116.70, 39.75), (116.50, 39.90), (116.30, 39.75)])

# The query box and time range used by the trajectory queries
# (the box is the reference's Beijing test region scaled to the derived data).
QUERY_BOX = (116.2, 39.3, 116.6, 39.7)
QUERY_T1 = "2024-01-05 06:00:00"
QUERY_T2 = "2024-01-12 18:30:00"
