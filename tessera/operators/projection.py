"""Projection operators (P01-P11): feature ids, geometry output, CRS,
simplification and small-shape thinning."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import _c, box, from_parts, geom_to_wkb, point
from ..session import stored

# Spherical Mercator (EPSG:3857) radius and latitude limit.
MERCATOR_R = 6378137.0
MERCATOR_MAX_LAT = 85.0511287798066


# P01 / P03 -------------------------------------------------------------------
def select_properties(df: DataFrame, properties: Sequence[str], pk: Sequence[str] = (),
                      expose_pk: bool = True) -> DataFrame:
    cols = [k for k in pk if k not in properties] + list(properties) if expose_pk else list(properties)
    return df.select(*cols)


# P04 -------------------------------------------------------------------------
def encode_fid(type_name: str, pk: Sequence[str]) -> Column:
    """``<type>.<pk1>.<pk2>``; null if a key part is null.  In a key of several parts, dots and percent signs of a part
    are written as %2E and %25, so different keys never give one id."""
    parts = [F.col(k).cast("string") for k in pk]
    if len(parts) > 1:
        parts = [F.replace(F.replace(p, F.lit("%"), F.lit("%25")), F.lit("."), F.lit("%2E")) for p in parts]
    return F.concat(F.lit(type_name), *[x for p in parts for x in (F.lit("."), p)])


def decode_fid(fid, type_name: str, pk_types: Sequence[str], strict: bool = True) -> Column:
    """fid -> struct of typed pk values (pk0, pk1, ...); the type name in front may be missing.  The key of one part is
    all that follows, dots included.  A wrong number of parts or a part of another type is an error (``strict``) or null."""
    c = _c(fid)
    body = F.when(c.startswith(type_name + "."), F.substring(c, len(type_name) + 2, 1 << 30)).otherwise(c)
    if len(pk_types) == 1:
        parts = F.array(body)
    else:
        parts = F.transform(F.split(body, r"\."), lambda p: F.replace(F.replace(p, F.lit("%2E"), F.lit(".")), F.lit("%25"), F.lit("%")))
    values = [F.get(parts, F.lit(i)).try_cast(t) for i, t in enumerate(pk_types)]
    ok = F.size(parts) == len(pk_types)
    for v in values:
        ok = ok & v.isNotNull()
    typed = F.struct(*[v.alias(f"pk{i}") for i, v in enumerate(values)])
    if strict:
        return F.when(c.isNull(), F.lit(None)).when(ok, typed).otherwise(F.raise_error(F.concat(F.lit("fid does not decode: "), c)))
    return F.when(ok, typed)


# P05 -------------------------------------------------------------------------
def to_wkb(df: DataFrame, geom: str = "geom", out: str = "the_geom") -> DataFrame:
    return df.withColumn(out, geom_to_wkb(F.col(geom)))


# P07 -------------------------------------------------------------------------
def reduce_small(geom, tolerance: float) -> Column:
    """A shape narrower than ``tolerance`` both ways becomes its envelope's
    point (both sides zero), diagonal line (one side zero) or box."""
    g = _c(geom)
    w, h = g["maxx"] - g["minx"], g["maxy"] - g["miny"]
    small = (w < tolerance) & (h < tolerance) & (g["kind"] != "Point")
    pt = point(g["minx"], g["miny"])
    diag = from_parts(F.lit("LineString"), F.array(F.array(F.array(
        F.struct(g["minx"].alias("x"), g["miny"].alias("y")), F.struct(g["maxx"].alias("x"), g["maxy"].alias("y"))))))
    bx = box(g["minx"], g["miny"], g["maxx"], g["maxy"])
    reduced = F.when((w == 0) & (h == 0), pt).when((w == 0) | (h == 0), diag).otherwise(bx)
    return F.when(small, reduced).otherwise(g)


# P08 -------------------------------------------------------------------------
def screen_thin(df: DataFrame, geom: str, x1: float, y1: float, x2: float, y2: float, width: int, height: int,
                fid: str = "fid") -> DataFrame:
    """Keep one feature per screen pixel among features smaller than a pixel
    (large features always kept).  Pixel = (floor((x-x1)/px), floor((y-y1)/py)).
    The first feature per pixel (by fid) is a min-aggregate, so a crowded
    pixel is pre-aggregated map-side."""
    g = F.col(geom)
    pxw, pxh = (x2 - x1) / width, (y2 - y1) / height
    small = ((g["maxx"] - g["minx"]) < pxw) & ((g["maxy"] - g["miny"]) < pxh)
    pix = df.withColumn("__px", F.floor((g["minx"] - F.lit(x1)) / F.lit(pxw))) \
            .withColumn("__py", F.floor((g["miny"] - F.lit(y1)) / F.lit(pxh))) \
            .withColumn("__small", small)
    firsts = pix.where("__small").groupBy("__px", "__py").agg(F.min(fid).alias("__keep"))
    kept = pix.join(firsts, (pix["__px"] == firsts["__px"]) & (pix["__py"] == firsts["__py"])
                    & (pix[fid] == firsts["__keep"]), "left_semi")
    return pix.where(~F.col("__small")).unionByName(kept).drop("__px", "__py", "__small")


# P09 -------------------------------------------------------------------------
def set_srid(df: DataFrame, srid: int, col: str = "srid") -> DataFrame:
    """Declare a CRS without changing coordinates."""
    return df.withColumn(col, F.lit(int(srid)))


# P10 / P11 ------------------------------------------------------------------
def _merc_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(MERCATOR_R)


def _merc_y(lat: Column) -> Column:
    lat = F.least(F.greatest(lat, F.lit(-MERCATOR_MAX_LAT)), F.lit(MERCATOR_MAX_LAT))
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(MERCATOR_R)


def _inv_x(x: Column) -> Column:
    return F.degrees(x / F.lit(MERCATOR_R))


def _inv_y(y: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(MERCATOR_R))) - F.lit(math.pi / 2))


def transform_xy(x: Column, y: Column, src: int, dst: int) -> tuple[Column, Column]:
    if src == dst:
        return x, y
    if (src, dst) == (4326, 3857):
        return _merc_x(x), _merc_y(y)
    if (src, dst) == (3857, 4326):
        return _inv_x(x), _inv_y(y)
    raise ValueError(f"reprojection {src} -> {dst} is not supported (only 4326 <-> 3857)")


def reproject_geom(geom, src: int, dst: int) -> Column:
    g = _c(geom)
    if src == dst:
        return g
    parts = F.transform(g["parts"], lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda p: F.struct(transform_xy(p["x"], p["y"], src, dst)[0].alias("x"),
                                 transform_xy(p["x"], p["y"], src, dst)[1].alias("y")))))
    return F.when(g.isNotNull(), from_parts(g["kind"], parts))


def reproject(df: DataFrame, geom: str, src: int, dst: int) -> DataFrame:
    return df.withColumn(geom, reproject_geom(geom, src, dst))


def reproject_bounds(minx: float, miny: float, maxx: float, maxy: float, src: int, dst: int):
    """Reprojected envelope of a box (corners, then min / max)."""
    def one(x, y):
        if (src, dst) == (4326, 3857):
            yy = max(-MERCATOR_MAX_LAT, min(MERCATOR_MAX_LAT, y))
            return math.radians(x) * MERCATOR_R, math.log(math.tan(math.pi / 4 + math.radians(yy) / 2)) * MERCATOR_R
        if (src, dst) == (3857, 4326):
            return math.degrees(x / MERCATOR_R), math.degrees(2 * math.atan(math.exp(y / MERCATOR_R)) - math.pi / 2)
        if src == dst:
            return x, y
        raise ValueError(f"reprojection {src} -> {dst} is not supported")
    pts = [one(x, y) for x in (minx, maxx) for y in (miny, maxy)]
    return (min(p[0] for p in pts), min(p[1] for p in pts), max(p[0] for p in pts), max(p[1] for p in pts))


def bounds_frame_reproject(bounds: DataFrame, src: int, dst: int) -> DataFrame:
    """P11 on a one-row bounds frame (minx, miny, maxx, maxy) as columns."""
    xs, ys = [], []
    for cx in ("minx", "maxx"):
        for cy in ("miny", "maxy"):
            x, y = transform_xy(F.col(cx), F.col(cy), src, dst)
            xs.append(x)
            ys.append(y)
    return bounds.select(F.least(*xs).alias("minx"), F.least(*ys).alias("miny"),
                         F.greatest(*xs).alias("maxx"), F.greatest(*ys).alias("maxy"))


# P06 -------------------------------------------------------------------------
def simplify(df: DataFrame, geom: str, tolerance: float, key: str | None = None) -> DataFrame:
    """Lines and rings without the vertices that lie within ``tolerance`` of what is left; points never change.

    Vertices are rows.  In every round each open stretch of a line finds its farthest vertex from the chord and is cut
    there; stretches within tolerance are done.  So a line of any length spreads over tasks by
    stretches, and rounds grow with the depth of the cuts.  A ring keeps four vertices.  ``key`` must be unique;
    without one, rows are written once with a number."""
    if key is None:
        return simplify(stored(df.withColumn("__row", F.monotonically_increasing_id()), "simplify"), geom, tolerance, "__row").drop("__row")
    g = F.col(geom)
    shapes = df.where(~g["kind"].isin("Point", "MultiPoint"))
    parts = shapes.select(F.col(key).alias("k"), F.posexplode(g["parts"]).alias("part", "rings"))
    rings = parts.select("k", "part", F.posexplode("rings").alias("ring", "pts")).withColumn("last", F.size("pts") - 1)
    end = lambda i: F.get("pts", F.lit(0) if i == 0 else F.col("last"))
    closed = (end(0) == end(1)) & (F.col("last") >= 3)
    rows = rings.select("k", "part", "ring", "last", closed.alias("closed"), F.posexplode("pts").alias("nr", "p"), F.lit(0).alias("lo"), F.col("last").alias("hi"),
                        end(0).alias("a"), end(1).alias("b"))
    ids = ["k", "part", "ring"]
    open_rows = stored(rows.where((F.col("nr") > 0) & (F.col("nr") < F.col("last"))), "simplify")
    kept = rows.where((F.col("nr") == 0) | (F.col("nr") == F.col("last"))).select(*ids, "nr", "p")
    rx, ry = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    qx, qy = F.col("p.x") - F.col("a.x"), F.col("p.y") - F.col("a.y")
    away = F.when((rx == 0) & (ry == 0), F.hypot(qx, qy)).otherwise(F.abs(rx * qy - ry * qx) / F.sqrt(rx * rx + ry * ry))
    found = []
    while not open_rows.isEmpty():
        far = open_rows.groupBy(*ids, "lo", "hi").agg(F.max(F.struct(away.alias("d"), (-F.col("nr")).alias("nr"), F.col("p"))).alias("f"))
        cuts = stored(far.where(F.col("f.d") > F.lit(float(tolerance))).select(*ids, "lo", "hi", (-F.col("f.nr")).alias("cut"), F.col("f.p").alias("c")), "simplify")
        found.append(cuts.select(*ids, F.col("cut").alias("nr"), F.col("c").alias("p")))
        low = F.col("nr") < F.col("cut")
        inside = open_rows.join(cuts, [*ids, "lo", "hi"]).where(F.col("nr") != F.col("cut"))
        open_rows = stored(inside.select(*ids, "last", "closed", "nr", "p", F.when(low, F.col("lo")).otherwise(F.col("cut")).alias("lo"), F.when(low, F.col("cut")).otherwise(F.col("hi")).alias("hi"),
                                         F.when(low, F.col("a")).otherwise(F.col("c")).alias("a"), F.when(low, F.col("c")).otherwise(F.col("b")).alias("b")), "simplify")
    for more in found:
        kept = kept.unionByName(more)
    # a ring of fewer than four vertices gets back those a third of the way round
    thin = kept.groupBy(*ids).agg(F.count("*").alias("n")).where("n < 4").join(rows.where("closed").select(*ids, "nr", "p", "last"), ids)
    thirds = F.array(*[F.round(F.col("last") * i / 3.0).cast("int") for i in (1, 2)])
    kept = kept.unionByName(thin.where(F.array_contains(thirds, F.col("nr"))).select(*ids, "nr", "p")).distinct()
    ordered = lambda c, by: F.transform(F.array_sort(F.collect_list(F.struct(by, c))), lambda x: x[c])
    out = kept.groupBy(*ids).agg(ordered("p", "nr").alias("pts")).groupBy("k", "part").agg(ordered("pts", "ring").alias("rings"))
    out = out.groupBy("k").agg(ordered("rings", "part").alias("__parts"))
    done = df.join(out.withColumnRenamed("k", "__k"), F.col(key) == F.col("__k"), "left")
    return done.withColumn(geom, F.when(F.col("__parts").isNull(), g).otherwise(from_parts(g["kind"], F.col("__parts")))).select(*df.columns)
