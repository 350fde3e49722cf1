"""Shapefile sets as a distributed ingest job.

``spark.read.format('binaryFile')`` lists every ``.shp`` / ``.dbf`` of a
folder; rows are grouped by file stem and each set is decoded in one
``applyInPandas`` task, so many sets decode in parallel (one set must fit in
a task: files of 2 GB or more are out).  Output rows carry the geometry
struct and the DBF values as text in a map; ``typed`` turns them into typed
columns from the DBF field table (S09 rules).  Header statistics (bounds,
counts) come from the first bytes of each file only (S10).
"""

from __future__ import annotations

import datetime as _dt
import re
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import GEOMETRY_T, Geom, geom_to_record

ROW_SCHEMA = T.StructType([
    T.StructField("stem", T.StringType()), T.StructField("recno", T.LongType()),
    T.StructField("geom", GEOMETRY_T), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])
FIELD_SCHEMA = "stem string, position int, name string, type string, length int, decimals int"

# Shape type codes by kind (2-D, Z and M variants).
POINT_CODES, LINE_CODES, POLY_CODES, MULTIPOINT_CODES = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)


# --------------------------------------------------------------------------
# decoding helpers (run inside tasks)
# --------------------------------------------------------------------------
def _ring_area(r) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r[:-1], r[1:])) / 2.0


def _inside(pt, ring) -> bool:
    x, y = pt
    c = False
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            c = not c
    return c


def decode_shape(buf: bytes) -> Geom | None:
    code = struct.unpack_from("<i", buf, 0)[0]
    if code == 0:
        return None
    if code in POINT_CODES:
        x, y = struct.unpack_from("<2d", buf, 4)
        return Geom.point(x, y)
    if code in MULTIPOINT_CODES:
        n = struct.unpack_from("<i", buf, 36)[0]
        pts = [struct.unpack_from("<2d", buf, 40 + 16 * k) for k in range(n)]
        return Geom("MultiPoint", tuple((((x, y),),) for x, y in pts))
    if code in LINE_CODES or code in POLY_CODES:
        nparts, npts = struct.unpack_from("<2i", buf, 36)
        starts = list(struct.unpack_from(f"<{nparts}i", buf, 44))
        off = 44 + 4 * nparts
        pts = [struct.unpack_from("<2d", buf, off + 16 * k) for k in range(npts)]
        rings = [tuple(pts[s:e]) for s, e in zip(starts, starts[1:] + [npts])]
        if code in LINE_CODES:
            return Geom("LineString" if len(rings) == 1 else "MultiLineString", tuple((r,) for r in rings))
        shells, holes = [], []
        for r in rings:
            (shells if _ring_area(r) <= 0 else holes).append(r)  # clockwise = shell
        parts = [[s] for s in shells]
        for h in holes:
            home = next((p for p in parts if _inside(h[0], p[0])), None)
            if home is None:
                parts.append([h])
            else:
                home.append(h)
        parts_t = tuple(tuple(p) for p in parts)
        return Geom("Polygon" if len(parts_t) == 1 else "MultiPolygon", parts_t)
    raise ValueError(f"unsupported shape type {code}")


def read_shp(data: bytes) -> list[Geom | None]:
    out, pos = [], 100
    while pos + 8 <= len(data):
        _, clen = struct.unpack_from(">2i", data, pos)
        body = data[pos + 8: pos + 8 + 2 * clen]
        out.append(decode_shape(body))
        pos += 8 + 2 * clen
    return out


def dbf_fields(data: bytes) -> list[tuple[str, str, int, int]]:
    fields, pos, seen = [], 32, {}
    while pos < len(data) and data[pos] != 0x0D:
        raw = data[pos:pos + 11].split(b"\x00")[0].decode("latin-1").strip()
        name = raw
        if name in seen:  # duplicate names get a numeric suffix
            seen[raw] += 1
            name = f"{raw}{seen[raw]}"
        else:
            seen[raw] = 0
        fields.append((name, chr(data[pos + 11]), data[pos + 16], data[pos + 17]))
        pos += 32
    return fields


def _dbf_value(ftype: str, raw: bytes, decimals: int) -> str | None:
    if ftype == "C":
        if raw[:1] == b"\x00":
            return None
        return raw.decode("latin-1").rstrip(" \x00")
    text = raw.decode("latin-1").strip().strip("\x00")
    if ftype in ("N", "F"):
        if not text or set(text) == {"*"}:
            return None
        try:
            v = float(text)
        except ValueError:
            return None  # the reference yields 0.0 here; null is the intended meaning
        return text if (ftype == "N" and decimals == 0 and "." not in text) else repr(v)
    if ftype == "L":
        return {"T": "true", "Y": "true", "F": "false", "N": "false"}.get(text[:1].upper()) if text else None
    if ftype == "D":
        if len(text) != 8 or not text.isdigit() or int(text) == 0:
            return None
        try:
            return _dt.date(int(text[:4]), int(text[4:6]), int(text[6:8])).isoformat()
        except ValueError:
            return None
    if ftype == "@":
        day, ms = struct.unpack("<2i", raw[:8])
        if day == 0:
            return None
        base = _dt.datetime(1970, 1, 1) + _dt.timedelta(days=day - 2440588, milliseconds=ms)
        return base.isoformat(sep=" ")
    return text or None


def read_dbf(data: bytes) -> tuple[list, list[dict | None]]:
    nrec = struct.unpack_from("<I", data, 4)[0]
    hlen, rlen = struct.unpack_from("<2H", data, 8)
    fields = dbf_fields(data)
    rows = []
    for k in range(nrec):
        rec = data[hlen + k * rlen: hlen + (k + 1) * rlen]
        if rec[:1] == b"*":
            rows.append(None)  # deleted
            continue
        vals, off = {}, 1
        for name, ftype, length, dec in fields:
            vals[name] = _dbf_value(ftype, rec[off:off + length], dec)
            off += length
        rows.append(vals)
    return fields, rows


def _decode_set(pdf: pd.DataFrame) -> pd.DataFrame:
    stem = pdf["stem"].iloc[0]
    files = {e: bytes(c) for e, c in zip(pdf["ext"], pdf["content"])}
    geoms = read_shp(files["shp"]) if "shp" in files else []
    _, rows = read_dbf(files["dbf"]) if "dbf" in files else ([], [None] * 0)
    if "dbf" in files and len(rows) != len(geoms):
        raise ValueError(f"{stem}: {len(geoms)} shapes but {len(rows)} dbf records")
    out = []
    for k, g in enumerate(geoms):
        attrs = rows[k] if rows else {}
        if attrs is None:
            continue
        out.append((stem, k + 1, geom_to_record(g), attrs))
    return pd.DataFrame(out, columns=["stem", "recno", "geom", "attributes"])


def _fields_of(pdf: pd.DataFrame) -> pd.DataFrame:
    stem = pdf["stem"].iloc[0]
    rows = [(stem, i, n, t, ln, d) for i, (n, t, ln, d) in enumerate(dbf_fields(bytes(pdf["content"].iloc[0])))]
    return pd.DataFrame(rows, columns=["stem", "position", "name", "type", "length", "decimals"])


# --------------------------------------------------------------------------
# Spark jobs
# --------------------------------------------------------------------------
def _files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
          .load(folder))
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    # the path below the folder names a set: sets of one name in two folders are two sets
    base = re.escape(folder.rstrip("/").rsplit("/", 1)[-1])
    tail = F.coalesce(F.get(F.split("path", f"/{base}/", 2), F.lit(1)), F.col("path"))
    return df.withColumn("ext", ext).withColumn("stem", F.regexp_replace(tail, r"\.[^./]+$", ""))


def read_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Every (shp, dbf) set of a folder -> rows, one task per set."""
    from ..session import ship_package

    ship_package(spark)
    files = _files(spark, folder, "*.{shp,dbf,SHP,DBF}").select("stem", "ext", "content")
    return files.groupBy("stem").applyInPandas(_decode_set, ROW_SCHEMA)


def fields(spark: SparkSession, folder: str) -> DataFrame:
    """DBF field tables (small: one row per field per file)."""
    from ..session import ship_package

    ship_package(spark)
    dbf = _files(spark, folder, "*.{dbf,DBF}").select("stem", F.substring("content", 1, 1 << 16).alias("content"))
    return dbf.groupBy("stem").applyInPandas(_fields_of, FIELD_SCHEMA)


def typed(rows: DataFrame, field_rows: list) -> DataFrame:
    """Map values -> typed columns (C string, N int / long / double,
    F double, L boolean, D date, @ timestamp); ``field_rows`` from ``fields``."""
    cols = [F.col("stem"), F.col("recno"), F.col("geom")]
    for f in sorted(field_rows, key=lambda r: r["position"]):
        v = F.col("attributes")[f["name"]]
        t = f["type"]
        if t == "N" and f["decimals"] == 0:
            c = v.try_cast("int") if f["length"] < 10 else v.try_cast("long")
        elif t in ("N", "F"):
            c = v.try_cast("double")
        elif t == "L":
            c = v.try_cast("boolean")
        elif t == "D":
            c = v.try_cast("date")
        elif t == "@":
            c = v.try_cast("timestamp")
        else:
            c = v
        cols.append(c.alias(f["name"]))
    return rows.select(*cols)


def header_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds and shape type from the .shp header, record count from the
    .dbf header -- the first bytes of each file, no record is decoded."""
    from ..session import ship_package

    ship_package(spark)
    shp = _files(spark, folder, "*.{shp,SHP}").select("stem", F.substring("content", 1, 100).alias("h"))
    dbf = _files(spark, folder, "*.{dbf,DBF}").select("stem", F.substring("content", 1, 12).alias("d"))

    @F.pandas_udf("shape_type int, minx double, miny double, maxx double, maxy double")
    def shp_head(h: pd.Series) -> pd.DataFrame:
        recs = [(struct.unpack_from("<i", b, 32)[0], *struct.unpack_from("<4d", b, 36)) for b in h]
        return pd.DataFrame(recs, columns=["shape_type", "minx", "miny", "maxx", "maxy"])

    @F.pandas_udf("long")
    def dbf_count(d: pd.Series) -> pd.Series:
        return pd.Series([struct.unpack_from("<I", b, 4)[0] for b in d])

    s = shp.select("stem", shp_head("h").alias("s")).select("stem", "s.*")
    c = dbf.select("stem", dbf_count("d").alias("count"))
    return s.join(c, "stem", "left")
