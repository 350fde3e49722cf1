"""Geometry values as Spark columns.

A geometry is one struct column::

    struct<kind: string, minx, miny, maxx, maxy: double,
           parts: array<array<array<struct<x: double, y: double>>>>>

``parts`` holds parts -> rings -> points (a Point is one part with one ring of
one point; a Polygon's first ring is the shell, the others are holes).  The
envelope lives in the struct so that Parquet can prune row groups on
``geom.minx`` etc. (nested predicate pushdown) and so envelope tests never
touch the coordinate arrays.

Literal geometries (query regions) are plain Python ``Geom`` objects; they turn
into literal columns or into unrolled native expressions.  WKT / WKB codecs are
small helpers used inside Arrow UDFs at ingest / export time only.
"""

from __future__ import annotations

import re
import struct as _struct
from dataclasses import dataclass
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_T = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS_T = T.ArrayType(T.ArrayType(T.ArrayType(POINT_T)))
GEOMETRY_T = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("minx", T.DoubleType()),
    T.StructField("miny", T.DoubleType()),
    T.StructField("maxx", T.DoubleType()),
    T.StructField("maxy", T.DoubleType()),
    T.StructField("parts", PARTS_T),
])

KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")


# --------------------------------------------------------------------------
# Python-side literal geometry
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Geom:
    kind: str
    parts: tuple  # tuple[tuple[tuple[tuple[float, float], ...], ...], ...]

    # constructors -----------------------------------------------------------
    @staticmethod
    def point(x: float, y: float) -> "Geom":
        return Geom("Point", ((((float(x), float(y)),),),))

    @staticmethod
    def box(x1: float, y1: float, x2: float, y2: float) -> "Geom":
        ring = ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))
        return Geom("Polygon", ((tuple((float(a), float(b)) for a, b in ring),),))

    @staticmethod
    def line(coords: Sequence[Sequence[float]]) -> "Geom":
        return Geom("LineString", ((tuple((float(a), float(b)) for a, b in coords),),))

    @staticmethod
    def polygon(shell: Sequence[Sequence[float]], *holes: Sequence[Sequence[float]]) -> "Geom":
        rings = [_close(shell)] + [_close(h) for h in holes]
        return Geom("Polygon", (tuple(rings),))

    @staticmethod
    def multi(kind: str, geoms: Iterable["Geom"]) -> "Geom":
        parts = tuple(p for g in geoms for p in g.parts)
        return Geom(kind, parts)

    # properties -------------------------------------------------------------
    def envelope(self) -> tuple[float, float, float, float]:
        xs = [p[0] for part in self.parts for ring in part for p in ring]
        ys = [p[1] for part in self.parts for ring in part for p in ring]
        return (min(xs), min(ys), max(xs), max(ys))

    def edges(self) -> list[tuple[float, float, float, float]]:
        """Segments of all rings / lines (x1, y1, x2, y2)."""
        out = []
        for part in self.parts:
            for ring in part:
                for a, b in zip(ring[:-1], ring[1:]):
                    out.append((a[0], a[1], b[0], b[1]))
        return out

    @property
    def dimension(self) -> int:
        return {"Point": 0, "MultiPoint": 0, "LineString": 1, "MultiLineString": 1}.get(self.kind, 2)

    def is_rectangle(self) -> bool:
        if self.kind != "Polygon" or len(self.parts[0]) != 1:
            return False
        ring = self.parts[0][0]
        if len(ring) != 5:
            return False
        x1, y1, x2, y2 = self.envelope()
        return all(p[0] in (x1, x2) and p[1] in (y1, y2) for p in ring) and len(set(ring[:4])) == 4

    def to_wkt(self) -> str:
        return to_wkt(self.kind, self.parts)

    def to_column(self) -> Column:
        """Literal geometry struct column."""
        x1, y1, x2, y2 = self.envelope()
        parts = F.array(*[
            F.array(*[F.array(*[F.struct(F.lit(float(px)).alias("x"), F.lit(float(py)).alias("y"))
                                 for px, py in ring]) for ring in part])
            for part in self.parts
        ])
        return F.struct(F.lit(self.kind).alias("kind"), F.lit(x1).alias("minx"), F.lit(y1).alias("miny"),
                        F.lit(x2).alias("maxx"), F.lit(y2).alias("maxy"), parts.alias("parts"))


def _close(ring: Sequence[Sequence[float]]) -> tuple:
    pts = [(float(a), float(b)) for a, b in ring]
    if pts[0] != pts[-1]:
        pts.append(pts[0])
    return tuple(pts)


# --------------------------------------------------------------------------
# Column constructors
# --------------------------------------------------------------------------
def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x, y) -> Column:
    """Point geometry column from two numeric columns (null if either is null)."""
    x, y = _c(x).cast("double"), _c(y).cast("double")
    g = F.struct(F.lit("Point").alias("kind"), x.alias("minx"), y.alias("miny"), x.alias("maxx"),
                 y.alias("maxy"),
                 F.array(F.array(F.array(F.struct(x.alias("x"), y.alias("y"))))).alias("parts"))
    return F.when(x.isNotNull() & y.isNotNull(), g)


def box(x1, y1, x2, y2) -> Column:
    """Rectangle polygon column from four envelope columns."""
    x1, y1, x2, y2 = (_c(v).cast("double") for v in (x1, y1, x2, y2))

    def p(a, b):
        return F.struct(a.alias("x"), b.alias("y"))

    ring = F.array(p(x1, y1), p(x2, y1), p(x2, y2), p(x1, y2), p(x1, y1))
    return F.struct(F.lit("Polygon").alias("kind"), x1.alias("minx"), y1.alias("miny"), x2.alias("maxx"),
                    y2.alias("maxy"), F.array(F.array(ring)).alias("parts"))


def from_parts(kind, parts) -> Column:
    """Geometry column from a kind column and a parts array; envelope computed natively."""
    def once(value, fn):  # the array is worked out once, however often the envelope is asked for
        return F.get(F.transform(F.array(value), fn), F.lit(0))

    def known(p):
        xs, ys = F.transform(p["all"], lambda q: q["x"]), F.transform(p["all"], lambda q: q["y"])
        return F.when(F.size(p["all"]) > 0, F.struct(
            p["kind"].alias("kind"), F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"), p["parts"].alias("parts")))

    given = F.struct(_c(kind).alias("kind"), _c(parts).alias("parts"))
    return once(given, lambda g: once(F.struct(g["kind"].alias("kind"), g["parts"].alias("parts"), F.flatten(F.flatten(g["parts"])).alias("all")), known))


def line2(x1, y1, x2, y2) -> Column:
    """Two-point LineString column."""
    x1, y1, x2, y2 = (_c(v).cast("double") for v in (x1, y1, x2, y2))
    parts = F.array(F.array(F.array(F.struct(x1.alias("x"), y1.alias("y")),
                                    F.struct(x2.alias("x"), y2.alias("y")))))
    return F.struct(F.lit("LineString").alias("kind"), F.least(x1, x2).alias("minx"),
                    F.least(y1, y2).alias("miny"), F.greatest(x1, x2).alias("maxx"),
                    F.greatest(y1, y2).alias("maxy"), parts.alias("parts"))


# --------------------------------------------------------------------------
# WKT
# --------------------------------------------------------------------------
def _fmt(v: float) -> str:
    r = repr(float(v))
    return r[:-2] if r.endswith(".0") else r


def to_wkt(kind: str, parts) -> str:
    if kind is None or parts is None:
        return None
    def ring_s(r):
        return "(" + ", ".join(f"{_fmt(p[0])} {_fmt(p[1])}" for p in r) + ")"
    name = kind.upper()
    if kind == "Point":
        p = parts[0][0][0]
        return f"POINT ({_fmt(p[0])} {_fmt(p[1])})"
    if kind == "LineString":
        return "LINESTRING " + ring_s(parts[0][0])
    if kind == "Polygon":
        return "POLYGON (" + ", ".join(ring_s(r) for r in parts[0]) + ")"
    if kind == "MultiPoint":
        return "MULTIPOINT (" + ", ".join(f"({_fmt(p[0][0][0])} {_fmt(p[0][0][1])})" for p in parts) + ")"
    if kind == "MultiLineString":
        return "MULTILINESTRING (" + ", ".join(ring_s(p[0]) for p in parts) + ")"
    if kind == "MultiPolygon":
        return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(ring_s(r) for r in p) + ")" for p in parts) + ")"
    raise ValueError(f"unknown geometry kind {name}")


_TOKEN = re.compile(r"\s*([A-Za-z]+|\(|\)|,|[-+0-9.eE]+)\s*")


def parse_wkt(text: str) -> Geom | None:
    """Parse 2-D WKT (Z / M ordinates are dropped); returns None when unparsable."""
    if text is None:
        return None
    try:
        toks = [t for t in _TOKEN.findall(text) if t]
        pos = 0

        def peek():
            return toks[pos] if pos < len(toks) else None

        def take(expect=None):
            nonlocal pos
            t = toks[pos]
            if expect is not None and t != expect:
                raise ValueError(t)
            pos += 1
            return t

        def coord():
            nums = []
            while peek() not in (",", ")", None):
                nums.append(float(take()))
            if len(nums) < 2:
                raise ValueError("short coordinate")
            return (nums[0], nums[1])

        def seq(item):
            take("(")
            out = [item()]
            while peek() == ",":
                take(",")
                out.append(item())
            take(")")
            return tuple(out)

        def ring():
            return seq(coord)

        def point_item():
            if peek() == "(":
                take("(")
                c = coord()
                take(")")
                return c
            return coord()

        name = take().upper()
        while peek() and peek().upper() in ("Z", "M", "ZM"):
            take()
        if peek() and peek().upper() == "EMPTY":
            return None
        kinds = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon",
                 "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString",
                 "MULTIPOLYGON": "MultiPolygon"}
        kind = kinds[name]
        if kind == "Point":
            take("(")
            c = coord()
            take(")")
            parts = (((c,),),)
        elif kind == "LineString":
            parts = ((ring(),),)
        elif kind == "Polygon":
            parts = (seq(ring),)
        elif kind == "MultiPoint":
            parts = tuple(((c,),) for c in seq(point_item))
        elif kind == "MultiLineString":
            parts = tuple((r,) for r in seq(ring))
        else:
            parts = seq(lambda: seq(ring))
        if pos != len(toks):
            raise ValueError("trailing tokens")
        return Geom(kind, parts)
    except (ValueError, IndexError, KeyError):
        return None


# --------------------------------------------------------------------------
# WKB (little endian out; both byte orders in)
# --------------------------------------------------------------------------
_WKB_CODE = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5,
             "MultiPolygon": 6}
_WKB_KIND = {v: k for k, v in _WKB_CODE.items()}


def to_wkb(kind: str, parts) -> bytes | None:
    if kind is None or parts is None:
        return None
    out = bytearray()

    def head(code):
        out.extend(_struct.pack("<BI", 1, code))

    def pts(r):
        out.extend(_struct.pack("<I", len(r)))
        for p in r:
            out.extend(_struct.pack("<dd", p[0], p[1]))

    def poly(rings):
        head(3)
        out.extend(_struct.pack("<I", len(rings)))
        for r in rings:
            pts(r)

    if kind == "Point":
        head(1)
        p = parts[0][0][0]
        out.extend(_struct.pack("<dd", p[0], p[1]))
    elif kind == "LineString":
        head(2)
        pts(parts[0][0])
    elif kind == "Polygon":
        poly(parts[0])
    else:
        head(_WKB_CODE[kind])
        out.extend(_struct.pack("<I", len(parts)))
        for p in parts:
            if kind == "MultiPoint":
                head(1)
                out.extend(_struct.pack("<dd", p[0][0][0], p[0][0][1]))
            elif kind == "MultiLineString":
                head(2)
                pts(p[0])
            else:
                poly(p)
    return bytes(out)


def parse_wkb(buf: bytes) -> Geom | None:
    if buf is None:
        return None
    try:
        mv = memoryview(bytes(buf))
        pos = 0

        def read(fmt, n, bo):
            nonlocal pos
            v = _struct.unpack_from(bo + fmt, mv, pos)
            pos += n
            return v

        def geom():
            bo = "<" if read("B", 1, "<")[0] == 1 else ">"
            code = read("I", 4, bo)[0]
            dims = 2
            if code > 0x1FFFFFFF:  # EWKB flags
                has_z, has_m, has_srid = code & 0x80000000, code & 0x40000000, code & 0x20000000
                dims = 2 + bool(has_z) + bool(has_m)
                if has_srid:
                    read("I", 4, bo)
                code &= 0xFF
            elif code >= 1000:
                dims = 3 if code // 1000 in (1, 2) else 4
                code %= 1000

            def coord():
                v = read("d" * dims, 8 * dims, bo)
                return (v[0], v[1])

            def ring():
                n = read("I", 4, bo)[0]
                return tuple(coord() for _ in range(n))

            kind = _WKB_KIND[code]
            if kind == "Point":
                return kind, (((coord(),),),)
            if kind == "LineString":
                return kind, ((ring(),),)
            if kind == "Polygon":
                n = read("I", 4, bo)[0]
                return kind, (tuple(ring() for _ in range(n)),)
            n = read("I", 4, bo)[0]
            parts = []
            for _ in range(n):
                _, sub = geom()
                parts.extend(sub)
            return kind, tuple(parts)

        kind, parts = geom()
        return Geom(kind, parts)
    except Exception:
        return None


# --------------------------------------------------------------------------
# pandas <-> geometry struct records (used inside Arrow UDFs)
# --------------------------------------------------------------------------
def geom_to_record(g: Geom | None):
    if g is None:
        return None
    x1, y1, x2, y2 = g.envelope()
    return {"kind": g.kind, "minx": x1, "miny": y1, "maxx": x2, "maxy": y2,
            "parts": [[[{"x": p[0], "y": p[1]} for p in ring] for ring in part] for part in g.parts]}


def record_to_geom(rec) -> Geom | None:
    if rec is None or (isinstance(rec, float) and np.isnan(rec)):
        return None
    kind = rec["kind"]
    parts = rec["parts"]
    if kind is None or parts is None:
        return None
    return Geom(kind, tuple(tuple(tuple((float(p["x"]), float(p["y"])) for p in ring) for ring in part)
                            for part in parts))


@F.pandas_udf(GEOMETRY_T)
def geom_from_wkt(s: pd.Series) -> pd.DataFrame:
    """WKT text column -> geometry struct (unparsable -> null)."""
    recs = [geom_to_record(parse_wkt(v)) if isinstance(v, str) else None for v in s]
    return _records_frame(recs)


@F.pandas_udf(GEOMETRY_T)
def geom_from_wkb(s: pd.Series) -> pd.DataFrame:
    recs = [geom_to_record(parse_wkb(v)) if v is not None else None for v in s]
    return _records_frame(recs)


@F.pandas_udf(T.StringType())
def geom_to_wkt(g: pd.DataFrame) -> pd.Series:
    return pd.Series([_rec_wkt(r) for r in g.to_dict("records")])


@F.pandas_udf(T.BinaryType())
def geom_to_wkb(g: pd.DataFrame) -> pd.Series:
    out = []
    for r in g.to_dict("records"):
        geo = record_to_geom(r) if r.get("kind") is not None else None
        out.append(None if geo is None else to_wkb(geo.kind, geo.parts))
    return pd.Series(out, dtype=object)


def _rec_wkt(r):
    geo = record_to_geom(r) if r.get("kind") is not None else None
    return None if geo is None else geo.to_wkt()


def _records_frame(recs) -> pd.DataFrame:
    cols = ["kind", "minx", "miny", "maxx", "maxy", "parts"]
    data = {c: [None if r is None else r[c] for r in recs] for c in cols}
    return pd.DataFrame(data, columns=cols)
