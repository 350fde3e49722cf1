"""Layer export (S11-S13), re-aimed at Parquet / CSV-WKT files.

S11: mixed layers are split by geometry kind with ``partitionBy('kind')``
and rolled over at ``maxRecordsPerFile``; S12: column names cut to 10
characters, made unique by a numeric suffix, geometry renamed ``the_geom``;
S13: column types per value class, unknown types refused.  The files are Parquet or
CSV, which hold text of any length; binary columns are kept (CSV: as base64).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import geom_to_wkt

# Export kinds by geometry kind, name width.
EXPORT_KIND = {"Point": "Point", "MultiPoint": "MPoint", "LineString": "Line", "MultiLineString": "Line",
               "Polygon": "Polygon", "MultiPolygon": "Polygon"}
MAX_NAME = 10


def export_names(columns: list[str], geom: str | None) -> list[str]:
    out, used = [], {"the_geom"} if geom in columns else set()
    for c in columns:
        if c == geom:
            name = "the_geom"
        else:
            name = c[:MAX_NAME]
            k = 0
            while name in used:
                k += 1
                suffix = str(k)
                name = c[:MAX_NAME - len(suffix)] + suffix
        used.add(name)
        out.append(name)
    return out


def export_frame(df: DataFrame, geom: str | None = "geom", wkt: bool = False) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if f.name == geom:
            cols.append(geom_to_wkt(c).alias(f.name) if wkt else c.alias(f.name))
        elif isinstance(dt, T.BinaryType):
            cols.append(F.base64(c).alias(f.name) if wkt else c)
        elif isinstance(dt, (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.ByteType,
                             T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
            cols.append(c)
        else:
            raise ValueError(f"column {f.name!r} of type {dt.simpleString()} cannot be exported")
    out = df.select(*cols)
    names = export_names(out.columns, geom)
    out = out.toDF(*names)
    if geom is not None and geom in df.columns:
        g = F.col("the_geom")
        kind = g["kind"] if not wkt else F.regexp_extract(g, r"^([A-Z]+)", 1)
        if wkt:
            kind = F.when(kind == "POINT", "Point").when(kind == "MULTIPOINT", "MPoint") \
                .when(kind.isin("LINESTRING", "MULTILINESTRING"), "Line").otherwise("Polygon")
        else:
            kind = F.element_at(F.create_map(*[F.lit(x) for kv in EXPORT_KIND.items() for x in kv]), kind)
        out = out.withColumn("kind", kind)
    return out


def export(df: DataFrame, path: str, geom: str | None = "geom", fmt: str = "parquet", max_records: int = 0,
           mode: str = "errorifexists") -> None:
    out = export_frame(df, geom, wkt=(fmt == "csv"))
    w = out.write.mode(mode)
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    if "kind" in out.columns:
        w = w.partitionBy("kind")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
