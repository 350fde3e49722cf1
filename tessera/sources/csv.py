"""CSV layers.

Read: Spark's CSV reader (header, values trimmed, short rows padded with
null in PERMISSIVE mode); types inferred over **all** rows in one aggregate
pass, Integer -> Double -> String only; then one of the geometry strategies:
attributes only, guessed or named lat/lon columns (a point replaces them at
the lat position), or a WKT column (unparsable -> null geometry).
Write: point -> lat, lon columns or WKT text; null -> empty string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import geom_from_wkt, geom_to_wkt, point

# Column names recognised as latitude / longitude.
LAT_NAMES = ("lat", "latitude")
LON_NAMES = ("lon", "lng", "long", "longitude")


def read_attributes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as trimmed strings; a doubled quote inside quotes is a quote.
    ``multi_line`` lets quoted values hold line breaks (a file is then one task)."""
    df = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True).option("mode", "PERMISSIVE").csv(path))
    return df.toDF(*[c.strip() for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """Integer if every non-null value parses as int, else Double if as
    double, else String; one aggregate over all rows, column order kept."""
    checks = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        checks.append(F.min(F.when(col.isNull(), True).otherwise(col.try_cast("int").isNotNull())).alias(f"i_{c}"))
        checks.append(F.min(F.when(col.isNull(), True).otherwise(col.try_cast("double").isNotNull())).alias(f"d_{c}"))
    row = df.agg(*checks).first()
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if row[f"i_{c}"]:
            out.append(col.cast("int").alias(c))
        elif row[f"d_{c}"]:
            out.append(col.cast("double").alias(c))
        else:
            out.append(col.alias(c))
    return df.select(*out)


def _numeric(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("integer", "double", "long", "float")


def with_latlon(df: DataFrame, lat: str | None = None, lon: str | None = None, point_col: str = "location",
                strict: bool = False) -> DataFrame:
    """Replace lat / lon columns by one point at the lat position.
    Names are guessed when not given; both must be numeric (else the layer
    stays attributes-only, or an error when ``strict``)."""
    cols = df.columns
    if lat is None:
        lat = next((c for c in cols if c.lower() in LAT_NAMES), None)
    if lon is None:
        lon = next((c for c in cols if c.lower() in LON_NAMES), None)
    if lat is None or lon is None or lat not in cols or lon not in cols:
        if strict:
            raise ValueError("lat / lon columns not found")
        return df
    if not (_numeric(df, lat) and _numeric(df, lon)):
        if strict:
            raise ValueError("lat / lon columns are not numeric")
        return df
    out = []
    for c in cols:
        if c == lat:
            out.append(point(F.col(lon), F.col(lat)).alias(point_col))
        elif c != lon:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def read_layer(spark: SparkSession, path: str, strategy: str = "guess", lat: str | None = None,
               lon: str | None = None, wkt: str | None = None, point_col: str = "location") -> DataFrame:
    """S01-S05 by strategy: attributes | guess | specify | wkt."""
    typed = infer_types(read_attributes(spark, path))
    if strategy == "attributes":
        return typed
    if strategy == "guess":
        return with_latlon(typed, point_col=point_col)
    if strategy == "specify":
        if not lat or not lon:
            raise ValueError("the specify strategy needs lat and lon field names")
        return with_latlon(typed, lat, lon, point_col, strict=True)
    if strategy == "wkt":
        if not wkt:
            raise ValueError("the wkt strategy needs the WKT field name")
        return typed.withColumn(wkt, geom_from_wkt(F.col(wkt).cast("string")))
    raise ValueError(f"unknown CSV strategy {strategy!r}")


def encode(df: DataFrame, geom: str | None = None, form: str = "latlon") -> DataFrame:
    """Geometry -> (lat, lon) or WKT text; every value as text, null -> ''."""
    out = []
    for c in df.columns:
        if c == geom and form == "latlon":
            g = F.col(c)
            kind_ok = F.when(g["kind"].isNull() | (g["kind"] == "Point"), F.lit(True)).otherwise(
                F.raise_error(F.lit("lat/lon CSV needs point geometries")))
            out.append(F.when(kind_ok, g["miny"]).cast("string").alias("lat"))
            out.append(g["minx"].cast("string").alias("lon"))
        elif c == geom:
            out.append(geom_to_wkt(F.col(c)).alias(c))
        else:
            out.append(F.col(f"`{c}`").cast("string").alias(c))
    return df.select(*out)


def write(df: DataFrame, path: str, geom: str | None = None, form: str = "latlon", mode: str = "errorifexists") -> None:
    """Header always written (an empty layer gives a header-only file)."""
    encode(df, geom, form).write.mode(mode).option("header", True).option("escape", '"').option("nullValue", "") \
        .option("emptyValue", "").csv(path)


def append(spark: SparkSession, existing: DataFrame, new: DataFrame, path: str, geom: str | None = None,
           form: str = "latlon") -> None:
    """Existing rows, then the new ones, geometries encoded, written to a new
    directory (the caller switches to it; the old files are never rewritten in place)."""
    write(existing.unionByName(new), path, geom, form)
