"""FeatureQuery: the reference's Query (filter, properties, sort, offset,
limit, CRS, joins) as chained DataFrame calls.

Order of application: joins -> filter -> sort -> offset / limit -> select ->
reproject.  Catalyst pushes the filter into the scan, prunes the columns that
are only read by the filter or the sort (P02 / W04), and turns sort + limit
into a top-k plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NATURAL = "__natural__"
REVERSE = "__reverse__"


@dataclass(frozen=True)
class FeatureQuery:
    filter: Column | None = None
    properties: Sequence[str] | None = None      # None: all columns
    sort_by: Sequence[tuple[str, str]] = ()        # (column | NATURAL | REVERSE, 'ASC' | 'DESC')
    offset: int | None = None
    limit: int | None = None
    force_srid: int | None = None                  # P09
    reproject_to: int | None = None                # P10
    joins: Sequence = field(default_factory=tuple)  # JoinPart list (J01-J07)


@dataclass(frozen=True)
class Layer:
    """A lazy DataFrame plus what the reference keeps in the feature type."""
    df: DataFrame
    name: str
    pk: Sequence[str] = ()
    geometry: str | None = "geom"
    srid: int | None = 4326
    expose_pk: bool = True


def sort_columns(layer: Layer, sort_by: Sequence[tuple[str, str]]) -> list[Column]:
    """Multi-key sort; natural order = pk; geometry refused."""
    out: list[Column] = []
    schema = {f.name: f.dataType for f in layer.df.schema.fields}
    for name, direction in sort_by:
        desc = str(direction).upper().startswith("DESC")
        if name in (NATURAL, REVERSE):
            if not layer.pk:
                raise ValueError("natural order needs a primary key")
            rev = (name == REVERSE) != desc
            out.extend(F.col(k).desc() if rev else F.col(k).asc() for k in layer.pk)
            continue
        if isinstance(schema.get(name), T.StructType) and name == layer.geometry:
            raise ValueError(f"cannot sort on geometry column {name!r}")
        out.append(F.col(name).desc() if desc else F.col(name).asc())
    return out


def run(layer: Layer, q: FeatureQuery) -> DataFrame:
    from ..operators.joins import apply_joins
    from ..operators.projection import reproject, set_srid

    df = layer.df
    if q.joins:
        df = apply_joins(df, layer.name, q.joins)
    if q.filter is not None:
        df = df.where(q.filter)
    order = sort_columns(layer, q.sort_by) if q.sort_by else []
    if q.offset and not order:
        # Offset without sort forces natural order, else pages vary by run
        order = sort_columns(layer, [(NATURAL, "ASC")])
    if order:
        df = df.orderBy(*order)
    if q.offset:
        df = df.offset(int(q.offset))
    if q.limit is not None:
        df = df.limit(int(q.limit))
    if q.properties is not None:
        cols = list(q.properties)
        if layer.expose_pk:
            cols = [k for k in layer.pk if k not in cols] + cols  # P01: pk always read
        df = df.select(*cols)
    elif not layer.expose_pk and layer.pk:
        df = df.drop(*layer.pk)  # P03
    if q.force_srid is not None:
        df = set_srid(df, q.force_srid)
    if q.reproject_to is not None and layer.geometry and layer.geometry in df.columns:
        if layer.srid is None:
            raise ValueError("layer has no CRS; cannot reproject")
        df = reproject(df, layer.geometry, layer.srid, q.reproject_to)
    return df
