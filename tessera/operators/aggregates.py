"""Aggregates (A01-A18).  All are Spark hash aggregates with partial
(map-side) aggregation, so a hot key is combined before the shuffle."""

from __future__ import annotations

from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGG_FUNCS = {"count": F.count, "min": F.min, "max": F.max, "sum": F.sum}


# A01 / A02 -------------------------------------------------------------------
def count(df: DataFrame, cond: Column | None = None) -> DataFrame:
    if cond is not None:
        df = df.where(cond)
    return df.agg(F.count(F.lit(1)).alias("count"))


def count_paged(df: DataFrame, offset: int = 0, limit: int | None = None, cond: Column | None = None) -> DataFrame:
    """max(0, n - offset) capped by limit, without reading rows past the page."""
    n = count(df, cond)
    c = F.greatest(F.col("count") - F.lit(int(offset or 0)), F.lit(0))
    if limit is not None:
        c = F.least(c, F.lit(int(limit)))
    return n.select(c.cast("long").alias("count"))


# A03-A05 --------------------------------------------------------------------
def minmax_sum(df: DataFrame, col: str, cond: Column | None = None) -> DataFrame:
    if cond is not None:
        df = df.where(cond)
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"), F.sum(col).alias(f"sum_{col}"))


# A06 ------------------------------------------------------------------------
def unique(df: DataFrame, col: str, ascending: bool | None = True, offset: int | None = None,
           limit: int | None = None) -> DataFrame:
    out = df.select(col).distinct()
    if ascending is not None:
        out = out.orderBy(F.col(col).asc_nulls_first() if ascending else F.col(col).desc_nulls_last())
    if offset:
        out = out.offset(int(offset))
    if limit is not None:
        out = out.limit(int(limit))
    return out


# A07 ------------------------------------------------------------------------
def group_by(df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str]]) -> DataFrame:
    """aggs: (function, column) with function in count / min / max / sum;
    output column ``<function>_<column>``."""
    exprs = []
    for fn, col in aggs:
        if fn not in AGG_FUNCS:
            raise ValueError(f"aggregate {fn!r} is not supported")
        c = F.lit(1) if (fn == "count" and col == "*") else F.col(col)
        exprs.append(AGG_FUNCS[fn](c).alias(f"{fn}_{'all' if col == '*' else col}"))
    return df.groupBy(*keys).agg(*exprs)


# A08 ------------------------------------------------------------------------
def group_unique(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Distinct values per group as rows (key..., value): scales with any
    number of distinct values per group."""
    return df.select(*keys, col).distinct()


# A09 / A11 -------------------------------------------------------------------
def page(df: DataFrame, order: Sequence[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    out = df.orderBy(*order)
    if offset:
        out = out.offset(int(offset))
    if limit is not None:
        out = out.limit(int(limit))
    return out


# A10 ------------------------------------------------------------------------
def bounds(df: DataFrame, geoms: Sequence[str] = ("geom",), cond: Column | None = None) -> DataFrame:
    """Envelope of all geometry columns, merged across columns; empty -> nulls."""
    if cond is not None:
        df = df.where(cond)
    g = [F.col(c) for c in geoms]
    return df.agg(F.least(*[F.min(c["minx"]) for c in g]).alias("minx") if len(g) > 1 else F.min(g[0]["minx"]).alias("minx"),
                  F.least(*[F.min(c["miny"]) for c in g]).alias("miny") if len(g) > 1 else F.min(g[0]["miny"]).alias("miny"),
                  F.greatest(*[F.max(c["maxx"]) for c in g]).alias("maxx") if len(g) > 1 else F.max(g[0]["maxx"]).alias("maxx"),
                  F.greatest(*[F.max(c["maxy"]) for c in g]).alias("maxy") if len(g) > 1 else F.max(g[0]["maxy"]).alias("maxy"))


def bounds_xy(df: DataFrame, x: str = "lon", y: str = "lat", cond: Column | None = None) -> DataFrame:
    """A10 for point layers kept as two columns."""
    if cond is not None:
        df = df.where(cond)
    return df.agg(F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy"))


# A12 ------------------------------------------------------------------------
def estimated_bounds(catalog: DataFrame, layer_name: str) -> DataFrame:
    """Bounds recorded in the layer catalog at its latest ingest (no data scan)."""
    e = F.col("envelope")
    latest = catalog.where(F.col("layer_name") == layer_name).orderBy(F.desc("cdate"), F.desc("id")).limit(1)
    return latest.select(
        e["minx"].alias("minx"), e["miny"].alias("miny"), e["maxx"].alias("maxx"), e["maxy"].alias("maxy"))


# A13 ------------------------------------------------------------------------
def nearest_value(df: DataFrame, col: str, target) -> DataFrame:
    """Value of ``col`` nearest to ``target`` in one pass: the largest value
    <= target (an exact hit wins), else the smallest above; a tie takes the
    lower value."""
    t = F.lit(target)
    below = F.max(F.when(F.col(col) <= t, F.col(col))).alias("below")
    above = F.min(F.when(F.col(col) > t, F.col(col))).alias("above")
    both = df.agg(below, above)
    pick = (F.when(F.col("below").isNull(), F.col("above"))
            .when(F.col("above").isNull(), F.col("below"))
            .when(F.col("below") == t, F.col("below"))
            .when((t - F.col("below")) <= (F.col("above") - t), F.col("below"))
            .otherwise(F.col("above")))
    return both.select(pick.alias("nearest"))


# A14 ------------------------------------------------------------------------
def accepts(df: DataFrame, partial: Callable[[pd.DataFrame], pd.DataFrame], partial_schema: str,
            merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user aggregate ("visitor") in two phases: ``partial`` runs on every
    Arrow batch of every partition (mapInPandas) and returns a small frame of
    partial states; ``merge`` combines those with Spark aggregates.  No group
    or task ever holds all rows."""

    def run(batches):
        for b in batches:
            out = partial(b)
            if out is not None and len(out):
                yield out

    return merge(df.mapInPandas(run, partial_schema))


# A15 / A16 -------------------------------------------------------------------
def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def contains_count(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """How many of ``others`` are in ``df`` (left-semi join count)."""
    return others.select(key).join(df.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("contained"))


# A18 ------------------------------------------------------------------------
def features_per_cell(cells: DataFrame, block: str = "block") -> DataFrame:
    """Rows per block and multi-cell features (from a layer_cells frame)."""
    return cells.groupBy(block).agg(F.count(F.lit(1)).alias("rows"),
                                    F.sum(F.when(F.col("partition") > 1, 1).otherwise(0)).alias("multi_cell_rows"))
