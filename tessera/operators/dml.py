"""Changes on Parquet layers.

A layer is never overwritten in place: every commit writes a new snapshot (``snapshots``), so a
reader of the old one is never disturbed and a failed job leaves it current.  Diffs are DataFrames keyed by fid: ``removed`` (fids),
``modified`` and ``added`` (full rows); reading through a diff is an anti join
plus a union, never a driver-side loop.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .snapshots import ConflictError, SnapshotLayer  # noqa: F401


# D04 -------------------------------------------------------------------------
def assign_keys(df: DataFrame, base: DataFrame | None, key: str, policy: str = "provided") -> DataFrame:
    """New-key policy: ``provided`` (as is), ``max_plus_one`` (previous max + 1,
    consecutive, computed without a single-task window) or ``uuid``."""
    if policy == "provided":
        if key not in df.columns:
            raise ValueError("provided keys need the key column")
        return df
    if policy == "uuid":
        return df.withColumn(key, F.expr("uuid()"))
    if policy != "max_plus_one":
        raise ValueError(f"unknown key policy {policy!r}")
    start = 0
    if base is not None:
        mx = base.agg(F.max(key)).first()[0]
        start = 0 if mx is None else int(mx)
    # row index = offset of the partition + index inside it: a per-partition
    # count (one row per partition) replaces a global row_number.  Partition ids are
    # written once: counting and joining two evaluations could disagree
    tagged = df.withColumn("__mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__pid", F.shiftright("__mid", 33)) \
                   .withColumn("__idx", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    tagged = stored(tagged, "new-keys")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window

    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("__pid", "__off")), "__pid")  # one row per partition
    return out.withColumn(key, (F.lit(start) + F.col("__off") + F.col("__idx") + 1).cast("long")) \
              .drop("__mid", "__pid", "__idx", "__off")


# D03 -------------------------------------------------------------------------
def insert(base: DataFrame, new: DataFrame, key: str, policy: str = "provided",
           not_null: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of ``new`` appended to ``base``; returns (result, inserted fids).
    Not-null columns are checked with ``raise_error`` (the job fails)."""
    rows = assign_keys(new, base, key, policy)
    for c in not_null:
        rows = rows.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null value in {c}")))
                               .otherwise(F.col(c)))
    return base.unionByName(rows.select(*base.columns)), rows.select(key)


# D05 -------------------------------------------------------------------------
def update(df: DataFrame, cond: Column, assignments: Mapping[str, Column | object], pk: Sequence[str] = ()) -> DataFrame:
    cols = {c: v for c, v in assignments.items() if c not in pk}
    if not cols:
        raise ValueError("update touches only primary key columns")
    hit = F.coalesce(cond, F.lit(False))
    out = df
    for c, v in cols.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(hit, val.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out


# D06 -------------------------------------------------------------------------
def delete(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(~F.coalesce(cond, F.lit(False)))


# D08 -------------------------------------------------------------------------
def upsert(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Update-else-insert: rows of ``new`` replace rows with the same key."""
    return new.select(*base.columns).unionByName(base.join(new.select(key), key, "left_anti"))


# D09 -------------------------------------------------------------------------
@dataclass
class Diff:
    removed: DataFrame     # one column: key
    modified: DataFrame    # full rows
    added: DataFrame       # full rows


def read_through(base: DataFrame, diff: Diff, key: str) -> DataFrame:
    gone = diff.removed.select(key).unionByName(diff.modified.select(key))
    kept = base.join(gone, key, "left_anti")
    return kept.unionByName(diff.modified.select(*base.columns)).unionByName(diff.added.select(*base.columns))


# D11 -------------------------------------------------------------------------
def change_summary(base: DataFrame, diff: Diff, key: str, value: str | None = None,
                   geom: str | None = None) -> DataFrame:
    """Per change kind: rows affected (and value total / bounds).  Modified
    rows report their old values too (old bounds, as feature events do)."""
    old_mod = base.join(diff.modified.select(key), key, "left_semi")
    old_rem = base.join(diff.removed.select(key), key, "left_semi")
    parts = [diff.added.withColumn("change", F.lit("added")),
             diff.modified.withColumn("change", F.lit("modified")),
             old_mod.withColumn("change", F.lit("modified_old")),
             old_rem.withColumn("change", F.lit("removed"))]
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p.select(*allrows.columns))
    aggs = [F.count(F.lit(1)).alias("rows")]
    if value:
        aggs.append(F.round(F.sum(value), 2).alias("total"))
    if geom:
        g = F.col(geom)
        aggs += [F.min(g["minx"]).alias("minx"), F.min(g["miny"]).alias("miny"),
                 F.max(g["maxx"]).alias("maxx"), F.max(g["maxy"]).alias("maxy")]
    return allrows.groupBy("change").agg(*aggs)
