"""Ranks, running sums and look-ups that no hot key can push into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: A class with more than one row in HEAVY is broadcast; there are fewer than HEAVY of them.
HEAVY = 1000


def running(df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with the running sum of each of ``sums`` within ``by`` (its own row included), in ``order`` (nulls
    first), and the group's sum as ``all_<sum>``.  ``by`` must not be null; ``order`` must tell all rows apart.

    Rows are range partitioned by group and order, so a hot group spreads over many tasks;
    each task sums its ranges, and the ranges' sums (a row for each range and group in it) give the offsets.
    """
    # the range partitions are fixed by being written, so offsets and rows always agree
    placed = stored(df.withColumns({f"__v_{s}": c.cast("long") for s, c in sums.items()})
                    .repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()), name)
    own = Window.partitionBy("__range", *by)
    local = placed.withColumns({s: F.sum(f"__v_{s}").over(own.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) for s in sums})
    part = placed.groupBy("__range", *by).agg(*[F.sum(f"__v_{s}").alias(f"__n_{s}") for s in sums])
    group = Window.partitionBy(*by)
    before = part.select("__range", *by, *[(F.sum(f"__n_{s}").over(group.orderBy("__range")) - F.col(f"__n_{s}")).alias(f"__b_{s}") for s in sums],
                         *[F.sum(f"__n_{s}").over(group).alias(f"all_{s}") for s in sums])
    out = local.join(before, ["__range", *by])
    return out.select(*df.columns, *[(F.col(s) + F.col(f"__b_{s}")).alias(s) for s in sums], *[f"all_{s}" for s in sums])


def look_up(rows: DataFrame, classes: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` joined with the ``classes`` of their keys, which must not be null; ``n`` of a class is its number of
    rows, ``total`` that of all.  Classes above one row in HEAVY, fewer than HEAVY of them, are broadcast; the
    others are joined on the keys, where no key has more than one row in HEAVY.  ``rows`` is read twice."""
    heavy = classes.where(F.col(n) * HEAVY > F.lit(total))
    light = classes.where(F.col(n) * HEAVY <= F.lit(total))
    marked = rows.join(F.broadcast(heavy.select(*keys, F.lit(True).alias("__heavy"))), keys, "left")
    rest = marked.where(F.col("__heavy").isNull()).drop("__heavy")
    return rest.join(light, keys).unionByName(rows.join(F.broadcast(heavy), keys))
