"""Station time series (S21): nested maps <-> a long table.

The reference keeps, per station, ``timestamp -> {metric -> value}``.  The
long form (station_id, ts, metric, value) is what Spark filters, joins and
aggregates well; the nested form is rebuilt per (station, ts), a group whose
size is the number of metrics of one observation (bounded), never a whole
series in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, station: str = "station_id", ts: str = "ts", records: str = "records") -> DataFrame:
    """(station, ts, map<metric, value>) -> (station, ts, metric, value)."""
    return df.select(station, ts, F.explode(records).alias("metric", "value"))


def to_observations(long: DataFrame, station: str = "station_id", ts: str = "ts") -> DataFrame:
    """Long rows -> one map of metrics per (station, ts)."""
    return long.groupBy(station, ts).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("records"))
