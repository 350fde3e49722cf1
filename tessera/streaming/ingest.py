"""Continuous trajectory ingest (S20 as a Structured Streaming job).

New ``id,time,lon,lat`` text files in a folder become rows of the
cell-partitioned track store: the same columns as the batch ingest (leaf
cell, level-12 block, hour epoch), one folder per micro-batch, partitioned by
day and sorted by hour and cell.  A batch that is run again overwrites its own
folder, and the checkpoint lives in the shared folder the session names, so a restarted
job neither loses nor doubles rows.
The reference has no streaming operator; this only re-expresses its ingest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..sources.cellstore import track_columns, write_track

TRACK_TEXT_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("time", T.StringType()),
                                  T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])


def track_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    raw = (spark.readStream.schema(TRACK_TEXT_SCHEMA).option("header", False)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))
    pts = raw.select("id", F.to_timestamp("time", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("ts"),
                     "lon", "lat")
    return track_columns(pts)


def start_ingest(spark: SparkSession, folder: str, store_path: str, name: str = "track_ingest",
                 trigger_seconds: int | None = None, available_now: bool = False):
    ckpt = ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_track(batch, f"{store_path.rstrip('/')}/batch={batch_id}")

    w = track_stream(spark, folder).writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
