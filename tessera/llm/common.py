"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from typing import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: The white space that separates words in every contract: space and \x09-\x0D.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the
    lineage, and a lost executor costs only a re-read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name not in ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def only(df: DataFrame, *cols: str) -> DataFrame:
    """Just the named input columns, so extra columns can never clash."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


#: Bytes of text that a Python worker holds as strings at a time, but for one longer text.
PORTION_BYTES = 4 << 20


def portions(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of at most ``most`` bytes of text (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        yield batch.slice(first)


def released(run: Callable, *caches: Callable) -> Callable:
    """``run`` for mapInArrow, after which a task clears ``caches`` and gives its memory back: workers are reused, and
    what one stage leaves would add to the next."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            for clear in caches:
                clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return task
