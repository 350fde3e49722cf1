"""Sharding: proportional stratified interleaving.

Method: rows of a source are shuffled by a seeded hash and ranked; row r of a source of n rows gets
the fractional rank (r + 1/2) / n.  Sorting all rows by it spreads every source evenly, so equal
consecutive cuts give shards whose counts differ by at most one and which all
match the mixture.

Scale: no rank is taken in one task.  A source is split into HASH_BINS hash ranges, the
fractional ranks into RANK_BINS ranges; rows are numbered within a range and the
ranges' counts give its offset.  Only ids, sizes and checksums are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, stored

#: Ranges of a source's hashes (a power of two) and of fractional ranks.
HASH_BITS, RANK_BINS = 12, 8192


def _offsets(rows: DataFrame, by: list[str], at: str) -> DataFrame:
    """Rows before each range ``at`` (within ``by``), and in all of ``by``."""
    count = rows.groupBy(*by, at).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*by)
    return count.select(*by, at, (F.sum("__n").over(w.orderBy(at)) - F.col("__n")).alias("__before"),
                        F.sum("__n").over(w).alias("__all"))


def interleave(docs: DataFrame, shards: int = 8, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """Per row: id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null).

    A null text counts as none (size 1, checksum 0); rows with a null source form a source
    of their own; null and repeated ids are ordinary rows (equal rows are
    interchangeable).  Equal texts are not kept together: the law is on rows.  Extra columns are
    not read; an empty table gives an empty result.
    """
    t = only(docs, id_col, text_col, source_col).toDF("id", "text", "source")
    base = stored(t.select(
        "id", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("s"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("id", F.lit(seed)).alias("h")), "shards")
    total = base.count()
    ties = ["h", "id", "text_crc32", "size"]
    binned = base.withColumn("bin", F.shiftright("h", 64 - HASH_BITS))
    own = Window.partitionBy("s", "bin").orderBy(*ties)
    ranked = binned.withColumn("r", F.row_number().over(own) - 1).join(_offsets(binned, ["s"], "bin"), ["s", "bin"])
    ranked = ranked.withColumn("f", (F.col("r") + F.col("__before") + 0.5) / F.col("__all")).drop("__before", "__all", "r", "bin")
    ranked = stored(ranked.withColumn("bin", F.floor(F.col("f") * RANK_BINS).cast("int")), "ranked")
    # RANK_BINS counts, whatever the size
    before = _offsets(ranked.withColumn("one", F.lit(1)), ["one"], "bin").select("bin", "__before")
    order = Window.partitionBy("bin").orderBy("f", F.xxhash64("s", F.lit(seed)), "s", *ties)
    g = (F.row_number().over(order) - 1)
    out = ranked.withColumn("g", g).join(before, "bin").withColumn("g", F.col("g") + F.col("__before"))
    shard = F.expr(f"cast(g * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    out = out.withColumn("shard", shard).withColumn("slot", (F.col("g") - first).cast("long"))
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("s").substr(2, 1 << 30).alias("mix_source"))
