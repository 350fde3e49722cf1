"""Exact deduplication by content hash.

Method: texts are normalised (every run of white space becomes one space) and hashed to 128
bits.  Rows are grouped by hash and, inside a hash, by the bytes of the text, so a collision
splits a hash into as many classes as it has texts.  A class keeps its smallest id.

Scale: the grouping combines copies on the map side, so a text crosses the network at most
once per task that holds it, however many copies there are.  Classes carry no text.
Rows then find their class by hash; classes with more than one row in a thousand are
broadcast (at most a thousand exist), so a hot text is never one task's work.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, stored
from .spread import look_up


def normalised(text: str | Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    # a lone space is left alone, so the expression only stops where something changes
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")


def content_hash(text: str | Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            hashed: Callable[[str], Column] = content_hash) -> DataFrame:
    """Per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Null and empty texts are one text.  Rows that repeat an id and its text are one
    document: where the id stays, all of them are kept, and each counts in group_size.  A null id stays only
    where no row of the text has an id (keep_id is then null).  Extra columns are not read; an empty table
    gives an empty result.  ``hashed`` may be any hash: results do not depend on it.
    """
    src = only(docs, id_col, text_col).toDF("id", "text").select("id", normalised("text").alias("text")).withColumn("hash", hashed("text"))

    def by_bytes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("hash", "text").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))

    found = stored(by_bytes(src).select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "classes")
    rows = stored(src.select("id", "hash"), "hashes")
    total = found.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    clash = stored(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "clash")
    if clash.isEmpty():  # one text a hash: the hash names the class
        out = look_up(rows, found, ["hash"], "group_size", total)
    else:
        mixed = src.join(clash, "hash", "left_semi")
        apart = mixed.join(by_bytes(mixed), ["hash", "text"]).withColumn("text_sha256", F.sha2("text", 256)).drop("text")
        out = look_up(rows.join(clash, "hash", "left_anti"), found.join(clash, "hash", "left_anti"), ["hash"], "group_size", total).unionByName(apart)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept; rows without an id are compared only by ``classes``."""
    gone = classes(docs, id_col, text_col).where(~F.col("kept") & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"].eqNullSafe(F.col("__gone")), "left_anti")
