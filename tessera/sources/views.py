"""SQL views with parameters (S16) and file directories as stores."""

from __future__ import annotations

import re
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

_PARAM = re.compile(r"%([A-Za-z_][A-Za-z0-9_]*)%")


class SqlView:
    """A named SQL text with ``%name%`` parameters, defaults and full-match
    validators.  Only declared names (``params``, a default or a validator) are
    parameters; any other ``%word%``, such as a LIKE pattern, is text.  Values are bound as Spark SQL parameters (never spliced into
    the text), so quoting is the engine's job."""

    def __init__(self, name: str, sql: str, defaults: Mapping[str, object] | None = None,
                 validators: Mapping[str, str] | None = None, params: Sequence[str] = ()):
        self.name, self.sql = name, sql
        self.defaults = dict(defaults or {})
        self.validators = {k: re.compile(v) for k, v in (validators or {}).items()}
        declared = {*params, *self.defaults, *self.validators}
        self.params = [p for p in _PARAM.findall(sql) if p in declared]

    def expand(self, hints: Mapping[str, object] | None = None) -> tuple[str, dict]:
        values = dict(self.defaults)
        values.update(hints or {})
        args = {}
        for p in self.params:
            if p not in values:
                raise ValueError(f"view {self.name}: no value for parameter {p!r}")
            v = values[p]
            rx = self.validators.get(p)
            if rx is not None and not rx.fullmatch(str(v)):
                raise ValueError(f"view {self.name}: value {v!r} rejected for parameter {p!r}")
            args[p] = v
        return _PARAM.sub(lambda m: f":{m.group(1)}" if m.group(1) in args else m.group(0), self.sql), args

    def frame(self, spark: SparkSession, hints: Mapping[str, object] | None = None) -> DataFrame:
        text, args = self.expand(hints)
        return spark.sql(text, args=args) if args else spark.sql(text)

    def schema(self, spark: SparkSession, hints: Mapping[str, object] | None = None):
        """Column types from an empty probe (no rows read)."""
        return self.frame(spark, hints).limit(0).schema

    def register(self, spark: SparkSession, hints: Mapping[str, object] | None = None) -> DataFrame:
        df = self.frame(spark, hints)
        df.createOrReplaceTempView(self.name)
        return df

    def drop(self, spark: SparkSession) -> None:
        spark.catalog.dropTempView(self.name)


def layers(spark: SparkSession, path: str, fmt: str = "parquet", glob: str | None = None) -> dict[str, DataFrame]:
    """Every top-level file or folder of a folder as a layer of its own schema, by its
    name without extension.  Only file names are listed on the driver, never rows."""
    base = path.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        files = files.option("pathGlobFilter", glob)
    tail = F.element_at(F.split("path", "/" + re.escape(base.rsplit("/", 1)[-1]) + "/", 2), 2)
    top = F.substring_index(tail, "/", 1)
    names = sorted(r[0] for r in files.load(base).select(top.alias("top")).distinct().collect())
    out = {}
    for name in names:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True).option("escape", '"')
        stem = name.rsplit(".", 1)[0] if "." in name[1:] else name
        if stem in out:
            raise ValueError(f"two entries of {path!r} give the layer {stem!r}")
        out[stem] = reader.load(f"{base}/{name}")
    return out


def read_directory(spark: SparkSession, path: str, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """All layers of a folder as one frame (columns by name, missing ones null) with ``layer``."""
    frames = [df.withColumn("layer", F.lit(name)) for name, df in layers(spark, path, fmt, glob).items()]
    if not frames:
        raise ValueError(f"no layers in {path!r}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --------------------------------------------------------------------------
# refresh on change
# --------------------------------------------------------------------------
LISTING = "version long, path string, length long, modified timestamp"


def listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of all files of a folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        files = files.option("pathGlobFilter", glob)
    return files.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


class FolderStore:
    """A folder of files as one layer that is kept in Parquet and refreshed on change.

    The store remembers the path, size and time of every file it has read, and holds a file's rows under the
    file's own partition.  ``refresh`` compares the folder with that list: new and changed files are read
    again, those of removed files are left out, the others are not touched.  A refresh that failed is repeated: partitions
    are replaced whole, and the list follows the data."""

    def __init__(self, spark: SparkSession, folder: str, store: str, fmt: str = "parquet", glob: str | None = None):
        self.spark, self.folder, self.store, self.fmt, self.glob = spark, folder.rstrip("/"), store.rstrip("/"), fmt, glob

    def known(self) -> DataFrame:
        """The list at the last refresh; empty before the first."""
        from ..operators.snapshots import Folder

        if not Folder(self.spark, f"{self.store}/_files").names():
            return self.spark.createDataFrame([], LISTING)
        log = self.spark.read.schema(LISTING).parquet(f"{self.store}/_files")
        return log.join(log.agg(F.max("version").alias("version")), "version", "left_semi")

    def changes(self) -> DataFrame:
        """(path, change) of the files that are added, changed or removed since the last refresh."""
        now, old = listing(self.spark, self.folder, self.glob), self.known()
        both = now.withColumn("here", F.lit(True)).join(old.select("path", F.col("length").alias("l0"), F.col("modified").alias("m0"), F.lit(True).alias("there")), "path", "full")
        same = F.col("length").eqNullSafe(F.col("l0")) & F.col("modified").eqNullSafe(F.col("m0"))
        kind = F.when(F.col("there").isNull(), "added").when(F.col("here").isNull(), "removed").when(~same, "changed")
        return both.select("path", kind.alias("change")).where(F.col("change").isNotNull())

    def refresh(self) -> dict[str, int]:
        """Bring the store up to date; the number of files by kind of change."""
        now = stored(listing(self.spark, self.folder, self.glob), "listing")
        found = self.changes().collect()  # names of changed files only
        again = [r["path"] for r in found if r["change"] != "removed"]
        version = (self.known().agg(F.max("version")).first()[0] or 0) + 1
        if again:
            reader = self.spark.read.format(self.fmt)
            if self.fmt == "csv":
                reader = reader.option("header", True).option("escape", '"')
            rows = reader.load(again).withColumn("file", F.sha2(F.col("_metadata.file_path"), 256))
            rows.repartitionByRange("file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(f"{self.store}/rows")
        if found:
            now.select(F.lit(version).cast("long").alias("version"), "path", "length", "modified").write.mode("append").parquet(f"{self.store}/_files")
        return {k: sum(r["change"] == k for r in found) for k in ("added", "changed", "removed")}

    def read(self) -> DataFrame:
        """The rows of all files that the folder had at the last refresh."""
        files = self.known().select(F.sha2("path", 256).alias("file"))
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.store}/rows").join(files, "file", "left_semi").drop("file")
