"""Snapshots of a Parquet layer with checked commits.

A version is one marker file, ``_versions/<number>.json``, that names a manifest: a table of the layer's buckets and
their folders.  A commit writes new folders and a new manifest, then renames its marker into place without
overwriting; of two commits from one version the second finds its number taken.  If the two changed
different buckets, the second is put on top of the first; else it is an error and changes nothing.  The file
system must rename atomically, as HDFS does.

Buckets are prefixes of the key's hash, of as many bits as the layer needs: one that outgrows ``rows_per_bucket``
is split when it is rewritten, the others stay.  A commit writes one folder of files sorted by bucket and key, so
small buckets share a file and a large one has several; a row says by which write and in which bucket it stands, and a reader
takes the files of the buckets it wants and of these the rows that the manifest names.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ConflictError(RuntimeError):
    """Another commit changed the same buckets since this one read the layer."""


class Folder:
    """Small files of a folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.hadoop.Path(self.path).getFileSystem(self.conf)

    def names(self) -> list[str]:
        at = self.hadoop.Path(self.path)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.hadoop.Path(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, name: str, text: str) -> bool:
        """Write a file whole, unless one of that name is there."""
        part = self.hadoop.Path(f"{self.path}/.{uuid.uuid4().hex}")
        out = self.fs.create(part, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        to = self.fs.makeQualified(self.hadoop.Path(f"{self.path}/{name}"))
        options = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            self.hadoop.FileContext.getFileContext(to.toUri(), self.conf).rename(self.fs.makeQualified(part), to, options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            self.fs.delete(part, False)
            return False


@dataclass(frozen=True)
class Bucket:
    """All keys whose hash starts with ``prefix`` of ``depth`` bits (-1: a layer without key); no folder: no rows.  Of the
    folder's files, those that hold some (none named: all)."""
    depth: int
    prefix: int
    path: str | None
    rows: int
    files: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return f"{self.depth}-{self.prefix}"


class SnapshotLayer:
    MANIFEST = "depth int, prefix long, path string, rows long, files array<string>"
    #: Rows of a file of small buckets, at most.
    FILE_ROWS = 1_000_000

    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = 4_000_000):
        self.spark, self.root, self.rows_per_bucket = spark, root.rstrip("/"), rows_per_bucket
        self.versions = Folder(spark, f"{self.root}/_versions")

    # ------------------------------------------------------------------ reading
    def version(self) -> int | None:
        names = [n for n in self.versions.names() if n.endswith(".json") and not n.startswith(".")]
        return max((int(n.split(".")[0]) for n in names), default=None)

    def _marker(self, version: int) -> dict:
        return json.loads(self.versions.read(f"{version:08d}.json"))

    def buckets(self, version: int) -> list[Bucket]:
        """The manifest: a row per bucket, some thousand for a layer of terabytes."""
        rows = self.spark.read.schema(self.MANIFEST).parquet(self._marker(version)["manifest"]).collect()
        return [Bucket(*r[:4], tuple(r[4])) for r in sorted(rows, key=lambda r: (r[0], r[1]))]

    def current(self) -> tuple[int, list[Bucket]] | None:
        v = self.version()
        return None if v is None else (v, self.buckets(v))

    def _frame(self, version: int, buckets: list[Bucket]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self._marker(version)["schema"]))
        held = [b for b in buckets if b.path is not None]
        if not held:
            return self.spark.createDataFrame([], schema)
        if held[0].depth < 0:
            return self.spark.read.schema(schema).parquet(held[0].path)
        paths = sorted({f"{b.path}/{f}" for b in held for f in b.files})
        rows = self.spark.read.schema(T.StructType([*schema.fields, *self.PLACE.fields])).parquet(*paths)
        named = self.spark.createDataFrame([(self._write_of(b.path), b.label) for b in held], self.PLACE)
        return rows.join(F.broadcast(named), self.PLACE.names, "left_semi").select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest (or a given) version."""
        v = self.version() if version is None else version
        if v is None:
            raise ValueError("layer has no snapshot")
        return self._frame(v, self.buckets(v))

    # ------------------------------------------------------------------ writing
    #: The write and the bucket of a row, in the files only.
    PLACE = T.StructType([T.StructField("__write", T.StringType()), T.StructField("__bucket", T.StringType())])

    @staticmethod
    def _write_of(path: str) -> str:
        return path.rsplit("/data-", 1)[1]

    @staticmethod
    def _prefix(key: str, depth: Column) -> Column:
        h = F.xxhash64(F.col(key))
        return F.when(depth <= 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", h, F.lit(64) - depth))

    def _placed(self, df: DataFrame, key: str, buckets: list[Bucket]) -> DataFrame:
        """``df`` with the label of the bucket that holds the row's key (one of ``buckets``, which share no key)."""
        depths = sorted({b.depth for b in buckets})
        known = self.spark.createDataFrame([(b.depth, b.prefix, b.label) for b in buckets], "__depth int, __prefix long, __bucket string")
        at = df.withColumn("__depth", F.explode(F.array(*[F.lit(d) for d in depths])))
        return at.withColumn("__prefix", self._prefix(key, F.col("__depth"))).join(known, ["__depth", "__prefix"]).drop("__depth", "__prefix")

    def _write(self, df: DataFrame, key: str, buckets: list[Bucket]) -> list[Bucket]:
        """Write the rows of ``buckets`` and return them with their new folders."""
        path = f"{self.root}/data-{uuid.uuid4().hex}"
        out = self._placed(df, key, buckets)
        out = out.repartitionByRange("__bucket", key).sortWithinPartitions("__bucket", key).withColumn("__write", F.lit(self._write_of(path)))
        out.write.option("maxRecordsPerFile", max(self.rows_per_bucket, self.FILE_ROWS)).parquet(path)
        there = self.spark.read.schema(self.PLACE).parquet(path).groupBy("__bucket", F.col("_metadata.file_name").alias("file")).count().collect()
        held, files = {}, {}  # a row per bucket and file, about as many as buckets
        for label, file, n in there:
            held[label] = held.get(label, 0) + n
            files.setdefault(label, []).append(file)
        return [Bucket(b.depth, b.prefix, path if b.label in held else None, held.get(b.label, 0), tuple(sorted(files.get(b.label, ())))) for b in buckets]

    def _publish(self, version: int, buckets: list[Bucket], schema: T.StructType, key: str | None) -> bool:
        path = f"{self.root}/_manifests/{uuid.uuid4().hex}"
        rows = [(b.depth, b.prefix, b.path, b.rows, list(b.files)) for b in buckets]
        self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1).write.parquet(path)
        return self.versions.add(f"{version:08d}.json", json.dumps({"manifest": path, "schema": schema.json(), "key": key}))

    def _split(self, depth: int, prefix: int, rows: int) -> list[Bucket]:
        """A bucket as the buckets that hold at most ``rows_per_bucket`` of its rows each, or about so."""
        bits = max(0, math.ceil(math.log2(max(1, rows) / self.rows_per_bucket)))
        return [Bucket(depth + bits, (prefix << bits) + i, None, 0) for i in range(1 << bits)]

    def replace(self, df: DataFrame, key: str | None = None) -> int:
        """Replace all content (a new snapshot).  Without a key the layer is one folder, which every commit rewrites."""
        version = (self.version() or 0) + 1
        if key is None:
            path = f"{self.root}/data-{uuid.uuid4().hex}"
            df.write.parquet(path)
            buckets = [Bucket(-1, 0, path, -1)]
        else:
            buckets = self._write(df, key, self._split(0, 0, df.count()))
        if not self._publish(version, buckets, df.schema, key):
            raise ConflictError(f"version {version} of {self.root} was published by another writer")
        return version

    def commit(self, diff, key: str, base: int | None = None) -> int:
        """A diff on top of the newest version (or of ``base``, the version that the caller read): only the buckets
        of its keys are read and written.  The new version's number."""
        from .dml import read_through

        version = self.version() if base is None else base
        if version is None:
            raise ValueError("layer has no snapshot")
        buckets = self.buckets(version)
        schema = T.StructType.fromJson(json.loads(self._marker(version)["schema"]))
        if buckets[0].depth < 0:
            path = f"{self.root}/data-{uuid.uuid4().hex}"
            read_through(self._frame(version, buckets), diff, key).write.parquet(path)
            touched, new = buckets, [Bucket(-1, 0, path, -1)]
        else:
            one = lambda df, n: df.select(key, F.lit(n).alias("__n"))
            keys = one(diff.removed, -1).unionByName(one(diff.modified, 0)).unionByName(one(diff.added, 1))
            change = {r[0]: r[1] for r in self._placed(keys, key, buckets).groupBy("__bucket").agg(F.sum("__n")).collect()}
            touched = [b for b in buckets if b.label in change]
            self._check(version, touched)  # what is refused need not be written first
            new = []
            if touched:
                parts = [p for b in touched for p in (self._split(b.depth, b.prefix, b.rows + change[b.label])
                                                      if b.rows + change[b.label] > 2 * self.rows_per_bucket else [b])]
                new = self._write(read_through(self._frame(version, touched), diff, key), key, parts)
        gone = {(b.depth, b.prefix) for b in touched}
        while True:
            newest, now = self._check(version, touched)
            if self._publish(newest + 1, [b for b in now if (b.depth, b.prefix) not in gone] + new, schema, key):
                return newest + 1

    def _check(self, version: int, touched: list[Bucket]) -> tuple[int, list[Bucket]]:
        """The newest version and its buckets: what others published since ``version`` stays, unless it is about the same buckets."""
        newest = self.version()
        now = self.buckets(newest)
        if newest != version:
            there = {(b.depth, b.prefix): b for b in now}
            if any(there.get((b.depth, b.prefix)) != b for b in touched):
                raise ConflictError(f"version {newest} of {self.root} changed the same buckets as this commit on version {version}")
        return newest, now
