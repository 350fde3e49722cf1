"""Merkle manifest of a data set with incremental witnesses.

Method: leaves are appended in order to an open tree.  Every completed subtree holds a partial witness:
the siblings of its run that are complete so far, before and after it.  A sibling that completes later
extends the witnesses of those before it; a full run completes the next higher subtree, which is appended one
level up.  A leaf's witness is the chain of its subtrees' witnesses.

Scale: a tree is cut into aligned blocks of FAN ** HEIGHT leaves, each streamed by one task.
The roots of the blocks are appends of the next round, cut into blocks likewise, until one node is left: a
round divides the rows by 729, so 10 ** 12 leaves take five.  Block paths return round by round to the
leaves, and no key of these joins has more rows than a block.  Positions come from range partitions and
their counts, so a hot source spreads over all tasks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, stored
from .spread import running

FAN, HEIGHT = 3, 6
BLOCK = FAN ** HEIGHT


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Subtree:
    """A completed subtree: its digest, its partial witness and the subtree it is part of."""

    __slots__ = ("digest", "left", "right", "above")

    def __init__(self, digest: str):
        self.digest, self.left, self.right, self.above = digest, "", "", None


class OpenTree:
    """Aligned append: ``runs[i]`` holds the complete subtrees of height i whose run is open."""

    def __init__(self):
        self.runs: list[list[Subtree]] = [[]]
        self.leaves: list[Subtree] = []

    def append(self, digest: str) -> None:
        leaf = Subtree(digest)
        self.leaves.append(leaf)
        self._complete(leaf, 0)

    def _complete(self, new: Subtree, height: int) -> None:
        if height == len(self.runs):
            self.runs.append([])
        run = self.runs[height]
        for old in run:  # the later sibling extends the witnesses there are
            old.right += new.digest
            new.left += old.digest
        run.append(new)
        if len(run) == FAN:
            self._end(height)

    def _end(self, height: int) -> None:
        run, self.runs[height] = self.runs[height], []
        above = Subtree(_digest("".join(x.digest for x in run)))
        for x in run:
            x.above = above
        self._complete(above, height + 1)

    def close(self, height: int | None = None) -> str:
        """End short runs: up to ``height``, or until one node is left.  The digest at the top."""
        at = 0
        while at < (len(self.runs) if height is None else height):
            alone = height is None and len(self.runs[at]) == 1 and not any(self.runs[at + 1:])
            if alone:
                break
            if self.runs[at]:
                self._end(at)
            at += 1
        return self.runs[at][0].digest

    def witness(self, leaf: int) -> tuple[list[str], list[str]]:
        """The siblings before and after, from the leaf's level up."""
        left, right, node = [], [], self.leaves[leaf]
        while node.above is not None:
            left.append(node.left)
            right.append(node.right)
            node = node.above
        return left, right


def _block(t: pa.Table) -> pa.Table:
    """A block's leaves in order, with their witnesses inside the block and the block's root."""
    t = t.sort_by("pos")
    tree = OpenTree()
    for x in t.column("node").to_pylist():
        tree.append(x)
    top = tree.close(HEIGHT if t.column("size")[0].as_py() > BLOCK else None)
    both = [tree.witness(i) for i in range(t.num_rows)]
    lists = pa.list_(pa.string())
    return (t.append_column("left", pa.array([x for x, _ in both], lists)).append_column("right", pa.array([x for _, x in both], lists))
            .append_column("top", pa.array([top] * t.num_rows, pa.string())))


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of nodes (tree, pos, size, node, more columns), then blocks of their roots, until a tree is one block."""
    rounds = []
    while True:
        block = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
        more = [T.StructField("left", T.ArrayType(T.StringType())), T.StructField("right", T.ArrayType(T.StringType())), T.StructField("top", T.StringType())]
        done = stored(block.groupBy("tree", "block").applyInArrow(_block, T.StructType([*block.schema.fields, *more])), "blocks")
        rounds.append(done)
        nodes = done.where(f"pos % {BLOCK} = 0").select("tree", F.col("block").alias("pos"), F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"),
                                                        F.col("top").alias("node"))
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            return rounds


def _down(rounds: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The first round's rows with their whole paths; ``tops`` (tree, left, right, top) continue the paths of whole trees."""
    path = None
    for rows in reversed(rounds):
        if path is None:
            above = tops and tops.select("tree", F.lit(0).cast("long").alias("block"), F.col("left").alias("l"), F.col("right").alias("r"), F.col("top").alias("t"))
        else:
            above = path.select("tree", F.col("pos").alias("block"), F.col("left").alias("l"), F.col("right").alias("r"), F.col("top").alias("t"))
        path = rows
        if above is not None:
            path = rows.join(above, ["tree", "block"]).withColumns({"left": F.concat("left", "l"), "right": F.concat("right", "r"), "top": F.col("t")}).drop("l", "r", "t")
    return path


def leaf_hash(*cols: str) -> Column:
    """SHA-256 over the values: ``-`` for null, else byte count, colon, value."""
    def one(c):
        s = F.col(c).cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[one(c) for c in cols]), 256)


def manifest(leaves: DataFrame, id_col: str = "doc_id", group_col: str = "source", leaf_col: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot`` (of the row's group), ``root``, and the witness up to the root: ``left`` and
    ``right``, per level the joined digests of the siblings before and after.

    Leaves of a group ascend by id, null ids first, equal ids by leaf; repeated rows are leaves like others.  A null
    group is a group of its own and comes first; groups ascend bytewise.  Leaves must not be null.  All columns of
    ``leaves`` return, except that columns named like these four are replaced.  An empty table gives an empty result.
    """
    carried = [c for c in leaves.columns if c not in ("subroot", "root", "left", "right")]
    tree = F.when(F.col(f"`{group_col}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(f"`{group_col}`").cast("string")))
    base = stored(leaves.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{leaf_col}`").alias("node"),
                                tree.alias("tree"), F.monotonically_increasing_id().alias("tie")), "leaves")
    placed = running(base, ["tree"], ["id", "node", "tie"], {"pos": F.lit(1)}, "placed")
    placed = placed.select("tree", (F.col("pos") - 1).alias("pos"), F.col("all_pos").alias("size"), "node", "row")
    rounds = _rounds(placed)
    subroots = stored(rounds[-1].where("pos = 0").select("tree", F.col("top").alias("node")), "subroots")
    one = subroots.select(F.lit("").alias("tree"), "node", F.col("tree").alias("group"))
    groups = running(one, ["tree"], ["group"], {"pos": F.lit(1)}, "groups").select("tree", (F.col("pos") - 1).alias("pos"), F.col("all_pos").alias("size"), "node", "group")
    tops = _down(_rounds(groups)).select(F.col("group").alias("tree"), F.col("left"), F.col("right"), F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top"))
    whole = _down(rounds, tops)
    return whole.select(*[F.col("row")[c].alias(c) for c in carried], F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), "left", "right")


def folded(leaf: str | Column) -> Column:
    """The root that a leaf and the witness ``left``, ``right`` lead to."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(F.arrays_zip("left", "right"), leaf, lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]), 256))


def proof() -> Column:
    """The digests of the witness, level by level, left to right."""
    return F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")


def signed(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """The manifest of a table: id, group, ``leaf``, ``subroot``, ``root``, ``left``, ``right`` per row."""
    rows = only(docs, *dict.fromkeys([id_col, group_col, *columns])).withColumn("leaf", leaf_hash(*columns))
    return manifest(rows.select(id_col, group_col, "leaf"), id_col, group_col)
