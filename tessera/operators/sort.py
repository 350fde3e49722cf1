"""Nearest features (W05); sort and page are in plans.query.

``nearest`` is a distance column plus ``orderBy(dist, fid).limit(k)``: Spark
plans it as TakeOrderedAndProject (a top-k per partition, then a merge of
k rows per partition), so it never sorts the layer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import relate
from ..functions.geometry import Geom
from ..functions.predicates import distance
from ..session import spread, stored
from .joins import PIECES, _is_segment, _point_segment, _unknown, _vertex


def nearest(df: DataFrame, geom: str, target: Geom, k: int, cond: Column | None = None, fid: str = "fid",
            point_layer: bool = False) -> DataFrame:
    """The ``k`` features nearest to ``target`` (ties by fid), with an
    optional extra filter."""
    if cond is not None:
        df = df.where(cond)
    d = distance(geom, target, point_layer=point_layer)
    return df.withColumn("dist", d).orderBy(F.col("dist").asc(), F.col(fid).asc()).limit(int(k))


#: Features of a leaf of the neighbour tree, cells a side of a split, and most splits.
LEAF, SIDE, DEPTH = 64, 4, 14


def _nearest_gap(n) -> Column:
    """Smallest distance of the left box and a box (``n``: name of a bound -> column)."""
    gap = lambda d: F.greatest(n(f"{d}1") - F.col(f"l{d}2"), F.col(f"l{d}1") - n(f"{d}2"), F.lit(0.0))
    return F.sqrt(gap("x") ** 2 + gap("y") ** 2)


def _farthest_gap(n) -> Column:
    """No feature of a box is farther from any place in the left box.  A connected feature reaches across its box, so it comes
    as near in one dimension as its ends there (u1, u2) let it; other features have their ends swapped and may lie in any corner."""
    far = lambda d: F.greatest(n(f"{d}2") - F.col(f"l{d}1"), F.col(f"l{d}2") - n(f"{d}1"))
    reach = lambda d: F.greatest(n(f"u{d}1") - F.col(f"l{d}1"), F.col(f"l{d}2") - n(f"u{d}2"), F.lit(0.0))
    return F.sqrt(F.least(reach("x") ** 2 + far("y") ** 2, far("x") ** 2 + reach("y") ** 2))


def _to_feature(n, gap) -> Column:
    """``gap`` to a feature's box, or the distance itself of a point and a two-point line (a to b), in plain columns."""
    line = _point_segment(F.col("lx1"), F.col("ly1"), *[n(c) for c in ("ax", "ay", "bx", "by")])
    point = (F.col("lx1") == F.col("lx2")) & (F.col("ly1") == F.col("ly2"))
    return F.coalesce(F.when(point & n("ax").isNotNull(), line), gap(n))


_BOX = ["x1", "y1", "x2", "y2", "ux1", "uy1", "ux2", "uy2"]
_ENDS = ["ax", "ay", "bx", "by"]


def _pieces(df: DataFrame, longest: float) -> DataFrame:
    """Features with their boxes; two-point lines longer than ``longest`` stand as up to PIECES equal pieces, as the box of a
    slanted line says little."""
    g = F.col("__g")
    a, b = _vertex(g, 0), _vertex(g, 1)
    known = _is_segment(g) & a["x"].isNotNull() & a["y"].isNotNull() & b["x"].isNotNull() & b["y"].isNotNull()
    long = F.greatest(g["maxx"] - g["minx"], g["maxy"] - g["miny"])
    n = F.when(known & (long > longest), F.least(F.ceil(long / F.lit(max(longest, 1e-300))), F.lit(float(PIECES))).cast("int")).otherwise(1)
    out = df.withColumns({"__n": n, "linked": F.coalesce(g["kind"].isin("Point", "LineString", "Polygon") & (F.size(g["parts"]) == 1) & ~_unknown(g), F.lit(False)),
                          **{f"{e}{d}": F.when(known, v[d]) for e, v in (("a", a), ("b", b)) for d in "xy"}})
    out = out.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    for d in "xy":
        at = lambda i, d=d: F.col(f"a{d}") + (F.col(f"b{d}") - F.col(f"a{d}")) * i / F.col("__n")
        first, last = at(F.col("__i")), at(F.col("__i") + 1)
        cut = F.col("__n") > 1
        out = out.withColumns({f"{d}1": F.when(cut, F.least(first, last)).otherwise(g[f"min{d}"]), f"{d}2": F.when(cut, F.greatest(first, last)).otherwise(g[f"max{d}"])})
        out = out.withColumns({f"u{d}1": F.when(F.col("linked"), F.col(f"{d}1")).otherwise(F.col(f"{d}2")), f"u{d}2": F.when(F.col("linked"), F.col(f"{d}2")).otherwise(F.col(f"{d}1"))})
    return out.select("rid", "rkey", *_BOX, *_ENDS)


def _tree(rows: DataFrame, k: int, whole, cut: bool) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Features by leaf, the cells of each level by their parent, and some features of each cell where a way down may end.

    A cell with more than LEAF is split into SIDE x SIDE within the extent of its own centres; each has its tight box and ``m``, the
    number of features in it."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    extent = [F.min(cx).alias("x0"), F.min(cy).alias("y0"), F.greatest(F.max(cx) - F.min(cx), F.max(cy) - F.min(cy)).alias("side")]
    box = [f(c).alias(c) for c, f in zip(_BOX, (F.min, F.min, F.max, F.max, F.max, F.max, F.min, F.min))]
    step = lambda c, low: F.when(F.col("side") > 0, F.least(F.floor((c - F.col(low)) / F.col("side") * SIDE), F.lit(SIDE - 1))).otherwise(0)
    dense = rows.sparkSession.createDataFrame([(1, whole["x0"], whole["y0"], whole["side"])], "node long, x0 double, y0 double, side double")
    rows, found, levels, some = rows.withColumn("node", F.lit(1).cast("long")), [], [], []
    own = Window.partitionBy("at").orderBy("rkey", *_BOX)
    for depth in range(1, DEPTH + 1):
        split = rows.join(F.broadcast(dense) if depth == 1 else dense, "node")
        rows = stored(split.withColumn("node", (F.col("node") * SIDE + step(cx, "x0")) * SIDE + step(cy, "y0")).drop("x0", "y0", "side"), "knn-right")
        cells = rows.groupBy("node").agg(F.count("*").alias("n"), (F.count_distinct("rkey") if cut else F.count("*")).alias("m"), *box, *extent)
        cells = cells.withColumn("dense", (F.col("n") > LEAF) & (F.col("side") > 0) & F.lit(depth < DEPTH)).withColumn("parent", F.expr(f"node div {SIDE * SIDE}"))
        cells = stored(cells, "knn-cells")
        kids = cells.groupBy("parent").agg(F.collect_list(F.struct("node", "m", "dense", *_BOX)).alias("kids"))  # at most SIDE x SIDE
        levels.append(stored(kids, "knn-kids"))
        found.append(rows.join(cells.where("NOT dense").select("node"), "node", "left_semi"))
        ends = cells.where((F.col("m") >= k) & ~F.col("dense")).select(F.col("node").alias("at"), "node")
        stuck = cells.groupBy("parent").agg(F.max("m").alias("m")).where(F.col("m") < k).select(F.col("parent").alias("at"))
        ends = ends.unionByName(cells.join(stuck, cells["parent"] == stuck["at"]).select("at", "node"))
        some.append(rows.join(ends, "node").withColumn("__o", F.row_number().over(own)).where(F.col("__o") <= max(LEAF, 4 * k)))
        dense = cells.where("dense").select("node", "x0", "y0", "side")
        if dense.isEmpty():
            break
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    sample = union(some).groupBy("at").agg(F.collect_list(F.struct("rkey", *_BOX, *_ENDS)).alias("sample"))
    return union(found), levels, sample


def knn_join(left: DataFrame, right: DataFrame, k: int, *, left_id: str = "fid", right_id: str = "fid_r",
             left_geom: str = "geom", right_geom: str = "geom_r") -> DataFrame:
    """W05 per row: the ``k`` nearest right features of every left feature of any kind (planar distance, 0 where they
    meet; ties by right id), exact; all right features where there are fewer than ``k``.  Rows with a null
    geometry have no neighbours.  Ids must be unique.

    The right features, of which equal ones beyond the k smallest ids never count, form a tree of cells.  Each left row goes down once, to
    the cell whose k features are surely nearest; distances to some features there bound the k-th.  Then it goes down
    again to all cells that begin within the bound.  So a row meets a few cells a level and the features of a few leaves,
    whether the layers are dense, sparse or apart, and only features within the bound are shuffled."""
    empty = left.limit(0).select(F.col(left_id), F.lit(None).cast(right.schema[right_id].dataType).alias(right_id),
                                 F.lit(None).cast("double").alias("dist"), F.lit(None).cast("int").alias("rank"))
    lg = F.col(left_geom)
    L = left.where(lg["minx"].isNotNull()).select(F.col(left_id).alias("lid"), *[lg[f"min{d}"].alias(f"l{d}1") for d in "xy"], *[lg[f"max{d}"].alias(f"l{d}2") for d in "xy"])
    R = right.where(F.col(right_geom)["minx"].isNotNull()).select(F.col(right_id).alias("rid"), F.col(right_geom).alias("__g"))
    g = F.col("__g")
    biggest = lambda *c: F.max(F.greatest(*[F.abs(x) for x in c]))
    here = L.agg(F.coalesce(F.bool_and((F.col("lx1") == F.col("lx2")) & (F.col("ly1") == F.col("ly2"))), F.lit(True)).alias("points"),
                 biggest(*[F.col(c) for c in L.columns[1:]]).alias("size")).first()
    there = R.agg(F.bool_and((g["minx"] == g["maxx"]) & (g["miny"] == g["maxy"])).alias("points"), biggest(g["minx"], g["miny"], g["maxx"], g["maxy"]).alias("size"),
                  F.max(g["maxx"]).alias("x2"), F.max(g["maxy"]).alias("y2"), F.min(g["minx"]).alias("x1"), F.min(g["miny"]).alias("y1"),
                  F.bool_or(_is_segment(g)).alias("lines")).first()
    if there["size"] is None or here["size"] is None:
        return empty
    points = here["points"] and there["points"]
    if not points:
        R = R.where(F.col("rid").isNotNull())
    same = Window.partitionBy(*([g["minx"], g["miny"]] if points else [g])).orderBy("rid")
    R = R.withColumn("__first", F.row_number().over(same)).where(F.col("__first") <= k).drop("__first")
    R = spread(R).withColumn("rkey", F.monotonically_increasing_id())
    cut = bool(there["lines"]) and not points
    wide = max(there["x2"] - there["x1"], there["y2"] - there["y1"])
    rows = stored(_pieces(R, wide / PIECES if cut else float("inf")), "knn-features")
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    whole = rows.agg(F.min(cx).alias("x0"), F.min(cy).alias("y0"), F.greatest(F.max(cx) - F.min(cx), F.max(cy) - F.min(cy)).alias("side")).first()
    if whole["side"] is None:
        return empty
    features, levels, sample = _tree(rows, k, whole, cut)

    # down to the cell whose k features are surely nearest
    slack = F.lit(1e-12 * max(here["size"], there["size"]))  # of rounded distances
    child = lambda c: lambda n: c[n]
    way = stored(spread(L).withColumns({"lkey": F.monotonically_increasing_id(), "bound": F.lit(float("inf")), "at": F.lit(1).cast("long"), "open": F.lit(True)}), "knn-left")
    for kids in levels:
        best = F.array_min(F.transform(F.filter("kids", lambda c: c["m"] >= k), lambda c: F.struct(_farthest_gap(child(c)).alias("hi"), c["node"].alias("node"), c["dense"].alias("dense"))))
        way = way.join(kids.withColumnRenamed("parent", "at").withColumn("open", F.lit(True)), ["at", "open"], "left").withColumn("__best", best)
        way = way.select("lid", "lkey", "lx1", "ly1", "lx2", "ly2", F.least("bound", "__best.hi").alias("bound"), F.coalesce("__best.node", "at").alias("at"),
                         F.coalesce("__best.dense", F.lit(False)).alias("open"))
    dist = F.transform("sample", lambda c: F.struct(_to_feature(child(c), _farthest_gap).alias("hi"), c["rkey"].alias("rkey")))
    way = way.join(sample, "at", "left").withColumn("__near", F.array_sort(dist)).drop("sample", "open", "at")
    kth = F.get(F.array_distinct(F.transform("__near", lambda c: c["rkey"])), F.lit(k - 1))
    way = way.withColumn("__kth", kth).withColumn("bound", F.least("bound", F.array_min(F.transform(F.filter("__near", lambda c: c["rkey"] == F.col("__kth")), lambda c: c["hi"]))))
    # a little more than the bound, for rounding
    reached = stored(way.withColumn("bound", F.col("bound") * (1 + 1e-9) + slack).drop("__near", "__kth").withColumn("node", F.lit(1).cast("long")), "knn-bounds")

    # and to all cells that begin within the bound
    leaves, cols = [], reached.columns
    for kids in levels:
        below = reached.join(kids.withColumnRenamed("parent", "node"), "node").withColumn("__c", F.explode(F.filter("kids", lambda c: _nearest_gap(child(c)) <= F.col("bound"))))
        below = stored(below.withColumn("node", F.col("__c.node")).select(*cols, F.col("__c.dense").alias("dense")), "knn-reached")
        leaves.append(below.where("NOT dense").drop("dense"))
        reached = below.where("dense").drop("dense")
    cand = reduce(lambda a, b: a.unionByName(b), leaves).join(features, "node")
    if points:
        cand = cand.withColumn("dist", F.sqrt((F.col("lx1") - F.col("x1")) ** 2 + (F.col("ly1") - F.col("y1")) ** 2)).where(F.col("dist") <= F.col("bound"))
    else:
        near = cand.withColumn("lo", _to_feature(F.col, _nearest_gap)).where(F.col("lo") <= F.col("bound")).withColumn("hi", _to_feature(F.col, _farthest_gap))
        near = near.groupBy("lkey", "rkey").agg(F.first("lid").alias("lid"), F.first("rid").alias("rid"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
        kth = F.nth_value("hi", k).over(Window.partitionBy("lkey").orderBy("hi", "rkey").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        near = near.withColumn("__kth", kth).where(F.col("__kth").isNull() | (F.col("lo") <= F.col("__kth") * (1 + 1e-9) + slack)).select("lid", "rid")
        near = near.join(left.select(F.col(left_id).alias("lid"), F.col(left_geom).alias("__lg")), "lid").join(right.select(F.col(right_id).alias("rid"), F.col(right_geom).alias("__rg")), "rid")
        cand = near.withColumn("dist", relate.distance("__lg", "__rg"))
    top = cand.withColumn("rank", F.row_number().over(Window.partitionBy("lid").orderBy("dist", "rid"))).where(F.col("rank") <= k)
    return top.select(F.col("lid").alias(left_id), F.col("rid").alias(right_id), "dist", "rank")
