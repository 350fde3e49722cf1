"""Joins (J01-J10).

Attribute joins are plain DataFrame joins; Catalyst / AQE pick broadcast or
sort-merge and split skewed partitions.  The spatial join (J08) is rewritten
as an equi-join on grid cells followed by the exact predicate (columns, no Python):

1. points against another layer: one cell of a fixed size per point, the cells along
   each line or under each other feature on the other side;
2. all other layers: ``grid.box_pairs`` joins rows by their envelopes on a multi-level grid
   that follows the features' sizes and splits crowded cells; long slanted lines stand
   there as pieces, whose envelopes are narrow.  Rows are put to their boxes before the
   join, not fetched for its pairs, of which there may be many more.

Both are hash / sort-merge joins, never cross joins, and name a pair once.

Whether a side is broadcast is left to Spark, which knows its bytes at run time (AQE), as
is the split of skewed cells.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesic, relate
from ..functions.predicates import haversine, point_distance_column, point_in_geometry_column, shape_intersects_box
from .grid import box_pairs


# --------------------------------------------------------------------------
# Attribute joins of layers
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class JoinPart:
    df: DataFrame
    type_name: str
    on: Callable[[Callable[[str], Column]], Column] | Sequence[tuple[str, str]]
    how: str = "inner"            # 'inner' | 'outer' (= left) | 'left'
    alias: str | None = None       # user alias
    filter: Callable[[Callable[[str], Column]], Column] | None = None
    properties: Sequence[str] | None = None
    nested: bool = False           # J07: joined row as one struct attribute


#: Marks a joined row, so that an unmatched outer row nests as null.
_HIT = "__joined"


def _how(h: str) -> str:
    h = h.lower()
    if h in ("inner",):
        return "inner"
    if h in ("outer", "left", "left_outer"):
        return "left"
    raise ValueError(f"join type {h!r} is not supported (inner / outer)")


def apply_joins(main: DataFrame, main_type: str, parts: Sequence[JoinPart],
                main_filter: Callable | None = None) -> DataFrame:
    """Left-deep multi-way join.  Internal aliases are a, b, c...; a user
    alias or type name resolves to its internal alias; an unqualified name
    goes to the first side that has it; an unknown name is an error.  Joined
    columns whose names clash are renamed ``<alias>_<name>`` (J04), or the
    joined row is nested as one struct (J07).  Per-part and main filters are
    applied after the joins (J05)."""
    internal = [chr(ord("a") + i) for i in range(len(parts) + 1)]
    sides = [(main_type, None, main)] + [(p.type_name, p.alias, p.df) for p in parts]
    # a type name means its first side; a repeated type needs an alias of its own
    aliases = {}
    for (tname, ualias, _), ia in zip(sides, internal):
        if tname in aliases and not ualias:
            raise ValueError(f"type {tname!r} is joined twice and needs an alias")
        aliases.setdefault(tname, ia)
        if ualias:
            if aliases.get(ualias, ia) != ia:
                raise ValueError(f"alias {ualias!r} is ambiguous")
            aliases[ualias] = ia
    cols_of = {ia: set(df.columns) for (_, _, df), ia in zip(sides, internal)}

    def resolve(name: str) -> Column:
        if "." in name:
            q, c = name.split(".", 1)
            if q not in aliases:
                raise ValueError(f"unknown alias {q!r}")
            ia = aliases[q]
            if c not in cols_of[ia]:
                raise ValueError(f"unknown column {name!r}")
            return F.col(f"{ia}.{c}")
        for ia in internal:
            if name in cols_of[ia]:
                return F.col(f"{ia}.{name}")
        raise ValueError(f"unknown column {name!r}")

    out = main.alias("a")
    for p, ia in zip(parts, internal[1:]):
        right = (p.df.withColumn(_HIT, F.lit(True)) if p.nested else p.df).alias(ia)
        if callable(p.on):
            cond = p.on(resolve)
        else:
            cond = reduce(lambda x, y: x & y, [resolve(l) == resolve(r) for l, r in p.on])
        out = out.join(right, cond, _how(p.how))
    conds = []
    if main_filter is not None:
        conds.append(main_filter(resolve))
    for p in parts:
        if p.filter is not None:
            conds.append(p.filter(resolve))
    for c in conds:
        out = out.where(c)  # J05: after the join (drops unmatched outer rows)
    # projection
    sel = [F.col(f"a.{c}") for c in main.columns]
    taken = set(main.columns)
    for p, ia in zip(parts, internal[1:]):
        pcols = list(p.properties) if p.properties is not None else p.df.columns
        if p.nested:
            name = p.alias or p.type_name
            sel.append(F.when(F.col(f"{ia}.{_HIT}"), F.struct(*[F.col(f"{ia}.{c}").alias(c) for c in pcols])).alias(name))
            taken.add(name)
            continue
        for c in pcols:
            name = c if c not in taken else f"{p.alias or p.type_name}_{c}"
            sel.append(F.col(f"{ia}.{c}").alias(name))
            taken.add(name)
    return out.select(*sel)


def join(left: DataFrame, right: DataFrame, cond, how: str = "inner") -> DataFrame:
    """Inner or left (OUTER) join on any condition."""
    return left.join(right, cond, _how(how))


# --------------------------------------------------------------------------
# Spatial join by grid cells
# --------------------------------------------------------------------------
def _cover_array(geom: str, size: float, pad: float) -> Column:
    """Distinct grid cells (struct gx, gy) within ``pad`` of a geometry.
    Lines are covered segment by segment (row by row of the grid, the
    segment clipped to the padded row band), so a long diagonal road gets
    the cells along it, not its whole envelope; other kinds use the padded
    envelope (their interior counts)."""
    from ..functions.predicates import _edges_of

    g = F.col(geom)
    eps = size * 1e-9
    pd_ = pad + eps

    def fl(v):
        return F.floor(v / F.lit(size)).cast("long")

    def seg_cells(e):
        y_lo, y_hi = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        dy = e["y2"] - e["y1"]

        def row(gy):
            b_lo = gy.cast("double") * F.lit(size) - F.lit(pd_)
            b_hi = (gy + 1).cast("double") * F.lit(size) + F.lit(pd_)
            ta = F.least(F.greatest((b_lo - e["y1"]) / dy, F.lit(0.0)), F.lit(1.0))
            tb = F.least(F.greatest((b_hi - e["y1"]) / dy, F.lit(0.0)), F.lit(1.0))
            xa = e["x1"] + ta * (e["x2"] - e["x1"])
            xb = e["x1"] + tb * (e["x2"] - e["x1"])
            x_lo = F.when(dy == 0, F.least(e["x1"], e["x2"])).otherwise(F.least(xa, xb))
            x_hi = F.when(dy == 0, F.greatest(e["x1"], e["x2"])).otherwise(F.greatest(xa, xb))
            return F.transform(F.sequence(fl(x_lo - F.lit(pd_)), fl(x_hi + F.lit(pd_))),
                               lambda gx: F.struct(gx.alias("gx"), gy.alias("gy")))

        return F.flatten(F.transform(F.sequence(fl(y_lo - F.lit(pd_)), fl(y_hi + F.lit(pd_))), row))

    line_cells = F.array_distinct(F.flatten(F.transform(_edges_of(g), seg_cells)))
    env_cells = F.flatten(F.transform(
        F.sequence(fl(g["miny"] - F.lit(pd_)), fl(g["maxy"] + F.lit(pd_))),
        lambda gy: F.transform(F.sequence(fl(g["minx"] - F.lit(pd_)), fl(g["maxx"] + F.lit(pd_))),
                               lambda gx: F.struct(gx.alias("gx"), gy.alias("gy")))))
    return F.when(g["kind"].isin("LineString", "MultiLineString"), line_cells).otherwise(env_cells)


def _points_join(left: DataFrame, right: DataFrame, predicate: str, left_geom: str, rg: str, distance,
                 cell_size: float) -> DataFrame:
    """Point side x any side: one cell per point, a padded cover per other
    row; a pair meets in exactly one cell, so no dedupe is needed.  Two-point lines go by themselves:
    their coordinates are plain columns, so a pair costs some arithmetic in compiled code."""
    straight = F.col(rg)["minx"].isNotNull() & _is_segment(F.col(rg))
    lines, others = right.where(straight), right.where(F.col(rg)["minx"].isNotNull() & ~straight)
    if others.isEmpty():
        return _points_by_cell(left, lines, predicate, left_geom, rg, distance, cell_size, True)
    out = _points_by_cell(left, others, predicate, left_geom, rg, distance, cell_size, False)
    return out if lines.isEmpty() else out.unionByName(_points_by_cell(left, lines, predicate, left_geom, rg, distance, cell_size, True))


def _points_by_cell(left: DataFrame, right: DataFrame, predicate: str, left_geom: str, rg: str, distance, cell_size: float,
                    straight: bool) -> DataFrame:
    pad = float(distance or 0.0) if predicate == "dwithin" else 0.0
    g, R = F.col(left_geom), F.col(rg)
    lc = (left.withColumns({"__x": g["minx"], "__y": g["miny"]}).withColumn("__gx", F.floor(F.col("__x") / F.lit(cell_size)).cast("long"))
          .withColumn("__gy", F.floor(F.col("__y") / F.lit(cell_size)).cast("long")))
    ends = {f"__{n}{d}": _vertex(R, i)[d] for i, n in enumerate("ab") for d in "xy"} if straight else {}
    rc = (right.withColumns({"__x1": R["minx"], "__x2": R["maxx"], "__y1": R["miny"], "__y2": R["maxy"], **ends})
          .withColumn("__c", F.explode(_cover_array(rg, cell_size, pad)))
          .withColumn("__rgx", F.col("__c.gx")).withColumn("__rgy", F.col("__c.gy")).drop("__c"))
    x, y = F.col("__x"), F.col("__y")
    pairs = lc.join(rc, (F.col("__gx") == F.col("__rgx")) & (F.col("__gy") == F.col("__rgy")), "inner")
    env = ((x - F.lit(pad) <= F.col("__x2")) & (x + F.lit(pad) >= F.col("__x1"))
           & (y - F.lit(pad) <= F.col("__y2")) & (y + F.lit(pad) >= F.col("__y1")))
    exact = _point_on_line(predicate, x, y, distance) if straight else _exact_pair(predicate, F.struct(x.alias("minx"), y.alias("miny")), R, True, False, distance)
    return pairs.where(env).where(exact).select(*left.columns, *right.columns)


def _point_on_line(predicate: str, x: Column, y: Column, distance) -> Column:
    """A point against the two-point line (__ax, __ay) to (__bx, __by), plain columns."""
    ax, ay, bx, by = (F.col(f"__{n}{d}") for n in "ab" for d in "xy")
    if predicate == "dwithin":
        return _point_segment(x, y, ax, ay, bx, by) <= F.lit(float(distance))
    on = (((bx - ax) * (y - ay) - (by - ay) * (x - ax)) == 0) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
    if predicate == "within":
        on = on & ~(((ax != bx) | (ay != by)) & (((ax == x) & (ay == y)) | ((bx == x) & (by == y))))
    return F.coalesce(on, F.lit(False))


def spatial_join(left: DataFrame, right: DataFrame, predicate: str = "intersects", *,
                 left_geom: str = "geom", right_geom: str = "geom", distance: float | None = None,
                 cell_size: float = 0.05, left_points: bool = False, right_points: bool = False,
                 how: str = "inner", left_key: str | None = None, right_key: str | None = None,
                 suffix: str = "_r") -> DataFrame:
    """Pairs (left row, right row) satisfying a spatial predicate.

    ``predicate``: intersects | contains (left contains right) | within (left
    within right) | equals | touches | crosses | overlaps | dwithin (``distance``, planar).  ``how='left'`` keeps
    unmatched left rows (needs ``left_key``).  Points against another layer meet on cells of ``cell_size``;
    all other layers on a grid that follows the features' sizes.  Keys, where given, must be unique."""
    pad = float(distance or 0.0) if predicate == "dwithin" else 0.0
    r_cols = [c for c in right.columns]
    clash = set(left.columns) & set(r_cols)
    right_r = right.select(*[F.col(c).alias(c + suffix if c in clash else c) for c in r_cols])
    rg = right_geom + suffix if right_geom in clash else right_geom
    if left_points and not right_points and predicate in ("intersects", "within", "dwithin"):
        out = _points_join(left, right_r, predicate, left_geom, rg, distance, cell_size)
        return _finish(left, out, how, left_key)
    rk = right_key + suffix if right_key in clash else right_key
    size_l, size_r = _sizes(left, left_geom), _sizes(right_r, rg)
    cut = None if size_r["thin"] is None and size_l["thin"] is None else "r" if (size_r["thin"] or 0.0) >= (size_l["thin"] or 0.0) else "l"
    L, R = F.col("__l")[left_geom], F.col("__r")[rg]
    lrows, rrows = _whole(left, left_key, "l"), _whole(right_r, rk, "r")
    plain = predicate in ("intersects", "dwithin") and not left_points and not right_points
    if plain:  # worked out for a row, not for each of its pairs
        lrows, rrows = (rows.select(*rows.columns, *[c.alias(f"__{side}_{n}") for n, c in _Plain.of(g).columns()]) for rows, g, side in ((lrows, L, "l"), (rrows, R, "r")))

    def met(lrows, rrows, cut):
        lb = _boxes(lrows, L, "l", pad, (size_r["size"] or 0.0) if cut == "l" else None)
        rb = _boxes(rrows, R, "r", 0.0, (size_l["size"] or 0.0) + 2 * pad if cut == "r" else None)
        return box_pairs(lb, rb, 2, True).where(_first_piece(cut) if cut else F.lit(True))

    # features with unknown places, of which envelopes say little, meet whole lines
    if cut and (size_l if cut == "r" else size_r)["odd"]:
        odd = _unknown(L if cut == "r" else R)
        of = lambda c: (lrows.where(c), rrows) if cut == "r" else (lrows, rrows.where(c))
        pairs = met(*of(~odd), cut).unionByName(met(*of(odd), None))
    else:
        pairs = met(lrows, rrows, cut)
    if not (predicate == "intersects" and size_l["boxes"] and size_r["boxes"]):  # the boxes are the features
        pairs = pairs.where(_exact_pair(predicate, L, R, left_points, right_points, distance, *([_Plain.named("__l_"), _Plain.named("__r_")] if plain else [])))
    out = pairs.select(*[F.col("__l")[c].alias(c) for c in left.columns], *[F.col("__r")[c].alias(c) for c in right_r.columns])
    return _finish(left, out, how, left_key)


def metres_join(left: DataFrame, right: DataFrame, metres: float, *, left_key: str, right_key: str, left_geom: str = "geom",
                right_geom: str = "geom_r") -> DataFrame:
    """Pairs of rows at most ``metres`` apart on the sphere, with ``metres`` as a column.

    Column names of the sides must differ, keys must be unique.  Boxes around unit vectors meet on the
    multi-level grid in three dimensions, so pairs across +-180 degrees or a pole are like others.  Of points the
    chord decides, and the arc where the chord is too close to the limit to tell."""
    def boxes(df, key, geom, side, pad):
        rows = _whole(df, key, side)
        return rows.select(*rows.columns, *[c.alias(f"{side}{x}{d}") for (d, x), c in zip([(d, x) for d in range(3) for x in "lh"], geodesic.cap_box(F.col(f"__{side}")[geom], pad))])

    pairs = box_pairs(boxes(left, left_key, left_geom, "l", metres), boxes(right, right_key, right_geom, "r", 0.0), 3, True)
    L, R = F.col("__l")[left_geom], F.col("__r")[right_geom]
    arc = haversine(L["minx"], L["miny"], R["minx"], R["miny"])
    limit = F.lit(float(metres))
    only_points = lambda df, geom: df.where(F.col(geom)["minx"].isNotNull() & (F.col(geom)["kind"] != "Point")).isEmpty()
    if only_points(left, left_geom) and only_points(right, right_geom):
        chord = F.sqrt(sum(((F.col(f"ll{d}") + F.col(f"lh{d}")) / 2 - (F.col(f"rl{d}") + F.col(f"rh{d}")) / 2) ** 2 for d in range(3)))
        reach, far = geodesic.chord(metres), arc
        sure = chord <= reach * (1 - 1e-9) - 1e-12 if reach < 1.9 else F.lit(False)
        pairs = pairs.where((chord <= reach * (1 + 1e-9) + 1e-12) & (sure | (arc <= limit)))
    else:
        points = (L["kind"] == "Point") & (R["kind"] == "Point")
        far = F.when(points, arc).otherwise(geodesic.metres(L, R))
        pairs = pairs.where(far <= limit)
    return pairs.select(*[F.col("__l")[c].alias(c) for c in left.columns], *[F.col("__r")[c].alias(c) for c in right.columns], far.alias("metres"))


def _whole(df: DataFrame, key: str | None, side: str) -> DataFrame:
    """The rows as one column ``__<side>``, and their key (rows of one key stand for each other)."""
    row = F.struct(*df.columns).alias(f"__{side}")
    if key is None:
        return df.select(F.lit(0).alias(f"{side}key"), row)
    return df.select(F.col(key).alias(f"{side}key")).join(df.select(F.col(key).alias(f"{side}key"), row), f"{side}key")


#: Pieces of a line, at most.
PIECES = 64


def _sizes(df: DataFrame, geom: str):
    """Mean longest side of the envelopes, mean shorter side of those of two-point lines, whether all are rectangles, and whether
    some have unknown places."""
    g = F.col(geom)
    w, h = g["maxx"] - g["minx"], g["maxy"] - g["miny"]
    return df.where(g["minx"].isNotNull()).agg(F.avg(F.greatest(w, h)).alias("size"), F.avg(F.when(_is_segment(g), F.least(w, h))).alias("thin"),
                                               F.bool_and(_is_rectangle(g)).alias("boxes"), F.bool_or(_unknown(g)).alias("odd")).first()


def _unknown(g: Column) -> Column:
    """A coordinate of some vertex is null."""
    return F.coalesce(F.exists(F.flatten(F.flatten(g["parts"])), lambda p: p["x"].isNull() | p["y"].isNull()), F.lit(True))


def _boxes(rows: DataFrame, g: Column, side: str, pad: float, width: float | None) -> DataFrame:
    """The rows with their envelopes, grown by ``pad``.  With a ``width``, two-point lines with wider envelopes on both
    sides stand as equal pieces, each with the envelope of the piece before it (null: none)."""
    whole = [g["minx"], g["maxx"], g["miny"], g["maxy"]]
    names = ["l0", "h0", "l1", "h1"]
    if width is None:
        pieces = rows.withColumns({"__n": F.lit(1), "__i": F.lit(0)})
    else:
        narrow = F.least(g["maxx"] - g["minx"], g["maxy"] - g["miny"])
        n = F.when(_is_segment(g) & (narrow > width), F.least(F.ceil(narrow / F.lit(max(width, 1e-300))), F.lit(float(PIECES))).cast("int")).otherwise(1)
        pieces = rows.withColumn("__n", n).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    a, b, n = _vertex(g, 0), _vertex(g, 1), F.col("__n")

    def piece(i):
        at = lambda k, d: F.when(k == 0, a[d]).when(k == n, b[d]).otherwise(a[d] + (b[d] - a[d]) * (k / n))
        out = []
        for d, low, high in (("x", whole[0], whole[1]), ("y", whole[2], whole[3])):
            e = F.greatest(F.abs(low), F.abs(high)) * 1e-12  # places between are rounded
            out += [F.greatest(low, F.least(at(i, d), at(i + 1, d)) - e), F.least(high, F.greatest(at(i, d), at(i + 1, d)) + e)]
        return out

    grown = lambda values: [v + (-pad if x[0] == "l" else pad) for x, v in zip(names, values)]
    own = grown([F.when(n > 1, v).otherwise(w) for v, w in zip(piece(F.col("__i")), whole)])
    before = [F.when(F.col("__i") > 0, v) for v in grown(piece(F.col("__i") - 1))]
    return pieces.select(*rows.columns, *[v.alias(side + x) for x, v in zip(names, own)], *[v.alias(f"__p{side}{x}") for x, v in zip(names, before)])


def _first_piece(cut: str) -> Column:
    """No piece before this one meets the other box: those that meet a box follow each other, as a line rises or falls in
    both directions evenly."""
    other = "l" if cut == "r" else "r"
    p = lambda x: F.col(f"__p{cut}{x}")
    o = lambda x: F.col(f"{other}{x}")
    met = (p("l0") <= o("h0")) & (p("h0") >= o("l0")) & (p("l1") <= o("h1")) & (p("h1") >= o("l1"))
    return p("l0").isNull() | ~met


def _finish(left: DataFrame, out: DataFrame, how: str, left_key: str | None) -> DataFrame:
    if how == "inner":
        return out
    if how == "left":
        if not left_key:
            raise ValueError("left spatial join needs left_key")
        # the pairs are worked out once; left_key identifies a left row
        new = [c for c in out.columns if c not in left.columns]
        return left.join(out.select(left_key, *new), left_key, "left").select(*out.columns)
    raise ValueError(f"spatial join type {how!r} is not supported")


def _exact_pair(pred: str, L: Column, R: Column, lp: bool, rp: bool, distance, l: _Plain | None = None, r: _Plain | None = None) -> Column:
    if lp and pred in ("intersects", "within"):
        # point x polygon: native ray casting over the polygon column
        if rp:
            return (L["minx"] == R["minx"]) & (L["miny"] == R["miny"])
        return point_in_geometry_column(L["minx"], L["miny"], R, pred)
    if lp and pred == "dwithin":
        return point_distance_column(L["minx"], L["miny"], R) <= F.lit(float(distance))
    if rp and pred == "dwithin":
        return point_distance_column(R["minx"], R["miny"], L) <= F.lit(float(distance))
    if rp and pred in ("intersects", "contains"):
        return point_in_geometry_column(R["minx"], R["miny"], L, "intersects" if pred == "intersects" else "within")
    if pred == "dwithin":
        return F.coalesce(_points_near_line(l or L, r or R, float(distance)), relate.distance(L, R) <= F.lit(float(distance)), F.lit(False))
    if pred == "intersects":
        box = lambda g: (g["minx"], g["miny"], g["maxx"], g["maxy"])
        l, r = l or _Plain.of(L), r or _Plain.of(R)
        return (F.when(r.rect, shape_intersects_box(L, *box(R))).when(l.rect, shape_intersects_box(R, *box(L)))
                .otherwise(F.coalesce(_small_meets_line(l, r), _small_meets_line(r, l), relate.intersects(L, R), F.lit(False))))
    return F.coalesce(relate.relate(pred, L, R), F.lit(False))


def _point_segment(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar point-to-segment distance, plain columns (whole-stage codegen instead of a higher-order function)."""
    dx, dy = bx - ax, by - ay
    ll = dx * dx + dy * dy
    t = F.when(ll > 0, F.least(F.greatest(((x - ax) * dx + (y - ay) * dy) / ll, F.lit(0.0)), F.lit(1.0))) \
        .otherwise(F.lit(0.0))
    return F.sqrt((x - (ax + t * dx)) ** 2 + (y - (ay + t * dy)) ** 2)


#: Vertices (or points) of a small feature, at most.
SMALL = 5
#: Relative width within which plain arithmetic leaves a pair to ``relate``; it is ten times as wide as an edge there.
NARROW = 1e-11


@dataclass(frozen=True)
class _Plain:
    """What the plain tests ask of a feature: whether it is a rectangle, a line or area of a few known vertices, a few known points
    or a known two-point line, how far from the origin it reaches, its first vertices (or points) and the lengths between them."""
    rect: Column
    small: Column
    few: Column
    segment: Column
    reach: Column
    xs: tuple
    ys: tuple
    lengths: tuple

    @staticmethod
    def of(g: Column) -> _Plain:
        ring = F.get(F.get(g["parts"], F.lit(0)), F.lit(0))
        points = F.coalesce(g["kind"].isin("Point", "MultiPoint"), F.lit(False))
        corner = [F.coalesce(F.get(ring, F.lit(i)), F.get(ring, F.size(ring) - 1)) for i in range(SMALL)]
        one = [F.get(F.get(F.get(g["parts"], F.lit(i)), F.lit(0)), F.lit(0)) for i in range(SMALL)]
        xs, ys = (tuple(F.when(points, p[d]).otherwise(c[d]) for p, c in zip(one, corner)) for d in "xy")
        known = lambda of: reduce(lambda m, c: m & c, [v[d].isNotNull() for v in of for d in "xy"])
        there = sum((p["x"].isNotNull() & p["y"].isNotNull()).cast("int") for p in one)
        small = (g["kind"].isin("LineString", "Polygon") & (F.size(g["parts"]) == 1) & (F.size(F.get(g["parts"], F.lit(0))) == 1) & F.size(ring).between(2, SMALL) & known(corner))
        few = points & F.size(g["parts"]).between(1, SMALL) & (there == F.size(g["parts"]))
        sure = lambda c: F.coalesce(c, F.lit(False))
        reach = F.greatest(F.lit(1.0), *[F.abs(g[c]) for c in ("minx", "miny", "maxx", "maxy")])
        lengths = tuple(F.hypot(xs[i + 1] - xs[i], ys[i + 1] - ys[i]) for i in range(SMALL - 1))
        return _Plain(_is_rectangle(g), sure(small), sure(few), _is_segment(g) & sure(known(corner[:2])), reach, xs, ys, lengths)

    @staticmethod
    def named(prefix: str) -> _Plain:
        c = lambda n: F.col(prefix + n)
        row = lambda d, n: tuple(c(f"{d}{i}") for i in range(n))
        return _Plain(c("rect"), c("small"), c("few"), c("segment"), c("reach"), row("x", SMALL), row("y", SMALL), row("d", SMALL - 1))

    def columns(self):
        return [*((n, getattr(self, n)) for n in ("rect", "small", "few", "segment", "reach")),
                *((f"{d}{i}", c) for d, of in (("x", self.xs), ("y", self.ys), ("d", self.lengths)) for i, c in enumerate(of))]


def _small_meets_line(g: Column | _Plain, line: Column | _Plain) -> Column:
    """Whether a line or area of a few vertices meets a two-point line, by the sides on which vertices lie; null where it
    is another kind of pair, or too close to tell."""
    g, line = (v if isinstance(v, _Plain) else _Plain.of(v) for v in (g, line))
    at, (a, b) = [*zip(g.xs, g.ys)], [*zip(line.xs, line.ys)][:2]
    reach = F.greatest(g.reach, line.reach) * NARROW
    cross = lambda p, q, v: (q[0] - p[0]) * (v[1] - p[1]) - (q[1] - p[1]) * (v[0] - p[0])
    side, far = [cross(a, b, v) for v in at], reach * line.lengths[0]

    def crossed(i):
        p, q = at[i], at[i + 1]
        apart = F.least(side[i], side[i + 1]) < -far, F.greatest(side[i], side[i + 1]) > far
        one, other, width = cross(p, q, a), cross(p, q, b), reach * g.lengths[i]
        return apart[0] & apart[1] & (F.least(one, other) < -width) & (F.greatest(one, other) > width)

    known = F.when((F.least(*side) > far) | (F.greatest(*side) < -far), F.lit(False)).when(reduce(lambda m, c: m | c, [crossed(i) for i in range(SMALL - 1)]), F.lit(True))
    return F.when(g.small & line.segment, known)


def _points_near_line(g: Column | _Plain, line: Column | _Plain, distance: float) -> Column:
    """Whether a few points are at most ``distance`` from a two-point line; null where it is another kind of pair, or too
    close to tell."""
    g, line = (v if isinstance(v, _Plain) else _Plain.of(v) for v in (g, line))
    gap = F.least(*[_point_segment(x, y, line.xs[0], line.ys[0], line.xs[1], line.ys[1]) for x, y in zip(g.xs, g.ys)])  # of the points that there are
    reach = F.greatest(g.reach, line.reach) * NARROW
    return F.when(g.few & line.segment, F.when(gap < distance - reach, F.lit(True)).when(gap > distance + reach, F.lit(False)))


def _vertex(g: Column, i: int) -> Column:
    """A vertex of the first part's first ring or line (null: none)."""
    return F.get(F.get(F.get(g["parts"], F.lit(0)), F.lit(0)), F.lit(i))


def _is_segment(g: Column) -> Column:
    return F.coalesce((g["kind"] == "LineString") & (F.size(g["parts"]) == 1)
                      & (F.size(F.get(F.get(g["parts"], F.lit(0)), F.lit(0))) == 2), F.lit(False))


def _is_rectangle(g: Column) -> Column:
    ring = F.get(F.get(g["parts"], F.lit(0)), F.lit(0))
    corners = F.forall(ring, lambda p: ((p["x"] == g["minx"]) | (p["x"] == g["maxx"]))
                       & ((p["y"] == g["miny"]) | (p["y"] == g["maxy"])))
    return F.coalesce((g["kind"] == "Polygon") & (F.size(g["parts"]) == 1) & (F.size(F.get(g["parts"], F.lit(0))) == 1)
                      & (F.size(ring) == 5) & corners, F.lit(False))
