"""S2 cells (C01-C05).

Point -> leaf cell is native column math (face pick, quadratic projection,
Hilbert order through a 4-bit lookup table built from the curve's rule), so it
runs inside whole-stage codegen for every row of a layer.  Parents, tokens and
the leaf-id range of a cell are bit operations on the 64-bit id (ids of faces
4 and 5 are negative as signed longs; ranges never cross a face, so range
tests on signed longs are still correct).

Coverings of literal query regions are computed on the driver (one small
region), by recursive subdivision of the six face cells with a conservative
lat/lon bound per cell: the result is a superset, and an exact test always
follows.  Coverings of layer rows and large regions are columns and rows (``cover``).
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import Geom, _c

MAX_LEVEL = 30
MAX_SIZE = 1 << MAX_LEVEL

# The Hilbert curve rule of the cell hierarchy.
# IJ_TO_POS[orientation][(i_bit << 1) | j_bit] -> child position;
# POS_TO_ORIENTATION[position] -> orientation flip (1 = swap axes, 2 = invert).
IJ_TO_POS = ((0, 1, 3, 2), (0, 3, 1, 2), (2, 3, 1, 0), (2, 1, 3, 0))
POS_TO_ORIENTATION = (1, 0, 0, 3)
POS_TO_IJ = tuple(tuple(row.index(p) for p in range(4)) for row in IJ_TO_POS)


@lru_cache(maxsize=1)
def _lookup_pos() -> tuple:
    """(i4 << 6 | j4 << 2 | orientation) -> (pos8 << 2 | orientation'), from the rule."""
    tbl = [0] * 1024
    for ori in range(4):
        for i4 in range(16):
            for j4 in range(16):
                o, pos = ori, 0
                for b in (3, 2, 1, 0):
                    ij = (((i4 >> b) & 1) << 1) | ((j4 >> b) & 1)
                    p = IJ_TO_POS[o][ij]
                    pos = (pos << 2) | p
                    o ^= POS_TO_ORIENTATION[p]
                tbl[(i4 << 6) | (j4 << 2) | ori] = (pos << 2) | o
    return tuple(tbl)


# --------------------------------------------------------------------------
# native columns
# --------------------------------------------------------------------------
def _let(value: Column, fn) -> Column:
    """Bind ``value`` to a lambda variable so ``fn`` may use it many times
    without copying its expression tree (keeps the plan small)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _shl(c: Column, n: Column) -> Column:
    return F.call_function("shiftleft", c, n)


def _shr(c: Column, n: Column) -> Column:
    return F.call_function("shiftright", c, n)


def _uv_to_st(u: Column) -> Column:
    return F.when(u >= 0, F.lit(0.5) * F.sqrt(F.lit(1.0) + F.lit(3.0) * u)) \
        .otherwise(F.lit(1.0) - F.lit(0.5) * F.sqrt(F.lit(1.0) - F.lit(3.0) * u))


def _st_to_ij(s: Column) -> Column:
    return F.least(F.greatest(F.floor(s * F.lit(float(MAX_SIZE))), F.lit(0)), F.lit(MAX_SIZE - 1)).cast("long")


def leaf_of_ij(face, i, j) -> Column:
    """The leaf cell at (i, j) of a face: eight 4-bit chunks through the lookup table built from the rule."""
    tbl = F.array(*[F.lit(int(t)) for t in _lookup_pos()])
    init = F.struct(F.lit(0).cast("long").alias("p"), face.cast("long").bitwiseAND(F.lit(1)).alias("o"))

    def step(acc, k):
        idx = (_shl(_shr(i, k * 4).bitwiseAND(F.lit(15)), F.lit(6))
               .bitwiseOR(_shl(_shr(j, k * 4).bitwiseAND(F.lit(15)), F.lit(2)))
               .bitwiseOR(acc["o"]))
        return _let(F.element_at(tbl, (idx + 1).cast("int")).cast("long"), lambda b: F.struct(
            acc["p"].bitwiseOR(_shl(_shr(b, F.lit(2)), k * 8)).alias("p"), b.bitwiseAND(F.lit(3)).alias("o")))

    pos = F.aggregate(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), init, step)["p"]
    return F.shiftleft(face.cast("long"), 61).bitwiseOR(F.shiftleft(pos, 1)).bitwiseOR(F.lit(1))


def leaf_cell(lat, lon) -> Column:
    """S2 leaf cell id (level 30) as a signed 64-bit long."""
    la, lo = F.radians(_c(lat).cast("double")), F.radians(_c(lon).cast("double"))
    xyz = F.struct((F.cos(la) * F.cos(lo)).alias("x"), (F.cos(la) * F.sin(lo)).alias("y"), F.sin(la).alias("z"))

    def with_face(p):
        x, y, z = p["x"], p["y"], p["z"]
        axis = F.when(F.abs(x) > F.abs(y), F.when(F.abs(x) > F.abs(z), 0).otherwise(2)) \
            .otherwise(F.when(F.abs(y) > F.abs(z), 1).otherwise(2))
        return _let(axis, lambda ax: _let(
            F.when(F.when(ax == 0, x).when(ax == 1, y).otherwise(z) < 0, ax + 3).otherwise(ax),
            lambda face: with_uv(p, face)))

    def with_uv(p, face):
        x, y, z = p["x"], p["y"], p["z"]
        u = (F.when(face == 0, y / x).when(face == 1, -x / y).when(face == 2, -x / z)
             .when(face == 3, z / x).when(face == 4, z / y).otherwise(-y / z))
        v = (F.when(face == 0, z / x).when(face == 1, z / y).when(face == 2, -y / z)
             .when(face == 3, y / x).when(face == 4, -x / y).otherwise(-x / z))
        ij = F.struct(_let(u, lambda uu: _st_to_ij(_uv_to_st(uu))).alias("i"),
                      _let(v, lambda vv: _st_to_ij(_uv_to_st(vv))).alias("j"))
        return _let(ij, lambda q: leaf_of_ij(face, q["i"], q["j"]))

    cid = _let(xyz, with_face)
    return F.when(_c(lat).isNotNull() & _c(lon).isNotNull(), cid)


def lsb_for_level(level: int) -> int:
    return 1 << (2 * (MAX_LEVEL - level))


def parent(cell, level: int) -> Column:
    """Ancestor at ``level``."""
    lsb = lsb_for_level(level)
    return _c(cell).bitwiseAND(F.lit(_signed(-lsb & 0xFFFFFFFFFFFFFFFF))).bitwiseOR(F.lit(lsb))


def token(cell) -> Column:
    """Hex token (16 hex digits, trailing zeros removed, lower case)."""
    return F.lower(F.regexp_replace(F.lpad(F.hex(_c(cell)), 16, "0"), "0+$", ""))


def from_token(tok) -> Column:
    """Token -> signed long id."""
    return F.conv(F.rpad(_c(tok), 16, "0"), 16, -10).cast("long")


def level_of(cell) -> Column:
    """Level from the position of the lowest set bit."""
    c = _c(cell)
    low = c.bitwiseAND(-c)
    return F.lit(MAX_LEVEL) - (F.log2(low.cast("double")) / 2).cast("int")


# --------------------------------------------------------------------------
# Python-side cell math (literal regions, row coverings)
# --------------------------------------------------------------------------
def _signed(v: int) -> int:
    v &= 0xFFFFFFFFFFFFFFFF
    return v - (1 << 64) if v >= (1 << 63) else v


def _unsigned(v: int) -> int:
    return v & 0xFFFFFFFFFFFFFFFF


def face_uv(lat_deg: float, lon_deg: float):
    lat, lon = math.radians(lat_deg), math.radians(lon_deg)
    x, y, z = math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)
    ax, ay, az = abs(x), abs(y), abs(z)
    axis = (0 if ax > az else 2) if ax > ay else (1 if ay > az else 2)
    face = axis + 3 if (x, y, z)[axis] < 0 else axis
    if face == 0:
        return face, y / x, z / x
    if face == 1:
        return face, -x / y, z / y
    if face == 2:
        return face, -x / z, -y / z
    if face == 3:
        return face, z / x, y / x
    if face == 4:
        return face, z / y, -x / y
    return face, -y / z, -x / z


def uv_to_st(u: float) -> float:
    return 0.5 * math.sqrt(1 + 3 * u) if u >= 0 else 1 - 0.5 * math.sqrt(1 - 3 * u)


def st_to_uv(s: float) -> float:
    return (1.0 / 3.0) * (4 * s * s - 1) if s >= 0.5 else (1.0 / 3.0) * (1 - 4 * (1 - s) * (1 - s))


def st_to_ij(s: float) -> int:
    return max(0, min(MAX_SIZE - 1, int(math.floor(MAX_SIZE * s))))


def cell_from_face_ij(face: int, i: int, j: int, level: int = MAX_LEVEL) -> int:
    """Unsigned id of the level-``level`` cell holding leaf (i, j) on ``face``."""
    ori = face & 1
    pos = 0
    for b in range(MAX_LEVEL - 1, -1, -1):
        ij = (((i >> b) & 1) << 1) | ((j >> b) & 1)
        p = IJ_TO_POS[ori][ij]
        pos = (pos << 2) | p
        ori ^= POS_TO_ORIENTATION[p]
    leaf = (face << 61) | (pos << 1) | 1
    return _parent_u(leaf, level)


def _parent_u(cid: int, level: int) -> int:
    lsb = lsb_for_level(level)
    return (cid & (-lsb & 0xFFFFFFFFFFFFFFFF)) | lsb


def leaf_cell_py(lat: float, lon: float) -> int:
    face, u, v = face_uv(lat, lon)
    return _signed(cell_from_face_ij(face, st_to_ij(uv_to_st(u)), st_to_ij(uv_to_st(v))))


def parent_py(cid: int, level: int) -> int:
    return _signed(_parent_u(_unsigned(cid), level))


def token_py(cid: int) -> str:
    return format(_unsigned(cid), "016x").rstrip("0") or "X"


def cell_level_py(cid: int) -> int:
    u = _unsigned(cid)
    low = u & -u
    return MAX_LEVEL - (low.bit_length() - 1) // 2


def range_py(cid: int) -> tuple[int, int]:
    """Signed [min, max] leaf ids under the cell."""
    u = _unsigned(cid)
    lsb = u & -u
    return _signed(u - (lsb - 1)), _signed(u + (lsb - 1))


def children_py(cid: int) -> list[int]:
    u = _unsigned(cid)
    lsb = u & -u
    new = lsb >> 2
    start = u - lsb + new
    return [_signed(start + k * 2 * new) for k in range(4)]


def _face_ij_of(cid: int):
    """Face, (i, j) of the cell's lower-left leaf and the cell's size in leaves."""
    u = _unsigned(cid)
    face = u >> 61
    level = cell_level_py(cid)
    ori = face & 1
    i = j = 0
    pos = (u & ((1 << 61) - 1)) >> 1
    for b in range(MAX_LEVEL - 1, -1, -1):
        p = (pos >> (2 * b)) & 3
        ij = POS_TO_IJ[ori][p]
        i |= (ij >> 1) << b
        j |= (ij & 1) << b
        ori ^= POS_TO_ORIENTATION[p]
    size = 1 << (MAX_LEVEL - level)
    i &= ~(size - 1)
    j &= ~(size - 1)
    return face, i, j, size


def _xyz_to_latlon(face: int, u: float, v: float):
    x, y, z = {0: (1, u, v), 1: (-u, 1, v), 2: (-u, -v, 1), 3: (-1, -v, -u), 4: (v, -1, -u),
               5: (v, u, -1)}[face]
    n = math.sqrt(x * x + y * y + z * z)
    return math.degrees(math.asin(z / n)), math.degrees(math.atan2(y, x))


def cell_rect_py(cid: int) -> tuple[float, float, float, float]:
    """Conservative (lon1, lat1, lon2, lat2) bound of a cell."""
    face, i, j, size = _face_ij_of(cid)
    u0, u1 = st_to_uv(i / MAX_SIZE), st_to_uv((i + size) / MAX_SIZE)
    v0, v1 = st_to_uv(j / MAX_SIZE), st_to_uv((j + size) / MAX_SIZE)
    pts = [_xyz_to_latlon(face, uu, vv) for uu in (u0, (u0 + u1) / 2, u1) for vv in (v0, (v0 + v1) / 2, v1)]
    lats = [p[0] for p in pts]
    lons = [p[1] for p in pts]
    lat1, lat2 = min(lats), max(lats)
    pad_lat = (lat2 - lat1) * 0.05 + 1e-9
    lat1, lat2 = max(-90.0, lat1 - pad_lat), min(90.0, lat2 + pad_lat)
    if face in (2, 5) and u0 <= 0 <= u1 and v0 <= 0 <= v1:  # holds a pole
        return -180.0, (lat1 if face == 2 else -90.0), 180.0, (90.0 if face == 2 else lat2)
    # a corner on the antimeridian counts on the side of the cell's middle
    lons = [lon + 360.0 * round((lons[4] - lon) / 360.0) for lon in lons]
    lon1, lon2 = min(lons), max(lons)
    if lon1 < -180.000001 or lon2 > 180.000001:  # crosses the antimeridian
        return -180.0, lat1, 180.0, lat2
    pad_lon = (lon2 - lon1) * 0.05 + 1e-9
    return lon1 - pad_lon, lat1, lon2 + pad_lon, lat2


def _clips(e, x1: float, y1: float, x2: float, y2: float) -> bool:
    """Whether an edge of a literal region enters a closed rectangle."""
    lo, hi = 0.0, 1.0
    for p, d, a, b in ((e[0], e[2] - e[0], x1, x2), (e[1], e[3] - e[1], y1, y2)):
        if d == 0:
            if not a <= p <= b:
                return False
        else:
            lo, hi = max(lo, min((a - p) / d, (b - p) / d)), min(hi, max((a - p) / d, (b - p) / d))
    return lo <= hi


def _holds(region: Geom, x: float, y: float) -> bool:
    """Ray parity of a place in a literal area."""
    return sum((b > y) != (d > y) and x < a + (y - b) * (c - a) / (d - b) for a, b, c, d in region.edges()) % 2 == 1


def _meets_rect(region: Geom, x1: float, y1: float, x2: float, y2: float) -> bool:
    if any(x1 <= x <= x2 and y1 <= y <= y2 for part in region.parts for ring in part for x, y in ring):
        return True
    return any(_clips(e, x1, y1, x2, y2) for e in region.edges()) or (region.dimension == 2 and _holds(region, x1, y1))


FACE_CELLS = tuple(_signed((f << 61) | (1 << 60)) for f in range(6))


def covering(region: Geom, level: int, min_level: int | None = None, max_cells: int | None = None,
             exact_test: bool = True, grow: float = 0.0) -> list[int]:
    """Cells covering a literal region.

    * ``min_level=None``: every cell is at ``level`` (C03 / C04).
    * ``min_level`` given: cells fully inside the region stay at the coarsest
      level >= ``min_level`` (C05), so a large region needs few cells.
    * ``max_cells``: when the covering at ``level`` would be larger, cells are
      coarsened (never dropped): still a superset, and the exact test after the
      read handles the extra rows.
    * ``grow``: the cells within so many degrees of the region (in both directions).
    """
    x1, y1, x2, y2 = region.envelope()

    def hits(cid):
        cx1, cy1, cx2, cy2 = cell_rect_py(cid)
        cx1, cy1, cx2, cy2 = cx1 - grow, cy1 - grow, cx2 + grow, cy2 + grow
        if cx1 > x2 or cx2 < x1 or cy1 > y2 or cy2 < y1:
            return False
        if not exact_test or region.kind == "Point" or region.is_rectangle():
            return True
        return _meets_rect(region, cx1, cy1, cx2, cy2)

    def inside(cid):
        if region.dimension != 2:
            return False
        cx1, cy1, cx2, cy2 = cell_rect_py(cid)
        if region.is_rectangle():
            return x1 <= cx1 and cx2 <= x2 and y1 <= cy1 and cy2 <= y2
        # no edge enters the rectangle and a corner is inside
        return not any(_clips(e, cx1, cy1, cx2, cy2) for e in region.edges()) and _holds(region, cx1, cy1)

    out: list[int] = []
    frontier = [c for c in FACE_CELLS if hits(c)]
    lvl = 0
    while frontier:
        split = []
        for c in frontier:
            if lvl >= level or (min_level is not None and lvl >= min_level and inside(c)):
                out.append(c)
            else:
                split.append(c)
        if not split:
            break
        nxt = [ch for c in split for ch in children_py(c) if hits(ch)]
        if max_cells is not None and len(out) + len(nxt) > max_cells:
            out.extend(split)  # coarser cells: still a superset
            break
        frontier = nxt
        lvl += 1
    return sorted(set(out))


def covering_tokens(region: Geom, level: int, **kw) -> list[str]:
    return [token_py(c) for c in covering(region, level, **kw)]


def cell_ranges(cells: list[int]) -> list[tuple[int, int]]:
    """Merged signed leaf-id ranges of a covering."""
    rs = sorted(range_py(c) for c in cells)
    merged: list[list[int]] = []
    for lo, hi in rs:
        if merged and lo <= merged[-1][1] + 1 and (merged[-1][1] < 0) == (lo < 0):
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [(a, b) for a, b in merged]


def in_ranges(cell, ranges: list[tuple[int, int]], computed: bool = False) -> Column:
    """Leaf id column inside any of the ranges.

    On a stored ``cell`` column this is a plain OR of BETWEENs, which Parquet
    uses to skip row groups by min / max.  For a cell computed in the same
    plan (``computed=True``) the test is bound to one evaluation of the cell,
    since pushing the filter below the projection would otherwise copy the
    cell expression into every range term."""
    def test(c):
        cond = F.lit(False)
        for lo, hi in ranges:
            cond = cond | c.between(F.lit(lo), F.lit(hi))
        return cond

    if computed:
        return _let(_c(cell), test)
    return test(_c(cell))


def with_leaf_cell(df, lat: str, lon: str, out: str = "cell"):
    """C01 as a DataFrame step: the same arithmetic as ``leaf_cell``, but
    every intermediate is a column of its own projection, so the whole chain
    stays in whole-stage codegen (no higher-order function) and no
    subexpression is copied.  Bit-identical to ``leaf_cell``.  Use it where
    the cell is written, grouped or joined; to filter on a cell computed in the
    same plan use ``leaf_cell`` with ``in_ranges(..., computed=True)``, since
    a pushed-down filter would re-inline these projections."""
    t = "__s2_"
    la, lo = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    df = df.withColumn(t + "x", F.cos(la) * F.cos(lo)).withColumn(t + "y", F.cos(la) * F.sin(lo)) \
           .withColumn(t + "z", F.sin(la))
    x, y, z = F.col(t + "x"), F.col(t + "y"), F.col(t + "z")
    axis = F.when(F.abs(x) > F.abs(y), F.when(F.abs(x) > F.abs(z), 0).otherwise(2)) \
        .otherwise(F.when(F.abs(y) > F.abs(z), 1).otherwise(2))
    df = df.withColumn(t + "a", axis)
    ax = F.col(t + "a")
    df = df.withColumn(t + "f", F.when(F.when(ax == 0, x).when(ax == 1, y).otherwise(z) < 0, ax + 3).otherwise(ax))
    face = F.col(t + "f")
    u = (F.when(face == 0, y / x).when(face == 1, -x / y).when(face == 2, -x / z)
         .when(face == 3, z / x).when(face == 4, z / y).otherwise(-y / z))
    v = (F.when(face == 0, z / x).when(face == 1, z / y).when(face == 2, -y / z)
         .when(face == 3, y / x).when(face == 4, -x / y).otherwise(-x / z))
    df = df.withColumn(t + "u", u).withColumn(t + "v", v)
    df = df.withColumn(t + "i", _st_to_ij(_uv_to_st(F.col(t + "u")))) \
           .withColumn(t + "j", _st_to_ij(_uv_to_st(F.col(t + "v"))))
    tbl = F.array(*[F.lit(int(v_)) for v_ in _lookup_pos()])
    i, j = F.col(t + "i"), F.col(t + "j")
    ori = face.cast("long").bitwiseAND(F.lit(1))
    names = []
    for k in range(7, -1, -1):
        idx = (F.shiftleft(F.shiftright(i, 4 * k).bitwiseAND(F.lit(15)), 6)
               .bitwiseOR(F.shiftleft(F.shiftright(j, 4 * k).bitwiseAND(F.lit(15)), 2)).bitwiseOR(ori))
        name = f"{t}b{k}"
        df = df.withColumn(name, F.element_at(tbl, (idx + 1).cast("int")).cast("long"))
        names.append((k, name))
        ori = F.col(name).bitwiseAND(F.lit(3))
    pos = F.lit(0).cast("long")
    for k, name in names:
        pos = pos.bitwiseOR(F.shiftleft(F.shiftright(F.col(name), 2), 8 * k))
    cid = F.shiftleft(face.cast("long"), 61).bitwiseOR(F.shiftleft(pos, 1)).bitwiseOR(F.lit(1))
    df = df.withColumn(out, F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), cid))
    return df.drop(*[c for c in df.columns if c.startswith(t)])
