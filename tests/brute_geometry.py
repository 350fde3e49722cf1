"""Planar predicates of two geometries, row by row, as the tests' second opinion.

The method is point sampling of the skeletons: every
vertex, every crossing with the other geometry, the middle of every piece
between crossings, and one interior point per polygon are located in the other
geometry (interior / boundary / exterior).  Between two consecutive samples a
segment cannot change side, so these samples decide the DE-9IM cells that the
OGC predicates read.
"""

from __future__ import annotations

import math

import numpy as np

from tessera.functions.geometry import Geom

I, B, E = "I", "B", "E"


class Shape:
    """Arrays derived once per geometry."""

    def __init__(self, g: Geom):
        self.g = g
        self.dim = g.dimension
        segs, seg_info = [], []
        self.points = []
        if self.dim == 0:
            self.points = [p[0][0] for p in g.parts]
        for pi, part in enumerate(g.parts):
            for ri, ring in enumerate(part):
                n = len(ring)
                for k in range(n - 1):
                    segs.append((*ring[k], *ring[k + 1]))
                    seg_info.append((pi, ri, k, n - 1))
        self.segs = np.array(segs, dtype=float).reshape(-1, 4)
        self.seg_info = seg_info
        # line boundary = endpoints of odd multiplicity (mod-2 rule)
        self.line_bnd = set()
        if self.dim == 1:
            counts = {}
            for part in g.parts:
                ring = part[0]
                if ring[0] != ring[-1]:
                    for p in (ring[0], ring[-1]):
                        counts[p] = counts.get(p, 0) + 1
            self.line_bnd = {p for p, c in counts.items() if c % 2 == 1}

    # ------------------------------------------------------------------
    def locate(self, pts: np.ndarray, tol: float = 0.0) -> np.ndarray:
        """Location of each point (k,2) in this shape: array of I/B/E."""
        k = len(pts)
        out = np.full(k, E, dtype=object)
        if k == 0:
            return out
        if self.dim == 0:
            own = np.array(self.points, dtype=float)
            hit = (np.abs(pts[:, None, 0] - own[None, :, 0]) <= tol) & (np.abs(pts[:, None, 1] - own[None, :, 1]) <= tol)
            out[hit.any(axis=1)] = I
            return out
        on = _on_segments(pts, self.segs, tol)
        if self.dim == 1:
            out[on] = I
            for idx in np.nonzero(on)[0]:
                if (pts[idx, 0], pts[idx, 1]) in self.line_bnd:
                    out[idx] = B
            return out
        inside = _parity(pts, self.segs)
        out[inside] = I
        out[on] = B
        return out

    def interior_points(self) -> list[tuple[float, float]]:
        """One interior point per polygon part (scan-line midpoint)."""
        res = []
        if self.dim != 2:
            return res
        for part in self.g.parts:
            ys = sorted({p[1] for ring in part for p in ring})
            if len(ys) < 2:
                continue
            cands = []
            for a, b in zip(ys[:-1], ys[1:]):
                cands.append(((a + b) / 2.0, b - a))
            cands.sort(key=lambda c: -c[1])
            edges = np.array([(*r[k], *r[k + 1]) for r in part for k in range(len(r) - 1)], dtype=float)
            for y, _ in cands:
                x1, y1, x2, y2 = edges.T
                m = (y1 > y) != (y2 > y)
                xs = np.sort(x1[m] + (y - y1[m]) * (x2[m] - x1[m]) / (y2[m] - y1[m]))
                best = None
                for j in range(0, len(xs) - 1, 2):
                    w = xs[j + 1] - xs[j]
                    if w > 0 and (best is None or w > best[0]):
                        best = (w, (xs[j] + xs[j + 1]) / 2.0)
                if best is not None:
                    res.append((best[1], y))
                    break
        return res


def _on_segments(pts: np.ndarray, segs: np.ndarray, tol: float) -> np.ndarray:
    if len(segs) == 0:
        return np.zeros(len(pts), dtype=bool)
    px, py = pts[:, 0:1], pts[:, 1:2]
    x1, y1, x2, y2 = (segs[:, i][None, :] for i in range(4))
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    if tol == 0:
        col = cross == 0
    else:
        length = np.hypot(x2 - x1, y2 - y1)
        col = np.abs(cross) <= tol * np.maximum(length, 1e-300)
    inx = (px >= np.minimum(x1, x2) - tol) & (px <= np.maximum(x1, x2) + tol)
    iny = (py >= np.minimum(y1, y2) - tol) & (py <= np.maximum(y1, y2) + tol)
    return (col & inx & iny).any(axis=1)


def _parity(pts: np.ndarray, segs: np.ndarray) -> np.ndarray:
    px, py = pts[:, 0:1], pts[:, 1:2]
    x1, y1, x2, y2 = (segs[:, i][None, :] for i in range(4))
    straddle = (y1 > py) != (y2 > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        xc = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    cross = straddle & (px < xc)
    return (cross.sum(axis=1) % 2) == 1


def _split_params(a: np.ndarray, b: np.ndarray) -> list[list[float]]:
    """For each segment of ``a``, the parameters where ``b`` meets it."""
    res = [[0.0, 1.0] for _ in range(len(a))]
    if len(a) == 0 or len(b) == 0:
        return res
    px, py = a[:, 0:1], a[:, 1:2]
    rx, ry = a[:, 2:3] - px, a[:, 3:4] - py
    qx, qy = b[None, :, 0], b[None, :, 1]
    sx, sy = b[None, :, 2] - qx, b[None, :, 3] - qy
    denom = rx * sy - ry * sx
    qpx, qpy = qx - px, qy - py
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (qpx * sy - qpy * sx) / denom
        u = (qpx * ry - qpy * rx) / denom
        proper = (denom != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        rr = rx * rx + ry * ry
        colin = (denom == 0) & ((qpx * ry - qpy * rx) == 0) & (rr > 0)
        t0 = (qpx * rx + qpy * ry) / rr
        t1 = t0 + (sx * rx + sy * ry) / rr
    for i, j in zip(*np.nonzero(proper)):
        res[i].append(float(t[i, j]))
    for i, j in zip(*np.nonzero(colin)):
        lo, hi = sorted((float(t0[i, j]), float(t1[i, j])))
        if hi >= 0 and lo <= 1:
            res[i].append(min(max(lo, 0.0), 1.0))
            res[i].append(min(max(hi, 0.0), 1.0))
    return res


def _samples(sa: Shape, sb: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Sample points of ``sa`` with their location in ``sa`` itself."""
    pts, locs = [], []
    if sa.dim == 0:
        for p in sa.points:
            pts.append(p)
            locs.append(I)
        return np.array(pts, dtype=float).reshape(-1, 2), np.array(locs, dtype=object)
    own_loc_mid = I if sa.dim == 1 else B
    params = _split_params(sa.segs, sb.segs if sb.dim > 0 else np.zeros((0, 4)))
    if sb.dim == 0:
        # points of b lying on a's segments split them too
        bp = np.array(sb.points, dtype=float)
        for i, s in enumerate(sa.segs):
            rx, ry = s[2] - s[0], s[3] - s[1]
            rr = rx * rx + ry * ry
            if rr == 0:
                continue
            for x, y in bp:
                if (rx * (y - s[1]) - ry * (x - s[0])) == 0:
                    t = ((x - s[0]) * rx + (y - s[1]) * ry) / rr
                    if 0 <= t <= 1:
                        params[i].append(t)
    for i, s in enumerate(sa.segs):
        ts = sorted(set(params[i]))
        for t in ts:
            pts.append((s[0] + t * (s[2] - s[0]), s[1] + t * (s[3] - s[1])))
            locs.append(None)  # vertex / crossing: located below
        for t0, t1 in zip(ts[:-1], ts[1:]):
            tm = (t0 + t1) / 2.0
            pts.append((s[0] + tm * (s[2] - s[0]), s[1] + tm * (s[3] - s[1])))
            locs.append(own_loc_mid)
    arr = np.array(pts, dtype=float).reshape(-1, 2)
    loc = np.array(locs, dtype=object)
    todo = np.array([v is None for v in locs], dtype=bool)
    if todo.any():
        loc[todo] = [B if sa.dim == 2 or tuple(p) in sa.line_bnd else I for p in arr[todo].tolist()]
    if sa.dim == 2:
        ip = sa.interior_points()
        if ip:
            arr = np.vstack([arr, np.array(ip, dtype=float)])
            loc = np.concatenate([loc, np.array([I] * len(ip), dtype=object)])
    return arr, loc


def _scale_tol(*shapes: Shape) -> float:
    m = 1.0
    for s in shapes:
        if len(s.segs):
            m = max(m, float(np.abs(s.segs).max()))
        if s.points:
            m = max(m, max(abs(v) for p in s.points for v in p))
    return 1e-12 * m


def relate_cells(a: Geom, b: Geom) -> dict:
    sa, sb = Shape(a), Shape(b)
    tol = _scale_tol(sa, sb)
    pa, la = _samples(sa, sb)
    pb, lb = _samples(sb, sa)
    la_in_b = sb.locate(pa, tol)
    lb_in_a = sa.locate(pb, tol)
    cells = set()
    for own, other in zip(la, la_in_b):
        cells.add(("a", own, other))
    for own, other in zip(lb, lb_in_a):
        cells.add(("b", own, other))
    return {"cells": cells, "sa": sa, "sb": sb}


def _has(cells, side, own, other):
    return (side, own, other) in cells


def _interiors_meet(r) -> bool:
    c, sa, sb = r["cells"], r["sa"], r["sb"]
    if _has(c, "a", I, I) or _has(c, "b", I, I):
        return True
    # an area's boundary inside another area's interior: the interiors meet
    if sa.dim == 2 and sb.dim == 2 and (_has(c, "a", B, I) or _has(c, "b", B, I)):
        return True
    return False


def _meets(r) -> bool:
    c = r["cells"]
    return any(o != E for (_, _, o) in c)


def _a_outside_b(r) -> bool:
    """interior (or area) of a meets the exterior of b."""
    c, sa, sb = r["cells"], r["sa"], r["sb"]
    if _has(c, "a", I, E) or (sa.dim == 2 and _has(c, "a", B, E)):
        return True
    if sa.dim == 2 and sb.dim == 2 and _has(c, "b", B, I):
        return True
    return False


def _b_outside_a(r) -> bool:
    c, sa, sb = r["cells"], r["sa"], r["sb"]
    if _has(c, "b", I, E) or (sb.dim == 2 and _has(c, "b", B, E)):
        return True
    if sa.dim == 2 and sb.dim == 2 and _has(c, "a", B, I):
        return True
    return False


def _within(r) -> bool:
    """a within b."""
    c, sa, sb = r["cells"], r["sa"], r["sb"]
    if sa.dim > sb.dim:
        return False
    if any(side == "a" and o == E for (side, _, o) in c):
        return False
    if sa.dim == 2 and _has(c, "b", B, I):
        return False
    return _interiors_meet(r)


def _flip(r):
    flipped = {(("b" if s == "a" else "a"), own, o) for (s, own, o) in r["cells"]}
    return {"cells": flipped, "sa": r["sb"], "sb": r["sa"]}


def predicate(name: str, a: Geom, b: Geom) -> bool:
    r = relate_cells(a, b)
    sa, sb = r["sa"], r["sb"]
    if name == "intersects":
        return _meets(r)
    if name == "disjoint":
        return not _meets(r)
    if name == "within":
        return _within(r)
    if name == "contains":
        return _within(_flip(r))
    if name == "equals":
        return _within(r) and _within(_flip(r))
    if name == "touches":
        if sa.dim == 0 and sb.dim == 0:
            return False
        return _meets(r) and not _interiors_meet(r)
    if name == "crosses":
        if sa.dim < sb.dim:
            return _interiors_meet(r) and _a_outside_b(r)
        if sa.dim > sb.dim:
            return _interiors_meet(r) and _b_outside_a(r)
        if sa.dim == 1:
            # interiors meet only in points: no piece of a runs along b
            return _interiors_meet(r) and not _mid_on_interior(a, b)
        return False
    if name == "overlaps":
        if sa.dim != sb.dim:
            return False
        if sa.dim == 1 and not _mid_on_interior(a, b):
            return False
        return _interiors_meet(r) and _a_outside_b(r) and _b_outside_a(r)
    raise ValueError(name)


def _mid_on_interior(a: Geom, b: Geom) -> bool:
    """Some piece of line a runs along line b (1-D overlap)."""
    sa, sb = Shape(a), Shape(b)
    params = _split_params(sa.segs, sb.segs)
    mids = []
    for i, s in enumerate(sa.segs):
        ts = sorted(set(params[i]))
        for t0, t1 in zip(ts[:-1], ts[1:]):
            tm = (t0 + t1) / 2.0
            mids.append((s[0] + tm * (s[2] - s[0]), s[1] + tm * (s[3] - s[1])))
    if not mids:
        return False
    return bool(_on_segments(np.array(mids), sb.segs, _scale_tol(sa, sb)).any())


def distance(a: Geom, b: Geom) -> float:
    if predicate("intersects", a, b):
        return 0.0
    sa, sb = Shape(a), Shape(b)
    pa = _vertices(sa)
    pb = _vertices(sb)
    best = math.inf
    if len(sb.segs):
        best = min(best, _pts_to_segs(pa, sb.segs))
    if len(sa.segs):
        best = min(best, _pts_to_segs(pb, sa.segs))
    if not len(sa.segs) and not len(sb.segs):
        d = np.hypot(pa[:, None, 0] - pb[None, :, 0], pa[:, None, 1] - pb[None, :, 1])
        best = float(d.min())
    return best


def _vertices(s: Shape) -> np.ndarray:
    if s.dim == 0:
        return np.array(s.points, dtype=float)
    return np.vstack([s.segs[:, 0:2], s.segs[:, 2:4]])


def _pts_to_segs(p: np.ndarray, segs: np.ndarray) -> float:
    px, py = p[:, 0:1], p[:, 1:2]
    x1, y1, x2, y2 = (segs[:, i][None, :] for i in range(4))
    dx, dy = x2 - x1, y2 - y1
    ll = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(ll > 0, ((px - x1) * dx + (py - y1) * dy) / ll, 0.0)
    t = np.clip(t, 0.0, 1.0)
    return float(np.hypot(px - (x1 + t * dx), py - (y1 + t * dy)).min())
