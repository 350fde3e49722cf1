"""Literal query regions cut by boxes (F27): half-plane by half-plane, on the driver, once per query."""

from __future__ import annotations

import math

from .geometry import Geom

WORLD = (-180.0, -90.0, 180.0, 90.0)
#: A region with a longer diagonal (degrees) is cut into quadrants of QUADRANT degrees.
LONGEST, QUADRANT = 180.0, 90

Ring = list[tuple[float, float]]


def _cut_at(a, b, axis: int, at: float):
    t = (at - a[axis]) / (b[axis] - a[axis])
    other = a[1 - axis] + t * (b[1 - axis] - a[1 - axis])
    return (at, other) if axis == 0 else (other, at)


def _half_plane(rings: list[Ring], axis: int, at: float, above: bool) -> list[Ring]:
    """Closed rings (first = last) cut to one side of a line.

    The chains on the kept side end on the line; along it, their ends bound the region's inside
    in pairs, so joining the pairs closes the chains into rings, however many pieces a ring falls into."""
    kept = lambda p: p[axis] >= at if above else p[axis] <= at
    whole, chains = [], []
    for ring in rings:
        pts = ring[:-1]
        if all(map(kept, pts)):
            whole.append(ring)
            continue
        if not any(map(kept, pts)):
            continue
        start = next(i for i, p in enumerate(pts) if not kept(p))
        chain: Ring = []
        for i in range(len(pts)):
            a, b = pts[(start + i) % len(pts)], pts[(start + i + 1) % len(pts)]
            if kept(b) and not kept(a):
                chain = [_cut_at(a, b, axis, at), b]
            elif kept(a) and kept(b):
                chain.append(b)
            elif kept(a):
                chains.append([*chain, _cut_at(a, b, axis, at)])
    ends = sorted(((c[e][1 - axis], n, e) for n, c in enumerate(chains) for e in (0, -1)))
    partner = {}
    for (_, n, e), (_, m, f) in zip(ends[::2], ends[1::2]):
        partner[n, e], partner[m, f] = (m, f), (n, e)
    left = set(range(len(chains)))
    while left:
        first = min(left)
        ring, at_end = list(chains[first]), -1
        left.discard(first)
        n, e = partner[first, at_end]
        while n in left:
            left.discard(n)
            ring += chains[n] if e == 0 else chains[n][::-1]
            n, e = partner[n, -1 if e == 0 else 0]
        ring = [p for i, p in enumerate(ring) if p != ring[i - 1]]
        if len(set(ring)) >= 3 and abs(_area(ring)) > 0:
            whole.append([*ring, ring[0]])
    return whole


def _area(pts: Ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1])) / 2


def _inside(ring: Ring, p) -> bool:
    x, y = p
    return sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:])) % 2 == 1


def _polygons(rings: list[Ring]) -> Geom | None:
    """Rings as polygons: a ring inside an odd number of others is a hole of the smallest of them."""
    probe = [((r[0][0] + r[1][0]) / 2, (r[0][1] + r[1][1]) / 2) for r in rings]
    around = [[j for j, s in enumerate(rings) if j != i and _inside(s, probe[i])] for i in range(len(rings))]
    shells = [i for i in range(len(rings)) if len(around[i]) % 2 == 0]
    parts = {i: [tuple(rings[i])] for i in shells}
    for i, outer in enumerate(around):
        if i not in parts:
            parts[min((j for j in outer if j in parts), key=lambda j: abs(_area(rings[j][:-1])))].append(tuple(rings[i]))
    if not parts:
        return None
    return Geom("Polygon" if len(parts) == 1 else "MultiPolygon", tuple(tuple(p) for p in parts.values()))


def _cut_line(line, box) -> list[tuple]:
    """The pieces of a line inside a box."""
    out: list[list] = []
    for a, b in zip(line, line[1:]):
        lo, hi = 0.0, 1.0
        for axis in (0, 1):
            d, p = b[axis] - a[axis], a[axis]
            if d == 0:
                if not box[axis] <= p <= box[axis + 2]:
                    lo, hi = 1.0, 0.0
                continue
            lo, hi = max(lo, min((box[axis] - p) / d, (box[axis + 2] - p) / d)), min(hi, max((box[axis] - p) / d, (box[axis + 2] - p) / d))
        if lo >= hi:
            continue
        at = lambda t: a if t == 0 else b if t == 1 else (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))  # noqa: E731,B023
        if out and out[-1][-1] == at(lo):
            out[-1].append(at(hi))
        else:
            out.append([at(lo), at(hi)])
    return [tuple(p) for p in out]


def cut_to_box(region: Geom, x1: float, y1: float, x2: float, y2: float) -> Geom | None:
    """The part of a region in a closed box; None where nothing is left.  Of areas only areas are kept, of lines lines."""
    ex1, ey1, ex2, ey2 = region.envelope()
    if x1 <= ex1 and y1 <= ey1 and ex2 <= x2 and ey2 <= y2:
        return region
    if region.dimension == 0:
        held = tuple(p for p in region.parts if x1 <= p[0][0][0] <= x2 and y1 <= p[0][0][1] <= y2)
        return Geom(region.kind, held) if held else None
    if region.dimension == 1:
        pieces = [p for part in region.parts for p in _cut_line(part[0], (x1, y1, x2, y2))]
        return Geom("LineString" if len(pieces) == 1 else "MultiLineString", tuple((p,) for p in pieces)) if pieces else None
    rings = [list(r) for part in region.parts for r in part]
    for axis, at, above in ((0, x1, True), (0, x2, False), (1, y1, True), (1, y2, False)):
        rings = _half_plane(rings, axis, at, above)
    return _polygons(rings)


def quadrants(region: Geom) -> list[Geom]:
    """The region itself, or, if its diagonal reaches LONGEST, its parts in boxes of QUADRANT degrees."""
    x1, y1, x2, y2 = region.envelope()
    if math.hypot(x2 - x1, y2 - y1) < LONGEST:
        return [region]
    cut = [cut_to_box(region, x, y, x + QUADRANT, y + QUADRANT)
           for x in range(math.floor(x1), math.ceil(x2), QUADRANT) for y in range(math.floor(y1), math.ceil(y2), QUADRANT)]
    return [c for c in cut if c is not None]
