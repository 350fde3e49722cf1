"""SQL text for the native spatial expressions, term for term the same
arithmetic as the Spark columns (same literals, same operation order), so
Spark and DuckDB agree to the last bit on boundary points."""

from __future__ import annotations

from ..functions.geometry import Geom
from .sqlviews import dbl


def point_in_polygon(x: str, y: str, poly: Geom, boundary: bool = True) -> str:
    terms = []
    for (x1, y1, x2, y2) in poly.edges():
        if y1 == y2:
            continue
        terms.append(f"(CASE WHEN (({dbl(y1)} > {y}) <> ({dbl(y2)} > {y})) AND "
                     f"({x} < {dbl(x2 - x1)} * ({y} - {dbl(y1)}) / {dbl(y2 - y1)} + {dbl(x1)}) THEN 1 ELSE 0 END)")
    inside = f"((0 + {' + '.join(terms)}) % 2 = 1)"
    on = on_edges(x, y, poly)
    return f"({inside} OR {on})" if boundary else f"({inside} AND NOT {on})"


def on_edges(x: str, y: str, g: Geom) -> str:
    conds = []
    for (x1, y1, x2, y2) in g.edges():
        cross = f"(({dbl(x2 - x1)} * ({y} - {dbl(y1)})) - ({dbl(y2 - y1)} * ({x} - {dbl(x1)})))"
        conds.append(f"({cross} = 0 AND {x} BETWEEN {dbl(min(x1, x2))} AND {dbl(max(x1, x2))} "
                     f"AND {y} BETWEEN {dbl(min(y1, y2))} AND {dbl(max(y1, y2))})")
    return "(" + " OR ".join(conds) + ")"


def point_segment_distance(x: str, y: str, x1, y1, x2, y2) -> str:
    dx, dy = x2 - x1, y2 - y1
    ll = dx * dx + dy * dy
    if ll == 0:
        return f"sqrt(pow({x} - {dbl(x1)}, 2) + pow({y} - {dbl(y1)}, 2))"
    t = f"((({x} - {dbl(x1)}) * {dbl(dx)} + ({y} - {dbl(y1)}) * {dbl(dy)}) / {dbl(ll)})"
    t = f"least(greatest({t}, 0.0e0), 1.0e0)"
    return (f"sqrt(pow({x} - ({dbl(x1)} + {t} * {dbl(dx)}), 2) + "
            f"pow({y} - ({dbl(y1)} + {t} * {dbl(dy)}), 2))")


def point_geom_distance(x: str, y: str, g: Geom) -> str:
    if g.dimension == 0:
        terms = [f"sqrt(pow({x} - {dbl(p[0][0][0])}, 2) + pow({y} - {dbl(p[0][0][1])}, 2))" for p in g.parts]
    else:
        terms = [point_segment_distance(x, y, *e) for e in g.edges()]
    d = terms[0] if len(terms) == 1 else f"least({', '.join(terms)})"
    if g.dimension == 2:
        d = f"(CASE WHEN {point_in_polygon(x, y, g)} THEN 0.0e0 ELSE {d} END)"
    return d


def box(x: str, y: str, x1, y1, x2, y2) -> str:
    return (f"({x} >= {dbl(x1)} AND {x} <= {dbl(x2)} AND {y} >= {dbl(y1)} AND {y} <= {dbl(y2)})")


def s2_ctes(src: str, lat: str, lon: str, levels: tuple[int, ...]) -> str:
    """CTE chain computing S2 leaf ids (UBIGINT) and parent tokens per level
    for rows of ``src`` -- the same arithmetic as ``cells.leaf_cell``."""
    from ..functions.cells import _lookup_pos, lsb_for_level

    tbl = "[" + ", ".join(str(v) for v in _lookup_pos()) + "]"
    d2r = "0.017453292519943295"
    ctes = [
        f"s2a AS (SELECT *, cos({lat} * {d2r}) * cos({lon} * {d2r}) AS s2x, "
        f"cos({lat} * {d2r}) * sin({lon} * {d2r}) AS s2y, sin({lat} * {d2r}) AS s2z FROM {src})",
        "s2b AS (SELECT *, CASE WHEN abs(s2x) > abs(s2y) THEN (CASE WHEN abs(s2x) > abs(s2z) THEN 0 ELSE 2 END) "
        "ELSE (CASE WHEN abs(s2y) > abs(s2z) THEN 1 ELSE 2 END) END AS s2axis FROM s2a)",
        "s2c AS (SELECT *, CASE WHEN (CASE s2axis WHEN 0 THEN s2x WHEN 1 THEN s2y ELSE s2z END) < 0 "
        "THEN s2axis + 3 ELSE s2axis END AS s2face FROM s2b)",
        "s2d AS (SELECT *, CASE s2face WHEN 0 THEN s2y / s2x WHEN 1 THEN -s2x / s2y WHEN 2 THEN -s2x / s2z "
        "WHEN 3 THEN s2z / s2x WHEN 4 THEN s2z / s2y ELSE -s2y / s2z END AS s2u, "
        "CASE s2face WHEN 0 THEN s2z / s2x WHEN 1 THEN s2z / s2y WHEN 2 THEN -s2y / s2z "
        "WHEN 3 THEN s2y / s2x WHEN 4 THEN -s2x / s2y ELSE -s2x / s2z END AS s2v FROM s2c)",
        "s2e AS (SELECT *, "
        "CAST(least(greatest(floor((CASE WHEN s2u >= 0 THEN 0.5e0 * sqrt(1.0e0 + 3.0e0 * s2u) "
        "ELSE 1.0e0 - 0.5e0 * sqrt(1.0e0 - 3.0e0 * s2u) END) * 1073741824.0e0), 0), 1073741823) AS UBIGINT) AS s2i, "
        "CAST(least(greatest(floor((CASE WHEN s2v >= 0 THEN 0.5e0 * sqrt(1.0e0 + 3.0e0 * s2v) "
        "ELSE 1.0e0 - 0.5e0 * sqrt(1.0e0 - 3.0e0 * s2v) END) * 1073741824.0e0), 0), 1073741823) AS UBIGINT) AS s2j, "
        "CAST(s2face & 1 AS UBIGINT) AS s2o8, CAST(0 AS UBIGINT) AS s2p8 FROM s2d)",
    ]
    prev = "s2e"
    for k in range(7, -1, -1):
        name = f"s2h{k}"
        bits = (f"CAST({tbl}[CAST((((s2i >> {4 * k}) & 15) << 6) | (((s2j >> {4 * k}) & 15) << 2) "
                f"| s2o{k + 1} AS BIGINT) + 1] AS UBIGINT)")
        ctes.append(f"{name} AS (SELECT *, s2p{k + 1} | ((({bits}) >> 2) << {8 * k}) AS s2p{k}, "
                    f"({bits}) & 3 AS s2o{k} FROM {prev})")
        prev = name
    sel = [f"((CAST(s2face AS UBIGINT) << 61) | (s2p0 << 1) | 1) AS s2leaf"]
    ctes.append(f"s2f AS (SELECT *, {sel[0]} FROM {prev})")
    toks = []
    for L in levels:
        lsb = lsb_for_level(L)
        mask = (-lsb) & 0xFFFFFFFFFFFFFFFF
        toks.append(f"rtrim(lower(lpad(hex((s2leaf & CAST({mask} AS UBIGINT)) | CAST({lsb} AS UBIGINT)), 16, '0')), "
                    f"'0') AS token{L}")
    ctes.append(f"s2 AS (SELECT *, {', '.join(toks)} FROM s2f)")
    return ",\n".join(ctes)
