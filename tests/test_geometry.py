"""Exact predicates (property checks, hand cases), WKT / WKB codecs."""
import itertools

import brute_geometry as X
from tessera.functions.geometry import Geom, parse_wkb, parse_wkt, to_wkb

SHAPES = [
    Geom.point(1, 1), Geom.point(0, 0), Geom.point(5, 5),
    Geom.line([(0, 0), (2, 2)]), Geom.line([(-1, 1), (3, 1)]), Geom.line([(0, 2), (2, 2)]),
    Geom.box(0, 0, 2, 2), Geom.box(1, 1, 3, 3), Geom.box(0.5, 0.5, 1.5, 1.5), Geom.box(2, 0, 4, 2),
    Geom.polygon([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]),
    Geom.multi("MultiPoint", [Geom.point(1, 1), Geom.point(9, 9)]),
]


def test_disjoint_is_not_intersects_and_within_is_contains_swapped():
    for a, b in itertools.product(SHAPES, SHAPES):
        assert X.predicate("disjoint", a, b) == (not X.predicate("intersects", a, b))
        assert X.predicate("within", a, b) == X.predicate("contains", b, a)
        assert X.predicate("intersects", a, b) == X.predicate("intersects", b, a)


def test_hand_cases():
    sq = Geom.box(0, 0, 2, 2)
    assert X.predicate("contains", sq, Geom.point(1, 1))
    assert not X.predicate("contains", sq, Geom.point(0, 1))          # boundary is not interior
    assert X.predicate("touches", sq, Geom.point(0, 1))
    assert X.predicate("touches", sq, Geom.box(2, 0, 4, 2))            # shared edge
    assert X.predicate("overlaps", sq, Geom.box(1, 1, 3, 3))
    assert X.predicate("within", Geom.box(0.5, 0.5, 1.5, 1.5), sq)
    assert X.predicate("crosses", Geom.line([(-1, 1), (3, 1)]), sq)
    assert X.predicate("crosses", Geom.line([(0, 0), (2, 2)]), Geom.line([(0, 2), (2, 0)]))
    assert X.predicate("equals", Geom.box(0, 0, 2, 2), Geom.polygon([(2, 0), (2, 2), (0, 2), (0, 0)]))
    holed = Geom.polygon([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)])
    assert not X.predicate("intersects", holed, Geom.point(2, 2))       # inside the hole
    assert not X.predicate("contains", holed, Geom.box(0.5, 0.5, 3.5, 3.5))
    assert X.distance(Geom.point(0, 3), sq) == 1.0


def test_wkt_wkb_round_trip():
    for g in SHAPES + [Geom.multi("MultiPolygon", [Geom.box(0, 0, 1, 1), Geom.box(2, 2, 3, 3)])]:
        assert parse_wkt(g.to_wkt()) == g
        assert parse_wkb(to_wkb(g.kind, g.parts)) == g
    assert parse_wkt("POINT Z (1 2 3)") == Geom.point(1, 2)
    assert parse_wkt("not wkt") is None
