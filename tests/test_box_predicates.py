"""Native box and point predicates against the exact geometry functions, on random shapes."""
import random

from pyspark.sql import functions as F

from tessera.functions import predicates as P
from brute_geometry import predicate
from tessera.functions.geometry import GEOMETRY_T, Geom, geom_to_record


def shapes():
    rnd = random.Random(12)
    p = lambda: (rnd.randint(0, 12) / 2, rnd.randint(0, 12) / 2)
    out = [Geom.point(*p()) for _ in range(40)]
    for _ in range(60):
        a, b = p(), p()
        if a != b:
            out.append(Geom.line([a, b] + [q for q in [p()] if q != b]))
    for _ in range(60):
        x, y = p()
        w, h = rnd.randint(1, 10) / 2, rnd.randint(1, 10) / 2
        out.append(Geom.box(x, y, x + w, y + h) if rnd.random() < 0.4 else Geom.polygon([(x, y), (x + w, y), (x, y + h)]))
    return out


def test_native_predicates_match_exact(spark):
    gs = shapes()
    schema = "id int, geom " + GEOMETRY_T.simpleString()
    df = spark.createDataFrame([(i, geom_to_record(g)) for i, g in enumerate(gs)], schema).repartition(2).cache()
    ids = lambda c: {r.id for r in df.where(c).select("id").collect()}
    boxes = [(1, 1, 3, 3), (2, 2, 2.5, 6), (0, 0, 6, 6), (4, 0.5, 6, 1)]
    for b in boxes:
        box = Geom.box(*b)
        assert ids(P.bbox("geom", *b)) == {i for i, g in enumerate(gs) if predicate("intersects", g, box)}, b
        assert ids(P.within("geom", box)) == {i for i, g in enumerate(gs) if predicate("within", g, box)}, b
    for xy in [(1, 1), (2.5, 2), (3, 3), (0.5, 6)]:
        pt = Geom.point(*xy)
        assert ids(P.intersects("geom", pt)) == {i for i, g in enumerate(gs) if predicate("intersects", g, pt)}, xy
        assert ids(P.contains("geom", pt)) == {i for i, g in enumerate(gs) if predicate("contains", g, pt)}, xy
    df.unpersist()
