"""Relations, grid pairs, nearest neighbours, regions and spherical distances against brute force on random data."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import brute_geometry as B
from conftest import SF_SMALL
from tessera.functions import geodesic, regions, relate
from tessera.functions.geometry import GEOMETRY_T, Geom, geom_to_record
from tessera.operators import grid
from tessera.operators import joins as J
from tessera.operators import sort as W

G = GEOMETRY_T.simpleString()


def shapes(seed, n):
    rnd = random.Random(seed)
    g = lambda: rnd.randrange(0, 7)

    def one():
        k = rnd.randrange(8)
        x, y, s = g(), g(), rnd.randrange(1, 4)
        if k == 0:
            return Geom.point(x, y)
        if k == 1:
            return Geom.multi("MultiPoint", [Geom.point(g(), g()) for _ in range(rnd.randrange(1, 4))])
        if k == 2:
            pts = [(x, y), (x + s, g())]
            return Geom.line(pts + [p for p in [(g(), g())] if p != pts[-1]])
        if k == 3:
            return Geom.multi("MultiLineString", [Geom.line([(g(), g()), (g() + 8, g())]) for _ in range(2)])
        if k == 4:
            return Geom.multi("MultiPolygon", [Geom.box(x, y, x + 1, y + 1), Geom.box(x + 2, y, x + 3, y + 2)])
        if k == 5:
            return Geom.polygon([(x, y), (x + 4, y), (x + 4, y + 4), (x, y + 4)], [(x + 1, y + 1), (x + 2, y + 1), (x + 2, y + 2), (x + 1, y + 2)])
        if k == 6:
            return Geom.polygon([(x, y), (x + 3, y), (x + 3, y + 3), (x + 2, y + 3), (x + 2, y + 1), (x + 1, y + 1), (x + 1, y + 3), (x, y + 3)])
        return Geom.polygon([(x, y), (x + s, y), (x, y + s)])
    return [one() for _ in range(n)]


def frame(spark, geoms, name="geom", key="id"):
    return spark.createDataFrame([(i, geom_to_record(g)) for i, g in enumerate(geoms)], f"{key} int, {name} {G}")


def test_relations_of_random_shapes(spark):
    a, b = shapes(1, 500), shapes(2, 500)
    names = ["intersects", "disjoint", "within", "contains", "equals", "touches", "crosses", "overlaps"]
    df = frame(spark, a, "a").join(frame(spark, b, "b"), "id").repartition(4)
    got = {r["id"]: r for r in df.select("id", *[relate.relate(n, "a", "b").alias(n) for n in names], relate.distance("a", "b").alias("d")).collect()}
    for i, (x, y) in enumerate(zip(a, b)):
        assert {n: got[i][n] for n in names} == {n: B.predicate(n, x, y) for n in names}, (x, y)
        assert got[i]["d"] == pytest.approx(B.distance(x, y), abs=1e-9)


def test_relations_in_sql_without_python(spark):
    df = frame(spark, [Geom.box(0, 0, 2, 2)], "a").withColumn("b", Geom.box(1, 1, 3, 3).to_column())
    relate.relate("overlaps", "a", "b")
    df.createOrReplaceTempView("pairs")
    out = spark.sql("SELECT tessera_overlaps(a, b) AS o FROM pairs")
    assert out.first()["o"] is True
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    null = df.select(relate.relate("overlaps", F.lit(None).cast(G), "b").alias("o"), relate.distance("a", F.lit(None).cast(G)).alias("d")).first()
    assert null["o"] is None and null["d"] is None


def random_boxes(seed, n, dims):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        size = rnd.choice([0, 0.001, 0.03, 1, 30, 200])
        lows = [float(rnd.choice([rnd.uniform(-180, 180), rnd.randrange(-4, 4)])) for _ in range(dims)]
        out.append((i, *[v for lo in lows for v in (lo, lo + size * rnd.choice([1, 0.5]))]))
    return out


@pytest.mark.parametrize("dims, crowded", [(2, None), (2, 20), (3, None), (3, 20)])
def test_box_pairs(spark, monkeypatch, dims, crowded):
    """With few pairs a cell, cells are split again and again; the pairs stay the same."""
    if crowded:
        monkeypatch.setattr(grid, "CROWDED", crowded)
        monkeypatch.setattr(grid, "SPLITS", 3)
    a, b = random_boxes(1, 250, dims), random_boxes(2, 200, dims)
    col = lambda s: ", ".join(f"{s}{x}{d} double" for d in range(dims) for x in "lh")
    got = grid.box_pairs(spark.createDataFrame([*a, (900, *[None] * 2 * dims)], f"lkey int, {col('l')}"), spark.createDataFrame(b, f"rkey int, {col('r')}"), dims).collect()
    meet = lambda x, y: all(x[2 * d] <= y[2 * d + 1] and x[2 * d + 1] >= y[2 * d] for d in range(dims))
    assert sorted(map(tuple, got)) == sorted((x[0], y[0]) for x in a for y in b if meet(x[1:], y[1:]))


def test_a_box_has_few_cells_whatever_its_size(spark):
    rows = [(0, 0.0, 300.0, 0.0, 300.0), (1, 0.0, 1e-5, 0.0, 1e-5), (2, 5.0, 5.0, 5.0, 5.0)]
    left = spark.createDataFrame(rows, "lkey int, ll0 double, lh0 double, ll1 double, lh1 double").withColumn("lv", grid._level(2, "l"))
    assert max(r["count"] for r in grid._cells(left, 2, "l").groupBy("lkey").count().collect()) <= 4


@pytest.mark.parametrize("predicate", ["intersects", "within", "touches", "dwithin"])
def test_spatial_join_of_shapes(spark, predicate):
    a, b = shapes(3, 60), shapes(4, 50)
    left, right = frame(spark, a), frame(spark, b, key="other")
    j = J.spatial_join(left, right, predicate, distance=0.5 if predicate == "dwithin" else None)
    assert j.columns == ["id", "geom", "other", "geom_r"]
    hit = (lambda x, y: B.distance(x, y) <= 0.5) if predicate == "dwithin" else (lambda x, y: B.predicate(predicate, x, y))
    assert sorted((r["id"], r["other"]) for r in j.collect()) == [(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if hit(x, y)]


@pytest.mark.parametrize("kind", ["points", "shapes"])
def test_nearest_of_random_layers(spark, monkeypatch, kind):
    monkeypatch.setattr(W, "LEAF", 4)
    rnd = random.Random(6)
    if kind == "points":  # a dense spot, copies, outliers
        right = [Geom.point(rnd.randrange(30), rnd.randrange(30)) for _ in range(150)] + [Geom.point(5 + rnd.random() * 1e-7, 5) for _ in range(100)]
        right += [Geom.point(7, 7)] * 40 + [Geom.point(1e6, -1e6)]
        left = [Geom.point(rnd.uniform(-5, 35), rnd.uniform(-5, 35)) for _ in range(40)] + [Geom.point(7, 7), Geom.point(-1e5, 0)]
    else:
        right, left = shapes(7, 120), shapes(8, 40)
    got = W.knn_join(frame(spark, left, key="fid"), frame(spark, right, "geom_r", "fid_r"), 5).collect()
    own = {}
    for r in sorted(got, key=lambda r: (r["fid"], r["rank"])):
        own.setdefault(r["fid"], []).append((r["fid_r"], r["dist"]))
    for i, x in enumerate(left):
        want = sorted((round(B.distance(x, y), 9), k) for k, y in enumerate(right))[:5]
        assert [round(d, 9) for _, d in own[i]] == [d for d, _ in want]
        assert len({k for k, _ in own[i]}) == 5
        if kind == "points":
            assert [k for k, _ in own[i]] == [k for _, k in sorted((math.dist(x.parts[0][0][0], y.parts[0][0][0]), k) for k, y in enumerate(right))[:5]]


@pytest.mark.parametrize("seed", range(8))
def test_cut_regions_hold_the_same_places(seed):
    rnd = random.Random(seed)
    star = [(math.cos(a) * r + 3, math.sin(a) * r + 2) for a, r in ((i * 2 * math.pi / 14, rnd.uniform(1, 6)) for i in range(14))]
    hole = [(3.2, 2.1), (3.4, 2.1), (3.4, 2.3)]
    region = Geom.polygon(star, hole)
    box = (rnd.uniform(-2, 3), rnd.uniform(-3, 2), rnd.uniform(3.3, 7), rnd.uniform(2.2, 6))
    cut = regions.cut_to_box(region, *box)
    inside = lambda g, p: g is not None and B.Shape(g).locate(np.array([p]))[0] == "I"
    for _ in range(300):
        p = (rnd.uniform(-4, 9), rnd.uniform(-5, 9))
        held = box[0] < p[0] < box[2] and box[1] < p[1] < box[3]
        assert inside(cut, p) == (held and inside(region, p))
    if cut is not None:
        assert all(box[0] - 1e-9 <= x <= box[2] + 1e-9 and box[1] - 1e-9 <= y <= box[3] + 1e-9 for part in cut.parts for r in part for x, y in r)


def test_cut_edges():
    u = Geom.polygon([(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3)])
    arms = regions.cut_to_box(u, -1, 2, 4, 4)
    assert arms.kind == "MultiPolygon" and len(arms.parts) == 2
    assert regions.cut_to_box(u, 5, 5, 6, 6) is None and regions.cut_to_box(u, -1, -1, 4, 4) is u
    line = regions.cut_to_box(Geom.line([(-1, 0.5), (1, 0.5), (1, 9), (0.5, 9), (0.5, 0)]), 0, 0, 1, 1)
    assert line.kind == "MultiLineString" and len(line.parts) == 2
    assert regions.cut_to_box(Geom.multi("MultiPoint", [Geom.point(0, 0), Geom.point(5, 5)]), -1, -1, 1, 1).parts == ((((0.0, 0.0),),),)
    wide = Geom.box(-170, -10, 170, 10)
    parts = regions.quadrants(wide)
    assert len(parts) == 4 and all(math.hypot(*(c - a for a, c in zip(p.envelope()[:2], p.envelope()[2:]))) < 180 for p in parts)


def arc(lon1, lat1, lon2, lat2):
    a, b, c, d = map(math.radians, (lon1, lat1, lon2, lat2))
    return 2 * math.asin(min(1, math.sqrt(math.sin((d - b) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((c - a) / 2) ** 2)))


def test_metres(spark):
    rnd = random.Random(11)
    pts = [(rnd.uniform(-180, 180), rnd.uniform(-89, 89)) for _ in range(60)]
    ends = [((x, y), (x + rnd.uniform(-20, 20), max(-89, min(89, y + rnd.uniform(-20, 20))))) for x, y in pts]
    a, b = [Geom.point(*p) for p in pts], [Geom.line(e) for e in ends[1:] + ends[:1]]
    df = frame(spark, a, "a").join(frame(spark, b, "b"), "id")
    got = {r["id"]: r["m"] for r in df.select("id", geodesic.metres("a", "b").alias("m")).collect()}

    def slerp(p, q, t):
        v = [[math.cos(math.radians(la)) * math.cos(math.radians(lo)), math.cos(math.radians(la)) * math.sin(math.radians(lo)), math.sin(math.radians(la))] for lo, la in (p, q)]
        w = arc(*p, *q)
        x = [(math.sin((1 - t) * w) * i + math.sin(t * w) * j) / math.sin(w) for i, j in zip(*v)]
        return math.degrees(math.atan2(x[1], x[0])), math.degrees(math.asin(max(-1, min(1, x[2]))))
    for i in got:
        p, (q, r) = pts[i], b[i].parts[0][0]
        near = min(arc(*p, *slerp(q, r, t / 4000)) for t in range(4001)) * geodesic.EARTH_RADIUS_M
        assert got[i] <= near + 1e-6 and got[i] == pytest.approx(near, rel=1e-3, abs=50)


def test_metres_join_over_the_pole_and_the_date_line(spark):
    a = frame(spark, [Geom.point(179.9, 0), Geom.point(10, 89.9), Geom.point(0, 0)])
    b = frame(spark, [Geom.point(-179.9, 0), Geom.point(-170, 89.9), Geom.line([(-1, 0.1), (1, 0.1)]), Geom.point(90, 0)], "geom_r", "other")
    got = J.metres_join(a, b, 25_000, left_key="id", right_key="other").collect()
    assert sorted((r["id"], r["other"], round(r["metres"] / 100)) for r in got) == [(0, 0, 222), (1, 1, 222), (2, 2, 111)]


# ---------------------------------------------------------------- coverings and stores
def cover_shapes(n):
    rnd, out = random.Random(3), []
    for _ in range(n):
        x, y, s = rnd.uniform(-179, 179), rnd.uniform(-85, 85), rnd.choice([0.01, 0.3, 2, 20])
        out.append(rnd.choice([Geom.line([(x, y), (x + s, min(89, y + s / 2))]), Geom.box(x, y, x + s, min(90, y + s)), Geom.polygon([(x, y), (x + s, y), (x, min(89, y + s))]),
                               Geom.multi("MultiPoint", [Geom.point(x, y), Geom.point(x + s, y)])]))
    return out


@pytest.mark.parametrize("level, most", [(6, 1000), (10, 30)])
def test_row_covers_equal_literal_covers(spark, level, most):
    from tessera.functions import cells as C
    from tessera.functions import cover as V

    gs = cover_shapes(40)
    ids = F.transform(V.cover("geom", level, most), lambda c: V.cell_id(c["face"], c["i"], c["j"], c["level"]))
    df = frame(spark, gs).select("id", ids.alias("c"))
    assert {r["id"]: sorted(r["c"]) for r in df.collect()} == {i: C.covering(g, level, max_cells=most) for i, g in enumerate(gs)}
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_region_cells_equal_literal_covers(spark):
    from tessera.functions import cells as C
    from tessera.functions import cover as V
    from tessera.sources.cellstore import covering_frame

    region = Geom.polygon([(0, 0), (30, 5), (20, 40)])
    assert sorted(r["cell"] for r in V.region_cells(spark, region, 6).collect()) == C.covering(region, 6)
    up = {C.token_py(C.parent_py(c, lv)) for c in C.covering(region, 5) for lv in range(6)}
    assert {r["block"] for r in covering_frame(spark, region, 5).collect()} == up


def test_store_reads_without_a_shuffle(spark, tmp_path):
    from tessera.sources import cellstore as CS

    path, catalog = str(tmp_path / "store"), str(tmp_path / "catalog")
    gs = cover_shapes(80) + [Geom.box(-170, -80, 170, 80), Geom.point(3, 4)]
    CS.write_layer(frame(spark, gs, key="fid"), path, level=7, catalog=catalog, layer_name="mixed")
    row = CS.read_catalog(spark, catalog).first()
    assert row["layer_name"] == "mixed" and row["envelope"]["minx"] == min(g.envelope()[0] for g in gs)
    for box in [(-20, -20, 60, 40), (2.5, 3.5, 3.5, 4.5), (-180, -90, 180, 90), (100, 50, 100.01, 50.01)]:
        got = CS.box_query(spark, path, *box, level=7)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["fid"] for r in got.select("fid").collect()) == [i for i, g in enumerate(gs) if B.predicate("intersects", g, Geom.box(*box))]


def slanted(seed, n):
    rnd = random.Random(seed)
    return [Geom.line([(rnd.uniform(0, 9), 0.0), (rnd.uniform(0, 9), 10.0)]) for _ in range(n)] + [Geom.line([(0.0, 5.0), (9.0, 5.0)]), Geom.line([(1.0, 1.0), (1.0, 1.0)])]


@pytest.mark.parametrize("lines_on", ["left", "right"])
@pytest.mark.parametrize("predicate", ["intersects", "dwithin"])
def test_long_lines_stand_as_pieces(spark, predicate, lines_on):
    """Small features meet pieces of slanted lines, not their wide envelopes, and every pair is named once."""
    rnd = random.Random(9)
    at = lambda: (rnd.uniform(0, 9), rnd.uniform(0, 10))
    small = []
    for x, y in (at() for _ in range(60)):
        small += [Geom.line([(x, y), (x + 0.3, y + 0.2)]), Geom.polygon([(x, y), (x + 0.3, y), (x, y + 0.3)]), Geom.point(x, y)]
    lines = slanted(5, 40)
    a, b = (lines, small) if lines_on == "left" else (small, lines)
    left, right = frame(spark, a), frame(spark, b, key="other")
    got = J.spatial_join(left, right, predicate, distance=0.2 if predicate == "dwithin" else None, left_key="id", right_key="other")
    hit = (lambda x, y: B.distance(x, y) <= 0.2) if predicate == "dwithin" else (lambda x, y: B.predicate("intersects", x, y))
    assert sorted((r["id"], r["other"]) for r in got.collect()) == [(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if hit(x, y)]
    cut = J._boxes(J._whole(frame(spark, lines), "id", "l"), F.col("__l")["geom"], "l", 0.0, 0.3)
    assert cut.count() > 5 * len(lines) and cut.agg(F.sum((F.col("lh0") - F.col("ll0")) * (F.col("lh1") - F.col("ll1")))).first()[0] < 0.3 * sum(
        (x2 - x1) * (y2 - y1) for x1, y1, x2, y2 in (g.envelope() for g in lines))


def test_pairs_of_a_join_fetch_no_rows(spark):
    """The rows go to their boxes before the join: no join follows that of the boxes, and boxes need no exact test."""
    boxes = frame(spark, [Geom.box(i, 0, i + 2, 1) for i in range(5)])
    j = J.spatial_join(boxes, boxes.withColumnsRenamed({"id": "other", "geom": "g2"}), "intersects", right_geom="g2", left_key="id", right_key="other")
    plan = j.groupBy("id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "exists(" not in plan
    assert j.count() == sum(abs(i - k) <= 2 for i in range(5) for k in range(5))


def test_points_and_two_point_lines_meet_in_plain_columns(spark):
    points = frame(spark, [Geom.point(1.0, 1.0), Geom.point(2.0, 2.0), Geom.point(3.0, 1.0)])
    lines = frame(spark, [Geom.line([(0.0, 0.0), (2.0, 2.0)])], "lg", "line")
    bent = frame(spark, [Geom.line([(0.0, 0.0), (2.0, 2.0), (4.0, 0.0)])], "lg", "line").withColumn("line", F.lit(7))
    for predicate, want in (("intersects", [0, 1]), ("within", [0]), ("dwithin", [0, 1])):
        j = J.spatial_join(points, lines, predicate, right_geom="lg", left_points=True, distance=0.5)
        assert sorted(r["id"] for r in j.collect()) == want
        pairs = j.select("id", "line")._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1].splitlines()[0]
        assert "lambda" not in pairs
    both = J.spatial_join(points, lines.unionByName(bent), "intersects", right_geom="lg", left_points=True)
    assert sorted((r["id"], r["line"]) for r in both.collect()) == [(0, 0), (0, 7), (1, 0), (1, 7), (2, 7)]


def test_heavy_work_by_row_is_spread(spark):
    """A layer of one partition is covered, and related to a region, by many tasks."""
    from tessera.sources import cellstore as CS

    one = frame(spark, [Geom.box(i, 0, i + 0.5, 1) for i in range(20)]).coalesce(1)
    assert CS.layer_cells(one, "geom", 5).rdd.getNumPartitions() >= 8
    assert E.queries()["f19_f23_shapes_and_hexagon"](spark, SF_SMALL).rdd.getNumPartitions() >= 8


def test_features_with_unknown_places_are_left_to_relate(spark):
    """A null coordinate: the plain tests tell nothing."""
    row = frame(spark, [Geom.line([(0.0, 0.0), (1.0, 1.0)])]).withColumn("lg", F.col("geom"))
    for kind in ("MultiPoint", "LineString"):
        part = "array(array(named_struct('x', 5D, 'y', 5D), named_struct('x', CAST(NULL AS double), 'y', CAST(NULL AS double))))"
        parts = f"array({part})" if kind == "LineString" else "array(array(array(named_struct('x', 5D, 'y', 5D))), array(array(named_struct('x', CAST(NULL AS double), 'y', CAST(NULL AS double)))))"
        odd = F.expr(f"named_struct('kind', '{kind}', 'minx', 5D, 'miny', 5D, 'maxx', 5D, 'maxy', 5D, 'parts', {parts})")
        got = row.select(J._small_meets_line(odd, F.col("lg")).alias("m"), J._points_near_line(odd, F.col("lg"), 0.5).alias("p")).first()
        assert got["m"] is None and got["p"] is None


def test_nearest_long_lines(spark, monkeypatch):
    """Long slanted lines, of which many envelopes hold every point, and copies: few distances are worked out, and the ids of equal ones ascend."""
    rnd = random.Random(11)
    lines = [Geom.line([(rnd.random(), 0.0), (rnd.random(), 1.0)]) for _ in range(300)]
    lines += lines[:40] * 5 + [Geom.multi("MultiPoint", [Geom.point(9.0, 9.0), Geom.point(0.5, 0.5)])]
    points = [Geom.point(rnd.random(), rnd.random()) for _ in range(60)]
    asked = spark.sparkContext.accumulator(0)

    def counted(a, b):
        asked.add(1)
        x, y = a["parts"][0][0][0]
        ends = [(ring[0], ring[-1]) for part in b["parts"] for ring in part]
        along = [max(0.0, min(1.0, ((x - p[0]) * (q[0] - p[0]) + (y - p[1]) * (q[1] - p[1])) / (math.dist(p, q) ** 2 or 1.0))) for p, q in ends]
        return min(math.dist((x, y), (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))) for (p, q), t in zip(ends, along))

    monkeypatch.setattr(W.relate, "distance", F.udf(counted, "double"))
    got = W.knn_join(frame(spark, points, key="fid"), frame(spark, lines, "geom_r", "fid_r"), 4).collect()
    own = {i: sorted((r["rank"], r["fid_r"], round(r["dist"], 9)) for r in got if r["fid"] == i) for i in range(len(points))}
    for i, p in enumerate(points):
        assert [d for _, _, d in own[i]] == [d for d, _ in sorted((round(B.distance(p, y), 9), k) for k, y in enumerate(lines))[:4]]
        ids = {}
        for _, k, d in own[i]:
            ids.setdefault(d, []).append(k)
        assert all(x == sorted(x) for x in ids.values()) and len({k for _, k, _ in own[i]}) == 4
    assert asked.value <= 15 * len(points)


def test_a_layer_is_covered_once(spark):
    """Neither the rows of the cells nor a filter on them work out a feature's covering again; cells on every face are the literal ones."""
    from tessera.functions import cells as C
    from tessera.functions import cover as V
    from tessera.sources import cellstore as CS

    rnd = random.Random(4)
    gs = []
    for lat, lon in ((0, 0), (0, 90), (89, 0), (0, 177), (0, -90), (-89, 10), (45, 135), (-35.2, 45)):
        for s in (0.05, 1.0, 4.0):
            x, y = lon + rnd.uniform(-1, 1), max(-90, min(90 - s, lat + rnd.uniform(-1, 1)))
            gs += [Geom.line([(x, y), (x + s, y + s)]), Geom.polygon([(x, y), (x + s, y), (x, y + s)])]
    layer = frame(spark, gs)
    said = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("ATAN2(")
    cells = CS.layer_cells(layer, "geom", 9).select("id", "cell")
    assert said(cells) == said(layer.select(V.cover("geom", 9, 1000))) > 0
    got = {}
    for r in cells.collect():
        got.setdefault(r["id"], []).append(r["cell"])
    assert {i: sorted(c) for i, c in got.items()} == {i: C.covering(g, 9, max_cells=1000) for i, g in enumerate(gs)}
    assert CS.layer_cells(spark.createDataFrame([(1, None)], f"id int, geom {G}"), "geom", 9).count() == 0


def test_a_split_writes_boxes_only(spark, monkeypatch):
    """Crowded cells are found from the boxes, not by writing the rows again, and cells that boxes fill are not split in vain."""
    written = []
    monkeypatch.setattr(grid, "CROWDED", 20)
    monkeypatch.setattr(grid, "stored", lambda df, name, real=grid.stored: (written.append((name, df.columns)), real(df, name))[1])
    rnd = random.Random(3)
    tiny = [(i, x, x + 0.01, y, y + 0.01, "row") for i, (x, y) in enumerate((rnd.uniform(8.1, 15.8), rnd.uniform(8.1, 15.8)) for _ in range(60))]
    meet = lambda x, y: all(x[d] <= y[d + 1] and x[d + 1] >= y[d] for d in (1, 3))
    for wide, split in (([(k, 8.0 + k / 2, 12.0 + k / 2, 9.0, 13.0) for k in range(8)], True), ([(k, -k / 9, 24.0 + k / 9, 0.0, 24.0 + k / 9) for k in range(8)], False)):
        written.clear()
        pairs = grid.box_pairs(spark.createDataFrame(tiny, "lkey int, ll0 double, lh0 double, ll1 double, lh1 double, what string"),
                               spark.createDataFrame(wide, "rkey int, rl0 double, rh0 double, rl1 double, rh1 double"), 2, True)
        assert sorted((r["lkey"], r["rkey"], r["what"]) for r in pairs.collect()) == sorted((a[0], b[0], "row") for a in tiny for b in wide if meet(a, b))
        halved = [c for name, c in written if name == "halved"]
        assert all("what" not in c for c in halved) and (len(halved) > 0 or not split)
        if not split:
            assert len(halved) <= 2


@pytest.mark.parametrize("predicate", ["intersects", "dwithin"])
def test_vertices_are_fetched_for_rows_not_for_pairs(spark, predicate):
    """The plain tests read kinds and vertices that were put beside the boxes, and do not look for them in each pair."""
    small = [Geom.line([(0.0, 0.0), (1.0, 1.0)]), Geom.polygon([(4.0, 0.0), (5.0, 0.0), (4.0, 1.0)])] if predicate == "intersects" else [Geom.point(0.5, 0.4), Geom.point(4.0, 0.0)]
    lines = frame(spark, [Geom.line([(0.0, 1.0), (1.0, 0.0)])], "lg", "line")
    j = J.spatial_join(frame(spark, small), lines, predicate, right_geom="lg", distance=0.2, left_key="id", right_key="line")
    assert [(r["id"], r["line"]) for r in j.collect()] == [(0, 0)]
    tests = [x for x in j.select("id", "line")._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x or "Filter" in x]
    asked = ["__l_small" if predicate == "intersects" else "__l_few", "__l_x0", "__r_x1", "__r_segment"]
    assert any(all(c in x for c in asked) for x in tests)
