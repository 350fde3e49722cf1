"""Operators on tiny inline frames with hand-computed results."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import filters as FL
from tessera.functions import predicates as P
from tessera.functions.geometry import Geom, box, point
from tessera.operators import aggregates as A
from tessera.operators import dml as D
from tessera.operators import joins as J
from tessera.operators import trajectory as TR


def test_null_rules_keep_two_valued_not(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "id int, x int")
    ids = sorted(r.id for r in df.where(~FL.eq("x", 1)).collect())
    assert ids == [2, 3]
    assert sorted(r.id for r in df.where(FL.is_null("x")).collect()) == [2]
    with pytest.raises(NotImplementedError):
        FL.is_nil("x")


def test_like_translation():
    assert FL.like_to_sql("a*b.c!*", "*", ".", "!") == "a%b_c*"
    assert FL.like_to_sql("100%", "*", ".", "!") == "100\\%"


def test_temporal_arguments():
    with pytest.raises(ValueError):
        FL.during("ts", dt.datetime(2024, 1, 1))
    with pytest.raises(NotImplementedError):
        FL.unsupported_temporal("Meets")


def test_bbox_edges_and_null_geometry(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.5), (3, 1.0000001, 0.5), (4, None, None),
                                (5, 180.0, 90.0), (6, -180.0, -90.0)], "id int, x double, y double")
    df = df.withColumn("geom", point("x", "y"))
    got = sorted(r.id for r in df.where(P.bbox("geom", 0, 0, 1, 1, point_layer=True)).collect())
    assert got == [1, 2]
    world = sorted(r.id for r in df.where(P.bbox("geom", -180, -90, 180, 90, point_layer=True)).collect())
    assert world == [1, 2, 3, 5, 6]
    assert sorted(r.id for r in df.where(P.disjoint("geom", Geom.box(0, 0, 1, 1), point_layer=True)).collect()) \
        == [3, 5, 6]


def test_spatial_join_equals_nested_loop(spark):
    pts = spark.createDataFrame([(i, (i * 37 % 100) / 10.0, (i * 53 % 100) / 10.0) for i in range(200)],
                                "fid long, x double, y double").withColumn("geom", point("x", "y"))
    boxes = spark.createDataFrame([(k, k % 3 * 3.0, k // 3 * 3.0, k % 3 * 3.0 + 4.0, k // 3 * 3.0 + 4.0)
                                   for k in range(9)], "zid int, x1 double, y1 double, x2 double, y2 double")
    boxes = boxes.withColumn("zgeom", box("x1", "y1", "x2", "y2"))
    got = J.spatial_join(pts.select("fid", "geom"), boxes.select("zid", "zgeom"), "intersects",
                         right_geom="zgeom", left_points=True, cell_size=1.0)
    got = sorted((r.fid, r.zid) for r in got.collect())
    P_ = [(r.fid, r.x, r.y) for r in pts.collect()]
    B_ = [(r.zid, r.x1, r.y1, r.x2, r.y2) for r in boxes.collect()]
    exp = sorted((f, z) for f, x, y in P_ for z, a, b, c, d in B_ if a <= x <= c and b <= y <= d)
    assert got == exp
    # polygon x polygon pairs are deduplicated by the reference-point rule
    bb = J.spatial_join(boxes.select("zid", F.col("zgeom").alias("geom")),
                        boxes.select(F.col("zid").alias("zid2"), F.col("zgeom").alias("g2")),
                        "intersects", right_geom="g2", cell_size=1.0)
    pairs = [(r.zid, r.zid2) for r in bb.collect()]
    assert len(pairs) == len(set(pairs))
    exp2 = {(a[0], b[0]) for a in B_ for b in B_ if a[1] <= b[3] and a[3] >= b[1] and a[2] <= b[4] and a[4] >= b[2]}
    assert set(pairs) == exp2


def test_aggregates_nearest_and_paged_count(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 4.0, 6.0, 10.0)], "v double")
    assert A.nearest_value(df, "v", 5.0).first()[0] == 4.0      # tie -> lower
    assert A.nearest_value(df, "v", 6.0).first()[0] == 6.0      # exact hit
    assert A.count_paged(df, 3, 10).first()[0] == 1
    assert A.count_paged(df, 10).first()[0] == 0


def test_dml_keys_and_snapshots(spark, tmp_path):
    base = spark.range(0, 50).withColumnRenamed("id", "k").withColumn("v", F.lit(1.0)).repartition(4)
    new = spark.range(0, 30).withColumn("v", F.lit(2.0)).drop("id").repartition(3)
    _, keys = D.insert(base, new, "k", policy="max_plus_one")
    ks = sorted(r.k for r in keys.collect())
    assert ks == list(range(50, 80))
    with pytest.raises(ValueError):
        D.update(base, F.lit(True), {"k": 1}, pk=["k"])
    layer = D.SnapshotLayer(spark, str(tmp_path / "layer"))
    layer.replace(base)
    diff = D.Diff(base.where("k < 5").select("k"), base.where("k = 7").withColumn("v", F.lit(9.0)),
                  new.limit(0).withColumn("k", F.lit(0).cast("long")).select("k", "v"))
    layer.commit(diff, "k")
    cur = layer.read()
    assert cur.count() == 45 and cur.where("k = 7").first().v == 9.0
    assert layer.current()[0] == 2


def _orders(spark, n):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("v"))


def test_commits_from_one_version(spark, tmp_path):
    """Of two commits from one version, one on other buckets is put on top; one on the same buckets is refused."""
    layer = D.SnapshotLayer(spark, str(tmp_path / "layer"), rows_per_bucket=20)
    base = layer.replace(_orders(spark, 500), "k")
    assert len(layer.current()[1]) >= 16
    none = _orders(spark, 0)
    add = lambda k: D.Diff(none.select("k"), none, spark.createDataFrame([(k, 1.0)], "k long, v double"))
    assert layer.commit(add(1000), "k", base) == base + 1
    same = next(b for b in layer.buckets(base + 1) if b not in layer.buckets(base))
    probe = layer._placed(spark.range(2000, 4000).withColumnRenamed("id", "k"), "k", layer.buckets(base + 1)).collect()
    inside = next(r["k"] for r in probe if r["__bucket"] == same.label)
    outside = next(r["k"] for r in probe if r["__bucket"] != same.label)
    with pytest.raises(D.ConflictError):
        layer.commit(add(inside), "k", base)
    assert layer.version() == base + 1 and layer.read().count() == 501
    assert layer.commit(add(outside), "k", base) == base + 2
    assert layer.read().count() == 502 and layer.read(base).count() == 500
    with pytest.raises(D.ConflictError):  # the number itself is taken
        if not layer._publish(base + 1, [], none.schema, "k"):
            raise D.ConflictError


def test_buckets_grow_with_the_layer(spark, tmp_path):
    layer = D.SnapshotLayer(spark, str(tmp_path / "layer"), rows_per_bucket=50)
    layer.replace(_orders(spark, 40), "k")
    assert len(layer.current()[1]) == 1
    none = _orders(spark, 0)
    layer.commit(D.Diff(none.select("k"), none, _orders(spark, 1000).where("k >= 40")), "k")
    held = layer.current()[1]
    assert len(held) == 32 and sum(b.rows for b in held) == 1000
    assert layer.read().agg(F.sum("v")).first()[0] == sum(2.0 * i for i in range(1000))
    layer.commit(D.Diff(_orders(spark, 1000).select("k"), none, none), "k")
    assert layer.read().count() == 0 and layer.read().columns == ["k", "v"]
    layer.commit(D.Diff(none.select("k"), none, none), "k")
    layer.commit(D.Diff(none.select("k"), none, _orders(spark, 3)), "k")
    assert sorted(r.k for r in layer.read().collect()) == [0, 1, 2]


def test_small_buckets_share_files(spark, tmp_path):
    """The files of a commit grow with its rows, not with its buckets, and a refused commit writes none."""
    layer = D.SnapshotLayer(spark, str(tmp_path / "layer"), rows_per_bucket=10)
    base = layer.replace(_orders(spark, 5000), "k")
    assert len(layer.current()[1]) == 512
    written = lambda: {p for p in (tmp_path / "layer").rglob("*.parquet") if "_manifests" not in str(p)}
    assert len(written()) <= 64
    none = _orders(spark, 0)
    layer.commit(D.Diff(none.select("k"), _orders(spark, 20).withColumn("v", F.lit(-1.0)), none), "k", base)
    before = written()
    with pytest.raises(D.ConflictError):
        layer.commit(D.Diff(none.select("k"), _orders(spark, 20), none), "k", base)
    assert written() == before
    got = {r.k: r.v for r in layer.read().collect()}
    assert len(got) == layer.read().count() == 5000 and all(v == (-1.0 if k < 20 else 2.0 * k) for k, v in got.items())
    assert sum(b.rows for b in layer.current()[1]) == 5000 and layer.read(base).where("v < 0").count() == 0


def test_trajectory_hours_and_t01(spark):
    assert TR.hours("2024-01-01 10:59:00", "2024-01-01 12:00:00") == ["2024010110", "2024010111", "2024010112"]
    rows = [(1, dt.datetime(2024, 1, 1, 10, 0), 116.3, 39.4), (1, dt.datetime(2024, 1, 1, 10, 30), 116.31, 39.41),
            (2, dt.datetime(2024, 1, 1, 10, 10), 118.0, 39.4)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, lon double, lat double")
    out = TR.vehicles_at(df, Geom.box(116.2, 39.3, 116.6, 39.7), "2024-01-01 10:45:00", window_seconds=3600)
    r = out.collect()
    assert len(r) == 1 and r[0].id == 1 and r[0].lon == 116.31


def test_relate_columns_polygons_and_points(spark):
    rows = [(1, 0.0, 0.0, 2.0, 2.0, 1.0, 1.0, 3.0, 3.0), (2, 0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0),
            (3, 0.0, 0.0, 4.0, 4.0, 1.0, 1.0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id int, a1 double, b1 double, a2 double, b2 double, "
                                     "c1 double, d1 double, c2 double, d2 double")
    df = df.withColumn("g1", box("a1", "b1", "a2", "b2")).withColumn("g2", box("c1", "d1", "c2", "d2"))
    ids = lambda name: sorted(r.id for r in df.where(P.relate_columns(name, "g1", "g2")).collect())
    assert ids("intersects") == [1, 3] and ids("disjoint") == [2]
    assert ids("overlaps") == [1] and ids("contains") == [3]
    pts = df.withColumn("p", point("c1", "d1"))
    got = sorted(r.id for r in pts.where(P.relate_columns("within", "p", "g1", a_points=True)).collect())
    assert got == [1, 3]
