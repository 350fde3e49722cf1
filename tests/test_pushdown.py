"""Filters reach the Parquet scan; two-valued logic on nulls."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import filters as FL
from tessera.functions import predicates as P
from tessera.functions.geometry import Geom, line2, point
from tessera.operators import joins as J
from tessera.operators import sort as W
from tessera.operators import trajectory as TR


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("push") / "layer")
    df = spark.range(200).select("id", (F.col("id") * 0.5).alias("v"), F.concat(F.lit("n"), "id").alias("name"),
                                 F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,cast(id as int))").alias("ts"),
                                 (F.col("id") / 10).alias("lon"), (F.col("id") / 20).alias("lat"))
    df.withColumn("geom", point("lon", "lat")).write.parquet(path)
    return spark.read.parquet(path)


def pushed(df):
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return " ".join(re.findall(r"PushedFilters: (.*)", plan))


T = dt.datetime(2024, 1, 3)
CASES = {
    "eq": (lambda: FL.eq("id", 5), "EqualTo(id,5)"),
    "text_eq": (lambda: FL.eq("name", "n5"), "EqualTo(name,n5)"),
    "gt": (lambda: FL.gt("v", 3.0), "GreaterThan(v,3.0)"),
    "between": (lambda: FL.between("v", 1.0, 2.0), "GreaterThanOrEqual(v,1.0)"),
    "like": (lambda: FL.like("name", "n1*"), "StringStartsWith(name,n1)"),
    "ids": (lambda: FL.id_filter("id", ["t.1", "t.2"], "t"), "In(id, [1,2])"),
    "during": (lambda: FL.during("ts", (T, T)), "GreaterThanOrEqual(ts"),
    "after": (lambda: FL.after("ts", T), "GreaterThan(ts"),
    "bbox": (lambda: P.bbox("geom", 1, 1, 2, 2, point_layer=True), "LessThanOrEqual(geom.minx,2.0)"),
    "loose": (lambda: P.bbox("geom", 1, 1, 2, 2, loose=True), "GreaterThanOrEqual(geom.maxy,1.0)"),
    "within": (lambda: P.within("geom", Geom.box(1, 1, 2, 2), point_layer=True), "geom.minx"),
    "dwithin": (lambda: P.dwithin("geom", Geom.point(1, 1), 0.5, point_layer=True), "geom.minx"),
    "region": (lambda: TR.in_region(Geom.box(1, 1, 2, 2)), "GreaterThanOrEqual(lon,1.0)"),
}


@pytest.mark.parametrize("name", CASES)
def test_pushed_to_parquet(layer, name):
    cond, want = CASES[name]
    assert want in pushed(layer.where(cond())), pushed(layer.where(cond()))


def test_two_valued_logic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, None, None)], "id int, v int, s string")
    ids = lambda c: [r.id for r in df.where(c).collect()]
    assert ids(FL.eq("v", 5)) == [1] and ids(~FL.eq("v", 5)) == [2] and ids(~FL.like("s", "a*")) == [2]
    assert ids(~FL.between("v", 1, 9)) == [2] and ids(~FL.eq("v", "abc")) == [1, 2] and ids(FL.eq("s", "A", match_case=False)) == [1]


def test_points_against_lines(spark):
    df = spark.createDataFrame([(1, -1.0, 1.0), (2, 1.0, 1.0), (3, 1.5, 1.0), (4, 2.0, 2.0)], "id int, x double, y double")
    pts = df.select("id", point("x", "y").alias("geom"))
    line = spark.range(1).select(F.lit("l").alias("line"), line2(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)).alias("lg"))
    got = lambda p: sorted(r.id for r in J.spatial_join(pts, line, p, right_geom="lg", left_points=True).collect())
    assert got("intersects") == [2, 4] and got("within") == [2]
    both = pts.join(pts.select(F.col("id").alias("id2"), F.col("geom").alias("g2")), F.col("id") == F.col("id2"))
    assert both.where(P.relate_columns("intersects", "geom", "g2", a_points=True)).count() == 4


def test_knn_far_point_and_few_candidates(spark):
    one = spark.createDataFrame([(1, 0.0, 0.0)], "fid int, x double, y double").select("fid", point("x", "y").alias("geom"))
    far = spark.createDataFrame([(9, 0.3, 0.0), (8, 50.0, -70.0)], "fid_r int, x double, y double").select("fid_r", point("x", "y").alias("geom_r"))
    assert [(r.fid_r, r["rank"]) for r in W.knn_join(one, far, 1).collect()] == [(9, 1)]
    assert [r.fid_r for r in W.knn_join(one, far, 5).orderBy("rank").collect()] == [9, 8]
    assert W.knn_join(one, far.limit(0), 3).collect() == []


def test_self_join_names_and_nested_outer(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "k int, g int")
    part = J.JoinPart(df, "t", alias="o", on=[("t.g", "o.g")])
    assert J.apply_joins(df, "t", [part]).count() == 5
    with pytest.raises(ValueError):
        J.apply_joins(df, "t", [J.JoinPart(df, "t", on=[("t.g", "t.g")])])
    none = J.JoinPart(df.where("k = 1"), "n", on=[("t.k", "n.k")], how="outer", nested=True)
    assert sorted((r.k, r.n is None) for r in J.apply_joins(df, "t", [none]).collect()) == [(1, False), (2, True), (3, True)]
