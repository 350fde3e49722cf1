"""S2 cells: native column == Python reference math; covering properties."""
import random

from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions.geometry import Geom


def test_known_cells():
    assert C.leaf_cell_py(0.0, 0.0) == 0x1000000000000001
    assert C.token_py(C.parent_py(C.leaf_cell_py(40.7128, -74.006), 9)).startswith("89c25")


def test_native_matches_python_including_faces_and_poles(spark):
    random.seed(7)
    pts = [(random.uniform(-90, 90), random.uniform(-180, 180)) for _ in range(300)]
    pts += [(89.999, 10.0), (-89.999, -170.0), (0.0, 180.0), (0.0, -180.0), (45.0, 45.0), (-45.0, 135.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = df.select("lat", "lon", C.leaf_cell("lat", "lon").alias("c"),
                    C.token(C.parent(C.leaf_cell("lat", "lon"), 10)).alias("t")).collect()
    for r in got:
        exp = C.leaf_cell_py(r["lat"], r["lon"])
        assert r["c"] == exp
        assert r["t"] == C.token_py(C.parent_py(exp, 10))


def test_covering_contains_points_of_box():
    box = Geom.box(116.2, 39.3, 116.6, 39.7)
    for kw in ({}, {"min_level": 8}, {"max_cells": 20}):
        ranges = C.cell_ranges(C.covering(box, 12, **kw))
        random.seed(3)
        for _ in range(500):
            lat, lon = random.uniform(39.3, 39.7), random.uniform(116.2, 116.6)
            leaf = C.leaf_cell_py(lat, lon)
            assert any(lo <= leaf <= hi for lo, hi in ranges)


def test_parent_is_in_covering_and_from_token(spark):
    cell = C.leaf_cell_py(39.9, 116.4)
    cov = C.covering(Geom.box(116.3, 39.8, 116.5, 40.0), 10)
    assert C.parent_py(cell, 10) in cov
    tok = C.token_py(C.parent_py(cell, 10))
    r = spark.createDataFrame([(tok,)], "t string").select(C.from_token("t").alias("c")).first()
    assert r["c"] == C.parent_py(cell, 10)
    assert C.cell_level_py(r["c"]) == 10
