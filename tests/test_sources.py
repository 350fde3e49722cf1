"""CSV strategies on the reference's 15-row fixture (written inline)."""
from tessera.sources import csv as CSV
from tessera.sources.views import SqlView

# The reference's locations.csv fixture (15 rows; header and
# values separated by ", ", the last two rows by ",").
LOCATIONS = """LAT, LON, CITY, NUMBER, YEAR
46.066667, 11.116667, Trento, 140, 2002
44.9441, -93.0852, St Paul, 125, 2003
13.752222, 100.493889, Bangkok, 150, 2004
45.420833, -75.69, Ottawa, 200, 2004
44.9801, -93.251867, Minneapolis, 350, 2005
46.519833, 6.6335, Lausanne, 560, 2006
48.428611, -123.365556, Victoria, 721, 2007
-33.925278, 18.423889, Cape Town, 550, 2008
-33.859972, 151.211111, Sydney, 436, 2009
41.383333, 2.183333, Barcelona, 914, 2010
39.739167, -104.984722, Denver, 869, 2011
52.95, -1.133333, Nottingham, 800, 2013
45.52, -122.681944, Portland, 840, 2014
37.5667,129.681944,Seoul,473,2015
50.733992,7.099814,Bonn,700,2016
"""


def _fixture(tmp_path):
    p = tmp_path / "locations.csv"
    p.write_text(LOCATIONS)
    return str(p)


def test_csv_guess_strategy(spark, tmp_path):
    df = CSV.read_layer(spark, _fixture(tmp_path), "guess")
    assert df.columns == ["location", "CITY", "NUMBER", "YEAR"]
    assert dict(df.dtypes)["NUMBER"] == "int"
    denver = df.where("CITY = 'Denver'").collect()
    assert len(denver) == 1 and denver[0].location.minx == -104.984722 and denver[0].location.miny == 39.739167
    assert df.count() == 15


def test_csv_attributes_and_specify(spark, tmp_path):
    df = CSV.read_layer(spark, _fixture(tmp_path), "attributes")
    assert dict(df.dtypes)["LAT"] == "double" and dict(df.dtypes)["CITY"] == "string"
    sp = CSV.read_layer(spark, _fixture(tmp_path), "specify", lat="LAT", lon="LON", point_col="pt")
    assert sp.columns[0] == "pt"


def test_view_parameters(spark):
    spark.range(10).createOrReplaceTempView("nums")
    v = SqlView("v_nums", "SELECT id FROM nums WHERE id > %lo%", validators={"lo": r"\d+"})
    assert v.frame(spark, {"lo": 7}).count() == 2
    import pytest

    with pytest.raises(ValueError):
        v.frame(spark, {"lo": "1 OR 1=1"})


def test_station_maps_round_trip(spark):
    from tessera.sources import stations as ST

    df = spark.createDataFrame([("s1", 1, {"t": 1.5, "h": 0.3}), ("s1", 2, {"t": 1.7}), ("s2", 1, {"p": 9.0})],
                               "station_id string, ts int, records map<string,double>")
    long = ST.to_long(df)
    assert long.count() == 4
    back = {(r.station_id, r.ts): dict(r.records) for r in ST.to_observations(long).collect()}
    assert back[("s1", 1)] == {"t": 1.5, "h": 0.3} and back[("s2", 1)] == {"p": 9.0}


def test_export_names_kinds_and_world_clip(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.functions import predicates as P
    from tessera.functions.geometry import Geom, line2, point
    from tessera.sources.export import export, export_names

    assert export_names(["a_very_long_name_1", "a_very_long_name_2", "geom"], "geom") == \
        ["a_very_lon", "a_very_lo1", "the_geom"]
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "id int, x double, y double")
    df = df.select("id", F.when(F.col("id") == 1, point("x", "y")).otherwise(line2("x", "y", F.lit(2.0), F.lit(3.0)))
                   .alias("geom"))
    out = str(tmp_path / "exp")
    export(df, out, "geom", fmt="parquet", max_records=1)
    back = spark.read.parquet(out)
    assert sorted(r.kind for r in back.select("kind").collect()) == ["Line", "Point"]
    pts = spark.createDataFrame([(1, 10.0, 10.0)], "id int, x double, y double").withColumn("geom", point("x", "y"))
    assert pts.where(P.geodetic_filter("bbox", "geom", Geom.box(-200, -100, 200, 100))).count() == 1
    assert pts.where(P.geodetic_filter("intersects", "geom", Geom.box(190, 0, 200, 5))).count() == 0
    assert pts.where(P.geodetic_filter("disjoint", "geom", Geom.box(190, 0, 200, 5))).count() == 1
