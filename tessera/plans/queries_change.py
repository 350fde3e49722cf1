"""Change and source queries: DML on a change set derived from orders
(D04-D11), CSV / JDBC / view / directory round trips of driver tables
(S01-S07, S14-S17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import filters as FL
from ..operators import dml as D
from . import sqlviews as V
from .layers import poi, table
from .registry import register

# The change set (FIXTURES.md) -- o_orderkey % 10: 0 removed,
# 1 price + 1, 2 also added again under key + 10,000,000.
ADD_OFFSET = 10_000_000


def _diff(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    removed = o.where(F.col("o_orderkey") % 10 == 0).select("o_orderkey")
    modified = o.where(F.col("o_orderkey") % 10 == 1).withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    added = o.where(F.col("o_orderkey") % 10 == 2).withColumn("o_orderkey", F.col("o_orderkey") + F.lit(ADD_OFFSET))
    return o, D.Diff(removed, modified, added)


@register("d09_read_through_diff", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 NOT IN (0, 1)
UNION ALL SELECT o_orderkey, o_totalprice + 1.0e0 FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT o_orderkey + {ADD_OFFSET}, o_totalprice FROM orders WHERE o_orderkey % 10 = 2""")
def d09_read_through_diff(spark, sf):
    base, diff = _diff(spark, sf)
    return D.read_through(base, diff, "o_orderkey").select("o_orderkey", "o_totalprice")


@register("d11_change_summary", """
SELECT 'added' AS change, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderkey % 10 = 2
UNION ALL SELECT 'modified', count(*), round(sum(o_totalprice + 1.0e0), 2) FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT 'modified_old', count(*), round(sum(o_totalprice), 2) FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT 'removed', count(*), round(sum(o_totalprice), 2) FROM orders WHERE o_orderkey % 10 = 0""")
def d11_change_summary(spark, sf):
    base, diff = _diff(spark, sf)
    return D.change_summary(base, diff, "o_orderkey", "o_totalprice")


@register("d05_d06_update_delete", V.with_(V.POI) + """
SELECT fid, CASE WHEN segment = 'BUILDING' THEN balance + 100.0e0 ELSE balance END AS balance FROM poi
WHERE NOT coalesce(nationkey = 0, false)""")
def d05_d06_update_delete(spark, sf):
    p = poi(spark, sf, with_geom=False).select("fid", "balance", "segment", "nationkey")
    up = D.update(p, FL.eq("segment", "BUILDING"), {"balance": F.col("balance") + F.lit(100.0)}, pk=["fid"])
    return D.delete(up, FL.eq("nationkey", 0)).select("fid", "balance")


@register("d08_upsert", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, 0.0e0 FROM orders WHERE o_orderstatus = 'F'""")
def d08_upsert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = o.where(FL.eq("o_orderstatus", "F")).withColumn("o_totalprice", F.lit(0.0))
    return D.upsert(o.drop("o_orderstatus"), new.drop("o_orderstatus"), "o_orderkey")


@register("d03_d04_insert_new_keys", """
SELECT count(*) AS n, min(k) AS first_key, max(k) AS last_key, count(DISTINCT k) AS distinct_keys FROM
 (SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS k
  FROM orders WHERE o_orderkey % 10 = 3) t""")
def d03_d04_insert_new_keys(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    new = o.where(F.col("o_orderkey") % 10 == 3).drop("o_orderkey")
    _, keys = D.insert(o, new, "o_orderkey", policy="max_plus_one")
    k = F.col("o_orderkey")
    return keys.agg(F.count(F.lit(1)).alias("n"), F.min(k).alias("first_key"), F.max(k).alias("last_key"),
                    F.count_distinct(k).alias("distinct_keys"))


# ---------------------------------------------------------------- sources
def _scratch(spark, name):
    from ..session import scratch_path

    return scratch_path(spark, name)


@register("s01_s06_csv_roundtrip", V.with_(V.POI) + "SELECT fid, name, lon, lat, balance FROM poi")
def s01_s06_csv_roundtrip(spark, sf):
    from ..functions.geometry import point
    from ..sources import csv as CSV

    path = _scratch(spark, "csv-poi")
    layer = poi(spark, sf, with_geom=False)
    src = layer.select("fid", "name", point("lon", "lat").alias("geom"), "balance")
    CSV.write(src, path, geom="geom", form="latlon")
    back = CSV.read_layer(spark, path, strategy="guess")
    return back.select(F.col("fid").cast("long").alias("fid"), "name",
                       F.col("location")["minx"].alias("lon"), F.col("location")["miny"].alias("lat"), "balance")


@register("s05_csv_wkt_roundtrip", V.with_(V.ROAD) + """
SELECT fid, least(x1, x2) AS minx, greatest(x1, x2) AS maxx, y1 AS miny, y2 AS maxy FROM road""")
def s05_csv_wkt_roundtrip(spark, sf):
    from ..sources import csv as CSV
    from .layers import road

    path = _scratch(spark, "csv-road")
    CSV.write(road(spark, sf).select("fid", "geom"), path, geom="geom", form="wkt")
    back = CSV.read_layer(spark, path, strategy="wkt", wkt="geom")
    g = F.col("geom")
    return back.select(F.col("fid").cast("long").alias("fid"), g["minx"].alias("minx"), g["maxx"].alias("maxx"),
                       g["miny"].alias("miny"), g["maxy"].alias("maxy"))


@register("s14_s15_jdbc_roundtrip", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 0.0e0""")
def s14_s15_jdbc_roundtrip(spark, sf):
    """Derby runs embedded in the driver's JVM (no server): write, then read with
    the filter and columns pushed into the database.  Local mode only: other machines'
    executors would see a database of their own."""
    import uuid

    from ..sources import jdbc as JD

    url = f"jdbc:derby:memory:tessera{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    JD.insert(cust, url, "CUSTOMER", props, not_null=["c_custkey"], mode="overwrite",
              column_types="c_name VARCHAR(64), c_mktsegment VARCHAR(32)")
    back = JD.read_table(spark, url, "CUSTOMER", properties=props)
    back = back.toDF(*[c.lower() for c in back.columns])
    return back.where(FL.eq("c_mktsegment", "AUTOMOBILE") & FL.gt("c_acctbal", 0.0)) \
        .select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal")


@register("s14_balanced_slices", """
SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, true AS by_number, true AS by_text FROM customer""")
def s14_balanced_slices(spark, sf):
    """A table with a skewed number, some null, and a skewed text, read in eight slices by either: no slice holds more than
    a third above the average, and the slice of nulls is one more."""
    import uuid

    from ..sources import jdbc as JD

    url = f"jdbc:derby:memory:tessera{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    k = F.col("c_custkey")
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.when(k % 10 < 9, k / 1000.0).when(k % 100 < 99, 1e6 + k).alias("num"),
        F.concat(F.lit("Customer#"), F.lpad((k * k % 1000).cast("string"), 4, "0"), F.col("c_custkey").cast("string")).alias("txt"))
    JD.insert(cust, url, "SKEWED", props, mode="overwrite", column_types="txt VARCHAR(64)")

    def even(df, nulls):
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        total = sum(sizes)
        if nulls:
            sizes.remove(nulls)
        return df.rdd.getNumPartitions() == 9 and max(sizes) <= 4 / 3 * (total - nulls) / 8 + 1

    num, txt = (JD.read_slices(spark, url, "SKEWED", c, 8, props, text) for c, text in (('"num"', False), ('"txt"', True)))
    nulls = cust.agg(F.count_if(F.col("num").isNull()), F.count_if(F.col("txt").isNull())).first()
    out = num.toDF(*[c.lower() for c in num.columns]).agg(F.count("*").alias("n"), F.sum("c_custkey").cast("long").alias("keys"))
    return out.select("n", "keys", F.lit(even(num, nulls[0])).alias("by_number"), F.lit(even(txt, nulls[1])).alias("by_text"))


@register("s17_refresh", """
SELECT 'a' AS layer, count(*) AS n, 2 AS added, 1 AS changed, 1 AS removed, 0 AS again FROM nation
UNION ALL SELECT 'b', 2 * count(*), 2, 1, 1, 0 FROM region UNION ALL SELECT 'd', count(*), 2, 1, 1, 0 FROM supplier UNION ALL SELECT 'e', count(*), 2, 1, 1, 0 FROM part""")
def s17_refresh(spark, sf):
    """Four files, of which one is written anew and one removed, and two new ones; a second refresh finds nothing."""
    from ..operators.snapshots import Folder
    from ..sources.views import FolderStore

    base, path = _scratch(spark, "folder"), _scratch(spark, "folder-store")
    rows = {n: table(spark, sf, t).select(F.lit(n).alias("layer"), F.col(c).cast("long").alias("k")) for n, t, c in
            (("a", "nation", "n_nationkey"), ("b", "region", "r_regionkey"), ("c", "customer", "c_custkey"), ("d", "supplier", "s_suppkey"), ("e", "part", "p_partkey"))}
    put = lambda name, df: df.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")
    for name in "abc":
        put(name, rows[name])
    store = FolderStore(spark, base, path, glob="*.parquet")
    store.refresh()
    f = Folder(spark, base)
    f.fs.delete(f.hadoop.Path(f"{base}/c"), True)
    # a file whose bytes change keeps its name
    held = Folder(spark, f"{base}/b")
    name = next(n for n in held.names() if n.endswith(".parquet"))
    put("new", rows["b"].unionByName(rows["b"]))
    fresh = Folder(spark, f"{base}/new")
    f.fs.delete(f.hadoop.Path(f"{base}/b"), True)
    f.fs.mkdirs(f.hadoop.Path(f"{base}/b"))
    f.fs.rename(f.hadoop.Path(f"{base}/new/{next(n for n in fresh.names() if n.endswith('.parquet'))}"), f.hadoop.Path(f"{base}/b/{name}"))
    f.fs.delete(f.hadoop.Path(f"{base}/new"), True)
    for name in "de":
        put(name, rows[name])
    found, again = store.refresh(), store.refresh()
    out = store.read().groupBy("layer").agg(F.count("*").alias("n"))
    return out.select("layer", "n", *[F.lit(found[c]).alias(c) for c in ("added", "changed", "removed")], F.lit(sum(again.values())).alias("again"))


@register("s16_parameterised_view", """
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000.0e0
GROUP BY o_orderpriority""")
def s16_parameterised_view(spark, sf):
    from ..sources.views import SqlView

    table(spark, sf, "orders").createOrReplaceTempView("orders_src")
    v = SqlView("orders_by_status",
                "SELECT o_orderpriority, count(*) AS n FROM orders_src "
                "WHERE o_orderstatus = %status% AND o_totalprice > %min_price% GROUP BY o_orderpriority",
                defaults={"min_price": 100000.0}, validators={"status": "[FOP]"})
    return v.register(spark, {"status": "O"})


@register("s17_directory_store", """
SELECT 'region' AS layer, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation""")
def s17_directory_store(spark, sf):
    from ..sources.views import read_directory

    base = _scratch(spark, "dir-store")
    table(spark, sf, "region").select(F.col("r_regionkey").alias("k")).write.parquet(f"{base}/region.parquet")
    table(spark, sf, "nation").select(F.col("n_nationkey").alias("k")).write.parquet(f"{base}/nation.parquet")
    return read_directory(spark, base).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))
