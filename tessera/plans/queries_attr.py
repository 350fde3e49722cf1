"""Attribute queries: filters (F01-F13), projection (P01-P04), sort / page
(W01-W04), aggregates (A01-A16), joins (J01-J07, J10), scalar functions
(X01-X15), temporal filters (F29-F34)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import filters as FL
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators.projection import encode_fid
from . import sqlviews as V
from .layers import poi, road, table
from .query import NATURAL, FeatureQuery, Layer, run
from .registry import register


def _poi(spark, sf):
    return Layer(poi(spark, sf, with_geom=False), "poi", pk=("fid",))


def _orders(spark, sf):
    return Layer(table(spark, sf, "orders"), "orders", pk=("o_orderkey",), geometry=None)


def _customer(spark, sf):
    return Layer(table(spark, sf, "customer"), "customer", pk=("c_custkey",), geometry=None)


POI = V.with_(V.POI)

# ---------------------------------------------------------------- filters
@register("f04_equals", POI + "SELECT fid, name, balance FROM poi WHERE segment = 'BUILDING'")
def f04_equals(spark, sf):
    return run(_poi(spark, sf), FeatureQuery(FL.eq("segment", "BUILDING"), ["name", "balance"]))


@register("f06_equals_ignore_case", POI + """
SELECT fid, segment FROM poi WHERE lower(segment) = lower('building') OR lower(segment) <> lower('MachINERY')""")
def f06_equals_ignore_case(spark, sf):
    cond = FL.eq("segment", "building", match_case=False) | FL.ne("segment", "MachINERY", match_case=False)
    return run(_poi(spark, sf), FeatureQuery(cond, ["segment"]))


@register("f05_f07_compare_between", POI + """
SELECT fid, balance, nationkey FROM poi
WHERE balance BETWEEN 1000.0e0 AND 5000.0e0 AND fid < 1000 AND nationkey >= 3 AND nationkey <= 20""")
def f05_f07_compare_between(spark, sf):
    cond = FL.all_of(FL.between("balance", 1000.0, 5000.0), FL.lt("fid", 1000), FL.ge("nationkey", 3),
                     FL.le("nationkey", 20))
    return run(_poi(spark, sf), FeatureQuery(cond, ["balance", "nationkey"]))


@register("f02_f03_and_or_not", POI + """
SELECT fid, segment, balance FROM poi
WHERE (segment = 'AUTOMOBILE' OR segment = 'FURNITURE') AND NOT coalesce(balance > 0.0e0, false)""")
def f02_f03_and_or_not(spark, sf):
    cond = FL.any_of(FL.eq("segment", "AUTOMOBILE"), FL.eq("segment", "FURNITURE")) & FL.not_(FL.gt("balance", 0.0))
    return run(_poi(spark, sf), FeatureQuery(cond, ["segment", "balance"]))


@register("f01_include_exclude_counts", POI + """
SELECT (SELECT count(*) FROM poi) AS included, (SELECT count(*) FROM poi WHERE false) AS excluded""")
def f01_include_exclude_counts(spark, sf):
    df = poi(spark, sf, with_geom=False)
    return df.agg(F.count(F.when(FL.include(), 1)).alias("included"),
                  F.count(F.when(FL.exclude(), 1)).alias("excluded"))


@register("f08_like_custom_wildcards", POI + r"""
SELECT fid, name FROM poi WHERE name LIKE 'Customer#00000_1%' ESCAPE '\'""")
def f08_like_custom_wildcards(spark, sf):
    return run(_poi(spark, sf), FeatureQuery(FL.like("name", "Customer#00000.1*"), ["name"]))


@register("f08_like_case_insensitive", POI + "SELECT fid, segment FROM poi WHERE segment ILIKE '%hold'")
def f08_like_case_insensitive(spark, sf):
    return run(_poi(spark, sf), FeatureQuery(FL.like("segment", "*HOLD", match_case=False), ["segment"]))


@register("f08_like_date_column", """
SELECT o_orderkey, o_orderdate FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') LIKE '1995-03%'""")
def f08_like_date_column(spark, sf):
    return run(_orders(spark, sf), FeatureQuery(FL.like("o_orderdate", "1995-03", is_date=True), ["o_orderdate"]))


@register("f09_is_null_counts", """
SELECT count(*) FILTER (WHERE o_orderpriority IS NULL) AS null_priority,
       count(*) FILTER (WHERE NOT (o_orderpriority IS NULL)) AS not_null_priority FROM orders""")
def f09_is_null_counts(spark, sf):
    df = table(spark, sf, "orders")
    return df.agg(F.count(F.when(FL.is_null("o_orderpriority"), 1)).alias("null_priority"),
                  F.count(F.when(~FL.is_null("o_orderpriority"), 1)).alias("not_null_priority"))


@register("f10_id_filter", POI + "SELECT fid, name FROM poi WHERE fid IN (1, 7, 13, 1499)")
def f10_id_filter(spark, sf):
    ids = ["poi.1", "poi.7", "poi.not-a-number", "13", "poi.1499"]
    return run(_poi(spark, sf), FeatureQuery(FL.id_filter("fid", ids, type_name="poi"), ["name"]))


@register("f10_id_semi_join", POI + """
SELECT fid, name FROM poi WHERE fid IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def f10_id_semi_join(spark, sf):
    ids = (table(spark, sf, "orders").where(FL.eq("o_orderpriority", "1-URGENT"))
           .select(F.concat(F.lit("poi."), F.col("o_custkey").cast("string")).alias("fid")))
    return FL.id_semi_join(poi(spark, sf, with_geom=False), "fid", ids, "fid", "poi").select("fid", "name")


@register("f12_arithmetic", POI + """
SELECT fid, balance FROM poi WHERE (balance * 2.0e0 + 10.0e0) > 15000.0e0 AND (fid - 1) / 2 < 700""")
def f12_arithmetic(spark, sf):
    cond = FL.gt(FL.arith("+", FL.arith("*", "balance", 2.0), 10.0), 15000.0) & \
        FL.lt(FL.arith("/", FL.arith("-", "fid", 1), 2), 700)
    return run(_poi(spark, sf), FeatureQuery(cond, ["balance"]))


@register("f13_function_in_filter", POI + """
SELECT fid, name FROM poi
WHERE upper(segment) = 'HOUSEHOLD' AND length(name) = 18 AND strpos(name, '9') - 1 >= 10""")
def f13_function_in_filter(spark, sf):
    cond = FL.all_of(FL.eq(FL.call("strToUpperCase", "segment"), "HOUSEHOLD"),
                     FL.eq(FL.call("strLength", "name"), 18),
                     FL.ge(FL.call("strIndexOf", "name", F.lit("9")), 10))
    return run(_poi(spark, sf), FeatureQuery(cond, ["name"]))


# ---------------------------------------------------------------- temporal
T1, T2 = dt.datetime(1996, 1, 1), dt.datetime(1996, 6, 30)


@register("f29_f33_temporal", """
SELECT o_orderkey,
       o_orderdate > TIMESTAMP '1996-06-30 00:00:00' AS after_period,
       o_orderdate < TIMESTAMP '1996-01-01 00:00:00' AS before_period,
       o_orderdate = TIMESTAMP '1996-01-01 00:00:00' AS begins,
       o_orderdate = TIMESTAMP '1996-06-30 00:00:00' AS ends,
       o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-06-30 00:00:00' AS during,
       o_orderdate = TIMESTAMP '1996-03-15 00:00:00' AS tequals
FROM orders""")
def f29_f33_temporal(spark, sf):
    df = table(spark, sf, "orders")
    c = "o_orderdate"
    return df.select("o_orderkey", FL.after(c, (T1, T2)).alias("after_period"),
                     FL.before(c, (T1, T2)).alias("before_period"), FL.begins(c, (T1, T2)).alias("begins"),
                     FL.ends(c, (T1, T2)).alias("ends"), FL.during(c, (T1, T2)).alias("during"),
                     FL.tequals(c, dt.datetime(1996, 3, 15)).alias("tequals"))


@register("f34_temporal_column_column", """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate > o.o_orderdate AS ship_after_order,
       l.l_shipdate < o.o_orderdate AS ship_before_order, l.l_shipdate = o.o_orderdate AS same_day
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def f34_temporal_column_column(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber", FL.t_after_col("l_shipdate", "o_orderdate").alias("ship_after_order"),
                    FL.t_before_col("l_shipdate", "o_orderdate").alias("ship_before_order"),
                    FL.t_equals_col("l_shipdate", "o_orderdate").alias("same_day"))


# ---------------------------------------------------------------- projection
@register("p01_p04_projection_fid", POI + "SELECT 'poi.' || CAST(fid AS VARCHAR) AS feature_id, fid, segment FROM poi")
def p01_p04_projection_fid(spark, sf):
    out = run(_poi(spark, sf), FeatureQuery(None, ["segment"]))
    return out.select(encode_fid("poi", ["fid"]).alias("feature_id"), "fid", "segment")


@register("p03_hidden_pk", POI + "SELECT name, segment FROM poi WHERE nationkey = 7")
def p03_hidden_pk(spark, sf):
    layer = Layer(poi(spark, sf, with_geom=False).select("fid", "name", "segment", "nationkey"), "poi", pk=("fid",),
                  expose_pk=False)
    return run(layer, FeatureQuery(FL.eq("nationkey", 7), ["name", "segment"]))


# ---------------------------------------------------------------- sort / page
@register("w01_sort_top_k", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey ASC LIMIT 25""")
def w01_sort_top_k(spark, sf):
    q = FeatureQuery(None, ["o_orderpriority", "o_totalprice"],
                     sort_by=[("o_orderpriority", "ASC"), ("o_totalprice", "DESC"), (NATURAL, "ASC")], limit=25)
    return run(_orders(spark, sf), q)


@register("w03_offset_natural_order", """
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100""")
def w03_offset_natural_order(spark, sf):
    return run(_orders(spark, sf), FeatureQuery(None, ["o_orderstatus"], offset=100, limit=50))


@register("w04_sort_on_unrequested_column", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10""")
def w04_sort_on_unrequested_column(spark, sf):
    q = FeatureQuery(FL.eq("o_orderstatus", "O"), ["o_orderstatus"],
                     sort_by=[("o_totalprice", "DESC"), ("__reverse__", "ASC")], limit=10)
    return run(_orders(spark, sf), q)


# ---------------------------------------------------------------- aggregates
@register("a01_count_filter", "SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F'")
def a01_count_filter(spark, sf):
    return A.count(table(spark, sf, "orders"), FL.eq("o_orderstatus", "F"))


@register("a02_count_offset_limit", """
SELECT CAST(least(greatest(count(*) - 100, 0), 1000) AS BIGINT) AS count FROM orders WHERE o_orderstatus = 'P'""")
def a02_count_offset_limit(spark, sf):
    return A.count_paged(table(spark, sf, "orders"), 100, 1000, FL.eq("o_orderstatus", "P"))


@register("a03_a05_min_max_sum", """
SELECT min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice,
       round(sum(o_totalprice), 2) AS sum_o_totalprice FROM orders WHERE o_orderstatus = 'O'""")
def a03_a05_min_max_sum(spark, sf):
    r = A.minmax_sum(table(spark, sf, "orders"), "o_totalprice", FL.eq("o_orderstatus", "O"))
    return r.withColumn("sum_o_totalprice", F.round("sum_o_totalprice", 2))


@register("a06_unique_sorted_paged", """
SELECT DISTINCT p_brand FROM part ORDER BY p_brand LIMIT 10 OFFSET 3""")
def a06_unique_sorted_paged(spark, sf):
    return A.unique(table(spark, sf, "part"), "p_brand", True, 3, 10)


@register("a07_group_by", """
SELECT o_orderstatus, o_orderpriority, count(*) AS count_all, min(o_totalprice) AS min_o_totalprice,
       max(o_totalprice) AS max_o_totalprice, round(sum(o_totalprice), 2) AS sum_o_totalprice
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def a07_group_by(spark, sf):
    g = A.group_by(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"],
                   [("count", "*"), ("min", "o_totalprice"), ("max", "o_totalprice"), ("sum", "o_totalprice")])
    return g.withColumn("sum_o_totalprice", F.round("sum_o_totalprice", 2))


@register("a08_group_unique", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def a08_group_unique(spark, sf):
    return A.group_unique(table(spark, sf, "customer"), ["c_mktsegment"], "c_nationkey")


@register("a09_aggregate_over_page", """
SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM
 (SELECT o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 10) t""")
def a09_aggregate_over_page(spark, sf):
    p = A.page(table(spark, sf, "orders"), ["o_orderkey"], 10, 100)
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("a13_nearest_value", """
WITH b AS (SELECT max(o_totalprice) FILTER (WHERE o_totalprice <= 250000.0e0) AS below,
                  min(o_totalprice) FILTER (WHERE o_totalprice > 250000.0e0) AS above FROM orders)
SELECT CASE WHEN below IS NULL THEN above WHEN above IS NULL THEN below
            WHEN below = 250000.0e0 THEN below
            WHEN 250000.0e0 - below <= above - 250000.0e0 THEN below ELSE above END AS nearest FROM b""")
def a13_nearest_value(spark, sf):
    return A.nearest_value(table(spark, sf, "orders"), "o_totalprice", 250000.0)


@register("a16_contains_count", """
SELECT count(*) AS contained FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def a16_contains_count(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return A.contains_count(o, cust, "k")


# ---------------------------------------------------------------- joins
@register("j01_inner_join", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_nationkey FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = 3 AND o.o_orderstatus = 'F'""")
def j01_inner_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    c = table(spark, sf, "customer")
    part = J.JoinPart(c, "customer", on=[("o_custkey", "c_custkey")], properties=["c_name", "c_nationkey"],
                      filter=lambda r: FL.eq(r("customer.c_nationkey"), 3))
    out = J.apply_joins(o, "orders", [part], main_filter=lambda r: FL.eq(r("o_orderstatus"), "F"))
    return out.select("o_orderkey", "o_totalprice", "c_name", "c_nationkey")


@register("j02_left_outer_join", """
SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') o
  ON o.o_custkey = c.c_custkey""")
def j02_left_outer_join(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").where(FL.eq("o_orderpriority", "1-URGENT") & FL.eq("o_orderstatus", "P"))
    part = J.JoinPart(o, "orders", on=[("c_custkey", "o_custkey")], how="outer", properties=["o_orderkey"])
    return J.apply_joins(c, "customer", [part])


@register("j05_outer_join_part_filter_after", """
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '1-URGENT' AND c.c_nationkey = 1""")
def j05_outer_join_part_filter_after(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf, "orders")
    part = J.JoinPart(o, "orders", on=[("c_custkey", "o_custkey")], how="outer", properties=["o_orderkey"],
                      filter=lambda r: FL.eq(r("orders.o_orderpriority"), "1-URGENT"))
    return J.apply_joins(c, "customer", [part], main_filter=lambda r: FL.eq(r("c_nationkey"), 1)) \
        .select("c_custkey", "o_orderkey")


@register("j03_j04_multiway_join_renames", V.with_(V.POI, V.ROAD) + """
SELECT p.fid, p.name, p.segment, n.n_name, r.fid AS road_fid, r.name AS road_name
FROM poi p JOIN nation n ON p.nationkey = n.n_nationkey
JOIN road r ON r.fid = p.fid % 100 WHERE n.n_regionkey = 2""")
def j03_j04_multiway_join_renames(spark, sf):
    p = poi(spark, sf, with_geom=False).select("fid", "name", "segment", "nationkey")
    p = p.withColumn("road_key", F.col("fid") % 100)
    nat = table(spark, sf, "nation")
    rd = road(spark, sf).select("fid", "name")
    parts = [J.JoinPart(nat, "nation", alias="n", on=lambda r: r("nationkey") == r("n.n_nationkey"),
                        properties=["n_name"], filter=lambda r: FL.eq(r("n.n_regionkey"), 2)),
             J.JoinPart(rd, "road", on=lambda r: r("road.fid") == r("road_key"), properties=["fid", "name"])]
    return J.apply_joins(p, "poi", parts).drop("nationkey", "road_key")


@register("j07_nested_joined_feature", """
SELECT o_orderkey, o_custkey, struct_pack(c_custkey := c_custkey, c_name := c_name, c_mktsegment := c_mktsegment) AS customer
FROM orders JOIN customer ON o_custkey = c_custkey""")
def j07_nested_joined_feature(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = J.JoinPart(c, "customer", on=[("o_custkey", "c_custkey")], nested=True)
    return J.apply_joins(o, "orders", [part])


@register("j10_aggregate_over_join", """
SELECT o.o_orderpriority, count(*) AS lines, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'
GROUP BY o.o_orderpriority""")
def j10_aggregate_over_join(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    o = table(spark, sf, "orders").where(FL.eq("o_orderstatus", "F")).select("o_orderkey", "o_orderpriority")
    j = J.join(li, o, li["l_orderkey"] == o["o_orderkey"])
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"),
                                            F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


# ---------------------------------------------------------------- scalar functions
@register("x01_x15_scalar_functions", """
SELECT c_custkey,
  concat(c_name, c_mktsegment) AS str_concat,
  ends_with(c_name, '7') AS ends7,
  starts_with(c_mktsegment, 'AUTO') AS starts_auto,
  lower(c_mktsegment) = lower('household') AS eq_household,
  CAST(strpos(c_name, '#') - 1 AS INTEGER) AS hash_pos,
  CAST(length(c_name) AS INTEGER) AS name_len,
  lower(c_name) AS lower_name, upper(c_mktsegment) AS upper_segment,
  regexp_replace(c_name, 'Customer', 'C', 'g') AS replaced,
  regexp_replace(c_name, '0', 'o') AS replaced_first,
  substring(c_name, 1 + 2, 8 - 2) AS sub_2_8,
  substring(c_name, 10 + 1) AS sub_from_10,
  trim('  ' || c_mktsegment || ' ') AS trimmed,
  abs(c_acctbal) AS abs_bal,
  CAST(ceil(c_acctbal) AS BIGINT) AS ceil_bal,
  CAST(floor(c_acctbal) AS BIGINT) AS floor_bal
FROM customer""")
def x01_x15_scalar_functions(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        S.str_concat("c_name", "c_mktsegment").alias("str_concat"),
        S.str_ends_with("c_name", F.lit("7")).alias("ends7"),
        S.str_starts_with("c_mktsegment", F.lit("AUTO")).alias("starts_auto"),
        S.str_equals_ignore_case("c_mktsegment", F.lit("household")).alias("eq_household"),
        S.str_index_of("c_name", F.lit("#")).alias("hash_pos"),
        S.str_length("c_name").alias("name_len"),
        S.str_to_lower("c_name").alias("lower_name"),
        S.str_to_upper("c_mktsegment").alias("upper_segment"),
        S.str_replace("c_name", "Customer", "C", True).alias("replaced"),
        S.str_replace("c_name", "0", "o", False).alias("replaced_first"),
        S.str_substring("c_name", 2, 8).alias("sub_2_8"),
        S.str_substring_start("c_name", 10).alias("sub_from_10"),
        S.str_trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("trimmed"),
        S.abs_("c_acctbal").alias("abs_bal"),
        S.ceil_("c_acctbal").alias("ceil_bal"),
        S.floor_("c_acctbal").alias("floor_bal"),
    )
