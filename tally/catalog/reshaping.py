"""Unpivot, pivot, set operations and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.functions.numbers import zero_pad
from tally.catalog.registry import SEGMENT_SQL, query
from tally.functions import measures as M
from tally.operators import aggregates as A
from tally.operators import joins as J
from tally.operators import reshape as R
from tally.plans import dimensions as D
from tally.plans import star
from tally.plans.star import table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("r01_unpivot_measures", """
SELECT l_orderkey, mass, CAST(pos AS INTEGER) AS pos, CAST(sum(wert) AS BIGINT) AS wert FROM (
  SELECT l_orderkey, 'l_quantity' AS mass, 1 AS pos, CAST(l_quantity AS BIGINT) AS wert FROM lineitem
  UNION ALL SELECT l_orderkey, 'l_discount', 2, CAST(round(l_discount * 100) AS BIGINT) FROM lineitem
  UNION ALL SELECT l_orderkey, 'l_tax', 3, CASE WHEN l_tax > 0 THEN CAST(round(l_tax * 100) AS BIGINT) END FROM lineitem) AS u
GROUP BY l_orderkey, mass, pos""")
def unpivot_measures(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("bigint").alias("l_quantity"),
        star.cents(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") > 0, star.cents(F.col("l_tax"))).alias("l_tax"))
    long = R.unpivot_measures(lines, ["l_orderkey"], ["l_quantity", "l_discount", "l_tax"], "mass", "wert", "pos")
    return long.groupBy("l_orderkey", "mass", "pos").agg(F.sum("wert").alias("wert"))


_PIVOT = ", ".join(
    f"CAST(sum(CASE WHEN c_mktsegment = '{s}' THEN stimmen END) AS BIGINT) AS \"{s}\"" for s in SEGMENTS)


@query("r02_pivot", SEGMENT_SQL + f" SELECT c_nationkey, {_PIVOT} FROM share GROUP BY c_nationkey")
def pivot(spark, sf):
    return R.pivot_measure(star.segment_share(spark, sf), ["c_nationkey"], SEGMENTS, "c_mktsegment")


_PIVOT_MANY = ", ".join(
    f"CAST(sum(CASE WHEN c_mktsegment = '{s}' THEN stimmen END) AS BIGINT) AS \"stimmen_{s}\", "
    f"max(CASE WHEN c_mktsegment = '{s}' THEN CAST(stimmen AS DOUBLE) / gueltig * 100 END) AS \"prozent_{s}\""
    for s in SEGMENTS)


@query("r03_pivot_many_values", SEGMENT_SQL + f" SELECT c_nationkey, {_PIVOT_MANY} FROM share GROUP BY c_nationkey")
def pivot_many_values(spark, sf):
    shares = star.segment_share(spark, sf).withColumn("prozent", M.share_pct(F.col("stimmen"), F.col("gueltig")))
    return R.pivot_measures(shares, ["c_nationkey"], SEGMENTS, ["stimmen", "prozent"], "c_mktsegment")


@query("j01_candidates_inner", """
SELECT p_brand, count(*) AS zeilen, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS menge
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size >= 10 GROUP BY p_brand""")
def candidates_inner(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("zeilen"), F.sum(F.col("l_quantity").cast("bigint")).alias("menge"))
    named = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand",
        F.when(F.col("p_size") >= 10, F.col("p_name")).alias("name"))
    return J.with_candidates(lines, named, ["l_partkey"]).groupBy("p_brand").agg(
        F.sum("zeilen").alias("zeilen"), F.sum("menge").alias("menge"))


@query("j02_baseline_left", """
WITH alt AS (SELECT o_custkey AS c, o_orderpriority AS p, count(*) AS stimmen_alt FROM orders
             WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL),
neu AS (SELECT o_custkey AS c, o_orderpriority AS p, count(*) AS stimmen FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL)
SELECT c AS o_custkey, p AS o_orderpriority, stimmen, coalesce(stimmen_alt, 0) AS stimmen_alt FROM neu LEFT JOIN alt USING (c, p)""")
def baseline_left(spark, sf):
    keys = ["o_custkey", "o_orderpriority"]
    orders = table(spark, sf, "orders")
    then = orders.filter(star.period(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("stimmen_alt"))
    now = orders.filter(star.period(True)).groupBy(*keys).agg(F.count(F.lit(1)).alias("stimmen"))
    return J.with_baseline(now, then, keys, ["stimmen_alt"])


@query("j05_override_name", """
SELECT o_orderkey, n.name AS kunde FROM orders LEFT JOIN
  (SELECT DISTINCT c_custkey, upper(c_name) AS name FROM customer WHERE c_acctbal >= 0) AS n ON o_custkey = c_custkey""")
def override_name(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("kunde"))
    names = table(spark, sf, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("o_custkey"), F.upper("c_name").alias("name"))
    return J.override_name(orders, names, "o_custkey", "name", "kunde").drop("o_custkey")


@query("j07_keep_listed", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def keep_listed(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return J.keep_listed(table(spark, sf, "customer"), urgent, "c_custkey").select("c_custkey", "c_name")


@query("j08_drop_listed", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def drop_listed(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return J.drop_listed(table(spark, sf, "customer"), urgent, "c_custkey").select("c_custkey", "c_name")


@query("j10_output_name_lookup", """
SELECT c_custkey, 'g06' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '_landesstimmen' AS fname FROM customer""")
def output_name_lookup(spark, sf):
    own = zero_pad(F.col("c_custkey"), 9)
    customers = table(spark, sf, "customer").select("c_custkey", own.alias("ags"))
    areas = table(spark, sf, "customer").select(
        own.alias("id"), F.when(F.col("c_mktsegment") == star.CITY_SEGMENT, F.lit("s")).otherwise(F.lit("g")).alias("typ"))
    named = J.with_output_name(customers, D.build_registry(areas), "ags", "landesstimmen", ["g", "s"])
    return named.select("c_custkey", "fname")


@query("j11_lookup_chain", """
SELECT o_orderkey AS ags, (o_orderkey // 1000) * 1000 AS k_ags, o_custkey AS wk, c_name AS wk_name,
       k.kreis_name, o_totalprice AS flaeche
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT (o_orderkey // 1000) * 1000 AS k_ags, max(o_orderpriority) AS kreis_name FROM orders GROUP BY 1) AS k
  ON (o_orderkey // 1000) * 1000 = k.k_ags""")
def lookup_chain(spark, sf):
    orders = table(spark, sf, "orders")
    assigned = orders.select(F.col("o_orderkey").alias("ags"), F.col("o_custkey").alias("wk"))
    constituencies = table(spark, sf, "customer").select(F.col("c_custkey").alias("wk"), F.col("c_name").alias("wk_name"))
    counties = orders.groupBy(((F.floor(F.col("o_orderkey") / 1000)) * 1000).cast("bigint").alias("k_ags")).agg(
        F.max("o_orderpriority").alias("kreis_name"))
    attributes = orders.select(F.col("o_orderkey").alias("ags"), F.col("o_totalprice").alias("flaeche"))
    return D.area_lookup(assigned, constituencies, counties, attributes)


@query("j12_fan_out", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT c_custkey, a.o_orderkey AS erste, u.o_orderkey AS dringend FROM customer
LEFT JOIN o a ON a.o_custkey = c_custkey AND a.n = 1
LEFT JOIN orders u ON u.o_custkey = c_custkey AND u.o_orderpriority = '1-URGENT'""")
def fan_out(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    first = A.first_by(orders, ["c_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).select(
        "c_custkey", F.col("o_orderkey").alias("erste"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("c_custkey", F.col("o_orderkey").alias("dringend"))
    customers = table(spark, sf, "customer").select("c_custkey")
    return J.join_fan_out(customers.join(first, "c_custkey", "left"), urgent, "c_custkey")


@query("j15_empty_results", """
WITH seg AS (SELECT DISTINCT c_mktsegment AS partei FROM customer),
ist AS (SELECT c_nationkey AS nk, c_mktsegment AS partei, count(*) AS kunden FROM customer GROUP BY ALL)
SELECT n_nationkey AS nk, partei, 0 AS stimmen, '0,0% (+0)' AS prozent, coalesce(kunden, 0) AS kunden
FROM nation CROSS JOIN seg LEFT JOIN ist ON ist.nk = n_nationkey AND ist.partei = seg.partei""".replace(
    "SELECT n_nationkey AS nk, partei,", "SELECT n_nationkey AS nk, seg.partei AS partei,"))
def empty_results(spark, sf):
    customers = table(spark, sf, "customer")
    ballot = customers.select(F.col("c_mktsegment").alias("partei")).distinct()
    areas = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nk"))
    actual = customers.groupBy(F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("partei")).agg(
        F.count(F.lit(1)).alias("kunden"))
    return J.with_baseline(J.empty_results(areas, ballot), actual, ["nk", "partei"], ["kunden"])


@query("j15_empty_candidate_results", """
WITH p AS (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY s_nationkey, s_suppkey * 7 % 25)
SELECT c_custkey, s_suppkey, 0 AS stimmen, '0,0% (+0)' AS prozent FROM customer JOIN p ON c_nationkey = s_nationkey""")
def empty_candidate_results(spark, sf):
    areas = table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 1).alias("wk"))
    entries = star.people(spark, sf).select("s_suppkey", "wk")
    return J.empty_results(areas, entries, ["wk"]).drop("wk")


@query("u01_union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS key")
    return J.union_all(customers, suppliers)


@query("u03_distinct_keys", """
SELECT o_custkey AS kunde FROM orders UNION SELECT user_id FROM events""")
def distinct_keys(spark, sf):
    return J.distinct_keys(
        "kunde", table(spark, sf, "orders").select(F.col("o_custkey").alias("kunde")),
        table(spark, sf, "events").select(F.col("user_id").alias("kunde")))


@query("u04_patch_union", """
WITH v AS (SELECT c_nationkey AS wk, c_mktsegment AS partei, o_orderdate < TIMESTAMP '1998-01-01' AS alt, count(*) AS stimmen
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT wk, partei, stimmen FROM v WHERE NOT alt AND wk NOT IN (3, 4)
UNION ALL SELECT wk, partei, stimmen FROM v WHERE alt AND wk IN (3, 4)""")
def patch_union(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")

    def votes(present):
        per_customer = table(spark, sf, "orders").filter(star.period(present)).groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"))
        return per_customer.join(customers, "o_custkey").groupBy(
            F.col("c_nationkey").alias("wk"), F.col("c_mktsegment").alias("partei")).agg(F.sum("n").alias("stimmen"))

    keys = table(spark, sf, "nation").filter(F.col("n_nationkey").isin(3, 4)).select(F.col("n_nationkey").alias("wk"))
    return J.patch_union(votes(True), votes(False), keys, "wk")
