"""Grouped and global aggregates, nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.catalog.basics import _ALL_YEARS, _YEARS, all_year_shares, year_shares
from tally.catalog.registry import FEED_SQL, SEGMENT_SQL, query
from tally.functions import measures as M
from tally.operators import aggregates as A
from tally.operators.documents import flatten_json
from tally.operators.reshape import colour_map
from tally.plans import star
from tally.plans.star import table


@query("a01_volatility", _YEARS + """
SELECT c_nationkey, sum(CAST(abs(round((prozent - prozent_alt) * 1000000)) AS BIGINT)) :: BIGINT AS summe
FROM beide GROUP BY c_nationkey""".replace("sum(", "sum("))
def volatility_exact(spark, sf):
    """Volatility doubled, in millionths of a point: whole numbers add up the same in any order."""
    change = F.abs(F.round((F.col("prozent") - F.col("prozent_alt")) * 1000000)).cast("bigint")
    return year_shares(spark, sf).withColumn("d", change).groupBy("c_nationkey").agg(
        (A.volatility(F.col("d")) * 2).cast("bigint").alias("summe"))


@query("a02_volatility_with_attributes", _YEARS + """
SELECT c_nationkey, 'NATION_' || c_nationkey AS name, round(sum(abs(prozent - prozent_alt)) / 2, 6) AS volatilitaet
FROM beide GROUP BY c_nationkey""")
def volatility_with_attributes(spark, sf):
    rows = year_shares(spark, sf).withColumns({
        "differenz": F.col("prozent") - F.col("prozent_alt"),
        "name": F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))})
    out = A.volatility_by(rows, ["c_nationkey"], "differenz", ["name"])
    return out.withColumn("volatilitaet", F.round("volatilitaet", 6))


@query("a02_volatility_of_every_year", _ALL_YEARS + """
SELECT jahr, c_nationkey, 'NATION_' || c_nationkey AS name,
       CAST(sum(CAST(abs(round((prozent - prozent_alt) * 1000000)) AS BIGINT)) AS BIGINT) AS summe
FROM beide GROUP BY jahr, c_nationkey""")
def volatility_of_every_year(spark, sf):
    """As ``a01_volatility``, for all years and with the area's name carried along."""
    rows = all_year_shares(spark, sf).withColumns({
        "d": F.abs(F.round((F.col("prozent") - F.col("prozent_alt")) * 1000000)).cast("bigint"),
        "name": F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))})
    out = A.volatility_by(rows, ["jahr", "c_nationkey"], "d", ["name"], into="summe")
    return out.withColumn("summe", (F.col("summe") * 2).cast("bigint"))


_POSTAL = """WITH line AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS e,
         CAST(sum(CASE WHEN l_returnflag IN ('A', 'R') THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS v,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS i1,
         CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS i2
  FROM lineitem GROUP BY l_orderkey),
sb AS (SELECT lpad(CAST(c_custkey + 1 AS VARCHAR), 12, '0') AS ags, c_name AS g_name, e, v, i1, i2,
              substr(reverse(CAST(o_orderkey AS VARCHAR)), 1, 2) IN ('90', '09', '99') OR o_orderpriority = '5-LOW' AS bw
       FROM orders JOIN line ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'),
g AS (SELECT ags, min(g_name) AS g_name, CAST(sum(e) AS BIGINT) AS wahlberechtigt, CAST(sum(v) AS BIGINT) AS waehler,
             CAST(sum(CASE WHEN bw THEN v ELSE 0 END) AS BIGINT) AS briefwaehler,
             CAST(sum(i1) AS BIGINT) AS ungueltig_wk, CAST(sum(i2) AS BIGINT) AS ungueltig_ls FROM sb GROUP BY ags)"""


@query("a04_postal_quota", _POSTAL + """
SELECT *, CAST(briefwaehler AS DOUBLE) / nullif(waehler, 0) * 1000 / 10 AS briefwahlquote FROM g""")
def postal_quota(spark, sf):
    from tally.plans.analysis import postal_by_municipality

    return postal_by_municipality(star.precincts(spark, sf), F.substring("Gebietsschlüssel", 4, 12))


@query("a05_overall_postal_quota", _POSTAL + """
SELECT CAST(CAST(sum(briefwaehler) AS BIGINT) AS DOUBLE) / CAST(sum(waehler) AS BIGINT) * 1000 / 10 AS briefwahlquote FROM g""")
def overall_postal_quota(spark, sf):
    from tally.plans.analysis import postal_overall

    return postal_overall(postal_quota(spark, sf))


@query("a04_strict_sum", """
SELECT c_nationkey, CASE WHEN count(*) FILTER (WHERE c_acctbal < -990) = 0 THEN CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) ELSE -1 END AS summe
FROM customer GROUP BY c_nationkey""")
def strict_sum(spark, sf):
    known = F.when(F.col("c_acctbal") >= -990, star.cents(F.col("c_acctbal")))
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.coalesce(A.total(known, strict=True), F.lit(-1)).alias("summe"))


@query("a06_area_profile", """
WITH c AS (SELECT c_nationkey AS wk, 'NATION_' || c_nationkey AS wk_name, c_mktsegment AS kreis_name,
                  CAST(round(c_acctbal * 100) AS BIGINT) + 200000 AS bevoelkerung, c_custkey + 1 AS flaeche FROM customer)
SELECT wk, min(wk_name) AS wk_name, string_agg(DISTINCT kreis_name, ' ' ORDER BY kreis_name) AS kreis_name, count(*) AS gemeinden,
       CAST(sum(bevoelkerung) AS BIGINT) AS bevoelkerung, CAST(sum(flaeche) AS BIGINT) AS flaeche,
       CAST(sum(bevoelkerung) AS DOUBLE) / CAST(sum(flaeche) AS BIGINT) AS bev_dichte
FROM c GROUP BY wk""")
def area_profile(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("wk"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("wk_name"),
        F.col("c_mktsegment").alias("kreis_name"),
        (star.cents(F.col("c_acctbal")) + 200000).alias("bevoelkerung"),
        (F.col("c_custkey") + 1).alias("flaeche"))
    return A.profile(rows, "wk", "wk_name", "kreis_name", "gemeinden", "bevoelkerung", "flaeche")


@query("a07_merge_entities", """
SELECT CASE WHEN c_nationkey IN (1, 2) THEN 101 ELSE c_nationkey END AS wk, count(*) AS waehler,
       CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS gueltig,
       100.0 - CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS ungueltig_prozent
FROM customer GROUP BY 1""")
def merge_entities(spark, sf):
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("wk")).agg(
        F.count(F.lit(1)).alias("waehler"),
        F.sum(F.when(F.col("c_acctbal") >= 0, F.lit(1)).otherwise(F.lit(0))).alias("gueltig"))
    crosswalk = table(spark, sf, "nation").filter(F.col("n_nationkey").isin(1, 2)).select(
        F.col("n_nationkey").alias("wk"), F.lit(101).alias("new_key"))
    return A.merge_entities(counts, crosswalk, "wk", ["waehler", "gueltig"], ratios={
        "ungueltig_prozent": M.invalid_pct_from_valid(F.col("gueltig"), F.col("waehler"))})


@query("a08_first_row_of_key", """
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) AS o WHERE n = 1""")
def first_row_of_key(spark, sf):
    out = A.first_by(table(spark, sf, "orders"), ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")


@query("a09_state_totals", FEED_SQL + """
SELECT max(stimmbezirke) AS stimmbezirke, max(gezaehlt) AS gezaehlt FROM area WHERE typ = 'LD'""")
def state_totals(spark, sf):
    return A.state_total(star.feed(spark, sf), {
        "stimmbezirke": "Anzahl Wahlbezirke", "gezaehlt": "Anzahl Wahlbezirke ausgezählt"})


@query("a10_area_constants", """
SELECT o_custkey, max(c_name) AS c_name, max(c_nationkey) AS c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey""")
def area_constants(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    rows = table(spark, sf, "orders").select("o_custkey").join(customers, "o_custkey")
    return A.area_constants(rows, "o_custkey", ["c_name", "c_nationkey"])


_LEVELS = """WITH n AS (SELECT c_nationkey, n_regionkey, count(*) AS kunden,
  CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS gueltig
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


@query("a11_roll_up", _LEVELS + """
SELECT 'region' AS ebene, n_regionkey AS id, CAST(sum(kunden) AS BIGINT) AS kunden, CAST(sum(gueltig) AS BIGINT) AS gueltig,
       CAST(sum(gueltig) AS DOUBLE) / CAST(sum(kunden) AS BIGINT) * 100 AS quote FROM n GROUP BY n_regionkey
UNION ALL SELECT 'alles', 0, CAST(sum(kunden) AS BIGINT), CAST(sum(gueltig) AS BIGINT),
       CAST(sum(gueltig) AS DOUBLE) / CAST(sum(kunden) AS BIGINT) * 100 FROM n""")
def roll_up(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("kunden"),
        F.sum(F.when(F.col("c_acctbal") >= 0, F.lit(1)).otherwise(F.lit(0))).alias("gueltig"),
    ).join(nations, "c_nationkey")
    rate = {"quote": M.turnout_pct(F.col("gueltig"), F.col("kunden"))}
    regions = A.roll_up(counts, ["n_regionkey"], ["kunden", "gueltig"], rate)
    everything = A.roll_up(counts, [], ["kunden", "gueltig"], rate)
    return regions.select(F.lit("region").alias("ebene"), F.col("n_regionkey").alias("id"), "kunden", "gueltig", "quote") \
        .unionByName(everything.select(F.lit("alles").alias("ebene"), F.lit(0).alias("id"), "kunden", "gueltig", "quote"))


@query("a12_progress", """
SELECT o_orderkey, CAST(floor(CAST(count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS DOUBLE) / count(*) * 100) AS BIGINT) AS fortschritt
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def progress(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.when(F.col("l_linestatus") == "F", 1)).alias("f"), F.count(F.lit(1)).alias("n"))
    known = table(spark, sf, "orders").select("o_orderkey").join(lines, "o_orderkey")
    return known.select("o_orderkey", M.progress_pct(F.col("f"), F.col("n")).alias("fortschritt"))


@query("a13_ordered_labels", SEGMENT_SQL + """
SELECT c_nationkey, string_agg(c_mktsegment || ': ' || stimmen, ', ' ORDER BY stimmen DESC, c_mktsegment) AS weitere
FROM share GROUP BY c_nationkey""")
def ordered_labels(spark, sf):
    label = F.concat("c_mktsegment", F.lit(": "), F.col("stimmen").cast("string"))
    order = F.struct(-F.col("stimmen"), F.col("c_mktsegment"))
    return star.segment_share(spark, sf).groupBy("c_nationkey").agg(A.ordered_labels(order, label).alias("weitere"))


@query("a14_distinct_labels", """
SELECT n_regionkey, string_agg(DISTINCT c_mktsegment, ' ' ORDER BY c_mktsegment) AS liste
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey""")
def distinct_labels(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return table(spark, sf, "customer").join(nations, "c_nationkey").groupBy("n_regionkey").agg(
        A.joined_labels(F.col("c_mktsegment")).alias("liste"))


@query("m10_colour_map", """
SELECT s_nationkey, CAST(map(['Supplier'], [min(n_name)]) AS VARCHAR) AS farben FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_nationkey""")
def colour_map_of_nations(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rows = table(spark, sf, "supplier").select("s_nationkey", F.lit("Supplier").alias("k")).distinct().join(
        nations, "s_nationkey")
    out = colour_map(rows, ["s_nationkey"], "k", "n_name")
    pairs = F.transform(F.map_entries("farben"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("s_nationkey", F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")).alias("farben"))


@query("f21_flatten_documents", """
SELECT event_id, j.key AS name, j.key AS path, CAST(json_extract(props, '$.' || j.key) AS VARCHAR) AS value, 'BIGINT' AS type
FROM events, (SELECT unnest(['k']) AS key) AS j""")
def flatten_documents(spark, sf):
    return flatten_json(table(spark, sf, "events").select("event_id", "props"), "props")
