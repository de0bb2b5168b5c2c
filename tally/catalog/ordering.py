"""Row-order operators and top rows per group."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.catalog.registry import SEGMENT_SQL, query
from tally.functions import measures as M
from tally.operators import aggregates as A
from tally.operators import ranking as K
from tally.operators import windows as W
from tally.plans import star
from tally.plans.star import table

HISTORY = ["ts", "event_id"]


def events(spark, sf):
    ok = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", ok.alias("gueltig"))


@query("w01_carry_forward", """
SELECT event_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gueltig
FROM events""")
def carry_forward(spark, sf):
    return W.locf(events(spark, sf), ["gueltig"], ["user_id"], HISTORY).select("event_id", "gueltig")


@query("w02_fill_down_table", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN user_id END IGNORE NULLS)
  OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kopf
FROM events""")
def fill_down_table(spark, sf):
    head = F.when(F.col("event_type") == "purchase", F.col("user_id"))
    sheet = events(spark, sf).select("event_id", head.alias("kopf"))
    return W.locf(sheet, ["kopf"], [], ["event_id"])


@query("w03_lead_flag", """
SELECT event_id, coalesce(lead(event_type = 'signup') OVER (ORDER BY event_id), false) AS ausgeschieden FROM events""")
def lead_flag(spark, sf):
    flagged = events(spark, sf).select("event_id", (F.col("event_type") == "signup").alias("nachruecker"))
    led = W.following(flagged, {"ausgeschieden": "nachruecker"}, [], ["event_id"])
    return led.select("event_id", F.coalesce("ausgeschieden", F.lit(False)).alias("ausgeschieden"))


@query("w04_step_fill", """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS gueltig FROM events)
SELECT event_id, coalesce(gueltig, lag(gueltig) OVER (PARTITION BY user_id ORDER BY ts, event_id), -1.0) AS gueltig FROM e""")
def step_fill(spark, sf):
    filled = W.step_fill(events(spark, sf), ["gueltig"], ["user_id"], HISTORY)
    return filled.select("event_id", F.coalesce("gueltig", F.lit(-1.0)).alias("gueltig"))


@query("w05_quintile", """
WITH p AS (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_retailprice / p_size END AS dichte FROM part),
t AS (SELECT p_partkey, CAST(ntile(5) OVER (ORDER BY dichte, p_partkey) AS INTEGER) AS quintil FROM p WHERE dichte IS NOT NULL)
SELECT p_partkey, coalesce(quintil, 0) AS quintil FROM p LEFT JOIN t USING (p_partkey)""")
def quintile(spark, sf):
    dense = F.when(F.col("p_type") != "PROMO", M.density(F.col("p_retailprice"), F.col("p_size")))
    parts = table(spark, sf, "part").select("p_partkey", dense.alias("dichte"))
    return W.ntile(parts, "dichte", ["p_partkey"], 5, "quintil").select(
        "p_partkey", F.coalesce("quintil", F.lit(0)).alias("quintil"))


@query("w05_quintile_of_hot_value", """
SELECT event_id, CAST(ntile(5) OVER (ORDER BY CASE WHEN value < 40 THEN 0.0 ELSE value END, event_id) AS INTEGER) AS quintil FROM events""")
def quintile_of_hot_value(spark, sf):
    flat = F.when(F.col("value") < 40, F.lit(0.0)).otherwise(F.col("value"))
    rows = table(spark, sf, "events").select("event_id", flat.alias("wert"))
    return W.ntile(rows, "wert", ["event_id"], 5, "quintil").select("event_id", "quintil")


@query("w06_drop_leading_rows", """
SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) AS e
WHERE n > 2""")
def drop_leading_rows(spark, sf):
    return W.drop_leading(events(spark, sf), 2, ["user_id"], HISTORY).select("event_id")


@query("w07_group_size", """
SELECT event_id, count(*) OVER (PARTITION BY user_id) AS anzahl FROM events""")
def group_size(spark, sf):
    return A.group_size(table(spark, sf, "events").select("event_id", "user_id"), ["user_id"]).select("event_id", "anzahl")


@query("w08_top_of_each_group", """
SELECT user_id, event_id, CAST(n AS INTEGER) AS rang FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) AS e WHERE n <= 3""")
def top_of_each_group(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "value")
    return K.top_n(rows, ["user_id"], [F.desc("value"), F.asc("event_id")], 3).select("user_id", "event_id", "rang")


def shares(spark, sf):
    return star.segment_share(spark, sf).withColumn("prozent", M.share_pct(F.col("stimmen"), F.col("gueltig")))


_SHARES = SEGMENT_SQL + """,
p AS (SELECT c_nationkey, c_mktsegment, CAST(stimmen AS DOUBLE) / gueltig * 100 AS prozent FROM share)"""


@query("t01_leading_nations", _SHARES + """
SELECT c_mktsegment, c_nationkey, prozent, CAST(n AS INTEGER) AS rang FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY prozent DESC, c_nationkey) AS n FROM p) AS r WHERE n <= 5""")
def leading_nations(spark, sf):
    top = K.top_n(shares(spark, sf), ["c_mktsegment"], [F.desc("prozent"), F.asc("c_nationkey")], 5)
    return top.select("c_mktsegment", "c_nationkey", "prozent", "rang")


@query("t02_rest_after_leading", """
SELECT user_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) AS e WHERE n > 5""")
def rest_after_leading(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "value")
    rest = K.remainder(rows, ["user_id"], ["event_id"], [F.desc("value"), F.asc("event_id")], 5)
    return rest.select("user_id", "event_id")


_TOP_BOTTOM = """
h AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY prozent DESC, c_nationkey) AS r FROM p),
l AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY prozent, c_nationkey) AS r FROM p)
SELECT c_mktsegment, c_nationkey, prozent, 'oben' AS seite, CAST(r AS INTEGER) AS rang, CAST(r AS INTEGER) AS zeile FROM h WHERE r <= {n}
UNION ALL SELECT c_mktsegment, c_nationkey, prozent, 'unten', CAST(r AS INTEGER), CAST({n} + {n} + 1 - r AS INTEGER) FROM l WHERE r <= {n}"""


@query("t03_highest_and_lowest", _SHARES + "," + _TOP_BOTTOM.format(n=5))
def highest_and_lowest(spark, sf):
    out = K.top_bottom_n(shares(spark, sf), ["c_mktsegment"], "prozent", ["c_nationkey"], 5)
    return out.select("c_mktsegment", "c_nationkey", "prozent", "seite", "rang", "zeile")


@query("t06_first_of_ballot", """
SELECT s_nationkey, s_suppkey, CAST(n AS INTEGER) AS rang FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier) AS s WHERE n <= 5""")
def first_of_ballot(spark, sf):
    return K.top_n(table(spark, sf, "supplier"), ["s_nationkey"], [F.asc("s_suppkey")], 5).select(
        "s_nationkey", "s_suppkey", "rang")


@query("t07_sorted_nulls_last", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size END AS groesse FROM part ORDER BY groesse NULLS LAST, p_partkey""")
def sorted_nulls_last(spark, sf):
    size = F.when(F.col("p_size") > 25, F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", size.alias("groesse")).orderBy(
        F.col("groesse").asc_nulls_last(), "p_partkey")
