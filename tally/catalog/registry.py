"""Registered queries: name -> function of (spark, sf_dir), and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tally.plans.star import BRANDS, CITY_SEGMENT, SPLIT, STATE_NAME, TYPES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests only."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _period_ctes(tag: str, condition: str) -> str:
    when = f"o_orderdate {condition} TIMESTAMP '{SPLIT}'"
    valid_l = "(f = 'A' OR (f = 'R' AND s <> 'F'))"
    return f"""
line{tag} AS (
  SELECT o_custkey AS ck, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f, l_linestatus AS s,
         p_brand AS b, p_type AS t
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  WHERE {when}),
prec{tag} AS (
  SELECT key, name, typ, count(*) AS stimmbezirke,
         CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS gezaehlt
  FROM orders JOIN lev ON o_custkey = ck WHERE {when} GROUP BY key, name, typ),
tot{tag} AS (
  SELECT key, CAST(sum(q) AS BIGINT) AS wahlberechtigt,
         CAST(sum(CASE WHEN f IN ('A', 'R') THEN q END) AS BIGINT) AS waehler,
         CAST(sum(CASE WHEN f = 'R' THEN q END) AS BIGINT) AS ungueltig_d,
         CAST(sum(CASE WHEN f = 'A' THEN q END) AS BIGINT) AS gueltig_d,
         CAST(sum(CASE WHEN f = 'R' AND s = 'F' THEN q END) AS BIGINT) AS ungueltig_l,
         CAST(sum(CASE WHEN {valid_l} THEN q END) AS BIGINT) AS gueltig_l
  FROM line{tag} JOIN lev USING (ck) GROUP BY key),
area{tag} AS (SELECT * FROM prec{tag} LEFT JOIN tot{tag} USING (key)),
votes{tag} AS (
  SELECT key, 'd' AS kind, b AS partei, CAST(sum(q) AS BIGINT) AS st
  FROM line{tag} JOIN lev USING (ck) WHERE f = 'A' GROUP BY key, b
  UNION ALL
  SELECT key, 'l', t, CAST(sum(q) AS BIGINT)
  FROM line{tag} JOIN lev USING (ck) WHERE {valid_l} GROUP BY key, t)"""


#: Areas (customers, nations, whole) and their counts in the present and earlier period.
FEED_SQL = f"""WITH cust AS (
  SELECT c_custkey AS ck, c_name, c_nationkey AS nk, c_mktsegment AS seg, c_acctbal,
         lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') AS wk3, lpad(CAST(c_custkey + 1 AS VARCHAR), 12, '0') AS own
  FROM customer),
lev AS (
  SELECT ck, CASE WHEN seg = '{CITY_SEGMENT}' THEN 'KS' ELSE 'VF' END AS typ,
         CASE WHEN seg = '{CITY_SEGMENT}' THEN '000' ELSE wk3 END || own AS key, c_name AS name FROM cust
  UNION ALL SELECT ck, 'WK', wk3 || '000000000000', 'NATION_' || nk FROM cust
  UNION ALL SELECT ck, 'LD', '000000000000000', '{STATE_NAME}' FROM cust),""" \
    + _period_ctes("", ">=") + "," + _period_ctes("0", "<") + f""",
brands AS (SELECT 'Brand#' || i AS partei, CAST(i AS INTEGER) AS pos FROM range(1, {len(BRANDS) + 1}) AS r(i)),
types AS (SELECT partei, CAST(pos AS INTEGER) AS pos FROM (VALUES
  {", ".join(f"('{t}', {i})" for i, t in enumerate(TYPES, start=1))}) AS v(partei, pos))"""

#: Order value in cents by nation and segment, of all orders.
SEGMENT_SQL = """WITH seg AS (
  SELECT c_nationkey, c_mktsegment, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS stimmen
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, c_mktsegment),
share AS (
  SELECT *, CAST(sum(stimmen) OVER (PARTITION BY c_nationkey) AS BIGINT) AS gueltig FROM seg)"""
