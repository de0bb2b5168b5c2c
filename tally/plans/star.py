"""A count feed derived from a star schema (lineitem, part, orders, customer, nation).

It has the shape of a snapshot feed, so that all pipelines run on ordinary tables:

- state = everything, constituency = nation, municipality = customer, precinct = order;
  customers of one market segment play the cities that span constituencies;
- votes = quantities; lines returned as ``A`` are valid, ``R`` invalid as first votes;
  as list votes ``R`` lines are invalid only when their status is ``F``;
- first-vote parties = brands, list-vote parties = part types;
- a precinct is counted unless its order is pending (``P``);
- orders from ``SPLIT`` on are the present election, those before the earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.measures import turnout_pct
from tally.functions.numbers import zero_pad
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.operators.aggregates import first_by
from tally.operators.cleaning import tick
from tally.operators.joins import with_baseline
from tally.sources.feed import INVALID, PERCENT, VALID

# --- fixed values of this derivation ---
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BASE_BRANDS = BRANDS[1:20]
BASE_TYPES = TYPES[1:5]
SPLIT = "1998-01-01"
CITY_SEGMENT = "MACHINERY"
STATE_NAME = "LAND"
KEY_SHAPE = (3, 12)
# ----------------------------------------

SUMS = ["wahlberechtigt", "waehler", "ungueltig_d", "gueltig_d", "ungueltig_l", "gueltig_l"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def period(present: bool) -> Column:
    border = F.lit(SPLIT).cast("timestamp_ntz")
    return F.col("o_orderdate") >= border if present else F.col("o_orderdate") < border


def _line_sums() -> list[Column]:
    """Counts of a group of lines: totals and votes by party and vote type."""
    votes = "CAST(l_quantity AS BIGINT)"
    kept, returned, settled = "l_returnflag = 'A'", "l_returnflag = 'R'", "l_linestatus = 'F'"
    valid_list = f"({kept} OR ({returned} AND NOT {settled}))"
    rows = {
        "wahlberechtigt": "true",
        "waehler": f"({kept} OR {returned})",
        "ungueltig_d": returned,
        "gueltig_d": kept,
        "ungueltig_l": f"({returned} AND {settled})",
        "gueltig_l": valid_list,
        **{b + DIRECT_SUFFIX: f"({kept} AND p_brand = '{b}')" for b in BRANDS},
        **{t + LIST_SUFFIX: f"({valid_list} AND p_type = '{t}')" for t in TYPES},
    }
    return [F.expr(f"sum(CASE WHEN {when} THEN {votes} END) AS {tick(name)}") for name, when in rows.items()]


VOTES = [b + DIRECT_SUFFIX for b in BRANDS] + [t + LIST_SUFFIX for t in TYPES]


def customer_counts(spark: SparkSession, sf_dir: str, present: bool = True) -> DataFrame:
    """One row per customer with orders in the period: precincts and all counts.

    Lines and orders are each reduced to one row per customer before they meet the
    customer table, so a hot customer is combined in the tasks that read it.
    """
    orders = table(spark, sf_dir, "orders").filter(period(present))
    # the period's orders first: they shrink the lines before the second join
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"),
              F.col("l_partkey") == F.col("p_partkey"))
    )
    counts = lines.groupBy("o_custkey").agg(*_line_sums())
    precincts = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("stimmbezirke"),
        F.sum(F.when(F.col("o_orderstatus") != "P", F.lit(1)).otherwise(F.lit(0))).alias("gezaehlt"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    return precincts.join(counts, "o_custkey", "left").join(customers, "o_custkey")


def _levels() -> Column:
    """The areas a customer row counts for: itself, its constituency, the state."""
    wk = zero_pad(F.col("c_nationkey") + 1, 3)
    is_city = F.col("c_mktsegment") == CITY_SEGMENT
    own = zero_pad(F.col("o_custkey") + 1, KEY_SHAPE[1])
    none = F.lit("0" * KEY_SHAPE[1])
    areas = [
        (F.when(is_city, F.lit("KS")).otherwise(F.lit("VF")),
         F.concat(F.when(is_city, F.lit("000")).otherwise(wk), own), F.col("c_name")),
        (F.lit("WK"), F.concat(wk, none), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))),
        (F.lit("LD"), F.concat(F.lit("000"), none), F.lit(STATE_NAME)),
    ]
    names = ("Gebietstyp", "Gebietsschlüssel", "Gebietsbezeichnung")
    return F.array(*[F.struct(*[c.alias(n) for c, n in zip(area, names)]) for area in areas])


def area_counts(spark: SparkSession, sf_dir: str, present: bool = True) -> DataFrame:
    """All levels from one pass: customer rows fan out to their areas and are summed."""
    rows = customer_counts(spark, sf_dir, present)
    sums = ["stimmbezirke", "gezaehlt", *SUMS, *VOTES]
    fanned = rows.select(F.inline(_levels()), *[tick(c) for c in sums])
    return fanned.groupBy("Gebietsschlüssel", "Gebietsbezeichnung", "Gebietstyp").agg(
        *[F.expr(f"sum({tick(c)}) AS {tick(c)}") for c in sums])


def feed(spark: SparkSession, sf_dir: str, present: bool = True, areas: DataFrame | None = None) -> DataFrame:
    """The wide snapshot of the present (or earlier) election; ``areas`` are its counts if they are stored already."""
    areas = area_counts(spark, sf_dir, present) if areas is None else areas
    voters = F.col("waehler")
    cols = {
        "Wahlberechtigte": F.col("wahlberechtigt"),
        "Wählerinnen und Wähler": voters,
        "Wahlbeteiligung": turnout_pct(voters, F.col("wahlberechtigt")),
        "Anzahl Wahlbezirke": F.col("stimmbezirke"),
        "Anzahl Wahlbezirke ausgezählt": F.col("gezaehlt"),
        "freigegeben": F.when(F.col("stimmbezirke") == F.col("gezaehlt"), F.lit(1.0)).otherwise(F.lit(0.0)),
    }
    for suffix, kind in ((DIRECT_SUFFIX, "d"), (LIST_SUFFIX, "l")):
        for word, source in ((INVALID, f"ungueltig_{kind}"), (VALID, f"gueltig_{kind}")):
            cols[word + suffix] = F.col(source)
            cols[word + suffix + PERCENT] = F.try_divide(F.col(source), voters) * 100
    return areas.select("Gebietsschlüssel", "Gebietsbezeichnung", "Gebietstyp",
                        *[c.alias(n) for n, c in cols.items()], *[tick(v) for v in VOTES])


def history(spark: SparkSession, sf_dir: str, suffix: str, areas: DataFrame | None = None) -> DataFrame:
    """Earlier results of one vote type, one row per area and one column per party.

    Municipality rows have ``ags`` and ``wk``, constituency rows only ``wk``, the state
    row neither. ``areas`` are the earlier counts if they are stored already.
    """
    kind = "d" if suffix == DIRECT_SUFFIX else "l"
    parties = BRANDS if kind == "d" else TYPES
    areas = area_counts(spark, sf_dir, present=False) if areas is None else areas
    key = F.col("Gebietsschlüssel")
    is_own = F.col("Gebietstyp").isin("VF", "KS")
    return areas.select(
        F.when(F.col("Gebietstyp") != "LD", F.substring(key, 1, KEY_SHAPE[0]).cast("int")).alias("wk"),
        F.when(is_own, F.substring(key, KEY_SHAPE[0] + 1, KEY_SHAPE[1])).alias("ags"),
        "Gebietstyp",
        F.col("Gebietsbezeichnung").alias("gebiet"),
        "wahlberechtigt", "waehler",
        F.col(f"gueltig_{kind}").alias("gueltig"),
        F.col(f"ungueltig_{kind}").alias("ungueltig"),
        *[F.expr(f"{tick(p + suffix)} AS {tick(p)}") for p in parties],
    )


def composite(spark: SparkSession, sf_dir: str, suffix: str, areas: DataFrame | None = None) -> DataFrame:
    """Earlier constituency results with the column names of a composite baseline."""
    return history(spark, sf_dir, suffix, areas).filter(F.col("Gebietstyp") == "WK").withColumnRenamed(
        "wahlberechtigt", "wahlberechtigte")


def gained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constituencies that gained territory: nations of region 0."""
    return table(spark, sf_dir, "nation").filter("n_regionkey = 0").selectExpr("n_nationkey + 1 AS wk")


def lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constituencies that lost territory: nations of region 1."""
    return table(spark, sf_dir, "nation").filter("n_regionkey = 1").selectExpr("n_nationkey + 1 AS wk")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct candidates: suppliers are spread over the brands, the first per nation and brand stands."""
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.col("s_nationkey") + 1).alias("wk"),
        F.concat(F.lit("Brand#"), (F.col("s_suppkey") * 7 % len(BRANDS) + 1).cast("string")).alias("partei"),
        F.col("s_name").alias("nachname"), "s_suppkey", "s_acctbal")
    return first_by(suppliers, ["wk", "partei"], [F.col("s_suppkey").asc()])


def brand_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party dimension: brands with their number as id."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(F.col("p_brand").alias("partei"), F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int").alias("id"))


def municipality_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean municipality names; customers with a negative balance have none."""
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        zero_pad(F.col("c_custkey") + 1, KEY_SHAPE[1]).alias("ags"),
        F.upper("c_name").alias("name"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("wk_name"),
    )


def precincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precinct rows of the feed: one per order; pending orders have no voters yet."""
    flag, votes = F.col("l_returnflag"), F.col("l_quantity").cast("bigint")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(votes).alias("e"),
        F.sum(F.when(flag.isin("A", "R"), votes).otherwise(0)).alias("v"),
        F.sum(F.when(flag == "R", votes).otherwise(0)).alias("i1"),
        F.sum(F.when((flag == "R") & (F.col("l_linestatus") == "F"), votes).otherwise(0)).alias("i2"),
    )
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    postal = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Briefwahl ")).otherwise(F.lit("Lokal "))
    return rows.select(
        F.concat(zero_pad(F.col("c_nationkey") + 1, 3), zero_pad(F.col("c_custkey") + 1, KEY_SHAPE[1])).alias("Gebietsschlüssel"),
        F.col("c_name").alias("Gebietsbezeichnung"),
        F.lit("SB").alias("Gebietstyp"),
        F.reverse(F.col("o_orderkey").cast("string")).alias("Wahlbezirksnummer"),
        F.concat(postal, "o_orderpriority").alias("Wahllokal"),
        F.col("e").alias("Wahlberechtigte"),
        F.when(F.col("o_orderstatus") != "P", F.col("v")).alias("Wählerinnen und Wähler"),
        F.col("i1").alias("ungültige Wahlkreisstimmen"),
        F.col("i2").alias("ungültige Landesstimmen"),
    )


def cents(value: Column) -> Column:
    """Money as whole cents, so that sums are exact in any order."""
    return F.round(value * 100).cast("bigint")


def segment_share(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Order value by nation and market segment, with its share of the nation in %."""
    orders = table(spark, sf_dir, "orders")
    if year is not None:
        first = F.lit(f"{year}-01-01").cast("timestamp_ntz")
        after = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
        orders = orders.filter((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after))
    by_customer = orders.groupBy("o_custkey").agg(F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    cells = by_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("c_nationkey", "c_mktsegment").agg(F.sum("cents").alias("stimmen"))
    totals = cells.groupBy("c_nationkey").agg(F.sum("stimmen").alias("gueltig"))
    return with_baseline(cells, totals, ["c_nationkey"])


def segment_share_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value by year, nation and market segment, with the total of year and nation; all years in one scan."""
    by_customer = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("jahr"), "o_custkey").agg(
        F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    cells = by_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("jahr", "c_nationkey", "c_mktsegment").agg(F.sum("cents").alias("stimmen"))
    totals = cells.groupBy("jahr", "c_nationkey").agg(F.sum("stimmen").alias("gueltig"))
    return with_baseline(cells, totals, ["jahr", "c_nationkey"])
