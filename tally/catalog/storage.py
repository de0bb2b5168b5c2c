"""Sources and sinks: results are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.functions.numbers import zero_pad
from tally.catalog import live as V
from tally.catalog import results as R
from tally.catalog.registry import FEED_SQL, QUERIES, SQL, query
from tally.functions.numbers import format_de
from tally.functions.text import LIST_SUFFIX
from tally.operators.cleaning import select_measures
from tally.plans import star
from tally.plans.star import TYPES, table
from tally.session import shared_folder
from tally.sources import sinks, snapshots, tables

_FEED_COLUMNS = ["Gebietsschlüssel", "Gebietsbezeichnung", "Gebietstyp", "Wahlberechtigte", "Wahlbeteiligung",
                 *[t + LIST_SUFFIX for t in TYPES]]
_LIST_VOTES = ", ".join(
    f"(SELECT st FROM votes{{tag}} v WHERE v.key = a.key AND kind = 'l' AND partei = '{t}') AS \"{t}\"" for t in TYPES)


def _feed_sql(tag: str) -> str:
    return FEED_SQL + f"""
SELECT key, name, typ, wahlberechtigt, CAST(printf('%.4f', CAST(waehler AS DOUBLE) / nullif(wahlberechtigt, 0) * 100) AS DOUBLE) AS wahlbeteiligung,
       {_LIST_VOTES.format(tag=tag)} FROM area{tag} a"""


def _write_feed(spark, sf, path, present, stand):
    feed = star.feed(spark, sf, present).select(*[f"`{c}`" for c in _FEED_COLUMNS])
    sinks.write_locale_text(feed, path, f"Muster;Stand: {stand}", {"Wahlbeteiligung": 4})


def _short(snapshot):
    fixed = {"key": "Gebietsschlüssel", "name": "Gebietsbezeichnung", "typ": "Gebietstyp",
             "wahlberechtigt": "Wahlberechtigte", "wahlbeteiligung": "Wahlbeteiligung"}
    return select_measures(snapshot, fixed, LIST_SUFFIX)


@query("s01_snapshot_file", _feed_sql(""))
def snapshot_file(spark, sf):
    """The feed as locale text with banner and header, read back with types."""
    path = shared_folder(spark, "feed")
    _write_feed(spark, sf, path, True, "08.10.2023 20:15:00")
    return _short(snapshots.read_snapshot(spark, path))


@query("s02_latest_snapshot", _feed_sql(""))
def latest_snapshot(spark, sf):
    """The newer of two archived snapshots."""
    folder = shared_folder(spark, "archive")
    _write_feed(spark, sf, f"{folder}/2018-10-28", False, "28.10.2018 20:15:00")
    _write_feed(spark, sf, f"{folder}/2023-10-08", True, "08.10.2023 20:15:00")
    return _short(snapshots.read_latest_snapshot(spark, folder))


@query("s03_snapshot_times", """
SELECT o_orderpriority, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS stand, count(*) AS zeilen FROM orders GROUP BY o_orderpriority""")
def snapshot_times(spark, sf):
    """One file per priority, each with the time of its last order in a banner line."""
    orders = table(spark, sf, "orders")
    stand = F.date_format(F.max("o_orderdate"), "dd.MM.yyyy HH:mm:ss")
    banner = orders.groupBy("o_orderpriority").agg(F.concat(F.lit("Muster;Stand: "), stand).alias("value"))
    rows = orders.select("o_orderpriority", F.concat_ws(";", "o_orderkey", "o_custkey").alias("value"))
    path = shared_folder(spark, "stand")
    banner.unionByName(rows).repartition("o_orderpriority").write.partitionBy("o_orderpriority").text(path)
    lines = spark.read.text(path)
    timed = snapshots.with_snapshot_ts(lines.filter(~F.col("value").startswith("Muster")), path)
    return timed.groupBy("o_orderpriority").agg(
        F.date_format(F.max("snapshot_ts"), "yyyy-MM-dd HH:mm:ss").alias("stand"), F.count(F.lit(1)).alias("zeilen"))


@query("s04_sniffed_tables", """
SELECT 'US' AS art, c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT 'DE', c_custkey, c_name, c_acctbal FROM customer""")
def sniffed_tables(spark, sf):
    """The same table once with commas, once with semicolons and decimal commas."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = shared_folder(spark, "table")
    customers.write.option("header", True).csv(f"{path}/us")
    customers.withColumn("c_acctbal", format_de(F.col("c_acctbal"), 2)).write.option("header", True).option(
        "sep", ";").csv(f"{path}/de")
    types = {"c_custkey": "bigint", "c_acctbal": "double"}
    us, de = (tables.read_table(spark, f"{path}/{kind}", types) for kind in ("us", "de"))
    return us.select(F.lit("US").alias("art"), "*").unionByName(de.select(F.lit("DE").alias("art"), "*"))


@query("s05_history_file", FEED_SQL + """
SELECT CAST(substr(key, 4) AS BIGINT) AS lfd, 'Größe ' || name AS gebiet, wahlberechtigt, gueltig_l AS gueltig FROM area0 WHERE typ IN ('VF', 'KS')""")
def history_file(spark, sf):
    """Earlier results in an old encoding, with grouped numbers and rows that are no data."""
    then = star.history(spark, sf, LIST_SUFFIX).filter(F.col("ags").isNotNull())
    text = then.select(F.col("ags").cast("bigint").cast("string").alias("lfd"), F.concat(F.lit("Größe "), "gebiet").alias("gebiet"),
                       format_de(F.col("wahlberechtigt"), 0).alias("wahlberechtigt"), format_de(F.col("gueltig"), 0).alias("gueltig"))
    path = shared_folder(spark, "history")
    text.write.option("sep", ";").option("header", True).option("encoding", "iso-8859-1").csv(path)
    columns = {"lfd": "bigint", "gebiet": "string", "wahlberechtigt": "bigint", "gueltig": "bigint"}
    return tables.read_history(spark, path, columns, "lfd")


@query("l10_history_header", """
SELECT CAST(13 + substr(p_brand, 7) :: INTEGER AS INTEGER) AS idx, 'Größe – ' || p_brand AS partei, count(*) AS zeilen
FROM part WHERE substr(p_brand, 7) :: INTEGER BETWEEN 3 AND 22 GROUP BY p_brand""")
def history_header(spark, sf):
    """A file with one column per brand; the header row read back as positions and names."""
    part = table(spark, sf, "part")
    header = "Lfd" + ";x" * 12 + "".join(f";Größe \u0096 {b}" for b in star.BRANDS)
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
    rows = part.select(F.concat_ws(";", "p_partkey", F.repeat(F.lit("x;"), number + 11), F.lit("1")).alias("value"))
    path = shared_folder(spark, "header")
    first = spark.createDataFrame([(header,)], "value string")
    first.unionByName(rows).write.option("encoding", "iso-8859-1").option("sep", "\u0001").option("quote", "").csv(path)
    names = tables.history_header(spark, path, 16, 35)
    counts = part.groupBy(number.alias("n")).agg(F.count(F.lit(1)).alias("zeilen"))
    return names.join(counts, F.col("idx") == F.col("n") + 13).select("idx", "partei", "zeilen")


@query("s06_headerless_file", "SELECT p_partkey, p_brand AS partei, p_name AS parteiname FROM part")
def headerless_file(spark, sf):
    path = shared_folder(spark, "plain")
    table(spark, sf, "part").select("p_partkey", "p_brand", "p_name").write.option("sep", ";").csv(path)
    return tables.read_headerless(spark, path, "p_partkey bigint, partei string, parteiname string")


@query("s07_typed_key_values", r"""
WITH v AS (SELECT event_id, 'k' AS name, replace(replace(props, '{"k": ', ''), '}', '') AS value FROM events
           UNION ALL SELECT event_id, 'typ', event_type FROM events
           UNION ALL SELECT event_id, 'wert', '.' || CAST(event_id AS VARCHAR) FROM events
           UNION ALL SELECT event_id, 'minus', '-' || CAST(event_id AS VARCHAR) FROM events)
SELECT event_id, name, value, CASE WHEN regexp_full_match(value, '[0-9]*\.*[0-9]+') THEN CAST(value AS DOUBLE) END AS num_value,
       CASE WHEN NOT regexp_full_match(value, '[0-9]*\.*[0-9]+') THEN value END AS str_value FROM v""")
def typed_key_values(spark, sf):
    number = F.col("event_id").cast("string")
    pairs = F.array(
        F.struct(F.lit("k").alias("name"), F.get_json_object("props", "$.k").alias("value")),
        F.struct(F.lit("typ").alias("name"), F.col("event_type").alias("value")),
        F.struct(F.lit("wert").alias("name"), F.concat(F.lit("."), number).alias("value")),
        F.struct(F.lit("minus").alias("name"), F.concat(F.lit("-"), number).alias("value")))
    return tables.typed_key_values(table(spark, sf, "events").select("event_id", F.inline(pairs)))


@query("s08_stored_table", SQL["l06_baseline_constituency_direct"])
def stored_table(spark, sf):
    path = shared_folder(spark, "baseline")
    tables.write_table(V.direct_baseline(spark, sf), path)
    return spark.read.parquet(path)


@query("s09_snapshot_archive", """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS snapshot_date FROM events""")
def snapshot_archive(spark, sf):
    """Rows archived by day in two appends."""
    path = shared_folder(spark, "raw")
    events = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").alias("snapshot_ts"))
    half = F.col("snapshot_ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    snapshots.archive_snapshot(events.filter(half), path)
    snapshots.archive_snapshot(events.filter(~half), path)
    return spark.read.parquet(path).select("event_id", "user_id", F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"))


@query("s10_long_tables", V.LIST_SQL + " SELECT wk, wk_name, partei, stimmen, prozent, differenz FROM ergebnis")
def long_tables(spark, sf):
    """The long constituency table as CSV."""
    path = shared_folder(spark, "long")
    rows = V.constituency_list_votes(spark, sf).select("wk", "wk_name", "partei", "stimmen", "prozent", "differenz")
    sinks.write_long_table(rows, path, "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("s11_area_tables", SQL["l17_constituency_direct_tables"].replace("CAST(n AS INTEGER) AS zeile, ", ""))
def area_tables(spark, sf):
    """One CSV per constituency, read back with its name from the directory."""
    path = shared_folder(spark, "livedaten")
    rows = QUERIES["l17_constituency_direct_tables"](spark, sf)
    sinks.write_area_tables(rows, path, order=["zeile"])
    schema = "name string, partei string, stimmen bigint, prozent string, fname string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("s12_area_documents", """SELECT 'wk' || lpad(CAST(wk AS VARCHAR), 3, '0') || '_landesstimmen' AS fname, document AS value FROM (
""" + SQL["l17_constituency_list_documents"] + ") AS d")
def area_documents(spark, sf):
    path = shared_folder(spark, "dokumente")
    documents = QUERIES["l17_constituency_list_documents"](spark, sf)
    named = documents.withColumn("fname", F.concat(F.lit("wk"), zero_pad(F.col("wk"), 3), F.lit("_landesstimmen")))
    sinks.write_area_documents(named, path)
    return spark.read.text(path).select("fname", "value")


@query("s13_party_sheets", SQL["l16_constituency_strongholds"])
def party_sheets(spark, sf):
    path = shared_folder(spark, "analysen")
    rows = R.constituency_strongholds(spark, sf)
    sinks.write_sheets(rows, path, "partei")
    return spark.read.schema(rows.schema).parquet(path)
