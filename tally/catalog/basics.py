"""Projections, cleaning, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.catalog.registry import FEED_SQL, SEGMENT_SQL, query
from tally.functions import measures as M
from tally.functions import numbers as NUM
from tally.functions import text as T
from tally.operators import cleaning as C
from tally.operators.joins import flag_listed, with_baseline
from tally.operators.ranking import top_n
from tally.plans import star
from tally.plans.dimensions import column_index
from tally.plans.star import table


@query("p00_german_numbers", """
SELECT o_orderkey, translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS betrag_text, o_totalprice AS betrag,
       CAST(NULL AS DOUBLE) AS kein_betrag
FROM orders""")
def german_numbers(spark, sf):
    text = NUM.format_de(F.col("o_totalprice"), 2)
    return table(spark, sf, "orders").select(
        "o_orderkey", text.alias("betrag_text"), NUM.parse_de_number(text).alias("betrag"),
        NUM.parse_de_number(F.col("o_orderpriority")).alias("kein_betrag"))


@query("p00_signed_german_numbers", """
SELECT c_custkey, CASE WHEN d < 0 THEN '-' ELSE '+' END || translate(format('{:,.1f}', abs(d)), ',.', '.,') AS abweichung
FROM (SELECT c_custkey, CAST(CAST(round(c_acctbal * 100) AS BIGINT) - 450000 AS DOUBLE) / 8 AS d FROM customer) AS x""")
def signed_german_numbers(spark, sf):
    delta = (star.cents(F.col("c_acctbal")) - 450000).cast("double") / 8
    return table(spark, sf, "customer").select("c_custkey", NUM.format_signed_de(delta, 1).alias("abweichung"))


@query("p01_select_measures", FEED_SQL + """
SELECT key AS area_key, gueltig_l AS gueltig, """ + ", ".join(
    f"(SELECT st FROM votes v WHERE v.key = area.key AND kind = 'l' AND partei = '{t}') AS \"{t}\""
    for t in star.BASE_TYPES) + " FROM area WHERE typ = 'WK'")
def select_measures(spark, sf):
    rows = star.feed(spark, sf).filter(F.col("Gebietstyp") == "WK")
    return C.select_measures(rows, {"area_key": "Gebietsschlüssel", "gueltig": "gültige Landesstimmen"},
                             T.LIST_SUFFIX, star.BASE_TYPES)


@query("p02_area_level_filter", FEED_SQL + """
SELECT key AS area_key, typ, stimmbezirke FROM area WHERE typ IN ('VF', 'KS')""")
def area_level_filter(spark, sf):
    return star.feed(spark, sf).filter(F.col("Gebietstyp").isin("VF", "KS")).select(
        F.col("Gebietsschlüssel").alias("area_key"), F.col("Gebietstyp").alias("typ"),
        F.col("Anzahl Wahlbezirke").alias("stimmbezirke"))


@query("p03_split_area_key", FEED_SQL + """
SELECT key AS area_key, CAST(substr(key, 1, 3) AS INTEGER) AS wk, substr(key, 4, 12) AS ags FROM area""")
def split_area_key(spark, sf):
    key = F.col("Gebietsschlüssel")
    parts = T.split_area_key(key, *star.KEY_SHAPE)
    return star.feed(spark, sf).select(key.alias("area_key"), *[c.alias(n) for n, c in parts.items()])


@query("p04_zero_fill", """
SELECT p_brand, CAST(sum(coalesce(CASE WHEN p_size >= 10 THEN p_size END, 0)) AS BIGINT) AS groesse,
       count(CASE WHEN p_size >= 20 THEN 1 END) AS mit_rest
FROM part GROUP BY p_brand""")
def zero_fill(spark, sf):
    part = table(spark, sf, "part").withColumns({
        "a": F.when(F.col("p_size") >= 10, F.col("p_size")), "b": F.when(F.col("p_size") >= 20, F.col("p_size"))})
    return C.zero_fill(part, ["a"]).groupBy("p_brand").agg(
        F.sum("a").alias("groesse"), F.count("b").alias("mit_rest"))


@query("p05_sentinel_to_null", """
SELECT p_partkey, CASE WHEN p_size < 5 OR p_type = 'PROMO' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS zelle FROM part""")
def sentinel_to_null(spark, sf):
    cell = F.when(F.col("p_size") < 5, F.lit("• •")).when(F.col("p_type") == "PROMO", F.lit("x")).otherwise(
        F.col("p_size").cast("string"))
    return C.clean_numbers(table(spark, sf, "part").select("p_partkey", cell.alias("zelle")), ["zelle"])


@query("p06_strip_label", """
SELECT p_partkey, p_type AS liste, p_brand AS spalte, p_name AS name FROM part""")
def strip_label(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey",
        T.strip_label(F.concat("p_type", F.lit(T.LIST_SUFFIX)), T.LIST_SUFFIX).alias("liste"),
        T.strip_position(F.concat("p_brand", F.lit("..."), F.col("p_size").cast("string"))).alias("spalte"),
        T.strip_label(F.col("p_name"), T.LIST_SUFFIX).alias("name"))


@query("p07_rename_header", """
SELECT s_suppkey AS "s suppkey", s_name AS "s name", s_nationkey AS "s nationkey", s_acctbal AS "s acctbal" FROM supplier""")
def rename_header(spark, sf):
    return C.rename_header(table(spark, sf, "supplier"), {"_": " "})


@query("p08_override_key", """
SELECT c_custkey, CASE WHEN c_custkey = 13 THEN 43 ELSE c_nationkey + 1 END AS wk,
       coalesce(CASE WHEN c_nationkey > 4 THEN c_nationkey END, 0) AS wk_oder_land FROM customer""")
def override_key(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        T.override_key(F.col("c_nationkey") + 1, F.col("c_custkey").cast("string"), {"13": 43}).alias("wk"),
        F.coalesce(F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")), F.lit(0)).alias("wk_oder_land"))


@query("p09_share_of_total", SEGMENT_SQL + """
SELECT c_nationkey, c_mktsegment, stimmen, gueltig,
       CASE WHEN stimmen = 0 THEN 0.0 ELSE CAST(stimmen AS DOUBLE) / gueltig * 100 END AS prozent FROM share""")
def share_of_total(spark, sf):
    return star.segment_share(spark, sf).withColumn("prozent", M.share_pct(F.col("stimmen"), F.col("gueltig")))


_YEARS = """WITH seg AS (
  SELECT year(o_orderdate) AS y, c_nationkey, c_mktsegment,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS stimmen
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
share AS (SELECT *, CAST(stimmen AS DOUBLE) / CAST(sum(stimmen) OVER (PARTITION BY y, c_nationkey) AS BIGINT) AS anteil FROM seg),
beide AS (
  SELECT a.c_nationkey, a.c_mktsegment, a.anteil * 100 AS prozent, coalesce(b.anteil * 1000 / 10, 0.0) AS prozent_alt
  FROM share a LEFT JOIN share b ON b.y = 1996 AND a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment
  WHERE a.y = 1997)"""


def year_shares(spark, sf):
    """Segment shares of 1997 with those of 1996."""
    now = star.segment_share(spark, sf, 1997).withColumn("prozent", M.share_pct(F.col("stimmen"), F.col("gueltig")))
    then = star.segment_share(spark, sf, 1996).select(
        "c_nationkey", "c_mktsegment", M.baseline_share_pct(F.col("stimmen"), F.col("gueltig")).alias("prozent_alt"))
    return with_baseline(now.select("c_nationkey", "c_mktsegment", "prozent"), then,
                         ["c_nationkey", "c_mktsegment"], ["prozent_alt"])


@query("p10_change_against_baseline", _YEARS + """
SELECT *, CASE WHEN prozent = 0 THEN 0.0 ELSE prozent - prozent_alt END AS differenz FROM beide""")
def change_against_baseline(spark, sf):
    return year_shares(spark, sf).withColumn("differenz", M.diff_pp(F.col("prozent"), F.col("prozent_alt")))


_ALL_YEARS = _YEARS.partition("beide AS (")[0] + """beide AS (
  SELECT CAST(a.y AS BIGINT) AS jahr, a.c_nationkey, a.c_mktsegment, a.anteil * 100 AS prozent, coalesce(b.anteil * 1000 / 10, 0.0) AS prozent_alt
  FROM share a LEFT JOIN share b ON b.y = a.y - 1 AND a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment)"""


def all_year_shares(spark, sf):
    """Segment shares of every year with those of the year before; without one the earlier share is 0."""
    shares = star.segment_share_by_year(spark, sf)
    keys = ["jahr", "c_nationkey", "c_mktsegment"]
    now = shares.select(*keys, M.share_pct(F.col("stimmen"), F.col("gueltig")).alias("prozent"))
    then = shares.select((F.col("jahr") + 1).alias("jahr"), *keys[1:],
                         M.baseline_share_pct(F.col("stimmen"), F.col("gueltig")).alias("prozent_alt"))
    return with_baseline(now, then, keys, ["prozent_alt"])


@query("p10_change_of_every_year", _ALL_YEARS + """
SELECT *, CASE WHEN prozent = 0 THEN 0.0 ELSE prozent - prozent_alt END AS differenz FROM beide""")
def change_of_every_year(spark, sf):
    return all_year_shares(spark, sf).withColumn("differenz", M.diff_pp(F.col("prozent"), F.col("prozent_alt")))


@query("p11_turnout_rates", FEED_SQL + """
SELECT key AS area_key, CAST(waehler AS DOUBLE) / wahlberechtigt * 100 AS wahlbeteiligung,
       CAST(ungueltig_d AS DOUBLE) / waehler * 100 AS ungueltig_prozent,
       100.0 - CAST(gueltig_d AS DOUBLE) / waehler * 100 AS ungueltig_aus_gueltig
FROM area WHERE typ IN ('WK', 'LD')""")
def turnout_rates(spark, sf):
    areas = star.area_counts(spark, sf).filter(F.col("Gebietstyp").isin("WK", "LD"))
    voters = F.col("waehler")
    return areas.select(
        F.col("Gebietsschlüssel").alias("area_key"),
        M.turnout_pct(voters, F.col("wahlberechtigt")).alias("wahlbeteiligung"),
        M.invalid_pct(F.col("ungueltig_d"), voters).alias("ungueltig_prozent"),
        M.invalid_pct_from_valid(F.col("gueltig_d"), voters).alias("ungueltig_aus_gueltig"))


@query("p12_runner_up", SEGMENT_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY stimmen DESC, c_mktsegment) AS n FROM share),
w AS (SELECT a.c_nationkey, a.stimmen, CAST(a.stimmen AS DOUBLE) / a.gueltig * 100 AS prozent, a.stimmen - b.stimmen AS vorsprung
      FROM r a JOIN r b ON a.c_nationkey = b.c_nationkey AND a.n = 1 AND b.n = 2)
SELECT *, stimmen / prozent * 100 AS gueltig, stimmen - vorsprung AS zweiter_stimmen,
       (stimmen - vorsprung) / (stimmen / prozent * 100) * 100 AS zweiter_prozent FROM w""")
def runner_up(spark, sf):
    shares = star.segment_share(spark, sf)
    first_two = top_n(shares, ["c_nationkey"], [F.desc("stimmen"), F.asc("c_mktsegment")], 2)
    win = first_two.groupBy("c_nationkey").agg(
        F.max("stimmen").alias("stimmen"),
        M.share_pct(F.max("stimmen"), F.max("gueltig")).alias("prozent"),
        (F.max("stimmen") - F.min("stimmen")).alias("vorsprung"),
        F.count(F.lit(1)).alias("n"))
    win = win.filter("n = 2").drop("n")
    return win.withColumns(M.runner_up(F.col("stimmen"), F.col("prozent"), F.col("vorsprung")))


@query("p13_collapse_columns", FEED_SQL + """,
w AS (SELECT key, sum(CASE WHEN partei = 'ECONOMY' THEN st END) AS a, sum(CASE WHEN partei = 'LARGE' THEN st END) AS b,
             sum(CASE WHEN partei = 'PROMO' THEN st END) AS c, sum(CASE WHEN partei = 'SMALL' THEN st END) AS d
      FROM votes WHERE kind = 'l' GROUP BY key)
SELECT key AS area_key, CAST(a AS BIGINT) AS "ECONOMY", CAST(b AS BIGINT) AS "LARGE", CAST(c + d AS BIGINT) AS "Sonstige"
FROM area LEFT JOIN w USING (key)""")
def collapse_columns(spark, sf):
    wide = C.select_measures(star.feed(spark, sf), {"area_key": "Gebietsschlüssel"}, T.LIST_SUFFIX,
                             ["ECONOMY", "LARGE", "PROMO", "SMALL"])
    return C.collapse_columns(wide, ["PROMO", "SMALL"], "Sonstige")


@query("p14_boundary_flag", """
SELECT n_nationkey + 1 AS wk, n_name, n_regionkey IN (0, 1) AS veraendert FROM nation""")
def boundary_flag(spark, sf):
    nations = table(spark, sf, "nation").selectExpr("n_nationkey + 1 AS wk", "n_name")
    return flag_listed(nations, star.gained(spark, sf).unionByName(star.lost(spark, sf)), "wk", "veraendert")


@query("p15_move_first", "SELECT c_mktsegment, c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def move_first(spark, sf):
    return C.move_first(table(spark, sf, "customer"), "c_mktsegment")


@query("p16_key_length_filter", """
SELECT p_partkey, p_brand FROM part WHERE length(p_brand) = 8 AND p_name IS NOT NULL AND p_size BETWEEN 1 AND 45""")
def key_length_filter(spark, sf):
    return table(spark, sf, "part").filter(
        (F.length("p_brand") == 8) & F.col("p_name").isNotNull() & F.col("p_size").between(1, 45)
    ).select("p_partkey", "p_brand")


@query("p17_density", """
SELECT p_partkey, p_retailprice / nullif(p_size - 10, 0) AS dichte FROM part WHERE p_size >= 10""")
def density(spark, sf):
    return table(spark, sf, "part").filter("p_size >= 10").select(
        "p_partkey", M.density(F.col("p_retailprice"), F.col("p_size") - 10).alias("dichte"))


@query("p18_pending_areas", FEED_SQL + """
SELECT key AS "Gebietsschlüssel", name AS "Gebietsbezeichnung", 0.0 :: DOUBLE AS freigegeben, gezaehlt, stimmbezirke
FROM area WHERE typ = 'VF' AND gezaehlt <> stimmbezirke""")
def pending_areas(spark, sf):
    return C.pending_areas(star.feed(spark, sf))


@query("p19_complete_areas", FEED_SQL + """
SELECT key AS area_key, typ, stimmbezirke FROM area WHERE gezaehlt = stimmbezirke""")
def complete_areas(spark, sf):
    areas = star.area_counts(spark, sf)
    return areas.filter(M.is_complete(F.col("gezaehlt"), F.col("stimmbezirke"))).select(
        F.col("Gebietsschlüssel").alias("area_key"), F.col("Gebietstyp").alias("typ"), "stimmbezirke")


@query("p20_display_names", """
SELECT s_suppkey, s_name || ' (' || 'NATION_' || s_nationkey || ')' AS name,
       CASE WHEN s_acctbal > 5000 THEN 'Dr. ' || s_name ELSE s_name END AS vorname FROM supplier""")
def display_names(spark, sf):
    title = F.when(F.col("s_acctbal") > 5000, F.lit("Dr."))
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        T.display_name(F.col("s_name"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))).alias("name"),
        T.titled_first_name(title, F.col("s_name")).alias("vorname"))


@query("p21_fallback_name", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, c_mktsegment) AS name FROM customer""")
def fallback_name(spark, sf):
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", F.coalesce(name, "c_mktsegment").alias("name"))


@query("p22_county_key", "SELECT o_orderkey, (o_orderkey // 1000) * 1000 AS kreis FROM orders")
def county_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.county_key(F.col("o_orderkey")).alias("kreis"))


@query("p23_postal_flag", """
SELECT o_orderkey, substr(CAST(o_orderkey AS VARCHAR), 1, 2) IN ('90', '09', '99') OR
       (CASE WHEN o_orderpriority = '5-LOW' THEN 'Briefwahl' ELSE 'Lokal' END) LIKE '%Briefwahl%' AS briefwahl FROM orders""")
def postal_flag(spark, sf):
    venue = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Briefwahl")).otherwise(F.lit("Lokal"))
    return table(spark, sf, "orders").select(
        "o_orderkey", T.is_postal(F.col("o_orderkey").cast("string"), venue).alias("briefwahl"))


@query("p24_clamp", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE least(p_size, 30) END AS gezaehlt FROM part""")
def clamp(spark, sf):
    limit = F.when(F.col("p_type") != "PROMO", F.lit(30))
    return table(spark, sf, "part").select("p_partkey", M.clamp_to(F.col("p_size"), limit).alias("gezaehlt"))


@query("p25_project_counts", """
SELECT l_orderkey, CAST(sum(CAST(floor(CAST(l_quantity AS BIGINT) * 0.75 :: DOUBLE) AS BIGINT)) AS BIGINT) AS hochgerechnet
FROM lineitem GROUP BY l_orderkey""")
def project_counts(spark, sf):
    scaled = M.project_count(F.col("l_quantity").cast("bigint"), 0.75)
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(scaled).alias("hochgerechnet"))


@query("p26_measure_index", """
SELECT DISTINCT p_brand AS partei, CAST(substr(p_brand, 7) AS INTEGER) AS ballot_pos,
       CAST(17 + CAST(substr(p_brand, 7) AS INTEGER) AS INTEGER) AS idx FROM part""")
def measure_index(spark, sf):
    return column_index(star.feed(spark, sf), T.DIRECT_SUFFIX, star.brand_parties(spark, sf))


@query("f03_extract_and_split", r"""
SELECT c_custkey, nullif(regexp_extract(c_name, '#0*([0-9]+)$', 1), '') AS nummer, split_part(c_name, '#', 1) AS stamm,
       nullif(regexp_extract(c_mktsegment, '^[A-M]+', 0), '') AS anfang, length(c_name) AS laenge,
       lower(c_mktsegment) AS klein, CAST(NULL AS VARCHAR) AS drittes
FROM customer""")
def extract_and_split(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", T.first_match(name, "#0*([0-9]+)$", 1).alias("nummer"), T.piece(name, "#", 1).alias("stamm"),
        T.first_match(F.col("c_mktsegment"), "^[A-M]+").alias("anfang"), F.length(name).cast("bigint").alias("laenge"),
        F.lower("c_mktsegment").alias("klein"), T.piece(name, "#", 3).alias("drittes"))


@query("f08_zero_pad", """
SELECT o_orderkey, CASE WHEN o_custkey < 1000 THEN lpad(CAST(o_custkey AS VARCHAR), 3, '0') ELSE CAST(o_custkey AS VARCHAR) END AS id
FROM orders""")
def zero_pad(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", NUM.zero_pad(F.col("o_custkey"), 3).alias("id"))


@query("f14_parse_and_format_times", """
SELECT event_id, strftime(ts, '%d.%m.%y, %H:%M') || ' Uhr' AS stand,
  (CASE isodow(ts) WHEN 1 THEN 'Montag' WHEN 2 THEN 'Dienstag' WHEN 3 THEN 'Mittwoch' WHEN 4 THEN 'Donnerstag'
   WHEN 5 THEN 'Freitag' WHEN 6 THEN 'Samstag' ELSE 'Sonntag' END) || strftime(ts, ', %d. ') || 'Januar' || strftime(ts, ' %Y, %H:%M') || ' Uhr' AS beginn,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS gelesen,
  strftime(date_trunc('second', ts) - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS vortag,
  date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') AS alter_sekunden,
  strftime(date_trunc('second', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS ortszeit
FROM events""")
def parse_and_format_times(spark, sf):
    ts = F.col("ts")
    banner = F.concat(F.lit("Muster;Stand: "), F.date_format(ts, "dd.MM.yyyy HH:mm:ss"))
    out = table(spark, sf, "events").withColumn("gelesen", T.parse_german_datetime(banner))
    shown = "yyyy-MM-dd HH:mm:ss"
    return out.select(
        "event_id", T.short_german_datetime(ts).alias("stand"), T.german_datetime(ts).alias("beginn"),
        F.date_format("gelesen", shown).alias("gelesen"),
        F.date_format(F.col("gelesen") - F.expr("INTERVAL 1 DAY"), shown).alias("vortag"),
        T.age_seconds(F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), F.col("gelesen")).alias("alter_sekunden"),
        F.date_format(T.to_zone(F.col("gelesen"), "Europe/Berlin"), shown).alias("ortszeit"))


@query("f22_person_names", r"""
SELECT p_partkey, split_part(p_name, ' ', 1) AS nachname,
       CASE WHEN p_size > 25 THEN 'Prof. ' ELSE '' END || split_part(p_name, ' ', 2) AS vorname FROM part""")
def person_names(spark, sf):
    title = F.when(F.col("p_size") > 25, F.lit("Prof. ")).otherwise(F.lit(""))
    before = F.when(F.col("p_type") == "PROMO", F.lit("Nachrückerin: ")).otherwise(F.lit(""))
    full = F.concat(before, title, T.piece(F.col("p_name"), " ", 1), F.lit(", "), T.piece(F.col("p_name"), " ", 2))
    return table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in T.parse_person_name(full).items()])
