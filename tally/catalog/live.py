"""Result tables of a snapshot, baselines and dimension tables, on the feed of the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.catalog.registry import FEED_SQL, query
from tally.functions.numbers import zero_pad
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.operators.joins import union_all
from tally.plans import baseline as B
from tally.plans import dimensions as D
from tally.plans import live as L
from tally.plans import star
from tally.plans.star import BASE_BRANDS, BASE_TYPES, BRANDS, KEY_SHAPE, TYPES, table
from tally.session import store

#: Municipality keys counted with one constituency, and two that were merged into a third.
OVERRIDES = {"000000000012": 5, "000000000040": 7}
MERGED = {"000000000021": "000000000030", "000000000027": "000000000030"}

# --- SQL building blocks ---


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def long_sql(kind: str, levels) -> str:
    """CTEs ``lang``/``anteil``: area x party with votes and share."""
    parties = "brands" if kind == "d" else "types"
    return f""",
lang AS (
  SELECT a.key AS area_key, a.name, a.typ, CAST(substr(a.key, 1, 3) AS INTEGER) AS wk, substr(a.key, 4) AS ags,
         stimmbezirke, gezaehlt, coalesce(wahlberechtigt, 0) AS wahlberechtigt, coalesce(waehler, 0) AS waehler,
         coalesce(CAST(waehler AS DOUBLE) / nullif(wahlberechtigt, 0) * 100, 0.0) AS wahlbeteiligung,
         coalesce(gueltig_{kind}, 0) AS gueltig, coalesce(ungueltig_{kind}, 0) AS ungueltig,
         coalesce(CAST(ungueltig_{kind} AS DOUBLE) / nullif(waehler, 0) * 100, 0.0) AS ungueltig_prozent,
         p.partei, p.pos AS ballot_pos, coalesce(v.st, 0) AS stimmen
  FROM area a CROSS JOIN {parties} p LEFT JOIN votes v ON v.key = a.key AND v.kind = '{kind}' AND v.partei = p.partei
  WHERE a.typ IN {_in(levels)}),
anteil AS (SELECT *, CASE WHEN stimmen = 0 THEN 0.0 ELSE CAST(stimmen AS DOUBLE) / nullif(gueltig, 0) * 100 END AS prozent FROM lang)"""


def base_sql(kind: str) -> str:
    """CTE ``basis``: earlier constituency results."""
    parties, listed = ("brands", BASE_BRANDS) if kind == "d" else ("types", BASE_TYPES)
    return f""",
basis AS (
  SELECT n_nationkey + 1 AS wk, wahlberechtigt AS wahlberechtigte_2018, waehler AS waehler_2018,
         gueltig_{kind} AS gueltig_2018, ungueltig_{kind} AS ungueltig_2018, n_regionkey IN (0, 1) AS veraendert,
         p.partei, v.st AS stimmen_2018, CAST(v.st AS DOUBLE) / nullif(gueltig_{kind}, 0) * 1000 / 10 AS prozent_2018
  FROM area0 a JOIN nation ON a.typ = 'WK' AND CAST(substr(a.key, 1, 3) AS INTEGER) = n_nationkey + 1
  CROSS JOIN {parties} p LEFT JOIN votes0 v ON v.key = a.key AND v.kind = '{kind}' AND v.partei = p.partei
  WHERE p.partei IN {_in(listed)})"""


CANDIDATE_SQL = """,
kandidat AS (
  SELECT s_nationkey + 1 AS wk, 'Brand#' || m AS partei, s_name AS nachname, s_suppkey, s_acctbal,
         s_name || ' (Brand#' || m || ')' AS name
  FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey, m ORDER BY s_suppkey) AS n
        FROM (SELECT *, s_suppkey * 7 % 25 + 1 AS m FROM supplier) AS s0) AS s WHERE n = 1)"""

NAME_SQL = """,
namen AS (SELECT DISTINCT own AS ags, upper(c_name) AS name, 'NATION_' || nk AS wk_name FROM cust WHERE c_acctbal >= 0)"""


def municipality_base_sql(kind: str) -> str:
    """CTE ``gbasis``: earlier municipality results, merged areas summed."""
    parties = "brands" if kind == "d" else "types"
    mapped = "CASE " + " ".join(f"WHEN substr(key, 4) = '{a}' THEN '{b}'" for a, b in MERGED.items()) + " ELSE substr(key, 4) END"
    return f""",
gsumme AS (
  SELECT {mapped} AS ags, min(CAST(substr(key, 1, 3) AS INTEGER)) AS wk, CAST(sum(wahlberechtigt) AS BIGINT) AS wahlberechtigt,
         CAST(sum(waehler) AS BIGINT) AS waehler, CAST(sum(gueltig_{kind}) AS BIGINT) AS gueltig,
         CAST(sum(ungueltig_{kind}) AS BIGINT) AS ungueltig
  FROM area0 WHERE typ IN ('VF', 'KS') GROUP BY 1),
gstimmen AS (
  SELECT {mapped} AS ags, partei, CAST(sum(st) AS BIGINT) AS stimmen_2018
  FROM votes0 JOIN area0 USING (key) WHERE kind = '{kind}' AND typ IN ('VF', 'KS') GROUP BY 1, 2),
gbasis AS (
  SELECT g.*, p.partei, s.stimmen_2018, CAST(s.stimmen_2018 AS DOUBLE) / nullif(g.gueltig, 0) * 1000 / 10 AS prozent_2018
  FROM gsumme g CROSS JOIN {parties} p LEFT JOIN gstimmen s ON s.ags = g.ags AND s.partei = p.partei)"""


FIGURES = """stimmbezirke, gezaehlt, wahlberechtigt, waehler, wahlbeteiligung, gueltig, ungueltig, ungueltig_prozent,
  partei, ballot_pos, stimmen, prozent"""
_CARRIED = ",\n".join(
    f"  last_value({c} IGNORE NULLS) OVER (PARTITION BY wk ORDER BY ballot_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in L.AREA_BASELINE)
_OVERRIDE = "CASE " + " ".join(f"WHEN ags = '{k}' THEN {v}" for k, v in OVERRIDES.items()) + " ELSE wk END"

STATE_LIST_SQL = FEED_SQL + long_sql("l", ["LD"]) + """,
lbasis AS (SELECT partei, CAST(st AS DOUBLE) / gueltig_l * 1000 / 10 AS prozent_2018
           FROM area0 JOIN votes0 USING (key) WHERE typ = 'LD' AND kind = 'l' AND partei IN """ + _in(BASE_TYPES) + f"""),
ergebnis AS (
  SELECT area_key, name AS wk_name, wk, {FIGURES}, coalesce(prozent_2018, 0.0) AS prozent_2018,
         CASE WHEN prozent = 0 THEN 0.0 ELSE prozent - coalesce(prozent_2018, 0.0) END AS differenz
  FROM anteil LEFT JOIN lbasis USING (partei))"""

DIRECT_SQL = FEED_SQL + long_sql("d", ["WK"]) + base_sql("d") + CANDIDATE_SQL + f""",
verbunden AS (SELECT * FROM anteil JOIN (SELECT wk, partei, nachname, name AS kname FROM kandidat) AS k USING (wk, partei) LEFT JOIN basis USING (wk, partei)),
ergebnis AS (
  SELECT area_key, name AS wk_name, wk, {FIGURES}, nachname, kname AS name,
{_CARRIED},
  coalesce(stimmen_2018, 0) AS stimmen_2018, coalesce(prozent_2018, 0.0) AS prozent_2018,
  CASE WHEN prozent = 0 THEN 0.0 ELSE prozent - coalesce(prozent_2018, 0.0) END AS differenz FROM verbunden)"""

LIST_SQL = FEED_SQL + long_sql("l", ["WK"]) + base_sql("l") + f""",
ergebnis AS (
  SELECT area_key, name AS wk_name, wk, {FIGURES},
{_CARRIED},
  coalesce(stimmen_2018, 0) AS stimmen_2018, coalesce(prozent_2018, 0.0) AS prozent_2018,
  prozent - coalesce(prozent_2018, 0.0) AS differenz FROM anteil LEFT JOIN basis USING (wk, partei))"""


def _municipality_sql(kind: str) -> str:
    candidates = "JOIN (SELECT wk, partei, nachname, name FROM kandidat) AS k USING (wk, partei)" if kind == "d" else ""
    extra = "nachname, k.name," if kind == "d" else ""
    return FEED_SQL + long_sql("d" if kind == "d" else "l", ["VF", "KS"]) + CANDIDATE_SQL + NAME_SQL + municipality_base_sql(kind) + f""",
korrigiert AS (SELECT * REPLACE ({_OVERRIDE} AS wk) FROM anteil),
ergebnis AS (
  SELECT area_key, n.name AS g_name, wk, a.ags, {FIGURES.replace("partei", "a.partei")}, {extra}
         coalesce(b.stimmen_2018, 0) AS stimmen_2018, coalesce(b.prozent_2018, 0.0) AS prozent_2018,
         CASE WHEN prozent = 0 THEN 0.0 ELSE prozent - coalesce(b.prozent_2018, 0.0) END AS differenz
  FROM korrigiert a {candidates} LEFT JOIN namen n ON n.ags = a.ags
  LEFT JOIN (SELECT ags, partei, stimmen_2018, prozent_2018 FROM gbasis) AS b ON b.ags = a.ags AND b.partei = a.partei)"""


MUNICIPALITY_DIRECT_SQL = _municipality_sql("d")
MUNICIPALITY_LIST_SQL = _municipality_sql("l")
RESULT = " SELECT * FROM ergebnis"

# --- inputs shared by the queries ---


def direct_baseline(spark, sf, areas=None):
    changed = B.changed_constituencies(star.gained(spark, sf), star.lost(spark, sf))
    return B.baseline_constituency(star.composite(spark, sf, DIRECT_SUFFIX, areas), changed, BASE_BRANDS)


def state_baseline(spark, sf, areas=None):
    return B.baseline_state(star.history(spark, sf, LIST_SUFFIX, areas), BASE_TYPES).select(
        "wk", "partei", F.col("prozent").alias("prozent_2018"))


def list_baseline(spark, sf, areas=None):
    changed = B.changed_constituencies(star.gained(spark, sf), star.lost(spark, sf))
    return B.baseline_constituency(star.composite(spark, sf, LIST_SUFFIX, areas), changed, BASE_TYPES)


def crosswalk(spark):
    return spark.createDataFrame(list(MERGED.items()), "ags string, new_key string")


def municipality_baseline(spark, sf, suffix, parties, areas=None):
    return B.baseline_municipality(star.history(spark, sf, suffix, areas), crosswalk(spark),
                                   star.municipality_names(spark, sf), parties, KEY_SHAPE[1])


def candidates(spark, sf):
    return D.candidate_dimension(star.people(spark, sf), star.brand_parties(spark, sf))


# --- result tables ---


@query("l01_state_list_votes", STATE_LIST_SQL + RESULT)
def state_list_votes(spark, sf):
    return L.state_list_votes(star.feed(spark, sf), TYPES, state_baseline(spark, sf), KEY_SHAPE)


@query("l02_constituency_direct_votes", DIRECT_SQL + RESULT)
def constituency_direct_votes(spark, sf):
    return L.constituency_direct_votes(star.feed(spark, sf), BRANDS, candidates(spark, sf),
                                       direct_baseline(spark, sf), KEY_SHAPE)


@query("l03_constituency_list_votes", LIST_SQL + RESULT)
def constituency_list_votes(spark, sf):
    return L.constituency_list_votes(star.feed(spark, sf), TYPES, list_baseline(spark, sf), KEY_SHAPE)


@query("l04_municipality_direct_votes", MUNICIPALITY_DIRECT_SQL + RESULT)
def municipality_direct_votes(spark, sf):
    return L.municipality_direct_votes(
        star.feed(spark, sf), BRANDS, star.municipality_names(spark, sf), store(candidates(spark, sf), "candidates"),
        municipality_baseline(spark, sf, DIRECT_SUFFIX, BRANDS), OVERRIDES, KEY_SHAPE)


@query("l05_municipality_list_votes", MUNICIPALITY_LIST_SQL + RESULT)
def municipality_list_votes(spark, sf):
    return L.municipality_list_votes(
        star.feed(spark, sf), TYPES, star.municipality_names(spark, sf),
        municipality_baseline(spark, sf, LIST_SUFFIX, TYPES), OVERRIDES, KEY_SHAPE)


@query("t01_leading_candidates", DIRECT_SQL + """
SELECT wk, wk_name, name, partei, stimmen, prozent, CAST(n AS INTEGER) AS rang FROM (
  SELECT *, row_number() OVER (PARTITION BY wk ORDER BY prozent DESC, ballot_pos) AS n FROM ergebnis) AS e WHERE n <= 5""")
def leading_candidates(spark, sf):
    from tally.plans.outputs import leading

    return leading(constituency_direct_votes(spark, sf), ["wk"]).select(
        "wk", "wk_name", "name", "partei", "stimmen", "prozent", "rang")


# --- baselines ---


@query("l06_baseline_constituency_direct", FEED_SQL + base_sql("d") + " SELECT * FROM basis")
def baseline_constituency_direct(spark, sf):
    return direct_baseline(spark, sf)


@query("l06_baseline_constituency_list", FEED_SQL + base_sql("l") + " SELECT * FROM basis")
def baseline_constituency_list(spark, sf):
    return list_baseline(spark, sf)


_G_RESULT = """
SELECT b.ags, n.name, n.wk_name, wk, wahlberechtigt, waehler, gueltig, ungueltig,
       CAST(waehler AS DOUBLE) / nullif(wahlberechtigt, 0) * 100 AS wahlbeteiligung,
       CAST(ungueltig AS DOUBLE) / nullif(waehler, 0) * 100 AS ungueltig_prozent, partei, stimmen_2018, prozent_2018
FROM gbasis b LEFT JOIN namen n ON n.ags = b.ags"""


@query("l07_baseline_municipality_direct", FEED_SQL + NAME_SQL + municipality_base_sql("d") + _G_RESULT)
def baseline_municipality_direct(spark, sf):
    return municipality_baseline(spark, sf, DIRECT_SUFFIX, BRANDS)


@query("l07_baseline_municipality_list", FEED_SQL + NAME_SQL + municipality_base_sql("l") + _G_RESULT)
def baseline_municipality_list(spark, sf):
    return municipality_baseline(spark, sf, LIST_SUFFIX, TYPES)


@query("l07_baseline_state", FEED_SQL + """
SELECT 0 AS wk, wahlberechtigt, waehler, gueltig_l AS gueltig, ungueltig_l AS ungueltig,
       CAST(waehler AS DOUBLE) / wahlberechtigt * 100 AS wahlbeteiligung, CAST(ungueltig_l AS DOUBLE) / waehler * 100 AS ungueltig_prozent,
       partei, st AS stimmen, CAST(st AS DOUBLE) / gueltig_l * 1000 / 10 AS prozent
FROM area0 JOIN votes0 USING (key) WHERE typ = 'LD' AND kind = 'l'""")
def baseline_state(spark, sf):
    return B.baseline_state(star.history(spark, sf, LIST_SUFFIX), TYPES)


_COUNTS = ["wahlberechtigte", "waehler", "wahlbeteiligung", "gueltig", "ungueltig", "ungueltig_prozent",
           "ECONOMY", "LARGE", "MEDIUM", "PROMO", "Sonstige"]


@query("l09_composite_baseline", FEED_SQL + """,
w AS (SELECT key, """ + ", ".join(f"sum(CASE WHEN partei = '{t}' THEN st END) AS \"{t}\"" for t in TYPES) + """
      FROM votes0 WHERE kind = 'l' GROUP BY key)
SELECT CAST(substr(key, 1, 3) AS INTEGER) AS wk, name AS wk_name, CAST(wahlberechtigt AS DOUBLE) AS wahlberechtigte,
       CAST(waehler AS DOUBLE) AS waehler, CAST(waehler AS DOUBLE) / wahlberechtigt * 100 AS wahlbeteiligung,
       CAST(gueltig_l AS DOUBLE) AS gueltig, CAST(ungueltig_l AS DOUBLE) AS ungueltig,
       CAST(ungueltig_l AS DOUBLE) / waehler * 100 AS ungueltig_prozent,
       CAST("ECONOMY" AS DOUBLE) AS "ECONOMY", CAST("LARGE" AS DOUBLE) AS "LARGE", CAST("MEDIUM" AS DOUBLE) AS "MEDIUM",
       CASE WHEN substr(key, 1, 3) NOT IN ('003', '004') AND CAST("PROMO" AS BIGINT) % 2 = 0 THEN NULL ELSE CAST("PROMO" AS DOUBLE) END AS "PROMO",
       CAST("SMALL" + "STANDARD" AS DOUBLE) AS "Sonstige"
FROM area0 JOIN w USING (key) WHERE typ = 'WK'""")
def composite_baseline(spark, sf):
    """The re-based sheet is text: a header row per constituency, then its figures, with markers."""
    then = star.composite(spark, sf, LIST_SUFFIX).withColumnRenamed("gebiet", "wk_name").drop("ags", "Gebietstyp")
    figures = then.withColumns({
        "Sonstige": F.col("SMALL") + F.col("STANDARD"),
        "wahlbeteiligung": F.col("waehler") / F.col("wahlberechtigte") * 100,
        "ungueltig_prozent": F.col("ungueltig") / F.col("waehler") * 100,
    })
    blocked = F.col("wk").isin(3, 4)
    cells = {c: F.when(blocked, F.lit("• •")).otherwise(F.col(c).cast("string")) for c in _COUNTS}
    cells["PROMO"] = F.when(~blocked & (F.col("PROMO") % 2 == 0), F.lit("x")).otherwise(cells["PROMO"])
    text = figures.select("wk", "wk_name", *[v.alias(k) for k, v in cells.items()])
    none = F.lit(None)
    header = text.select((F.col("wk") * 2).alias("row_pos"), "wk", "wk_name", none.cast("string").alias("wahl"),
                         *[none.cast("string").alias(c) for c in _COUNTS])
    detail = text.select((F.col("wk") * 2 + 1).alias("row_pos"), none.cast("int").alias("wk"),
                         none.cast("string").alias("wk_name"), F.lit("L").alias("wahl"), *_COUNTS)
    sheet = B.filled_sheet(header.unionByName(detail), ["wk", "wk_name"], "wahl")
    keys = table(spark, sf, "nation").selectExpr("n_nationkey + 1 AS wk").filter("wk IN (3, 4)")
    return B.composite_baseline(sheet.drop("row_pos", "wahl"), then, keys, _COUNTS, {"Sonstige": ["SMALL", "STANDARD"]})


# --- dimensions ---


@query("l08_candidate_dimension", FEED_SQL + CANDIDATE_SQL + """
SELECT wk, partei, nachname, s_suppkey, s_acctbal, CAST(substr(partei, 7) AS INTEGER) AS p_id, name FROM kandidat""")
def candidate_dimension(spark, sf):
    return candidates(spark, sf)


_DENSE = """WITH c AS (
  SELECT lpad(CAST(c_custkey + 1 AS VARCHAR), 12, '0') AS ags, c_name AS name, c_nationkey + 1 AS wk, 'NATION_' || c_nationkey AS wk_name,
         c_mktsegment AS kreis_name, CAST(c_custkey % 97 + 1 AS BIGINT) AS flaeche, CAST(round(c_acctbal * 100) AS BIGINT) AS bevoelkerung FROM customer)"""


def municipalities(spark, sf):
    return table(spark, sf, "customer").select(
        zero_pad(F.col("c_custkey") + 1, 12).alias("ags"), F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 1).alias("wk"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("wk_name"),
        F.col("c_mktsegment").alias("kreis_name"), (F.col("c_custkey") % 97 + 1).alias("flaeche"),
        star.cents(F.col("c_acctbal")).alias("bevoelkerung"))


@query("l11_municipality_index", _DENSE + """,
d AS (SELECT *, CAST(bevoelkerung AS DOUBLE) / flaeche AS bev_dichte FROM c WHERE bevoelkerung > 0)
SELECT *, CAST(ntile(5) OVER (ORDER BY bev_dichte, ags, wk) AS INTEGER) AS dichte_quintil FROM d""")
def municipality_index(spark, sf):
    return D.municipality_index(municipalities(spark, sf))


@query("l11_constituency_index", _DENSE + """,
d AS (SELECT lpad(CAST(wk AS VARCHAR), 3, '0') AS wk, min(wk_name) AS wk_name, string_agg(DISTINCT kreis_name, ' ' ORDER BY kreis_name) AS kreise,
             count(*) AS gemeinden, CAST(sum(bevoelkerung) AS BIGINT) AS bevoelkerung, CAST(sum(flaeche) AS BIGINT) AS flaeche,
             CAST(sum(bevoelkerung) AS DOUBLE) / CAST(sum(flaeche) AS BIGINT) AS bev_dichte FROM c GROUP BY c.wk)
SELECT *, CAST(ntile(5) OVER (ORDER BY bev_dichte, wk) AS INTEGER) AS dichte_quintil FROM d""")
def constituency_index(spark, sf):
    return D.constituency_index(municipalities(spark, sf))


_SHEET = r"""WITH s AS (
  SELECT p_partkey AS row_pos, CASE WHEN p_type <> 'PROMO' THEN p_partkey END AS wk, p_type = 'PROMO' AS nachruecker,
         CASE WHEN p_type <> 'PROMO' THEN p_size * 100 END AS stimmen, CASE WHEN p_type <> 'PROMO' THEN 30.0 + CAST(p_size AS DOUBLE) / 2 END AS prozent,
         CASE WHEN p_type <> 'PROMO' THEN p_size END AS vorsprung, p_brand AS partei, p_name FROM part),
f AS (SELECT row_pos, nachruecker, coalesce(lead(nachruecker) OVER w, lag(lead_n) OVER w) AS ausgeschieden, partei,
       coalesce(wk, lag(wk) OVER w) AS wk, coalesce(stimmen, lag(stimmen) OVER w) AS stimmen, coalesce(prozent, lag(prozent) OVER w) AS prozent,
       coalesce(vorsprung, lag(vorsprung) OVER w) AS vorsprung, split_part(p_name, ' ', 1) AS nachname, split_part(p_name, ' ', 2) AS vorname
  FROM (SELECT *, lead(nachruecker) OVER (ORDER BY row_pos) AS lead_n FROM s) AS s2 WINDOW w AS (ORDER BY row_pos))"""


def winner_sheet(spark, sf):
    """A sheet of winners; parts of type PROMO play successors, with the winner's cells empty."""
    successor = F.col("p_type") == "PROMO"
    name = F.concat(F.when(successor, F.lit("Nachrücker: ")).otherwise(F.lit("")),
                    F.regexp_replace("p_name", " ", ", "))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_pos"),
        F.when(~successor, F.col("p_partkey")).alias("wk"),
        F.lit(None).cast("string").alias("wk_name"),
        name.alias("full_name"), F.col("p_brand").alias("partei"),
        F.when(~successor, F.col("p_size") * 100).alias("stimmen"),
        F.when(~successor, F.lit(30.0) + F.col("p_size") / 2).alias("prozent"),
        F.when(~successor, F.col("p_size")).alias("vorsprung"))


@query("l12_previous_winners", _SHEET + """
SELECT row_pos, f.wk, p_brand AS wk_name, partei, stimmen, prozent, vorsprung, nachruecker, ausgeschieden,
       CAST(stimmen AS DOUBLE) / prozent * 100 AS gueltig, stimmen - vorsprung AS zweiter_stimmen,
       CAST(stimmen - vorsprung AS DOUBLE) / (CAST(stimmen AS DOUBLE) / prozent * 100) * 100 AS zweiter_prozent, nachname, vorname
FROM f LEFT JOIN part ON p_partkey = f.wk""")
def previous_winners(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("wk"), F.col("p_brand").alias("wk_name"))
    return D.previous_winners(winner_sheet(spark, sf), names).drop("full_name")


@query("l13_boundary_changes", """
WITH m AS (SELECT c_nationkey + 1 AS wk, CASE WHEN c_mktsegment = 'BUILDING' THEN (c_nationkey + 3) % 25 + 1 END AS wk_alt,
                  coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, 'Teil von ' || c_name) AS gebiet FROM customer)
SELECT 'neu' AS art, wk, 'NATION_' || (wk - 1) AS wk_name, gebiet FROM m WHERE wk_alt IS NOT NULL
UNION ALL SELECT 'ab', wk_alt, 'NATION_' || (wk_alt - 1), gebiet FROM m WHERE wk_alt IS NOT NULL""")
def boundary_changes(spark, sf):
    areas = table(spark, sf, "customer").select(
        (F.col("c_nationkey") + 1).alias("wk"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("wk_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", (F.col("c_nationkey") + 3) % 25 + 1).alias("wk_alt"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.concat(F.lit("Teil von "), "c_name").alias("stadtteilname"))
    names = table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("wk"), F.col("n_name").alias("wk_name"))
    gains, losses = D.boundary_changes(areas, names)
    return union_all(gains.select(F.lit("neu").alias("art"), "wk", "wk_name", F.col("neu_dazu").alias("gebiet")),
                     losses.select(F.lit("ab").alias("art"), "wk", "wk_name", F.col("abgegeben").alias("gebiet")))


@query("l14_candidate_sheet", FEED_SQL + CANDIDATE_SQL + """,
k AS (SELECT *, 'NATION_' || (wk - 1) AS wk_name, row_number() OVER (PARTITION BY wk ORDER BY s_suppkey) AS n FROM kandidat),
sieger AS (SELECT wk, partei, nachname, n FROM k WHERE n = 1 OR s_acctbal < 2000)
SELECT k.wk, k.wk_name, k.partei, k.nachname, CASE WHEN s_acctbal > 5000 THEN 'Dr. Erika' ELSE 'Erika' END AS vorname,
       'Beruf' AS beruf, 1970 AS geboren, 'Ort' AS geburtsort, CASE WHEN s_acctbal > 0 THEN 'https://example.org/k/' || s_suppkey END AS link,
       CAST(substr(k.partei, 7) AS INTEGER) AS id, 'Max' AS sieger_vorname, s.nachname AS sieger_nachname, s.partei AS sieger_partei,
       40.5 :: DOUBLE AS sieger_prozent, 100 AS sieger_vorsprung,
       CASE WHEN r.wk IS NOT NULL THEN 'Max' END AS nachruecker_vorname, r.nachname AS nachruecker_nachname
FROM k LEFT JOIN sieger s ON s.wk = k.wk AND s.n = 1 LEFT JOIN sieger r ON r.wk = k.wk AND r.n > 1""")
def candidate_sheet(spark, sf):
    """The first candidate of a nation plays the earlier winner, those with little money successors."""
    base = star.people(spark, sf)
    people = base.select(
        "wk", F.concat(F.lit("NATION_"), (F.col("wk") - 1).cast("string")).alias("wk_name"), "partei", "nachname",
        F.when(F.col("s_acctbal") > 5000, F.lit("Dr.")).alias("titel"), F.lit("Erika").alias("vorname"),
        F.lit("Beruf").alias("beruf"), F.lit(1970).alias("geboren"), F.lit("Ort").alias("geburtsort"),
        F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("check_id"))
    first = base.groupBy("wk").agg(F.min("s_suppkey").alias("erster"))
    successor = F.col("s_suppkey") != F.col("erster")
    winners = base.join(first, "wk").filter(~successor | (F.col("s_acctbal") < 2000)).select(
        "wk", "partei", "nachname", successor.alias("nachruecker"), F.lit("Max").alias("vorname"),
        F.lit(40.5).alias("prozent"), F.lit(100).alias("vorsprung"))
    return D.candidate_sheet(people, star.brand_parties(spark, sf), winners, "https://example.org/k/")


@query("l15_party_lists", """
WITH x AS (SELECT 1)""" + CANDIDATE_SQL + """
SELECT DISTINCT p_brand AS partei, CAST(substr(p_brand, 7) AS INTEGER) AS id FROM part
WHERE p_brand IN (SELECT partei FROM kandidat WHERE s_acctbal > 5000)""")
def party_lists(spark, sf):
    listed = star.people(spark, sf).withColumn("listenplatz", F.when(F.col("s_acctbal") > 5000, F.col("s_suppkey")))
    return D.party_lists(star.brand_parties(spark, sf), listed)


@query("l15_unmatched_municipalities", """
SELECT c_custkey AS ags, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'F')""")
def unmatched_municipalities(spark, sf):
    known = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("ags"))
    return D.unmatched_municipalities(table(spark, sf, "customer").select(F.col("c_custkey").alias("ags"), "c_name"), known)
