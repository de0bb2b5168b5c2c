"""Analyses, published texts and tables, projection."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tally.catalog import live as V
from tally.catalog.live import OVERRIDES
from tally.catalog.registry import FEED_SQL, query
from tally.functions import notes as N
from tally.functions.numbers import zero_pad
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.operators.cleaning import tick
from tally.operators.reshape import unpivot_measures
from tally.plans import analysis as A
from tally.plans import dimensions as D
from tally.plans import outputs as O
from tally.plans import projection as P
from tally.plans import star
from tally.plans.cycle import Election, run_cycle
from tally.plans.star import BASE_BRANDS, BASE_TYPES, BRANDS, KEY_SHAPE, TYPES, table
from tally.session import shared_folder, store, together

MAIN = TYPES[:4]
SNAPSHOT = "2023-10-08 20:15:00"
IMPRINT = O.Imprint(byline="Redaktion", source_name="Wahlamt", source_url="https://example.org/wahl",
                    start="2023-10-08 18:00:00")
BEFORE = O.Imprint(byline="Redaktion", source_name="Wahlamt", source_url="https://example.org/wahl",
                   start="2023-10-15 18:00:00", test_mode=True)


def snapshot_time():
    return F.lit(SNAPSHOT).cast("timestamp_ntz")


def type_parties(spark, sf):
    """The main list parties with an id."""
    types = table(spark, sf, "part").select(F.col("p_type").alias("partei")).distinct()
    position = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("partei")).cast("int")
    return types.select("partei", position.alias("id")).filter(F.col("id") <= len(MAIN))


def municipality_results(spark, sf):
    """Stored, as the rankings read it from both ends."""
    votes = V.municipality_list_votes(spark, sf)
    return store(A.party_results(votes, type_parties(spark, sf), ["ags", "g_name", "wk"]), "results")


# --- analyses ---

_MAIN_RESULTS = V.MUNICIPALITY_LIST_SQL + """,
m AS (SELECT ags, g_name, wk, wahlbeteiligung, partei, prozent, differenz FROM ergebnis
      WHERE partei IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO'))"""


def _extremes_sql(value: str, key: str, n: int) -> str:
    return f""",
h AS (SELECT *, row_number() OVER (PARTITION BY partei ORDER BY {value} DESC NULLS LAST, {key}) AS r FROM m),
t AS (SELECT *, row_number() OVER (PARTITION BY partei ORDER BY {value} ASC NULLS LAST, {key}) AS r FROM m),
x AS (SELECT * EXCLUDE r, CAST(r AS INTEGER) AS rang, 'oben' AS seite, CAST(r AS INTEGER) AS zeile FROM h WHERE r <= {n}
      UNION ALL SELECT * EXCLUDE r, CAST(r AS INTEGER), 'unten', CAST({2 * n + 1} - r AS INTEGER) FROM t WHERE r <= {n})"""


@query("l16_strongholds", _MAIN_RESULTS + _extremes_sql("prozent", "ags", 5) + " SELECT * FROM x")
def strongholds(spark, sf):
    return A.strongholds(municipality_results(spark, sf), "ags")


@query("l16_gains_losses", _MAIN_RESULTS + _extremes_sql("differenz", "ags", 3) + """
SELECT x.*, CAST(pos AS INTEGER) AS id FROM x JOIN types USING (partei)""")
def gains_losses(spark, sf):
    return A.gains_losses(municipality_results(spark, sf), "ags", type_parties(spark, sf))


@query("l16_constituency_strongholds", V.LIST_SQL + """,
m AS (SELECT wk, wk_name, wahlbeteiligung, partei, prozent, differenz FROM ergebnis
      WHERE partei IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO'))""" + _extremes_sql("prozent", "wk", 5) + " SELECT * FROM x")
def constituency_strongholds(spark, sf):
    votes = V.constituency_list_votes(spark, sf)
    return A.strongholds(store(A.party_results(votes, type_parties(spark, sf), ["wk", "wk_name"]), "results"), "wk")


_VOLATILITY = "round(sum(abs({d})) / 2, 6) AS volatilitaet"


@query("l16_volatility_municipality", V.MUNICIPALITY_LIST_SQL + f"""
SELECT ags, max(g_name) AS g_name, max(wahlbeteiligung) AS wahlbeteiligung, {_VOLATILITY.format(d='differenz')} FROM ergebnis GROUP BY ags""")
def volatility_municipality(spark, sf):
    out = A.volatility_municipality(V.municipality_list_votes(spark, sf))
    return out.withColumn("volatilitaet", F.round("volatilitaet", 6))


@query("l16_volatility_constituency", V.LIST_SQL + f"""
SELECT wk, max(wk_name) AS wk_name, max(wahlbeteiligung) AS wahlbeteiligung, {_VOLATILITY.format(d='prozent - prozent_2018')} FROM ergebnis GROUP BY wk""")
def volatility_constituency(spark, sf):
    out = A.volatility_constituency(V.constituency_list_votes(spark, sf))
    return out.withColumn("volatilitaet", F.round("volatilitaet", 6))


_WIDE = ", ".join(f"max(CASE WHEN partei = '{t}' THEN {v} END) AS \"{v}_{t}\"" for v in ("prozent", "differenz") for t in MAIN)


@query("l16_choropleth_wide", _MAIN_RESULTS + f""",
vol AS (SELECT ags, {_VOLATILITY.format(d='differenz')} FROM ergebnis GROUP BY ags)
SELECT '06' || ags AS ags, g_name, wk, wahlbeteiligung, volatilitaet, {_WIDE} FROM m JOIN vol USING (ags) GROUP BY ALL""")
def choropleth_wide(spark, sf):
    votes = store(V.municipality_list_votes(spark, sf), "long")
    results = A.party_results(votes, type_parties(spark, sf), ["ags", "g_name", "wk"])
    volatility = A.volatility_municipality(votes).withColumn("volatilitaet", F.round("volatilitaet", 6))
    return A.choropleth_wide(results, volatility, MAIN)


# --- published tables ---

_DE = "replace(printf('%.1f', {x}), '.', ',')"
_SIGNED = "(CASE WHEN {x} < 0 THEN '-' ELSE '+' END || replace(printf('%.1f', abs({x})), '.', ','))"


def _delta(known, sign: str = "", change: str = "differenz") -> str:
    signed = _SIGNED.format(x=change)
    if known is not None:
        signed = f"CASE WHEN partei IN {V._in(known)} THEN {signed} ELSE '?' END"
    return f"{_DE.format(x='prozent')} || '{sign} (' || {signed} || ')'"


def registry(spark, sf):
    """Output names of all nations and customers; cities with one constituency count as municipalities."""
    nations = table(spark, sf, "nation").select(zero_pad(F.col("n_nationkey") + 1, 3).alias("id"), F.lit("w").alias("typ"))
    own = zero_pad(F.col("c_custkey") + 1, KEY_SHAPE[1])
    city = (F.col("c_mktsegment") == star.CITY_SEGMENT) & ~own.isin(*OVERRIDES)
    customers = table(spark, sf, "customer").select(
        own.alias("id"), F.when(city, F.lit("s")).otherwise(F.lit("g")).alias("typ"))
    return D.build_registry(nations.unionByName(customers))


_CITY = f"seg = '{star.CITY_SEGMENT}' AND own NOT IN {V._in(OVERRIDES)}"


@query("m09_output_registry", FEED_SQL + f"""
SELECT id, typ, kind, CASE WHEN typ = 'w' THEN 'wk' ELSE 'g06' END || id || '_' || kind AS fname FROM (
  SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS id, 'w' AS typ FROM nation
  UNION ALL SELECT own, CASE WHEN {_CITY} THEN 's' ELSE 'g' END FROM cust) AS a,
  (VALUES ('direkt'), ('landesstimmen')) AS k(kind) WHERE typ <> 's' OR kind = 'landesstimmen'""")
def output_registry(spark, sf):
    return registry(spark, sf)


@query("l17_constituency_direct_tables", V.DIRECT_SQL + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY wk ORDER BY prozent DESC NULLS LAST, ballot_pos) AS n FROM ergebnis)
SELECT 'wk' || lpad(CAST(wk AS VARCHAR), 3, '0') || '_direkt' AS fname, CAST(n AS INTEGER) AS zeile, name, partei, stimmen,
       {_delta(BASE_BRANDS, '%')} AS prozent FROM r WHERE n <= 5""")
def constituency_direct_tables(spark, sf):
    return O.constituency_direct_tables(V.constituency_direct_votes(spark, sf), registry(spark, sf), BASE_BRANDS)


@query("l17_constituency_list_tables", V.LIST_SQL + f"""
SELECT 'wk' || lpad(CAST(wk AS VARCHAR), 3, '0') || '_landesstimmen' AS fname, ballot_pos AS zeile, partei, stimmen, wk,
       {_delta(BASE_TYPES, change='(prozent - prozent_2018)')} AS prozent FROM ergebnis WHERE partei IN {V._in(MAIN)}""")
def constituency_list_tables(spark, sf):
    return O.list_tables(V.constituency_list_votes(spark, sf), registry(spark, sf), type_parties(spark, sf), "wk", ["w"],
                         BASE_TYPES, None)


@query("l17_municipality_direct_tables", V.MUNICIPALITY_DIRECT_SQL + f"""
SELECT 'g06' || ags || '_direkt' AS fname, ballot_pos AS zeile, name, partei, stimmen, {_delta(None)} AS prozent FROM ergebnis""")
def municipality_direct_tables(spark, sf):
    return O.municipality_direct_tables(V.municipality_direct_votes(spark, sf), registry(spark, sf))


@query("l17_municipality_list_tables", V.MUNICIPALITY_LIST_SQL + f"""
SELECT 'g06' || ags || '_landesstimmen' AS fname, ballot_pos AS zeile, partei, stimmen, wk, {_delta(None)} AS prozent
FROM ergebnis WHERE partei IN {V._in(MAIN)}""")
def municipality_list_tables(spark, sf):
    return O.list_tables(V.municipality_list_votes(spark, sf), registry(spark, sf), type_parties(spark, sf), "ags", ["g", "s"])


@query("l17_state_table", V.STATE_LIST_SQL + f"""
SELECT ballot_pos AS zeile, partei, prozent, CASE WHEN prozent = 0 THEN '(.)' ELSE '(' || {_SIGNED.format(x='(prozent - prozent_2018)')} || ')' END AS plusminus
FROM ergebnis""")
def state_table(spark, sf):
    return O.state_table(V.state_list_votes(spark, sf))


# --- published texts ---



def _turnout_sql() -> str:
    return (f"'{N.CAST_VOTES}' || replace(format('{{:,}}', waehler), ',', '.') || '{N.OF_THESE_INVALID}' || "
            f"{_DE.format(x='coalesce(CAST(ungueltig AS DOUBLE) / nullif(waehler, 0) * 100, 0.0)')} || '%, ' || "
            f"CASE WHEN gezaehlt = stimmbezirke THEN '{N.TURNOUT}' || {_DE.format(x='coalesce(CAST(waehler AS DOUBLE) / nullif(wahlberechtigt, 0) * 100, 0.0)')} || '%' ELSE '' END || '{N.BREAK}'")


def _status_sql() -> str:
    done = "CAST(floor(CAST(gezaehlt AS DOUBLE) / stimmbezirke * 100) AS BIGINT)"
    q = lambda t: "'" + t.replace("'", "''") + "'"
    bar = " || ".join([
        q(N.COUNTED), q(N.BAR_OPEN), q(N.BAR_LABEL), "gezaehlt", q("</span>"), q(N.BAR_PART), done, q(N.BAR_DONE),
        q(N.BAR_PART), f"(100 - {done})", q(N.BAR_OPEN_PART), q(N.BAR_CLOSE), "stimmbezirke", q(N.BAR_STATUS),
        q("08.10.23, 20:15 Uhr"), q("</strong>")])
    return f"CASE WHEN gezaehlt = stimmbezirke THEN '{N.COUNT_DONE}' || stimmbezirke || '{N.PRECINCTS_DONE}' ELSE {bar} END"


def _mark_sql() -> str:
    return f"CASE WHEN gezaehlt = stimmbezirke THEN '{N.RESULT}' ELSE '{N.TREND}' END"


_FIGURES = ", ".join(f"max({c}) AS {c}" for c in O.FIGURES)
_REMARK = f"CASE WHEN veraendert THEN '{N.BOUNDARY_REMARK}' ELSE '' END"


@query("l17_constituency_direct_texts", V.DIRECT_SQL + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY wk ORDER BY prozent DESC NULLS LAST, ballot_pos) AS n FROM ergebnis),
w AS (SELECT wk, string_agg(name || ': ' || {_delta(BASE_BRANDS, '%')}, ', ' ORDER BY n) AS weitere FROM r WHERE n > 5 GROUP BY wk),
a AS (SELECT wk, max(wk_name) AS wk_name, max(veraendert) AS veraendert, {_FIGURES} FROM ergebnis GROUP BY wk)
SELECT wk, '{N.CONSTITUENCY}' || wk || ' - ' || wk_name || '{N.DIRECT_TITLE}' || {_mark_sql()} AS title,
       {_turnout_sql()} || '{N.INTRO_CONSTITUENCY_DIRECT + N.ROUNDED}' AS intro,
       '{N.OTHERS}' || coalesce(weitere, '') || '{N.BREAK}' || {_REMARK} || {_status_sql()} AS notes
FROM a LEFT JOIN w USING (wk)""")
def constituency_direct_texts(spark, sf):
    texts = O.constituency_direct_texts(V.constituency_direct_votes(spark, sf), BASE_BRANDS, snapshot_time(), IMPRINT)
    return texts.select("wk", "title", "intro", "notes")


_DOCUMENT = """'{"title":["' || title || '"],"describe":{"intro":["' || intro || '"],"byline":["Redaktion"],"source-name":["Wahlamt"],"source-url":["https://example.org/wahl"]},"annotate":{"notes":["' || notes || '"]}}'"""


@query("l17_constituency_list_documents", V.LIST_SQL + f""",
a AS (SELECT wk, max(wk_name) AS wk_name, max(veraendert) AS veraendert, {_FIGURES} FROM ergebnis GROUP BY wk),
x AS (SELECT wk, '{N.CONSTITUENCY}' || wk || ' - ' || wk_name || '{N.LIST_TITLE}' || {_mark_sql()} AS title,
       {_turnout_sql()} || '{N.INTRO_CONSTITUENCY_LIST + N.ROUNDED}' AS intro,
       '{N.BALLOT_ORDER}' || {_REMARK} || {_status_sql()} AS notes FROM a)
SELECT wk, {_DOCUMENT} AS document FROM x""")
def constituency_list_documents(spark, sf):
    texts = O.constituency_list_texts(V.constituency_list_votes(spark, sf), snapshot_time(), IMPRINT)
    return O.documents(texts, IMPRINT).select("wk", "document")


@query("l17_municipality_list_documents", V.MUNICIPALITY_LIST_SQL + f""",
a AS (SELECT ags, max(wk) AS wk, coalesce(max(g_name), ags) AS g_name, {_FIGURES} FROM ergebnis GROUP BY ags),
x AS (SELECT ags, g_name || '{N.LIST_TITLE}' || {_mark_sql()} AS title,
       {_turnout_sql()} || 'Zweitstimmen in ' || g_name || ', alle Wahllisten. {N.ROUNDED}' AS intro,
       '{N.BALLOT_ORDER}' || {_status_sql()} AS notes FROM a)
SELECT ags, {_DOCUMENT} AS document FROM x""")
def municipality_list_documents(spark, sf):
    texts = O.municipality_list_texts(V.municipality_list_votes(spark, sf), snapshot_time(), IMPRINT)
    return O.documents(texts, IMPRINT).select("ags", "document")


@query("l17_municipality_direct_texts", V.MUNICIPALITY_DIRECT_SQL + f""",
a AS (SELECT ags, max(wk) AS wk, coalesce(max(g_name), ags) AS g_name, {_FIGURES} FROM ergebnis GROUP BY ags)
SELECT ags, '{N.TEST_TITLE}' || wk AS title,
       '{N.TEST_OPEN.replace("'", "''")}' || g_name || '{N.DIRECT_TITLE}' || {_mark_sql()} || '{N.TEST_INTRO}' || {_turnout_sql()} ||
       'Erststimmen in ' || g_name || ' für die Direktkandidaten im Wahlkreis ' || wk || '. {N.ROUNDED}{N.TEST_CLOSE}' AS intro,
       '{N.BALLOT_ORDER}{N.COUNT_BEGINS}Sonntag, 15. Oktober 2023, 18:00 Uhr' AS notes FROM a""")
def municipality_direct_texts(spark, sf):
    """In test mode, at a time before the count begins."""
    texts = O.municipality_direct_texts(V.municipality_direct_votes(spark, sf), snapshot_time(), BEFORE)
    return texts.select("ags", "title", "intro", "notes")


@query("l17_state_texts", V.STATE_LIST_SQL + f""",
a AS (SELECT wk, {_FIGURES} FROM ergebnis GROUP BY wk)
SELECT 'Land{N.LIST_TITLE}' || {_mark_sql()} AS title, {_turnout_sql()} || '{N.INTRO_STATE_LIST}' AS intro,
       '{N.STATE_BALLOT_ORDER}' || {_status_sql()} AS notes FROM a""")
def state_texts(spark, sf):
    return O.state_list_texts(V.state_list_votes(spark, sf), snapshot_time(), IMPRINT).select("title", "intro", "notes")


@query("l17_placeholder_candidates", FEED_SQL + V.CANDIDATE_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY wk ORDER BY CAST(substr(partei, 7) AS INTEGER), name) AS r FROM kandidat)
SELECT 'wk' || lpad(CAST(wk AS VARCHAR), 3, '0') || '_direkt' AS fname, CAST(r AS INTEGER) AS zeile, name, 0.0 :: DOUBLE AS prozent
FROM r WHERE r <= 5""")
def placeholder_candidates(spark, sf):
    return O.placeholder_direct(V.candidates(spark, sf), registry(spark, sf))


@query("l17_placeholder_lists", FEED_SQL + """
SELECT 'g06' || own || '_landesstimmen' AS fname, nk + 1 AS wk, partei, 0 AS stimmen, '0,0% (+0)' AS prozent
FROM cust CROSS JOIN types WHERE pos <= 4""")
def placeholder_lists(spark, sf):
    areas = table(spark, sf, "customer").select(
        zero_pad(F.col("c_custkey") + 1, KEY_SHAPE[1]).alias("ags"), (F.col("c_nationkey") + 1).alias("wk"))
    return O.placeholder_lists(areas, type_parties(spark, sf), registry(spark, sf))


@query("l17_placeholder_texts", FEED_SQL + V.CANDIDATE_SQL + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY wk ORDER BY CAST(substr(partei, 7) AS INTEGER), name) AS r FROM kandidat),
t AS (SELECT wk, coalesce(string_agg(name || '{N.NO_SHARE}', ', ' ORDER BY r) FILTER (WHERE r > 5), '') AS rest FROM r GROUP BY wk)
SELECT wk, '{N.CONSTITUENCY}' || wk || ' - NATION_' || (wk - 1) || '{N.DIRECT_TITLE}' AS title, '{N.INTRO_BEFORE_DIRECT}' AS intro,
       CASE WHEN rest <> '' THEN '{N.OTHERS_BEFORE}' ELSE '' END || rest || '{N.BREAK}{N.COUNT_BEGINS}Sonntag, 08. Oktober 2023, 18:00 Uhr' AS notes FROM t""")
def placeholder_texts(spark, sf):
    people = V.candidates(spark, sf).withColumn(
        "wk_name", F.concat(F.lit("NATION_"), (F.col("wk") - 1).cast("string")))
    return O.placeholder_direct_texts(people, IMPRINT)


@query("m08_result_links", """
SELECT wk, wk_name, 'https://example.org/wahlkreis-wk' || lpad(CAST(wk AS VARCHAR), 3, '0') || '-ergebnis-100.html' AS url
FROM (SELECT n_nationkey + 1 AS wk, n_name AS wk_name FROM nation) AS n""")
def result_links(spark, sf):
    areas = table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("wk"), F.col("n_name").alias("wk_name"))
    return D.result_links(areas, "wk", "https://example.org/", "wahlkreis-wk", 3)


# --- a whole cycle ---


def election(spark, sf, then=None) -> Election:
    """Dimensions and baselines of the derived feed, stored once as for a counting night; ``then`` are the earlier counts if they are stored already."""
    then = store(star.area_counts(spark, sf, present=False), "then") if then is None else then
    kept = {
        "candidates": V.candidates(spark, sf), "listed": type_parties(spark, sf),
        "names": star.municipality_names(spark, sf), "registry": registry(spark, sf),
        "state_baseline": V.state_baseline(spark, sf, then),
        "constituency_direct_baseline": V.direct_baseline(spark, sf, then),
        "constituency_list_baseline": V.list_baseline(spark, sf, then),
        "municipality_direct_baseline": V.municipality_baseline(spark, sf, DIRECT_SUFFIX, BRANDS, then),
        "municipality_list_baseline": V.municipality_baseline(spark, sf, LIST_SUFFIX, TYPES, then),
    }
    return Election(BRANDS, TYPES, BASE_BRANDS, BASE_TYPES, overrides=OVERRIDES, shape=KEY_SHAPE,
                    **dict(zip(kept, together([partial(store, t, k) for k, t in kept.items()]))))


@query("e01_snapshot_cycle", V.MUNICIPALITY_LIST_SQL + f"""
SELECT 'g06' || ags || '_landesstimmen' AS fname, ballot_pos AS zeile, partei, stimmen, wk, {_delta(None)} AS prozent
FROM ergebnis WHERE partei IN {V._in(MAIN)}""")
def snapshot_cycle(spark, sf):
    """The whole cycle; shown are the published list-vote rows of all municipalities and cities."""
    folder = shared_folder(spark, "cycle")
    run_cycle(spark, star.feed(spark, sf), election(spark, sf), folder, snapshot_time(), IMPRINT, area_files=False)
    return spark.read.parquet(f"{folder}/tabellen/gemeinden_landesstimmen")


# --- projection ---

FACTOR = 0.6


def _scaled_sql() -> str:
    fl = lambda x: f"CAST(floor({x} * {FACTOR} :: DOUBLE) AS BIGINT)"
    parts = [(b, "d", DIRECT_SUFFIX) for b in BRANDS] + [(t, "l", LIST_SUFFIX) for t in TYPES]
    votes = ", ".join(f"sum(CASE WHEN kind = '{k}' AND partei = '{p}' THEN {fl('st')} END) AS \"{p}{s}\"" for p, k, s in parts)
    names = [f'"{p}{s}"' for p, _, s in parts]
    counts = ['"Anzahl Wahlbezirke ausgezählt"', '"Wahlberechtigte"', '"Wählerinnen und Wähler"',
              '"Wählerinnen und Wähler mit Wahlschein"', '"ungültige Wahlkreisstimmen"', '"gültige Wahlkreisstimmen"',
              '"ungültige Landesstimmen"', '"gültige Landesstimmen"', *names]
    return FEED_SQL + f""",
sv AS (SELECT key, {votes} FROM votes0 GROUP BY key),
f AS (SELECT p.key AS "Gebietsschlüssel", p.name AS "Gebietsbezeichnung", p.typ AS "Gebietstyp", p.stimmbezirke AS "Anzahl Wahlbezirke",
   {fl('p.stimmbezirke')} AS "Anzahl Wahlbezirke ausgezählt", e.wahlberechtigt AS "Wahlberechtigte", {fl('e.waehler')} AS "Wählerinnen und Wähler",
   {fl('(e.waehler // 10)')} AS "Wählerinnen und Wähler mit Wahlschein",
   {fl('e.ungueltig_d')} AS "ungültige Wahlkreisstimmen", {fl('e.waehler')} - {fl('e.ungueltig_d')} AS "gültige Wahlkreisstimmen",
   {fl('e.ungueltig_l')} AS "ungültige Landesstimmen", {fl('e.waehler')} - {fl('e.ungueltig_l')} AS "gültige Landesstimmen",
   {", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)}
 FROM prec p LEFT JOIN area0 e USING (key) LEFT JOIN sv USING (key) WHERE p.typ <> 'LD'),
ld AS (SELECT '000000000000000' AS "Gebietsschlüssel", 'LAND' AS "Gebietsbezeichnung", 'LD' AS "Gebietstyp",
   CAST(sum("Anzahl Wahlbezirke") AS BIGINT) AS "Anzahl Wahlbezirke", {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in counts)}
 FROM f WHERE "Gebietstyp" = 'WK'),
u AS (SELECT * FROM f UNION ALL BY NAME SELECT * FROM ld)
SELECT *, CAST("Wählerinnen und Wähler" AS DOUBLE) / nullif("Wahlberechtigte", 0) * 100 AS "Wahlbeteiligung" FROM u"""


@query("l18_scaled_snapshot", _scaled_sql())
def scaled_snapshot(spark, sf):
    key = "Gebietsschlüssel"
    template = store(star.feed(spark, sf).select(key, "Gebietsbezeichnung", "Gebietstyp", P.TOTAL, F.col(key).alias("area")), "template")
    then = store(star.area_counts(spark, sf, present=False).withColumn("area", F.col(key)), "then")
    totals = then.select(
        "area", F.col("wahlberechtigt").alias("wahlberechtigte_2018"), F.col("waehler").alias("waehler_2018"),
        F.expr("waehler div 10").alias("wahlschein_2018"), F.col("ungueltig_d").alias("ungueltig_2018"),
        F.col("ungueltig_l").alias("ungueltig_l_2018"))

    def votes(suffix, parties):
        wide = then.selectExpr("area", *[f"{tick(p + suffix)} AS {tick(p)}" for p in parties])
        return unpivot_measures(wide, ["area"], parties, value="stimmen_2018", position=None)

    def level(*types):
        return P.scaled_areas(template.filter(F.col("Gebietstyp").isin(*types)), "area", totals,
                              votes(DIRECT_SUFFIX, BRANDS), votes(LIST_SUFFIX, TYPES), BRANDS, TYPES, FACTOR)

    state = template.filter(F.col("Gebietstyp") == "LD")
    return P.scaled_snapshot(state, level("WK"), level("VF", "KS"))
