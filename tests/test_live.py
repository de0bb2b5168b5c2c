"""Result tables on the small counting night, with known figures."""

import pytest
from fixtures import feed_text
from pyspark.sql import functions as F

from tally.plans import analysis, baseline, dimensions, live, outputs
from tally.plans.cycle import Election, finished, run_cycle
from tally.sources.feed import MAIN_PARTIES
from tally.sources.snapshots import read_snapshot
from tally.streaming.live import run_live

PARTIES = list(MAIN_PARTIES)


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "stand.csv"
    path.write_text(feed_text(), encoding="utf-8")
    return read_snapshot(spark, str(path)).cache()


@pytest.fixture(scope="module")
def candidates(spark):
    people = [(1, p, f"Name{i}") for i, p in enumerate(PARTIES)] + [(2, "CDU", "Solo"), (43, "SPD", "Stadt"), (None, "SPD", "Liste")]
    df = spark.createDataFrame(people, "wk int, partei string, nachname string")
    parties = spark.createDataFrame([(i, p, "#fff") for i, p in enumerate(PARTIES)], "id int, partei string, farbwert string")
    return dimensions.candidate_dimension(df, parties)


@pytest.fixture(scope="module")
def wk_baseline(spark):
    table = spark.createDataFrame(
        [(1, 1000, 500, 480, 20, 200, 100, None), (2, 900, 400, 390, 10, 390, 0, 0)],
        "wk int, wahlberechtigte int, waehler int, gueltig int, ungueltig int, CDU int, SPD int, `GRÜNE` int")
    changed = baseline.changed_constituencies(
        spark.createDataFrame([(1,)], "wk int"), spark.createDataFrame([(1,), (7,)], "wk int"))
    return baseline.baseline_constituency(table, changed, ["CDU", "SPD", "GRÜNE"])


@pytest.fixture(scope="module")
def g_baseline(spark):
    return spark.createDataFrame([("633011", "CDU", 900, 30.0)], "ags string, partei string, stimmen_2018 int, prozent_2018 double")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("633011", "Stadten"), ("633011", "Stadten"), ("413000", "Offen")], "ags string, name string")


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_state(spark, snapshot):
    base = spark.createDataFrame([(0, "CDU", 25.0), (1, "CDU", 99.0)], "wk int, partei string, prozent_2018 double")
    got = by(live.state_list_votes(snapshot, PARTIES, base), "partei")
    assert len(got) == 7 and got["CDU"].prozent == pytest.approx(12250 / 49000 * 100)
    assert got["CDU"].differenz == pytest.approx(12250 / 49000 * 100 - 25)
    assert (got["SPD"].stimmen, got["SPD"].prozent, got["SPD"].differenz) == (0, 0.0, 0.0)


def test_constituency_direct(snapshot, candidates, wk_baseline):
    votes = live.constituency_direct_votes(snapshot, PARTIES, candidates, wk_baseline)
    got = by(votes, "wk", "partei")
    assert len(got) == 8  # seven candidates in the first, one in the second
    shares = {p: round(got[1, p].prozent, 4) for p in PARTIES}
    assert shares == {"SPD": 31.0, "CDU": 22.0, "GRÜNE": 13.0, "AfD": 12.0, "FDP": 6.0, "FREIE WÄHLER": 5.0, "DIE LINKE": 4.0}
    assert got[1, "CDU"].differenz == pytest.approx(220 / 1000 * 100 - 200 / 480 * 100)
    # figures of the area are carried down the ballot to parties without an earlier result
    assert got[1, "FREIE WÄHLER"].gueltig_2018 == 480 and got[1, "FREIE WÄHLER"].veraendert is True
    assert (got[1, "FREIE WÄHLER"].stimmen_2018, got[1, "FREIE WÄHLER"].prozent_2018) == (0, 0.0)
    assert got[2, "CDU"].prozent == 0.0 and got[2, "CDU"].differenz == 0.0 and got[2, "CDU"].veraendert is False
    top = outputs.leading(votes.filter("wk = 1"), ["wk"]).orderBy("rang")
    assert [r.partei for r in top.collect()] == ["SPD", "CDU", "GRÜNE", "AfD", "FDP"]


def test_constituency_list(snapshot, wk_baseline):
    got = by(live.constituency_list_votes(snapshot, PARTIES, wk_baseline), "wk", "partei")
    assert len(got) == 14
    assert [round(got[1, p].prozent, 4) for p in ("CDU", "GRÜNE", "SPD")] == [20.0, 13.9303, 26.8657]
    assert got[2, "SPD"].prozent == 0.0 and got[2, "SPD"].differenz == 0.0 - got[2, "SPD"].prozent_2018
    volatility = by(analysis.volatility_constituency(live.constituency_list_votes(snapshot, PARTIES, wk_baseline)), "wk")
    assert volatility[2].volatilitaet == pytest.approx((abs(400 / 790 * 100 - 100) + 390 / 790 * 100) / 2)


def test_municipality_direct(snapshot, candidates, g_baseline, names):
    votes = live.municipality_direct_votes(snapshot, PARTIES, names, candidates, g_baseline, {"413000": 43})
    got = by(votes, "ags", "partei")
    # the city with several constituencies has no candidates; the one with a single one keeps its SPD candidate
    assert {k[0] for k in got} == {"633011", "413000"} and len(got) == 8
    assert got["633011", "CDU"].g_name == "Stadten" and round(got["633011", "CDU"].prozent, 2) == 42.5
    assert got["633011", "CDU"].differenz == pytest.approx(1870 / 4400 * 100 - 30)
    assert got["413000", "SPD"].wk == 43 and got["413000", "SPD"].stimmen == 0



def test_baseline_rows_of_a_party_in_a_municipality(spark, snapshot, names):
    """Several rows of a party each give one, a party without a name gives none, and nulls stay nulls until they are filled."""
    rows = [("633011", "CDU", 900, 30.0), ("633011", "CDU", 700, None), ("633011", None, 5, 1.0), (None, "CDU", 6, 2.0), ("413000", "SPD", 8, 4.0)]
    earlier = spark.createDataFrame(rows, "ags string, partei string, stimmen_2018 int, prozent_2018 double")
    got = live.municipality_list_votes(snapshot, PARTIES, names.dropDuplicates(["ags"]), earlier).where("ags IS NOT NULL").collect()
    found = sorted((r.ags, r.partei, r.stimmen_2018, r.prozent_2018) for r in got if r.stimmen_2018)
    assert found == [("413000", "SPD", 8, 4.0), ("633011", "CDU", 700, 0.0), ("633011", "CDU", 900, 30.0)], found
    assert len(got) == 3 * len(PARTIES) + 1


def test_municipality_list_keeps_cities(snapshot, g_baseline, names):
    got = live.municipality_list_votes(snapshot, PARTIES, names, g_baseline)
    assert got.select("ags").distinct().count() == 3
    assert got.filter("ags = '611000'").select("g_name").first()[0] is None


def test_postal(snapshot):
    quota = analysis.postal_by_municipality(snapshot, F.substring("Gebietsschlüssel", 4, 6)).first()
    assert (quota.ags, quota.waehler, quota.briefwaehler, quota.briefwahlquote) == ("633011", 100, 40, 40.0)


def test_history_merges_areas(spark, names):
    data = [(1, "633021", 100, 50, 40, 10, 30), (1, "633027", 300, 250, 200, 50, 100), (1, "63302101", 9, 9, 9, 0, 9),
            (None, None, 1000, 600, 580, 20, 400), (1, None, 500, 300, 290, 10, 200)]
    history = spark.createDataFrame(data, "wk int, ags string, wahlberechtigt int, waehler int, gueltig int, ungueltig int, CDU int")
    cross = spark.createDataFrame([("633021", "633030"), ("633027", "633030")], "ags string, new_key string")
    clean = spark.createDataFrame([("633030", "Neustadt", "WK1"), ("633030", "Neustadt", "WK2")], "ags string, name string, wk_name string")
    got = baseline.baseline_municipality(history, cross, clean, ["CDU"]).collect()
    assert len(got) == 1
    assert (got[0].ags, got[0].wk_name, got[0].stimmen_2018, got[0].wahlbeteiligung) == ("633030", "WK1", 130, 75.0)
    assert got[0].prozent_2018 == pytest.approx(130 / 240 * 100) and got[0].ungueltig_prozent == 20.0
    state = baseline.baseline_state(history, ["CDU"]).collect()
    assert [(r.wk, r.stimmen) for r in state] == [(0, 400)]


def test_unknown_area_type_is_rejected(spark):
    areas = spark.createDataFrame([("001", "w"), ("611000", "s"), ("633011", "g")], "id string, typ string")
    names = sorted(r.fname for r in dimensions.build_registry(areas).collect())
    assert names == ["g06611000_landesstimmen", "g06633011_direkt", "g06633011_landesstimmen", "wk001_direkt", "wk001_landesstimmen"]
    with pytest.raises(Exception, match="unknown area type"):
        dimensions.build_registry(spark.createDataFrame([("1", "x")], "id string, typ string")).collect()


def test_composite_takes_originals_where_rebasing_failed(spark):
    rebased = spark.createDataFrame([(1, "100", "60", "60,0", "10", "50", "16", "x", "20"), (34, "•", "•", "•", "•", "•", "•", "•", "•")],
                                    "wk int, wahlberechtigte string, waehler string, wahlbeteiligung string, ungueltig string,"
                                    " gueltig string, ungueltig_prozent string, CDU string, Sonstige string")
    originals = spark.createDataFrame([(34, 200, 0, 20, 80, 50, 10, 20), (1, 9, 9, 9, 9, 9, 9, 9)],
                                      "wk int, wahlberechtigte int, waehler int, ungueltig int, gueltig int, CDU int, LKR int, DiB int")
    keys = spark.createDataFrame([(34,)], "wk int")
    counts = ["wahlberechtigte", "waehler", "wahlbeteiligung", "ungueltig", "gueltig", "ungueltig_prozent", "CDU", "Sonstige"]
    got = by(baseline.composite_baseline(rebased, originals, keys, counts, {"Sonstige": ["LKR", "DiB"]}, True), "wk")
    assert (got[1].CDU, got[1].Sonstige, got[1].wahlbeteiligung) == (None, 20.0, None)  # decimal commas are for the reader
    assert (got[34].waehler, got[34].wahlbeteiligung, got[34].ungueltig_prozent, got[34].Sonstige) == (100.0, 50.0, 20.0, 30.0)


def test_indexes_leave_districts_out(spark):
    df = spark.createDataFrame(
        [("1", "A", 1, "W", "K2", 2, 10, "VF"), ("2", "B", 1, "W", "K1", 2, 30, "KS"), ("2", "B", 1, "W", "K1", 1, 99, "ST"), ("3", "C", 1, "W", "K1", 5, 0, "VF")],
        "ags string, name string, wk int, wk_name string, kreis_name string, flaeche int, bevoelkerung int, Gebietstyp string")
    areas = by(dimensions.municipality_index(df), "ags")
    assert {k: (r.bev_dichte, r.dichte_quintil) for k, r in areas.items()} == {"1": (5.0, 1), "2": (15.0, 2)}
    wk = dimensions.constituency_index(df).first()
    assert (wk.wk, wk.kreise, wk.gemeinden, wk.bevoelkerung, wk.flaeche) == ("001", "K1 K2", 3, 40, 9)
    ids = spark.createDataFrame([("001", "abc", "wk001_direkt")], "id string, chart_id string, fname string")
    named = dimensions.with_chart_ids(dimensions.constituency_index(df), ids, "wk").first()
    assert (named.direkt_id, named.landesstimmen_id) == ("abc", None)


def test_previous_winners(spark):
    sheet = spark.createDataFrame(
        [(1, 1, "Alt 1", "Dr. Maier, Eva", "CDU", 400, 40.0, 100), (2, None, None, "Nachrücker: Groß, Uwe", None, None, None, None),
         (3, 2, "Alt 2", "Weiß, Jo", "SPD", 300, 30.0, 50)],
        "row_pos int, wk int, wk_name string, full_name string, partei string, stimmen int, prozent double, vorsprung int")
    clean = spark.createDataFrame([(1, "Neu 1"), (2, "Neu 2")], "wk int, wk_name string")
    got = by(dimensions.previous_winners(sheet, clean), "row_pos")
    assert (got[1].nachname, got[1].vorname, got[1].ausgeschieden, got[1].zweiter_prozent) == ("Maier", "Dr. Eva", True, 30.0)
    assert (got[2].wk, got[2].wk_name, got[2].partei, got[2].nachruecker, got[2].nachname) == (1, "Neu 1", "CDU", True, "Groß")
    assert got[3].wk_name == "Neu 2"


@pytest.fixture(scope="module")
def night(spark, candidates, wk_baseline, g_baseline, names):
    areas = spark.createDataFrame([("001", "w"), ("002", "w"), ("633011", "g"), ("413000", "g"), ("611000", "s")], "id string, typ string")
    state = spark.createDataFrame([(0, "CDU", 25.0)], "wk int, partei string, prozent_2018 double")
    listed = spark.createDataFrame([(p,) for p in PARTIES], "partei string")
    return Election(PARTIES, PARTIES, ["CDU", "SPD"], ["CDU", "SPD"], candidates, listed, names,
                    dimensions.build_registry(areas), state, wk_baseline, wk_baseline, g_baseline, g_baseline, {"413000": 43})


IMPRINT = outputs.Imprint("Redaktion", "Amt", "https://example.org", "2023-10-08 18:00:00")


def document(folder, table, name):
    return next((folder / "dokumente" / table / f"fname={name}").glob("*.txt")).read_text()


def test_live_run_publishes_newer_snapshots_only(spark, night, tmp_path):
    landing, work = tmp_path / "landing", tmp_path / "work"
    landing.mkdir()

    def arrive(name, stand, counted):
        text = feed_text().replace("20:15:00", stand).replace(";120;3;", f";120;{counted};")
        (landing / name).write_text(text, encoding="utf-8")
        run_live(spark, str(landing), night, str(work), IMPRINT).awaitTermination()
        if (work / "out").exists():
            return document(work / "out", "kreise_direkt", "wk001_direkt")

    assert arrive("a.csv", "17:59:00", 1) is None  # before the count begins
    first = arrive("b.csv", "19:00:00", 12)
    assert ">12</span>" in first and "Stand: 08.10.23, 19:00 Uhr" in first
    assert arrive("c.csv", "18:30:00", 6) == first  # late
    last = arrive("d.csv", "22:00:00", 120)
    assert "ERGEBNIS" in last and "alle 120 Stimmbezirke ausgezählt" in last


def test_analysis_run_writes_all_tables(spark, night, snapshot, tmp_path):
    ts = F.lit("2023-10-08 20:15:00").cast("timestamp_ntz")
    stored = run_cycle(spark, snapshot, night, str(tmp_path / "c"), ts, IMPRINT, area_files=False)
    main = spark.createDataFrame([("CDU", 1), ("SPD", 3)], "partei string, id int")
    out = str(tmp_path / "analysen")
    analysis.run_analysis(stored, snapshot, main, ["CDU", "SPD"], out, F.substring("Gebietsschlüssel", 4, 6))
    assert spark.read.parquet(f"{out}/hochburgen_kreise").select("partei").distinct().count() == 2
    wide = spark.read.parquet(f"{out}/choropleth_alle")
    assert wide.count() == 3 and {"prozent_CDU", "differenz_SPD", "volatilitaet"} <= set(wide.columns)
    assert spark.read.parquet(f"{out}/briefwahl_nach_gemeinde").first().briefwahlquote == 40.0
    assert spark.read.parquet(f"{out}/gewinn_verlust").filter("partei = 'CDU' AND seite = 'oben'").count() == 3


def test_cycle_publishes_every_area(spark, night, snapshot, tmp_path):
    ts = F.lit("2023-10-08 20:15:00").cast("timestamp_ntz")
    stored = run_cycle(spark, snapshot, night, str(tmp_path), ts, IMPRINT)
    assert finished(stored).first() == (200, 96)
    made = {p.parent.name for p in (tmp_path / "tabellen").glob("*/fname=*/*.csv")}
    assert made == {f"fname={n}" for n in (
        "wk001_direkt", "wk002_direkt", "wk001_landesstimmen", "wk002_landesstimmen", "g06633011_direkt", "g06413000_direkt",
        "g06633011_landesstimmen", "g06413000_landesstimmen", "g06611000_landesstimmen")}
    assert {p.parent.name for p in (tmp_path / "dokumente").glob("*/fname=*/*.txt")} == made
    table = next((tmp_path / "tabellen" / "kreise_direkt" / "fname=wk001_direkt").glob("*.csv")).read_text().splitlines()
    assert table[0] == "name,partei,stimmen,prozent" and len(table) == 6
    assert table[1] == 'Name2 (SPD),SPD,310,"31,0% (+10,2)"' and table[3] == 'Name1 (GRÜNE),GRÜNE,130,"13,0% (?)"'
    doc = document(tmp_path, "kreise_direkt", "wk001_direkt")
    assert '"title":["Wahlkreis 1 - Auenkreis I: Stimmen fürs Direktmandat - TREND (bislang ausgezählte Stimmen)"]' in doc
    assert "Weitere: Name6 (FREIE WÄHLER): 5,0% (?), Name5 (DIE LINKE): 4,0% (?)<br><br>Der Zuschnitt" in doc
    doc = document(tmp_path, "gemeinden_direkt", "g06633011_direkt")
    assert "Abgegebene Stimmen: 4.500, davon ungültig: 2,2%, Wahlbeteiligung: 75,0%" in doc
    assert "in der Reihenfolge vom Stimmzettel<br><br>Auszählung beendet, alle 6 Stimmbezirke ausgezählt" in doc


def test_earlier_results_meet_areas_before_these_are_rolled_out(spark):
    """A baseline joined by area gives what a join of the long rows gives, also with repeated and null keys; long rows are not shuffled."""
    from tally.plans import live as L
    from tally.sources.feed import feed_types

    key = "Gebietsschlüssel"
    names = [key, "Gebietsbezeichnung", "Gebietstyp", "Anzahl Wahlbezirke", "Anzahl Wahlbezirke ausgezählt", "Wahlberechtigte", "Wählerinnen und Wähler",
             "Wahlbeteiligung", "gültige Landesstimmen", "ungültige Landesstimmen", "ungültige Landesstimmen (%)", "A Landesstimmen", "B Landesstimmen"]
    assert feed_types(names)
    rows = [("001000001", "x", "VF", 2, 1, 10, 8, 80.0, 8, 0, 0.0, 6, 2), ("001000002", "y", "VF", 2, 1, 10, 8, 80.0, 8, 0, 0.0, None, 8)]
    live = spark.createDataFrame(rows, ", ".join(f"`{n}` {'string' if i < 3 else 'double' if '%' in n or n == 'Wahlbeteiligung' else 'bigint'}" for i, n in enumerate(names)))
    clean = spark.createDataFrame([("000001", "X"), ("000002", "Y")], "ags string, name string")
    base = spark.createDataFrame([("000001", "A", 5, 50.0), ("000001", "A", 6, 60.0), ("000002", "B", 1, 10.0), (None, "A", 9, 9.0), ("000002", None, 9, 9.0)],
                                 "ags string, partei string, stimmen_2018 bigint, prozent_2018 double")
    out = L.municipality_list_votes(live, ["A", "B"], clean, base)
    got = sorted((r.ags, r.partei, r.stimmen, r.stimmen_2018, r.prozent_2018) for r in out.collect())
    assert got == [("000001", "A", 6, 5, 50.0), ("000001", "A", 6, 6, 60.0), ("000001", "B", 2, 0, 0.0), ("000002", "A", 0, 0, 0.0), ("000002", "B", 8, 1, 10.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "Join" not in plan[: plan.index("Generate")]
