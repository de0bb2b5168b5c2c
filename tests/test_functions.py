import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.functions import measures as M
from tally.functions import notes as N
from tally.functions import numbers as NUM
from tally.functions import text as T


def lit(x):
    return F.lit(x)


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_parse_german_numbers(values):
    got = values(*[NUM.parse_de_number(lit(t)) for t in ("1.234,5", "12", " 0,25 ", "-3,0", "NA", "", None)])
    assert got == (1234.5, 12.0, 0.25, -3.0, None, None, None)


def test_whole_numbers_with_decimals(values):
    got = values(*[NUM.parse_de_number(lit(t), "bigint") for t in ("1.234,0", "1.234", "12,5", "NA")])
    assert got == (1234, 1234, None, None)


def test_format_german_numbers(values):
    got = values(NUM.format_de(lit(1234567.25)), NUM.format_de(lit(4500), 0), NUM.format_de(lit(0.25)),
                 NUM.format_de(lit(0.35)), NUM.format_de(lit(None).cast("double")))
    assert got == ("1.234.567,2", "4.500", "0,2", "0,3", None)  # halves go to the even digit of the exact value


def test_signed_german_numbers(values):
    got = values(*[NUM.format_signed_de(lit(x)) for x in (10.1, -3.0, 0.0, 3.2, -0.04)])
    assert got == ("+10,1", "-3,0", "+0,0", "+3,2", "-0,0")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=30))
def test_printed_numbers_parse_back(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    back = df.select("x", NUM.parse_de_number(NUM.format_de(F.col("x"), 2)).alias("y"))
    assert back.filter("x <> y OR y IS NULL").count() == 0


def test_zero_pad_keeps_long_numbers(values):
    assert values(NUM.zero_pad(lit(7), 3), NUM.zero_pad(lit(1234), 3)) == ("007", "1234")


def test_plain_numbers_only(values):
    got = values(*[NUM.numeric_or_null(lit(t)) for t in ("42", "4.5", ".5", "1e3", "-1", "x1")])
    assert got == (42.0, 4.5, 0.5, None, None, None)


def test_sentinels(values):
    got = values(*[NUM.sentinel_to_null(lit(t), "•", "x") for t in ("•", "a • b", "x", "xx", "5", None)])
    assert got == (None, None, None, "xx", "5", None)


@pytest.mark.parametrize("votes,total,want", [(310, 1240, 25.0), (0, 0, 0.0), (0, 5, 0.0), (3, 0, None), (None, 5, None)])
def test_share(values, votes, total, want):
    got = values(M.share_pct(lit(votes).cast("bigint"), lit(total).cast("bigint")))[0]
    assert got == pytest.approx(want) if want is not None else got is None


def test_change(values):
    got = values(M.diff_pp(lit(0.0), lit(5.0)), M.diff_pp(lit(0.0), lit(5.0), guard=False), M.diff_pp(lit(7.5), lit(5.0)))
    assert got == (0.0, -5.0, 2.5)


def test_clamp_and_progress(values):
    null = lit(None).cast("bigint")
    got = values(M.clamp_to(lit(7), lit(5)), M.clamp_to(lit(3), lit(5)), M.clamp_to(lit(3), null), M.clamp_to(null, lit(3)),
                 M.progress_pct(lit(2), lit(3)), M.progress_pct(lit(2), lit(0)), M.project_count(lit(7), 0.5))
    assert got == (5, 3, None, None, 66, None, 3)


def test_runner_up(values):
    cols = M.runner_up(lit(400), lit(40.0), lit(100))
    assert values(*cols.values()) == (1000.0, 300, 30.0)


def test_labels_and_keys(values):
    got = values(T.strip_label(lit("KLIMALISTE WÄHLERL. Landesstimmen"), T.LIST_SUFFIX),
                 T.strip_label(lit("SPD"), T.LIST_SUFFIX), T.strip_position(lit("CDU...12")),
                 *T.split_area_key(lit("00543101600")).values(), T.county_key(lit(431022)),
                 T.override_key(lit(0), lit("413000"), {"413000": 43}), T.override_key(lit(0), lit("x"), {"413000": 43}))
    assert got == ("KLIMALISTE WÄHLERL.", "SPD", "CDU", 5, "431016", 431000, 43, 0)


def test_no_match_is_null(values):
    got = values(T.first_match(lit("abc"), "[0-9]+"), T.piece(lit("a, b"), ", ", 2), T.piece(lit("a"), ", ", 2))
    assert got == (None, "b", None)


def test_postal_flag_is_three_valued(values):
    null = lit(None).cast("string")
    got = values(T.is_postal(lit("9012"), null), T.is_postal(lit("0900"), lit("Schule")), T.is_postal(lit("1200"), lit("Briefwahl 3")),
                 T.is_postal(lit("1200"), lit("Schule")), T.is_postal(lit("1200"), null))
    assert got == (True, True, True, False, None)


@pytest.mark.parametrize("full,want", [
    ("Müller-Groß, Anna", ("Müller-Groß", "Anna")),
    ("Prof. Dr. Weiß, Jörg", ("Weiß", "Prof. Jörg")),
    ("Nachrückerin: Dr. Özel, Eva", ("Özel", "Dr. Eva")),
    ("Nachrücker: Bär, Uwe", ("Bär", "Uwe")),
    ("Allein", ("Allein", None)),
])
def test_person_names(values, full, want):
    assert values(*T.parse_person_name(lit(full)).values()) == want


def test_names_skip_missing_titles(values):
    null = lit(None).cast("string")
    got = values(T.display_name(lit("Heitland"), lit("CDU")), T.titled_first_name(null, lit("Eva")),
                 T.titled_first_name(lit("Dr."), lit("Eva")))
    assert got == ("Heitland (CDU)", "Eva", "Dr. Eva")


def test_german_times(values):
    when = ts("2023-10-08 18:05:00")
    got = values(T.german_datetime(when), T.short_german_datetime(when), T.parse_german_datetime(lit("08.10.2023 18:05:00")),
                 T.parse_german_datetime(lit("kein Datum")), T.age_seconds(ts("2023-10-08 18:07:30"), when),
                 T.to_zone(when, "Europe/Berlin"))
    assert got == ("Sonntag, 08. Oktober 2023, 18:05 Uhr", "08.10.23, 18:05 Uhr", dt.datetime(2023, 10, 8, 18, 5),
                   None, 150, dt.datetime(2023, 10, 8, 20, 5))


def test_published_share_with_change(values):
    got = values(N.share_delta(lit(1870 / 4400 * 100), lit(10.1)), N.share_delta(lit(42.46), lit(10.1), lit(False), "%"),
                 N.state_delta(lit(0.0), lit(3.0)), N.state_delta(lit(5.2), lit(8.5)))
    assert got == ("42,5 (+10,1)", "42,5% (?)", "(.)", "(-3,3)")


def test_status_note_states(values):
    start, total = ts("2023-10-08 18:00:00"), lit(6)
    before, counting, done = values(
        N.status_note(lit(0), total, ts("2023-10-07 12:00:00"), start),
        N.status_note(lit(2), total, ts("2023-10-08 19:30:00"), start, lit("x<br>")),
        N.status_note(lit(6), total, ts("2023-10-08 22:00:00"), start))
    assert before == "Auszählung beginnt am Sonntag, 08. Oktober 2023, 18:00 Uhr"
    assert done == "Auszählung beendet, alle 6 Stimmbezirke ausgezählt"
    assert counting.startswith("x<br>Ausgezählt sind <span") and "width:33%;" in counting and "width:67%;" in counting
    assert counting.endswith("von 6 Stimmbezirken - <strong>Stand: 08.10.23, 19:30 Uhr</strong>")


def test_turnout_text(values):
    args = [lit(4500), lit(100), lit(6000)]
    full, part, none = values(N.turnout_text(*args, lit(6), lit(6)), N.turnout_text(*args, lit(5), lit(6)),
                              N.turnout_text(lit(0), lit(0), lit(10), lit(0), lit(1)))
    assert full == "Abgegebene Stimmen: 4.500, davon ungültig: 2,2%, Wahlbeteiligung: 75,0%<br><br>"
    assert part == "Abgegebene Stimmen: 4.500, davon ungültig: 2,2%, <br><br>"
    assert none == "Abgegebene Stimmen: 0, davon ungültig: 0,0%, <br><br>"


def test_test_mode_moves_the_title(values):
    assert values(N.test_marking(lit("T"), lit("I"), lit(0), True)[0]) == ("*** TEST *** wk0 - FIKTIVE DATEN",)
    assert values(*N.test_marking(lit("T"), lit("I"), lit(5), False)) == ("T", "I")
    title, intro = N.test_marking(lit("T"), lit("I"), lit(5), True)
    assert values(title, intro) == ("*** TEST *** - FIKTIVE DATEN wk 5", "<b style='color:#dfedf8;'>TITLE T<br><br>INTRO I</b>")
