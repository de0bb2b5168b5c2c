"""Texts shown with a result, as string expressions over area rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tally.functions.measures import invalid_pct, is_complete, progress_pct, turnout_pct
from tally.functions.numbers import format_de, format_signed_de
from tally.functions.text import german_datetime, short_german_datetime

# --- fixed values: wording of the published texts ------------------------------
RESULT = " - ERGEBNIS"
TREND = " - TREND (bislang ausgezählte Stimmen)"
CAST_VOTES = "Abgegebene Stimmen: "
OF_THESE_INVALID = ", davon ungültig: "
TURNOUT = "Wahlbeteiligung: "
BREAK = "<br><br>"
OTHERS = "Weitere: "
OTHERS_BEFORE = "Sonstige: "
NO_SHARE = ": 0,0%"
DIRECT_TITLE = ": Stimmen fürs Direktmandat"
LIST_TITLE = ": Landesstimmen"
CONSTITUENCY = "Wahlkreis "
ROUNDED = "Prozentzahlen auf Zehntel gerundet; in Klammern: Vergleich zu 2018"
INTRO_CONSTITUENCY_DIRECT = (
    "Erststimmen für die Wahl des Direktkandidaten im Wahlkreis - "
    "die derzeit fünf führenden Kandidatinnen und Kandidaten. "
)
INTRO_CONSTITUENCY_LIST = "Zweitstimmen im Wahlkreis für die Parteien im neuen Landtag. "
INTRO_BEFORE_DIRECT = (
    "Bisher gezählte Stimmanteile für das Direktmandat im Wahlkreis; "
    "fünf erste Kandidierende von der Liste"
)
INTRO_STATE_LIST = (
    "Zweitstimmen für die Parteien landesweit; auf Zehntel gerundet. in Klammern die Stimmanteile "
    "bei der Landtagswahl 2018, soweit vorhanden"
)
BOUNDARY_REMARK = (
    "Der Zuschnitt des Wahlkreises hat sich seit der letzten Landtagswahl verändert. "
    "Ergebnisse 2018 umgerechnet auf den aktuellen Wahlkreiszuschnitt<br><br>"
)
BALLOT_ORDER = "in der Reihenfolge vom Stimmzettel<br><br>"
STATE_BALLOT_ORDER = " Reihenfolge der Parteien wie auf dem Stimmzettel.<br><br>"
COUNT_BEGINS = "Auszählung beginnt am "
COUNT_DONE = "Auszählung beendet, alle "
PRECINCTS_DONE = " Stimmbezirke ausgezählt"
COUNTED = "Ausgezählt sind "
BAR_OPEN = ("<span style='height:24px;display: flex;justify-content: space-around;"
            "align-items: flex-end; width: 100%;'>")
BAR_LABEL = "<span style='width:70px; text-align:center;'>"
BAR_PART = "<span style='width:"
BAR_DONE = "%; background:#002747; height:16px;'></span>"
BAR_OPEN_PART = "%; background:#CCC; height:16px;'></span>"
BAR_CLOSE = "<span style='width:5px;'></span></span><br> von "
BAR_STATUS = " Stimmbezirken - <strong>Stand: "
TEST_OPEN = "<b style='color:#dfedf8;'>TITLE "
TEST_INTRO = "<br><br>INTRO "
TEST_CLOSE = "</b>"
TEST_TITLE = "*** TEST *** - FIKTIVE DATEN wk "
TEST_TITLE_STATE = "*** TEST *** wk0 - FIKTIVE DATEN"
# --------------------------------------------------------------------------------


def share_delta(share: Column, change: Column, comparable: Column | None = None, sign: str = "") -> Column:
    """``42,5 (+10,1)``; ``?`` instead of the change where nothing can be compared.

    ``sign="%"`` puts a percent sign after the share.
    """
    delta = format_signed_de(change, 1)
    if comparable is not None:
        delta = F.when(comparable, delta).otherwise(F.lit("?"))
    return F.concat(format_de(share, 1), F.lit(f"{sign} ("), delta, F.lit(")"))


def state_delta(share: Column, base: Column) -> Column:
    """Change in brackets, ``(.)`` where the present share is 0."""
    return F.when(share == 0, F.lit("(.)")).otherwise(
        F.concat(F.lit("("), format_signed_de(share - base, 1), F.lit(")")))


def progress_html(counted: Column, total: Column, ts: Column) -> Column:
    """Progress bar with counted and total precincts and the time of the snapshot."""
    done = progress_pct(counted, total)
    text = [
        F.lit(COUNTED), F.lit(BAR_OPEN), F.lit(BAR_LABEL), counted.cast("string"), F.lit("</span>"),
        F.lit(BAR_PART), done.cast("string"), F.lit(BAR_DONE),
        F.lit(BAR_PART), (F.lit(100) - done).cast("string"), F.lit(BAR_OPEN_PART),
        F.lit(BAR_CLOSE), total.cast("string"), F.lit(BAR_STATUS), short_german_datetime(ts), F.lit("</strong>"),
    ]
    return F.concat(*text)


def status_note(counted: Column, total: Column, ts: Column, start: Column, *before: Column) -> Column:
    """Count not begun, under way or finished; ``before`` texts come first."""
    finished = F.concat(F.lit(COUNT_DONE), total.cast("string"), F.lit(PRECINCTS_DONE))
    waiting = F.concat(F.lit(COUNT_BEGINS), german_datetime(start))
    state = F.when(ts >= start, F.when(is_complete(counted, total), finished).otherwise(
        progress_html(counted, total, ts))).otherwise(waiting)
    return F.concat(*before, state)


def with_status(title: Column, counted: Column, total: Column) -> Column:
    """Title with a mark for a final result or a trend."""
    return F.concat(title, F.when(is_complete(counted, total), F.lit(RESULT)).otherwise(F.lit(TREND)))


def turnout_text(voters: Column, invalid: Column, eligible: Column, counted: Column, total: Column) -> Column:
    """Votes cast, share of invalid ones and, once all is counted, the turnout (0,0 of nobody)."""
    none = F.lit(0.0)
    turnout = F.concat(F.lit(TURNOUT), format_de(F.coalesce(turnout_pct(voters, eligible), none), 1), F.lit("%"))
    return F.concat(
        F.lit(CAST_VOTES), format_de(voters, 0), F.lit(OF_THESE_INVALID),
        format_de(F.coalesce(invalid_pct(invalid, voters), none), 1), F.lit("%, "),
        F.when(is_complete(counted, total), turnout).otherwise(F.lit("")),
        F.lit(BREAK),
    )


def boundary_remark(changed: Column) -> Column:
    return F.when(changed, F.lit(BOUNDARY_REMARK)).otherwise(F.lit(""))


def test_marking(title: Column, intro: Column, wk: Column, test_mode: bool) -> tuple[Column, Column]:
    """In test mode the title is replaced by a warning and moved into the intro."""
    if not test_mode:
        return title, intro
    marked = F.concat(F.lit(TEST_OPEN), title, F.lit(TEST_INTRO), intro, F.lit(TEST_CLOSE))
    warning = F.when(wk == 0, F.lit(TEST_TITLE_STATE)).otherwise(F.concat(F.lit(TEST_TITLE), wk.cast("string")))
    return warning, marked


def others_text(labels: Column) -> Column:
    """``Weitere: a, b`` before the status note."""
    return F.concat(F.lit(OTHERS), F.coalesce(labels, F.lit("")), F.lit(BREAK))
