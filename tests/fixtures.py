"""A small counting night: one state row, two constituencies, three municipalities, five precincts."""

from __future__ import annotations

from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.sources.feed import PARTIES, feed_columns

BANNER = "Muster;Stand: 08.10.2023 20:15:00"
COLUMNS = feed_columns()


def row(key, name, kind, **cells):
    values = {"Gebietsschlüssel": key, "Gebietsbezeichnung": name, "Gebietstyp": kind, **cells}
    return ";".join(str(values.get(c, "")) for c in COLUMNS)


def votes(suffix, **by_party):
    return {p + suffix: v for p, v in zip(PARTIES, by_party.pop("main")) if v is not None}


def totals(suffix, valid, invalid, share):
    return {"gültige" + suffix: valid, "ungültige" + suffix: invalid, "ungültige" + suffix + " (%)": share}


def progress(total, counted, eligible, voters, **more):
    return {"Anzahl Wahlbezirke": total, "Anzahl Wahlbezirke ausgezählt": counted, "Wahlberechtigte": eligible,
            "Wählerinnen und Wähler": voters, "Wahlbeteiligung": more.pop("turnout", ""), **more}


def feed_text():
    """The feed as text. All names and figures are invented."""
    lines = [BANNER, ";".join(COLUMNS)]
    lines.append(row("00000000000", "Land", "LD", **progress(200, 96, "4.000.000", "50.000", turnout="1,2"),
                     **totals(LIST_SUFFIX, "49.000", "1.000", "2,0"), **votes(LIST_SUFFIX, main=["12.250", "9.800", None])))
    lines.append(row("00100000000", "Auenkreis I", "WK", **progress(120, 3, "80.000", "1.030", turnout="1,29"),
                     **totals(DIRECT_SUFFIX, "1.000", 30, "2,91"), **totals(LIST_SUFFIX, "1.005", 25, "2,43"),
                     **votes(DIRECT_SUFFIX, main=[220, 130, 310, 120, 60, 40, 50]),
                     **votes(LIST_SUFFIX, main=[201, 140, 270, 120, 70, 45, 35])))
    lines.append(row("00200000000", "Auenkreis II", "WK", **progress(80, 80, 1000, 800),
                     **totals(DIRECT_SUFFIX, 0, 800, 100), **totals(LIST_SUFFIX, 790, 10, "1,25"),
                     **votes(DIRECT_SUFFIX, main=[0, "NA"]), **votes(LIST_SUFFIX, main=[400, 390])))
    lines.append(row("00163301100", "Altenfurt, Stadt", "VF", **progress(6, 6, 6000, 4500, freigegeben=1),
                     **totals(DIRECT_SUFFIX, 4400, 100, "2,2"), **votes(DIRECT_SUFFIX, main=[1870, 790, 630, 650, 230, 85, 145])))
    lines.append(row("00041300000", "Offenstadt", "KS", **progress(10, 4, 900, 500, freigegeben=0),
                     **totals(DIRECT_SUFFIX, 490, 10, 2), **votes(DIRECT_SUFFIX, main=[245, 245])))
    lines.append(row("00061100000", "Vielstadt", "KS", **progress(30, 1, 9000, 100, freigegeben=0),
                     **totals(DIRECT_SUFFIX, 99, 1, 1), **votes(DIRECT_SUFFIX, main=[99])))
    for number, venue, voters in (("0001", "Schule", 60), ("9001", "Rathaus", 30), ("0002", "Briefwahl 1", 10), ("0003", "Schule", "")):
        lines.append(row("00163301100", "Altenfurt, Stadt", "SB", Wahlbezirksnummer=number, Wahllokal=venue,
                         **progress(1, 1, 100, voters), **totals(DIRECT_SUFFIX, 1, 2, 1), **totals(LIST_SUFFIX, 1, 3, 1)))
    return "\n".join(lines) + "\n"
