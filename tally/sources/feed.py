"""The snapshot feed: its header, its column types and its parties."""

from __future__ import annotations

from collections.abc import Sequence

from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX

# --- fixed values: header of the feed and parties in ballot order -------------
KEY = "Gebietsschlüssel"
IDENTITY = (KEY, "Gebietsbezeichnung", "Gebietstyp", "Wahlbezirksnummer", "Wahllokal")
TURNOUT = (
    "Wahlberechtigte",
    "Wahlberechtigte ohne Sperrvermerk",
    "Wahlberechtigte mit Sperrvermerk",
    "Wahlberechtigte nach §12a(2) LWO",
    "Wählerinnen und Wähler",
    "Wählerinnen und Wähler mit Wahlschein",
    "Wahlbeteiligung",
    "Berechnungsmethode",
)
INVALID, VALID, PERCENT = "ungültige", "gültige", " (%)"
WINNER = (
    "Wahlkreis gewonnen: Name",
    "Wahlkreis gewonnen: Vorname",
    "Wahlkreis gewonnen: Titel",
    "Wahlkreis gewonnen: Wahlvorschlag",
)
PROGRESS = (
    "Anzahl Wahlbezirke",
    "Anzahl Wahlbezirke ausgezählt",
    "Letzte Änderung",
    "freigegeben",
    "Nummer aufnehmender Wahlbezirk",
    "Name aufnehmender Wahlbezirk",
    "Aufnahme Wahlbezirk",
)
PARTIES = (
    "CDU", "GRÜNE", "SPD", "AfD", "FDP", "DIE LINKE", "FREIE WÄHLER", "Tierschutzpartei", "Die PARTEI",
    "PIRATEN", "ÖDP", "Verjüngungsforschung", "V-Partei³", "PdH", "ABG", "APPD", "dieBasis", "DKP",
    "DIE NEUE MITTE", "Volt", "KLIMALISTE WÄHLERL.", "Bündnis C", "WDMR", "BUNDESPA. KLIMALISTE", "MERA25",
    "NEV", "PP", "SGV", "Solibew",
)
MAIN_PARTIES = PARTIES[:7]
STATE, CONSTITUENCY, MUNICIPALITY, CITY, PRECINCT = "LD", "WK", "VF", "KS", "SB"
TEXT_COLUMNS = IDENTITY + ("Berechnungsmethode", "Letzte Änderung",
                           "Nummer aufnehmender Wahlbezirk", "Name aufnehmender Wahlbezirk") + WINNER
DOUBLE_COLUMNS = ("Wahlbeteiligung", "freigegeben", "Aufnahme Wahlbezirk")
# ------------------------------------------------------------------------------


def feed_columns(direct: Sequence[str] = PARTIES, lists: Sequence[str] = PARTIES) -> list[str]:
    """Header of a feed whose ballots hold the given parties (148 columns by default)."""
    out = [*IDENTITY, *TURNOUT]
    for suffix, parties in ((DIRECT_SUFFIX, direct), (LIST_SUFFIX, lists)):
        totals = [INVALID + suffix, VALID + suffix]
        counts = [p + suffix for p in parties]
        out += totals + [t + PERCENT for t in totals] + counts + [c + PERCENT for c in counts]
    return [*out, *WINNER, *PROGRESS]


def feed_types(columns: Sequence[str]) -> dict[str, str]:
    """Target type of every numeric column; columns not listed stay text."""
    return {
        c: "double" if c in DOUBLE_COLUMNS or c.endswith(PERCENT) else "bigint"
        for c in columns if c not in TEXT_COLUMNS
    }
