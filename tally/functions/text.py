"""Keys, labels, names and dates as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
DIRECT_SUFFIX = " Wahlkreisstimmen"
LIST_SUFFIX = " Landesstimmen"
POSITION_SUFFIX = r"\.\.\.[0-9]+$"
POSTAL_PREFIXES = ("90", "09", "99")
POSTAL_VENUE = "Briefwahl"
SUCCESSOR_PREFIX = r"^Nachrücker(in)?: "
TITLES = r"(Dr\. )|(Prof\. )"
SURNAME = r"[A-Za-zäöüßÄÖÜ\-]+"
WEEKDAYS = ("Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag")
MONTHS = (
    "Januar", "Februar", "März", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Dezember",
)
# ----------------------------------------------------------------------------


def strip_label(label: Column, suffix: str) -> Column:
    """Remove a literal suffix from a column label."""
    bare = F.left(label, F.length(label) - len(suffix))
    return F.when(label.endswith(suffix), bare).otherwise(label)


def strip_position(label: Column) -> Column:
    """Remove the ``...12`` that readers append to repeated header names."""
    return F.regexp_replace(label, POSITION_SUFFIX, "")


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """First regex match, null (not empty text) when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def piece(text: Column, separator: str, index: int) -> Column:
    """The 1-based piece of a separated text, null when there are fewer pieces."""
    return F.try_element_at(F.split(text, separator, -1), F.lit(index))


def split_area_key(key: Column, wk_len: int = 3, ags_len: int = 6) -> dict[str, Column]:
    """Constituency number and municipality key packed in an area key."""
    return {
        "wk": F.substring(key, 1, wk_len).try_cast("int"),
        "ags": F.substring(key, wk_len + 1, ags_len),
    }


def override_key(value: Column, by: Column, overrides: Mapping[str, int]) -> Column:
    """Replace ``value`` where ``by`` is one of a few listed keys."""
    out = value
    for key, new in overrides.items():
        out = F.when(by == F.lit(key), F.lit(new)).otherwise(out)
    return out


def county_key(ags: Column, step: int = 1000) -> Column:
    """Key of the enclosing county: the municipality key rounded down to ``step``."""
    return F.floor(ags / F.lit(step)).cast("bigint") * step


def is_postal(number: Column, venue: Column) -> Column:
    """Postal precinct by number prefix or by venue name (three-valued or)."""
    return F.substring(number, 1, 2).isin(*POSTAL_PREFIXES) | venue.contains(POSTAL_VENUE)


def display_name(surname: Column, party: Column) -> Column:
    return F.concat(surname, F.lit(" ("), party, F.lit(")"))


def titled_first_name(title: Column, first: Column) -> Column:
    """Title and first name, without a gap when there is no title."""
    return F.concat_ws(" ", title, first)


def parse_person_name(full: Column) -> dict[str, Column]:
    """Split ``[Nachrücker: ][Prof. ][Dr. ]Surname, First`` into surname and first name."""
    bare = F.regexp_replace(F.regexp_replace(full, SUCCESSOR_PREFIX, ""), TITLES, "")
    title = F.regexp_extract(full, TITLES, 0)
    return {
        "nachname": first_match(bare, SURNAME),
        "vorname": F.concat(title, piece(full, ", ", 2)),
    }


def german_datetime(ts: Column) -> Column:
    """``Sonntag, 08. Oktober 2023, 18:00 Uhr`` whatever the session locale."""
    weekday = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(ts) + 1)
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts))
    return F.concat(
        weekday, F.lit(", "), F.date_format(ts, "dd"), F.lit(". "), month,
        F.date_format(ts, " yyyy, HH:mm"), F.lit(" Uhr"),
    )


def short_german_datetime(ts: Column) -> Column:
    """``08.10.23, 18:05 Uhr``."""
    return F.concat(F.date_format(ts, "dd.MM.yy, HH:mm"), F.lit(" Uhr"))


def parse_german_datetime(text: Column) -> Column:
    """``08.10.2023 18:05:00`` as wall-clock time, null when it does not parse."""
    return F.to_timestamp_ntz(first_match(text, r"[0-9]{2}\.[0-9]{2}\.[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}"),
                              F.lit("dd.MM.yyyy HH:mm:ss"))


def age_seconds(now: Column, ts: Column) -> Column:
    """Whole seconds from ``ts`` to ``now``."""
    return F.timestamp_diff("SECOND", ts, now)


def to_zone(ts: Column, target: str, source: str = "UTC") -> Column:
    """Wall-clock time of one zone as the wall-clock time of another."""
    return F.convert_timezone(F.lit(source), F.lit(target), ts)
