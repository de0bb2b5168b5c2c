"""Results of the earlier election, re-based to present areas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.measures import baseline_share_pct, invalid_pct, turnout_pct
from tally.operators.aggregates import first_by, merge_entities
from tally.operators.cleaning import clean_numbers, collapse_columns, tick
from tally.operators.joins import distinct_keys, flag_listed, patch_union
from tally.operators.reshape import unpivot_measures
from tally.operators.windows import locf

COUNTS = ("wahlberechtigt", "waehler", "gueltig", "ungueltig")


def changed_constituencies(*changes: DataFrame, key: str = "wk") -> DataFrame:
    """Constituencies that gained or lost territory, once each."""
    return distinct_keys(key, *changes)


def baseline_constituency(composite: DataFrame, changed: DataFrame, parties: Sequence[str]) -> DataFrame:
    """Long earlier result by constituency with a flag for changed boundaries."""
    flagged = flag_listed(composite, changed, "wk", "veraendert")
    ids = flagged.select(
        "wk",
        F.col("wahlberechtigte").alias("wahlberechtigte_2018"),
        F.col("waehler").alias("waehler_2018"),
        F.col("gueltig").alias("gueltig_2018"),
        F.col("ungueltig").alias("ungueltig_2018"),
        "veraendert",
        *[tick(p) for p in parties],
    )
    keep = ["wk", "wahlberechtigte_2018", "waehler_2018", "gueltig_2018", "ungueltig_2018", "veraendert"]
    long = unpivot_measures(ids, keep, parties, value="stimmen_2018", position=None)
    return long.withColumn("prozent_2018", baseline_share_pct(F.col("stimmen_2018"), F.col("gueltig_2018")))


def _rates() -> dict[str, Column]:
    return {
        "wahlbeteiligung": turnout_pct(F.col("waehler"), F.col("wahlberechtigt")),
        "ungueltig_prozent": invalid_pct(F.col("ungueltig"), F.col("waehler")),
    }


def merged_history(history: DataFrame, crosswalk: DataFrame, parties: Sequence[str]) -> DataFrame:
    """Earlier results by area with merged municipalities summed and rates computed from the sums.

    A missing constituency means the whole state (0); its row has no municipality key.
    """
    filled = history.withColumn("wk", F.coalesce("wk", F.lit(0)))
    state = filled.filter(F.col("ags").isNull()).withColumns(_rates())
    areas = filled.filter(F.col("ags").isNotNull())
    merged = merge_entities(areas, crosswalk, "ags", [*COUNTS, *parties], first=["wk"], ratios=_rates())
    return merged.unionByName(state.select(*merged.columns))


def baseline_municipality(history: DataFrame, crosswalk: DataFrame, names: DataFrame, parties: Sequence[str],
                          key_length: int = 6) -> DataFrame:
    """Long earlier result by municipality, precinct rows left out, present names joined.

    A city that spans several constituencies has one row per name: the entry with the
    lowest constituency wins.
    """
    rows = merged_history(history, crosswalk, parties).filter(F.length("ags") == key_length)
    named = rows.join(names.select("ags", "name", "wk_name"), "ags", "left")
    single = first_by(named, ["ags", "name"], [F.col("wk").asc_nulls_last(), F.col("wk_name").asc_nulls_last()])
    ids = ["ags", "name", "wk_name", "wk", *COUNTS, "wahlbeteiligung", "ungueltig_prozent"]
    long = unpivot_measures(single, ids, parties, value="stimmen_2018", position=None)
    return long.withColumn("prozent_2018", baseline_share_pct(F.col("stimmen_2018"), F.col("gueltig")))


def baseline_state(history: DataFrame, parties: Sequence[str]) -> DataFrame:
    """Long earlier result of the whole state."""
    state = history.filter(F.col("ags").isNull() & (F.coalesce("wk", F.lit(0)) == 0))
    ids = state.withColumns(_rates()).withColumn("wk", F.lit(0))
    long = unpivot_measures(ids, ["wk", *COUNTS, "wahlbeteiligung", "ungueltig_prozent"], parties, position=None)
    return long.withColumn("prozent", baseline_share_pct(F.col("stimmen"), F.col("gueltig")))


def filled_sheet(sheet: DataFrame, header: Sequence[str], marker: str, order: str = "row_pos") -> DataFrame:
    """A sheet whose header cells apply to the rows below: fill down, drop rows without ``marker``."""
    return locf(sheet, header, [], [order]).filter(F.col(marker).isNotNull())


def composite_baseline(rebased: DataFrame, originals: DataFrame, unchanged: DataFrame, counts: Sequence[str],
                       collapse: Mapping[str, Sequence[str]], voters_from_ballots: bool = False) -> DataFrame:
    """Re-based results, with the original rows for constituencies that could not be re-based.

    Marker cells of the re-based sheet become null; the originals' small parties are
    summed so that both sides have the same columns. With ``voters_from_ballots`` the
    originals' voters are valid plus invalid ballots, as for list votes.
    """
    clean = clean_numbers(rebased, counts)
    if voters_from_ballots:
        originals = originals.withColumn("waehler", F.col("ungueltig") + F.col("gueltig"))
    for into, parts in collapse.items():
        originals = collapse_columns(originals, parts, into)
    originals = originals.withColumns({
        "wahlbeteiligung": turnout_pct(F.col("waehler"), F.col("wahlberechtigte")),
        "ungueltig_prozent": invalid_pct(F.col("ungueltig"), F.col("waehler")),
    })
    return patch_union(clean, originals, unchanged, "wk")
