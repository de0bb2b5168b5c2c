"""Analyses of a final result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.aggregates import overall_quota, postal_quota, volatility_by
from tally.operators.joins import keep_listed
from tally.operators.ranking import top_bottom_n
from tally.operators.reshape import pivot_measures
from tally.session import together
from tally.sources.sinks import write_long_table, write_sheets


def party_results(votes: DataFrame, main: DataFrame, area: Sequence[str]) -> DataFrame:
    """Area, turnout, party, share and change, for the main parties."""
    rows = keep_listed(votes, main, "partei")
    return rows.select(*area, "wahlbeteiligung", "partei", "prozent", "differenz")


def strongholds(results: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Per party the areas with the highest shares, then those with the lowest."""
    return top_bottom_n(results, ["partei"], "prozent", [key], n)


def gains_losses(results: DataFrame, key: str, parties: DataFrame, n: int = 3) -> DataFrame:
    """Per party the biggest gains and losses, with party attributes."""
    return top_bottom_n(results, ["partei"], "differenz", [key], n).join(parties, "partei", "left")


def volatility_municipality(votes: DataFrame) -> DataFrame:
    return volatility_by(votes, ["ags"], "differenz", ["g_name", "wahlbeteiligung"])


def volatility_constituency(votes: DataFrame) -> DataFrame:
    """From the unguarded change: share now minus share then."""
    change = votes.withColumn("differenz", F.col("prozent") - F.col("prozent_2018"))
    return volatility_by(change, ["wk"], "differenz", ["wk_name", "wahlbeteiligung"])


def choropleth_wide(results: DataFrame, volatility: DataFrame, parties: Sequence[str],
                    prefix: str = "06") -> DataFrame:
    """One row per municipality with share and change of every main party, for a map."""
    joined = results.join(volatility.select("ags", "volatilitaet"), "ags", "left")
    keyed = joined.withColumn("ags", F.concat(F.lit(prefix), F.col("ags")))
    ids = ["ags", "g_name", "wk", "wahlbeteiligung", "volatilitaet"]
    return pivot_measures(keyed, ids, parties, ["prozent", "differenz"])


def postal_by_municipality(live: DataFrame, ags: Column, strict: bool = False) -> DataFrame:
    """Postal-vote quota per municipality from the precinct rows of a snapshot."""
    precincts = live.filter(F.col("Gebietstyp") == "SB").select(
        ags.alias("ags"),
        F.col("Gebietsbezeichnung").alias("g_name"),
        F.col("Wahlbezirksnummer").alias("wahlbezirksnummer"),
        F.col("Wahllokal").alias("wahllokal"),
        F.col("Wahlberechtigte").alias("wahlberechtigt"),
        F.col("Wählerinnen und Wähler").alias("waehler"),
        F.col("ungültige Wahlkreisstimmen").alias("ungueltig_wk"),
        F.col("ungültige Landesstimmen").alias("ungueltig_ls"),
    )
    return postal_quota(precincts, "ags", strict)


def run_analysis(tables: Mapping[str, DataFrame], live: DataFrame, main: DataFrame, parties: Sequence[str],
                 folder: str, ags: Column) -> None:
    """All analyses of a final result, from stored long tables, written side by side."""
    votes, wk_votes = tables["gemeinden_landesstimmen"], tables["kreise_landesstimmen"]
    results = party_results(votes, main, ["ags", "g_name", "wk"])
    wk_results = party_results(wk_votes, main, ["wk", "wk_name"])
    swings = volatility_municipality(votes)
    sheets = {
        "hochburgen_gemeinden": strongholds(results, "ags"),
        "hochburgen_kreise": strongholds(wk_results, "wk"),
        "choropleth": results,
    }
    whole = {
        "gewinn_verlust": gains_losses(results, "ags", main),
        "volatilitaet_gemeinden": swings,
        "volatilitaet_kreise": volatility_constituency(wk_votes),
        "choropleth_alle": choropleth_wide(results, swings, parties),
        "briefwahl_nach_gemeinde": postal_by_municipality(live, ags),
    }
    together([partial(write_sheets, t, f"{folder}/{name}", "partei") for name, t in sheets.items()]
             + [partial(write_long_table, t, f"{folder}/{name}") for name, t in whole.items()])


def postal_overall(by_municipality: DataFrame) -> DataFrame:
    return overall_quota(by_municipality, "briefwaehler", "waehler", "briefwahlquote")
