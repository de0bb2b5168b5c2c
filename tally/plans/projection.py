"""What-if snapshot: an earlier result scaled by a factor, in the feed's own columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.measures import clamp_to, project_count, turnout_pct
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.operators.aggregates import roll_up
from tally.operators.cleaning import quoted
from tally.operators.joins import union_all
from tally.operators.reshape import pivot_measure
from tally.sources.feed import INVALID, KEY, VALID

ELIGIBLE, VOTERS, PROXY = "Wahlberechtigte", "Wählerinnen und Wähler", "Wählerinnen und Wähler mit Wahlschein"
TOTAL, COUNTED = "Anzahl Wahlbezirke", "Anzahl Wahlbezirke ausgezählt"
EARLIER = ("wahlberechtigte_2018", "waehler_2018", "wahlschein_2018", "ungueltig_2018", "ungueltig_l_2018")


def earlier_wide(long: DataFrame, key: str, suffix: str, parties: Sequence[str]) -> DataFrame:
    """Earlier votes, one row per area and one column per party of one vote type."""
    return pivot_measure(long.withColumn("partei", F.concat("partei", F.lit(suffix))), [key],
                         [p + suffix for p in parties], value="stimmen_2018")


def scaled_areas(template: DataFrame, key: str, totals: DataFrame, direct: DataFrame, lists: DataFrame,
                 direct_parties: Sequence[str], list_parties: Sequence[str], factor: float) -> DataFrame:
    """Fill the areas of a template with ``floor(earlier count * factor)``.

    Precincts counted scale too, at most to the total. Valid votes are voters minus
    invalid ones, the turnout is computed from the scaled figures.
    """
    joined = template.join(totals, key, "left").join(
        earlier_wide(direct, key, DIRECT_SUFFIX, direct_parties), key, "left").join(
        earlier_wide(lists, key, LIST_SUFFIX, list_parties), key, "left")
    scaled = joined.withColumns({
        COUNTED: clamp_to(project_count(F.col(TOTAL), factor), F.col(TOTAL)),
        ELIGIBLE: F.col("wahlberechtigte_2018"),
        VOTERS: project_count(F.col("waehler_2018"), factor),
        PROXY: project_count(F.col("wahlschein_2018"), factor),
        INVALID + DIRECT_SUFFIX: project_count(F.col("ungueltig_2018"), factor),
        INVALID + LIST_SUFFIX: project_count(F.col("ungueltig_l_2018"), factor),
        **{p + s: project_count(quoted(p + s), factor)
           for s, ps in ((DIRECT_SUFFIX, direct_parties), (LIST_SUFFIX, list_parties)) for p in ps},
    })
    return scaled.withColumns({
        "Wahlbeteiligung": turnout_pct(F.col(VOTERS), F.col(ELIGIBLE)),
        VALID + DIRECT_SUFFIX: F.col(VOTERS) - F.col(INVALID + DIRECT_SUFFIX),
        VALID + LIST_SUFFIX: F.col(VOTERS) - F.col(INVALID + LIST_SUFFIX),
    }).drop(*EARLIER, key)


def scaled_state(constituencies: DataFrame, state: DataFrame) -> DataFrame:
    """The state row: counts summed over constituencies, turnout from the sums."""
    counts = [c for c, t in constituencies.dtypes if t == "bigint" and c != TOTAL]
    sums = roll_up(constituencies, [], counts).withColumn("Wahlbeteiligung", turnout_pct(F.col(VOTERS), F.col(ELIGIBLE)))
    total = sums.select(F.struct(*[quoted(c) for c in sums.columns])).scalar()
    row = state.select(KEY, "Gebietsbezeichnung", "Gebietstyp", TOTAL, total.alias("_sums"))
    return row.select(KEY, "Gebietsbezeichnung", "Gebietstyp", TOTAL, "_sums.*")


def scaled_snapshot(state: DataFrame, constituencies: DataFrame, municipalities: DataFrame) -> DataFrame:
    """State, constituencies and municipalities as one snapshot."""
    return union_all(scaled_state(constituencies, state), constituencies, municipalities)
