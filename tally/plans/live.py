"""Long result tables of one snapshot: area x party with share and change.

Input is a typed snapshot (see ``tally.sources.snapshots``). A ``snapshot_ts`` column,
if there is one, is kept and separates snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.measures import diff_pp, share_pct
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX, override_key, split_area_key
from tally.operators.cleaning import select_measures, zero_fill
from tally.operators.joins import override_name, with_baseline, with_candidates
from tally.operators.reshape import unpivot_measures
from tally.operators.windows import locf
from tally.sources.feed import CITY, CONSTITUENCY, INVALID, KEY, MUNICIPALITY, PERCENT, STATE, VALID

#: Columns in which a missing number means zero. The precinct counters are not among them.
ZERO_FILLED = ("wahlberechtigt", "waehler", "wahlbeteiligung", "gueltig", "ungueltig", "ungueltig_prozent")
#: Figures of the earlier election that hold for a whole constituency.
AREA_BASELINE = ("wahlberechtigte_2018", "waehler_2018", "gueltig_2018", "ungueltig_2018", "veraendert")
PARTY_BASELINE = ("stimmen_2018", "prozent_2018")

KeyShape = tuple[int, int]
FEED_KEY: KeyShape = (3, 6)


def _identity(name: str, suffix: str, columns: Sequence[str]) -> dict[str, str]:
    out = {
        "area_key": KEY,
        name: "Gebietsbezeichnung",
        "stimmbezirke": "Anzahl Wahlbezirke",
        "gezaehlt": "Anzahl Wahlbezirke ausgezählt",
        "wahlberechtigt": "Wahlberechtigte",
        "waehler": "Wählerinnen und Wähler",
        "wahlbeteiligung": "Wahlbeteiligung",
        "gueltig": VALID + suffix,
        "ungueltig": INVALID + suffix,
        "ungueltig_prozent": INVALID + suffix + PERCENT,
    }
    if "snapshot_ts" in columns:
        out["snapshot_ts"] = "snapshot_ts"
    return out


def _areas(live: DataFrame, levels: Sequence[str], name: str, suffix: str, parties: Sequence[str],
           keys: Mapping[str, Column]) -> DataFrame:
    """One row per area with clean identity columns and one column per party."""
    rows = live.filter(F.col("Gebietstyp").isin(*levels))
    wide = select_measures(rows, _identity(name, suffix, live.columns), suffix, parties)
    return zero_fill(wide, ZERO_FILLED).withColumns(dict(keys))


def _votes(wide: DataFrame, suffix: str, parties: Sequence[str]) -> DataFrame:
    """Area x party rows with votes and share. One generator per area row, no shuffle."""
    ballot = [c for c in wide.columns if c in set(parties)]
    ids = [c for c in wide.columns if c not in set(parties)]
    long = zero_fill(unpivot_measures(wide, ids, ballot), ["stimmen"])
    return long.withColumn("prozent", share_pct(F.col("stimmen"), F.col("gueltig")))


def _area_key(shape: KeyShape) -> dict[str, Column]:
    return split_area_key(F.col("area_key"), *shape)


def state_list_votes(live: DataFrame, parties: Sequence[str], baseline: DataFrame,
                     shape: KeyShape = FEED_KEY) -> DataFrame:
    """List votes of the whole state, compared with the state rows (wk 0) of the baseline."""
    key = {"wk": _area_key(shape)["wk"]}
    votes = _votes(_areas(live, [STATE], "wk_name", LIST_SUFFIX, parties, key), LIST_SUFFIX, parties)
    state = baseline.filter(F.col("wk") == 0).select("partei", "prozent_2018")
    out = with_baseline(votes, state, ["partei"], ["prozent_2018"])
    return out.withColumn("differenz", diff_pp(F.col("prozent"), F.col("prozent_2018")))


def _constituency_votes(live: DataFrame, suffix: str, parties: Sequence[str], baseline: DataFrame,
                        candidates: DataFrame | None, guard: bool, shape: KeyShape) -> DataFrame:
    key = {"wk": _area_key(shape)["wk"]}
    votes = _votes(_areas(live, [CONSTITUENCY], "wk_name", suffix, parties, key), suffix, parties)
    if candidates is not None:
        votes = with_candidates(votes, candidates.select("wk", "partei", "nachname", "name"))
    joined = votes.join(baseline.select("wk", "partei", *AREA_BASELINE, *PARTY_BASELINE), ["wk", "partei"], "left")
    # a constituency's rows are one ballot, so its window stays small
    part = ["wk", *([c for c in ("snapshot_ts",) if c in votes.columns])]
    filled = zero_fill(locf(joined, AREA_BASELINE, part, ["ballot_pos"], small_groups=True), PARTY_BASELINE)
    return filled.withColumn("differenz", diff_pp(F.col("prozent"), F.col("prozent_2018"), guard))


def constituency_direct_votes(live: DataFrame, parties: Sequence[str], candidates: DataFrame,
                              baseline: DataFrame, shape: KeyShape = FEED_KEY) -> DataFrame:
    """First votes by constituency and candidate, with the earlier result."""
    return _constituency_votes(live, DIRECT_SUFFIX, parties, baseline, candidates, True, shape)


def constituency_list_votes(live: DataFrame, parties: Sequence[str], baseline: DataFrame,
                            shape: KeyShape = FEED_KEY) -> DataFrame:
    """List votes by constituency; the change is computed for a share of 0 as well."""
    return _constituency_votes(live, LIST_SUFFIX, parties, baseline, None, False, shape)


def _rows_by_party(name: str) -> Column:
    """Map from party to its baseline rows, of an array of one area's rows; a party mostly has one."""
    rows, parties = F.col(name), F.array_distinct(F.col(name)["partei"])

    def own(e: Column) -> Column:
        return F.struct(*[e[c].alias(c) for c in PARTY_BASELINE])

    single = F.transform(rows, lambda e: F.struct(e["partei"].alias("partei"), F.array(own(e)).alias("rows")))
    several = F.transform(parties, lambda p: F.struct(p.alias("partei"), F.transform(F.filter(rows, lambda e: e["partei"] == p), own).alias("rows")))
    return F.map_from_entries(F.when(F.size(parties) == F.size(rows), single).otherwise(several))


def _municipality_votes(live: DataFrame, suffix: str, parties: Sequence[str], names: DataFrame,
                        candidates: DataFrame | None, baseline: DataFrame, overrides: Mapping[str, int],
                        shape: KeyShape) -> DataFrame:
    key = _area_key(shape)
    key["wk"] = override_key(key["wk"], key["ags"], overrides)
    wide = _areas(live, [MUNICIPALITY, CITY], "g_name", suffix, parties, key)
    # the name belongs to the area: joined before the rows multiply by party
    wide = override_name(wide, names, "ags", "name", "g_name")
    # So is the earlier result, as one map an area from party to its rows: the long rows are not shuffled.
    known = baseline.where("ags IS NOT NULL AND partei IS NOT NULL")
    earlier = known.groupBy("ags").agg(F.collect_list(F.struct("partei", *PARTY_BASELINE)).alias("_all")).select("ags", _rows_by_party("_all").alias("_earlier"))
    votes = _votes(wide.join(earlier, "ags", "left"), suffix, parties)
    votes = votes.select(*[F.col(c) for c in votes.columns if c != "_earlier"], F.inline_outer(F.element_at("_earlier", F.col("partei"))))
    if candidates is not None:
        votes = with_candidates(votes, candidates.select("wk", "partei", "nachname", "name"))
    first = ["ags", "partei"]
    out = zero_fill(votes.select(*first, *[c for c in votes.columns if c not in (*first, *PARTY_BASELINE)], *PARTY_BASELINE), PARTY_BASELINE)
    return out.withColumn("differenz", diff_pp(F.col("prozent"), F.col("prozent_2018")))


def municipality_direct_votes(live: DataFrame, parties: Sequence[str], names: DataFrame, candidates: DataFrame,
                              baseline: DataFrame, overrides: Mapping[str, int] | None = None,
                              shape: KeyShape = FEED_KEY) -> DataFrame:
    """First votes by municipality and candidate.

    Cities with several constituencies have constituency 0, hence no candidates, and
    drop out; ``overrides`` (key -> constituency) keeps those that have just one.
    """
    return _municipality_votes(live, DIRECT_SUFFIX, parties, names, candidates, baseline, overrides or {}, shape)


def municipality_list_votes(live: DataFrame, parties: Sequence[str], names: DataFrame, baseline: DataFrame,
                            overrides: Mapping[str, int] | None = None, shape: KeyShape = FEED_KEY) -> DataFrame:
    """List votes by municipality and city."""
    return _municipality_votes(live, LIST_SUFFIX, parties, names, None, baseline, overrides or {}, shape)
