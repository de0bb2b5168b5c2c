"""Dimension and index tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.measures import density, runner_up
from tally.functions.text import county_key, display_name, parse_person_name, titled_first_name
from tally.functions.numbers import zero_pad
from tally.operators.aggregates import profile
from tally.operators.cleaning import measure_index
from tally.operators.joins import chain_lookups, drop_listed, join_fan_out, keep_listed, override_name
from tally.operators.windows import following, global_rank, ntile, step_fill


def candidate_dimension(people: DataFrame, parties: DataFrame) -> DataFrame:
    """Direct candidates (those with a constituency) with party attributes and display name."""
    direct = people.filter(F.col("wk").isNotNull())
    joined = direct.join(parties.withColumnRenamed("id", "p_id"), "partei", "left")
    return joined.withColumn("name", display_name(F.col("nachname"), F.col("partei")))


def column_index(feed: DataFrame, suffix: str, standing: DataFrame) -> DataFrame:
    """Positions of the party columns of one vote type, for parties that stand."""
    return measure_index(feed, suffix, standing)


def party_lists(parties: DataFrame, people: DataFrame) -> DataFrame:
    """Parties with at least one list place."""
    return keep_listed(parties, people.filter(F.col("listenplatz").isNotNull()), "partei")


def unmatched_municipalities(assigned: DataFrame, known: DataFrame, key: str = "ags") -> DataFrame:
    """Rows of the assignment table whose municipality is unknown."""
    return drop_listed(assigned, known, key)


def area_lookup(assigned: DataFrame, constituencies: DataFrame, counties: DataFrame,
                municipalities: DataFrame) -> DataFrame:
    """Municipality -> constituency -> county -> attributes. Numeric municipality key."""
    keyed = assigned.withColumn("k_ags", county_key(F.col("ags")))
    return chain_lookups(keyed, (constituencies, "wk"), (counties, "k_ags"), (municipalities, "ags"))


def _whole_areas(municipalities: DataFrame) -> DataFrame:
    """Municipalities and cities without their districts, where the table has area types."""
    if "Gebietstyp" in municipalities.columns:
        return municipalities.filter(F.col("Gebietstyp").isin("VF", "KS"))
    return municipalities


def municipality_index(municipalities: DataFrame) -> DataFrame:
    """Inhabited municipalities with density and density quintile."""
    lived_in = _whole_areas(municipalities).filter(F.col("bevoelkerung") > 0)
    dense = lived_in.withColumn("bev_dichte", density(F.col("bevoelkerung"), F.col("flaeche")))
    return ntile(dense, "bev_dichte", ["ags", "wk"], 5, "dichte_quintil")


def constituency_index(municipalities: DataFrame) -> DataFrame:
    """Constituency profile with three-digit key and density quintile."""
    areas = profile(_whole_areas(municipalities), "wk", "wk_name", "kreis_name", "gemeinden", "bevoelkerung", "flaeche")
    keyed = areas.withColumnRenamed("kreis_name", "kreise").withColumn("wk", zero_pad(F.col("wk"), 3))
    return ntile(keyed, "bev_dichte", ["wk"], 5, "dichte_quintil")


def with_chart_ids(index: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Add the output ids registered for both vote types (``direkt_id``, ``landesstimmen_id``)."""
    for kind in ("direkt", "landesstimmen"):
        ids = registry.filter(F.col("fname").endswith(kind)).select(
            F.col("id").alias(key), F.col("chart_id").alias(f"{kind}_id"))
        index = index.join(ids, key, "left")
    return index


def previous_winners(sheet: DataFrame, constituencies: DataFrame, order: str = "row_pos") -> DataFrame:
    """Winners and successors from a sheet in which a successor row follows its winner.

    A row without constituency is a successor; the row before it left office. Empty
    cells take the value of the row above, names are split, clean constituency names
    are joined.
    """
    marked = sheet.withColumn("nachruecker", F.col("wk").isNull())
    led = following(marked, {"ausgeschieden": "nachruecker"}, [], [order])
    cols = [c for c in led.columns if c not in (order, "nachruecker")]
    filled = step_fill(led, cols, [], [order])
    second = runner_up(F.col("stimmen"), F.col("prozent"), F.col("vorsprung"))
    out = filled.withColumns(second).withColumns(parse_person_name(F.col("full_name")))
    names = constituencies.select("wk", F.col("wk_name").alias("_clean"))
    return override_name(out, names, "wk", "_clean", "wk_name")


def boundary_changes(municipalities: DataFrame, constituencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Territory gained and lost by constituency, from municipalities with an old constituency."""
    moved = municipalities.filter(F.col("wk_alt").isNotNull()).withColumn(
        "_area", F.coalesce("name", "stadtteilname"))
    gains = moved.select("wk", "wk_name", F.col("_area").alias("neu_dazu"))
    losses = moved.select(F.col("wk_alt").alias("wk"), F.col("_area").alias("abgegeben")).join(
        constituencies.select("wk", "wk_name"), "wk", "left").select("wk", "wk_name", "abgegeben")
    return gains, losses


def candidate_sheet(people: DataFrame, parties: DataFrame, winners: DataFrame, link_prefix: str) -> DataFrame:
    """One row per candidate (and successor of the constituency) with the earlier winner."""
    sheet = people.filter(F.col("wk").isNotNull()).select(
        "wk", "wk_name", "partei", "nachname",
        titled_first_name(F.col("titel"), F.col("vorname")).alias("vorname"),
        "beruf", "geboren", "geburtsort",
        F.concat(F.lit(link_prefix), F.col("check_id").cast("string")).alias("link"),
    ).join(parties.select("partei", "id"), "partei", "left")
    won = winners.filter(~F.col("nachruecker")).select(
        "wk",
        F.col("vorname").alias("sieger_vorname"),
        F.col("nachname").alias("sieger_nachname"),
        F.col("partei").alias("sieger_partei"),
        F.col("prozent").alias("sieger_prozent"),
        F.col("vorsprung").alias("sieger_vorsprung"),
    )
    followed = winners.filter(F.col("nachruecker")).select(
        "wk", F.col("vorname").alias("nachruecker_vorname"), F.col("nachname").alias("nachruecker_nachname"))
    # a constituency has one winner, but may have many successors
    return join_fan_out(sheet.join(won, "wk", "left"), followed, "wk")


def result_links(areas: DataFrame, key: str, prefix: str, kind: str, width: int = 0,
                 suffix: str = "-ergebnis-100.html", into: str = "url") -> DataFrame:
    """Address of the result page of each area: prefix, kind, (padded) key, suffix."""
    padded = zero_pad(F.col(key), width) if width else F.col(key).cast("string")
    return areas.withColumn(into, F.concat(F.lit(prefix + kind), padded, F.lit(suffix)))


def build_registry(areas: DataFrame, kinds: Sequence[str] = ("direkt", "landesstimmen")) -> DataFrame:
    """Output names for every area and vote type: ``id, typ, kind, fname``.

    ``areas`` has ``id`` and ``typ`` (w constituency, g municipality, s city). Cities
    get list votes only. An unknown type stops the job.
    """
    known = F.when(F.col("typ").isin("w", "g", "s"), F.col("typ")).otherwise(
        F.raise_error(F.concat(F.lit("unknown area type: "), F.coalesce("typ", F.lit("null")))))
    rows = areas.select("id", known.alias("typ")).withColumn(
        "kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    rows = rows.filter((F.col("typ") != "s") | (F.col("kind") == "landesstimmen"))
    stem = F.when(F.col("typ") == "w", F.concat(F.lit("wk"), zero_pad(F.col("id"), 3))).otherwise(
        F.concat(F.lit("g06"), F.col("id")))
    return rows.withColumn("fname", F.concat(stem, F.lit("_"), F.col("kind")))


def lasting_ids(registry: DataFrame, held: DataFrame | None = None, key: str = "fname", prefix: str = "o") -> DataFrame:
    """Add ``chart_id`` to a registry: ids that were given before stay, new outputs get the numbers after them.

    ``held`` are all rows (``key``, ``chart_id``) ever given, by which an output that went and comes again
    has its old id, and no id is given twice. Numbers of new outputs follow the order of ``key``, whatever the
    partitions. Keep the result with ``held`` for the next time: :func:`held_ids`.
    """
    if held is None:
        held = registry.sparkSession.createDataFrame([], f"{key} string, chart_id string")
    held = held.select(key, "chart_id")
    top = held.agg(F.coalesce(F.max(F.regexp_extract("chart_id", "([0-9]+)$", 1).cast("bigint")), F.lit(0))).first()[0]
    fresh = registry.select(key).distinct().join(held, key, "left_anti")
    given = global_rank(fresh, [F.col(key).asc()], "_n").select(key, F.concat(F.lit(prefix), zero_pad(F.col("_n") + F.lit(top), 6)).alias("chart_id"))
    return registry.join(held.unionByName(given), key, "left")


def held_ids(registry: DataFrame, held: DataFrame | None = None, key: str = "fname") -> DataFrame:
    """All ids given so far: those of ``held`` and of a registry with ``chart_id``."""
    now = registry.select(key, "chart_id").distinct()
    return now if held is None else held.select(key, "chart_id").unionByName(now.join(held, key, "left_anti"))
