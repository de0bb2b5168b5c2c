"""Published outputs: one table and one document per area and vote type, for all areas at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions import notes as N
from tally.functions.numbers import zero_pad
from tally.operators.aggregates import ordered_labels
from tally.operators.joins import empty_results, keep_listed, with_output_name
from tally.operators.ranking import top_n
from tally.sources.sinks import area_document

#: Figures that are the same on every row of an area.
FIGURES = ("stimmbezirke", "gezaehlt", "waehler", "wahlberechtigt", "ungueltig")


@dataclass(frozen=True)
class Imprint:
    """What a document says besides the figures."""

    byline: str
    source_name: str
    source_url: str
    start: str  # begin of the count, ``yyyy-MM-dd HH:mm:ss``
    test_mode: bool = False
    state_name: str = "Land"


def comparable(parties: Sequence[str] | None) -> Column | None:
    """Parties that stood in the earlier election; None: all."""
    return None if parties is None else F.col("partei").isin(*parties)


def leading(votes: DataFrame, part: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` candidates of each area by share."""
    return top_n(votes, part, [F.col("prozent").desc_nulls_last(), F.col("ballot_pos").asc()], n)


def constituency_direct_tables(votes: DataFrame, registry: DataFrame, known: Sequence[str] | None,
                               n: int = 5) -> DataFrame:
    """Rows of the published table: the leading candidates per constituency."""
    text = N.share_delta(F.col("prozent"), F.col("differenz"), comparable(known), "%")
    rows = leading(votes, ["wk"], n).withColumn("prozent", text)
    out = with_output_name(rows.withColumn("_id", zero_pad(F.col("wk"), 3)),
                           registry, "_id", "direkt", ["w"])
    return out.select("fname", F.col("rang").alias("zeile"), "name", "partei", "stimmen", "prozent")


def list_tables(votes: DataFrame, registry: DataFrame, listed: DataFrame, area: str, types: Sequence[str],
                known: Sequence[str] | None = None, change: str | None = "differenz") -> DataFrame:
    """Rows of the published list-vote tables, parties in ballot order."""
    delta = F.col(change) if change else F.col("prozent") - F.col("prozent_2018")
    rows = keep_listed(votes, listed, "partei").withColumn(
        "prozent", N.share_delta(F.col("prozent"), delta, comparable(known)))
    key = zero_pad(F.col(area), 3) if area == "wk" else F.col(area)
    out = with_output_name(rows.withColumn("_id", key), registry, "_id", "landesstimmen", types)
    return out.select("fname", F.col("ballot_pos").alias("zeile"), "partei", "stimmen", "prozent", "wk")


def municipality_direct_tables(votes: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the published municipality tables, candidates in ballot order."""
    rows = votes.withColumn("prozent", N.share_delta(F.col("prozent"), F.col("differenz")))
    out = with_output_name(rows.withColumn("_id", F.col("ags")), registry, "_id", "direkt", ["g"])
    return out.select("fname", F.col("ballot_pos").alias("zeile"), "name", "partei", "stimmen", "prozent")


def state_table(votes: DataFrame) -> DataFrame:
    """Parties of the whole state with share and bracketed change."""
    return votes.select(
        F.col("ballot_pos").alias("zeile"), "partei", "prozent",
        N.state_delta(F.col("prozent"), F.col("prozent_2018")).alias("plusminus"))


def _figures(votes: DataFrame, part: Sequence[str], attrs: Sequence[str], *extra: Column) -> DataFrame:
    """One row per area with the figures its texts need."""
    return votes.groupBy(*part).agg(*[F.max(c).alias(c) for c in (*FIGURES, *attrs)], *extra)


def _named(areas: DataFrame) -> DataFrame:
    """A municipality without a clean name is shown by its key."""
    return areas.withColumn("g_name", F.coalesce("g_name", "ags"))


def _texts(areas: DataFrame, title: Column, intro: Column, before: Sequence[Column], ts: Column,
           imprint: Imprint) -> DataFrame:
    counted, total = F.col("gezaehlt"), F.col("stimmbezirke")
    start = F.to_timestamp_ntz(F.lit(imprint.start), F.lit("yyyy-MM-dd HH:mm:ss"))
    full_title = N.with_status(title, counted, total)
    full_intro = F.concat(
        N.turnout_text(F.col("waehler"), F.col("ungueltig"), F.col("wahlberechtigt"), counted, total), intro)
    marked_title, marked_intro = N.test_marking(full_title, full_intro, F.col("wk"), imprint.test_mode)
    return areas.withColumns({
        "title": marked_title,
        "intro": marked_intro,
        "notes": N.status_note(counted, total, ts, start, *before),
    })


def constituency_direct_texts(votes: DataFrame, known: Sequence[str] | None, ts: Column,
                              imprint: Imprint, n: int = 5) -> DataFrame:
    """Texts with the candidates after the leading ``n``: ``name: share, …``.

    A constituency's rows are one ballot, so it is ranked and joined in one window.
    """
    order = [F.col("prozent").desc_nulls_last(), F.col("ballot_pos").asc()]
    ranked = votes.withColumn("_rank", F.row_number().over(Window.partitionBy("wk").orderBy(*order)))
    share = N.share_delta(F.col("prozent"), F.col("differenz"), comparable(known), "%")
    label = F.coalesce(F.concat("name", F.lit(": "), share), F.concat("name", F.lit(N.NO_SHARE)))
    rest = ordered_labels(F.col("_rank"), label, where=F.col("_rank") > n).alias("weitere")
    areas = _figures(ranked, ["wk"], ["wk_name", "veraendert"], rest)
    title = F.concat(F.lit(N.CONSTITUENCY), F.col("wk").cast("string"), F.lit(" - "), "wk_name", F.lit(N.DIRECT_TITLE))
    before = [N.others_text(F.col("weitere")), N.boundary_remark(F.col("veraendert"))]
    return _texts(areas, title, F.lit(N.INTRO_CONSTITUENCY_DIRECT + N.ROUNDED), before, ts, imprint)


def constituency_list_texts(votes: DataFrame, ts: Column, imprint: Imprint) -> DataFrame:
    areas = _figures(votes, ["wk"], ["wk_name", "veraendert"])
    title = F.concat(F.lit(N.CONSTITUENCY), F.col("wk").cast("string"), F.lit(" - "), "wk_name", F.lit(N.LIST_TITLE))
    before = [F.lit(N.BALLOT_ORDER), N.boundary_remark(F.col("veraendert"))]
    return _texts(areas, title, F.lit(N.INTRO_CONSTITUENCY_LIST + N.ROUNDED), before, ts, imprint)


def municipality_direct_texts(votes: DataFrame, ts: Column, imprint: Imprint) -> DataFrame:
    areas = _named(_figures(votes, ["ags"], ["wk", "g_name"]))
    title = F.concat("g_name", F.lit(N.DIRECT_TITLE))
    intro = F.concat(F.lit("Erststimmen in "), "g_name", F.lit(" für die Direktkandidaten im Wahlkreis "),
                     F.col("wk").cast("string"), F.lit(". " + N.ROUNDED))
    return _texts(areas, title, intro, [F.lit(N.BALLOT_ORDER)], ts, imprint)


def municipality_list_texts(votes: DataFrame, ts: Column, imprint: Imprint) -> DataFrame:
    areas = _named(_figures(votes, ["ags"], ["wk", "g_name"]))
    title = F.concat("g_name", F.lit(N.LIST_TITLE))
    intro = F.concat(F.lit("Zweitstimmen in "), "g_name", F.lit(", alle Wahllisten. " + N.ROUNDED))
    return _texts(areas, title, intro, [F.lit(N.BALLOT_ORDER)], ts, imprint)


def state_list_texts(votes: DataFrame, ts: Column, imprint: Imprint) -> DataFrame:
    areas = _figures(votes, ["wk"], ["wk_name"])
    title = F.lit(imprint.state_name + N.LIST_TITLE)
    return _texts(areas, title, F.lit(N.INTRO_STATE_LIST), [F.lit(N.STATE_BALLOT_ORDER)], ts, imprint)


# --- before the count ---


def placeholder_direct(candidates: DataFrame, registry: DataFrame, n: int = 5) -> DataFrame:
    """Empty constituency tables: the first ``n`` candidates in ballot order without votes."""
    first = top_n(candidates, ["wk"], [F.col("p_id").asc_nulls_last(), F.col("name").asc()], n)
    rows = first.select(zero_pad(F.col("wk"), 3).alias("_id"), F.col("rang").alias("zeile"), "name",
                        F.lit(0.0).alias("prozent"))
    return with_output_name(rows, registry, "_id", "direkt", ["w"]).drop("_id")


def placeholder_lists(areas: DataFrame, listed: DataFrame, registry: DataFrame) -> DataFrame:
    """Empty list tables: every listed party for every area (``ags``, ``wk``)."""
    rows = empty_results(areas.select(F.col("ags").alias("_id"), "wk"), listed.select("partei"))
    return with_output_name(rows, registry, "_id", "landesstimmen", ["g", "s"]).drop("_id")


def constituency_of(areas: DataFrame, lookup: DataFrame) -> DataFrame:
    """``areas`` (``ags``) with their ``wk`` from ``lookup`` (``ags``, ``wk``), all at once; of several the smallest, none is null."""
    return areas.join(lookup.groupBy("ags").agg(F.min("wk").alias("wk")), "ags", "left")


def placeholder_municipality_direct(areas: DataFrame, lookup: DataFrame, candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Empty candidate tables of municipalities (``ags``): all candidates of the constituency that ``lookup`` gives, in ballot order.

    An area without a constituency, or in one without candidates, has no rows, as its table has none.
    """
    where = constituency_of(areas.select("ags"), lookup).filter(F.col("wk").isNotNull())
    ballot = candidates.select("wk", "partei", "name", "p_id")
    rows = empty_results(where.select(F.col("ags").alias("_id"), "wk"), ballot, on=["wk"])
    order = Window.partitionBy("_id").orderBy(F.col("p_id").asc_nulls_last(), F.col("name").asc())
    placed = rows.withColumn("zeile", F.row_number().over(order))
    named = with_output_name(placed, registry, "_id", "direkt", ["g"])
    return named.select("fname", "zeile", "name", "partei", "stimmen", "prozent")


def placeholder_lists_of(areas: DataFrame, lookup: DataFrame, listed: DataFrame, registry: DataFrame) -> DataFrame:
    """:func:`placeholder_lists` with the constituency looked up."""
    return placeholder_lists(constituency_of(areas.select("ags"), lookup), listed, registry)


def placeholder_direct_texts(candidates: DataFrame, imprint: Imprint, n: int = 5) -> DataFrame:
    """Constituency texts before the count, with the candidates after the first ``n``."""
    w = Window.partitionBy("wk").orderBy(F.col("p_id").asc_nulls_last(), F.col("name").asc())
    ranked = candidates.withColumn("_rank", F.row_number().over(w))
    rest = ordered_labels(F.col("_rank"), F.concat("name", F.lit(N.NO_SHARE)), where=F.col("_rank") > n)
    areas = ranked.groupBy("wk").agg(F.max("wk_name").alias("wk_name"), rest.alias("_rest"))
    start = F.to_timestamp_ntz(F.lit(imprint.start), F.lit("yyyy-MM-dd HH:mm:ss"))
    others = F.concat(F.when(F.col("_rest") != "", F.lit(N.OTHERS_BEFORE)).otherwise(F.lit("")), "_rest", F.lit(N.BREAK))
    none = F.lit(0)
    return areas.select(
        "wk",
        F.concat(F.lit(N.CONSTITUENCY), F.col("wk").cast("string"), F.lit(" - "), "wk_name",
                 F.lit(N.DIRECT_TITLE)).alias("title"),
        F.lit(N.INTRO_BEFORE_DIRECT).alias("intro"),
        N.status_note(none, none, start - F.expr("INTERVAL 1 DAY"), start, others).alias("notes"))


def named_texts(texts: DataFrame, registry: DataFrame, table: str) -> DataFrame:
    """Add the output name of each area's text; ``table`` is like ``kreise_direkt``."""
    level, kind = table.split("_")
    if level == "kreise":
        key, types = zero_pad(F.col("wk"), 3), ["w"]
    else:
        key, types = F.col("ags"), ["g", "s"]
    return with_output_name(texts.withColumn("_id", key), registry, "_id", kind, types)


def documents(texts: DataFrame, imprint: Imprint) -> DataFrame:
    """Add the JSON document made of title, intro, notes and imprint."""
    return texts.withColumn("document", area_document(
        F.col("title"), F.col("intro"), F.col("notes"),
        F.lit(imprint.byline), F.lit(imprint.source_name), F.lit(imprint.source_url)))
