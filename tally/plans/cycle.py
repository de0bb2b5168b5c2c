"""One evaluation cycle: a snapshot in, all long tables, area tables and documents out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.plans import live as L
from tally.plans import outputs as O
from tally.session import together
from tally.sources import sinks


@dataclass(frozen=True)
class Election:
    """What stays the same from snapshot to snapshot: ballots, dimensions, baselines."""

    direct_parties: Sequence[str]
    list_parties: Sequence[str]
    comparable_direct: Sequence[str]
    comparable_lists: Sequence[str]
    candidates: DataFrame
    listed: DataFrame
    names: DataFrame
    registry: DataFrame
    state_baseline: DataFrame
    constituency_direct_baseline: DataFrame
    constituency_list_baseline: DataFrame
    municipality_direct_baseline: DataFrame
    municipality_list_baseline: DataFrame
    overrides: Mapping[str, int] = field(default_factory=dict)
    shape: L.KeyShape = L.FEED_KEY


def land(snapshot: DataFrame, folder: str) -> DataFrame:
    """Store a typed snapshot by area level, so that each result table reads its level only."""
    snapshot.write.mode("overwrite").partitionBy("Gebietstyp").parquet(f"{folder}/snapshot")
    return snapshot.sparkSession.read.schema(snapshot.schema).parquet(f"{folder}/snapshot")


def long_tables(live: DataFrame, e: Election) -> dict[str, DataFrame]:
    """The five long result tables of a snapshot."""
    return {
        "land_landesstimmen": L.state_list_votes(live, e.list_parties, e.state_baseline, e.shape),
        "kreise_direkt": L.constituency_direct_votes(
            live, e.direct_parties, e.candidates, e.constituency_direct_baseline, e.shape),
        "kreise_landesstimmen": L.constituency_list_votes(
            live, e.list_parties, e.constituency_list_baseline, e.shape),
        "gemeinden_direkt": L.municipality_direct_votes(
            live, e.direct_parties, e.names, e.candidates, e.municipality_direct_baseline, e.overrides, e.shape),
        "gemeinden_landesstimmen": L.municipality_list_votes(
            live, e.list_parties, e.names, e.municipality_list_baseline, e.overrides, e.shape),
    }


def published(tables: Mapping[str, DataFrame], e: Election, ts: Column,
              imprint: O.Imprint) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Published tables and texts of all areas, from stored long tables."""
    wk_direct, wk_list = tables["kreise_direkt"], tables["kreise_landesstimmen"]
    g_direct, g_list = tables["gemeinden_direkt"], tables["gemeinden_landesstimmen"]
    rows = {
        "kreise_direkt": O.constituency_direct_tables(wk_direct, e.registry, e.comparable_direct),
        "kreise_landesstimmen": O.list_tables(
            wk_list, e.registry, e.listed, "wk", ["w"], e.comparable_lists, None),
        "gemeinden_direkt": O.municipality_direct_tables(g_direct, e.registry),
        "gemeinden_landesstimmen": O.list_tables(g_list, e.registry, e.listed, "ags", ["g", "s"]),
    }
    texts = {
        "kreise_direkt": O.constituency_direct_texts(wk_direct, e.comparable_direct, ts, imprint),
        "kreise_landesstimmen": O.constituency_list_texts(wk_list, ts, imprint),
        "gemeinden_direkt": O.municipality_direct_texts(g_direct, ts, imprint),
        "gemeinden_landesstimmen": O.municipality_list_texts(g_list, ts, imprint),
    }
    return rows, {k: O.documents(O.named_texts(t, e.registry, k), imprint) for k, t in texts.items()}


STATE_OUTPUT = "land_landesstimmen"


def state_outputs(tables: Mapping[str, DataFrame], ts: Column, imprint: O.Imprint) -> tuple[DataFrame, DataFrame]:
    """Published table and document of the whole state."""
    votes = tables[STATE_OUTPUT]
    return O.state_table(votes), O.documents(O.state_list_texts(votes, ts, imprint), imprint)


def published_with_state(tables: Mapping[str, DataFrame], e: Election, ts: Column,
                         imprint: O.Imprint) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All published tables and documents, each with the name of its output."""
    rows, documents = published(tables, e, ts, imprint)
    table, text = (d.withColumn("fname", F.lit(STATE_OUTPUT)) for d in state_outputs(tables, ts, imprint))
    return {**rows, STATE_OUTPUT: table}, {**documents, STATE_OUTPUT: text}


def run_cycle(spark: SparkSession, snapshot: DataFrame, e: Election, folder: str, ts: Column,
              imprint: O.Imprint, area_files: bool = True) -> dict[str, DataFrame]:
    """Land the snapshot, write the long tables, then all published tables and documents.

    Everything published is computed from the stored long tables. Without
    ``area_files`` tables and documents are written as one Parquet table each, for
    runs with very many areas.
    """
    live = land(snapshot, folder)
    tables = long_tables(live, e)
    together([partial(sinks.write_long_table, t, f"{folder}/lang/{name}") for name, t in tables.items()])
    stored = {name: spark.read.schema(t.schema).parquet(f"{folder}/lang/{name}") for name, t in tables.items()}
    rows, documents = published(stored, e, ts, imprint)
    if area_files:
        jobs = [partial(sinks.write_area_tables, t, f"{folder}/tabellen/{name}", order=["zeile"])
                for name, t in rows.items()]
        jobs += [partial(sinks.write_area_documents, t, f"{folder}/dokumente/{name}") for name, t in documents.items()]
    else:
        jobs = [partial(sinks.write_long_table, t, f"{folder}/tabellen/{name}") for name, t in rows.items()]
        jobs += [partial(sinks.write_long_table, t.select("fname", "document"), f"{folder}/dokumente/{name}")
                 for name, t in documents.items()]
    table, text = state_outputs(stored, ts, imprint)
    if area_files:
        jobs += [partial(sinks.write_long_table, table.coalesce(1).sortWithinPartitions("zeile"), f"{folder}/tabellen/{STATE_OUTPUT}", "csv"),
                 partial(text.select("document").coalesce(1).write.mode("overwrite").text, f"{folder}/dokumente/{STATE_OUTPUT}")]
    else:
        jobs += [partial(sinks.write_long_table, table, f"{folder}/tabellen/{STATE_OUTPUT}"),
                 partial(sinks.write_long_table, text.select("document"), f"{folder}/dokumente/{STATE_OUTPUT}")]
    together(jobs)
    return stored


def finished(stored: Mapping[str, DataFrame]) -> DataFrame:
    """One row: are all precincts of the state counted?"""
    return stored["land_landesstimmen"].agg(F.max("stimmbezirke").alias("stimmbezirke"), F.max("gezaehlt").alias("gezaehlt"))
