"""The whole counting night as one stream: archive, outputs, finished areas, progress, and an end.

Every batch with a newer snapshot lands its rows and rejects in one pass, archives them, computes the
long tables, publishes the areas that changed as a new version, reports the areas that have
newly finished, and writes how far the count is. What a batch leaves is keyed by its number and
written anew if the batch is run again; it reads what the batch before left. So a batch
that is killed at any place is repeated whole, and nothing is reported twice or lost.

The night ends when all precincts are counted, by the total of that very snapshot, as precincts can
be merged in the course of the night. Snapshots that come later are not processed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions.measures import is_complete, share_pct
from tally.functions.text import DIRECT_SUFFIX, LIST_SUFFIX
from tally.operators.cleaning import quoted
from tally.plans.cycle import Election, long_tables, land, published_with_state
from tally.plans.outputs import Imprint
from tally.plans.versions import publish
from tally.session import together
from tally.sources import sinks
from tally.sources.archive import read_if_there
from tally.sources.feed import KEY, MAIN_PARTIES, PERCENT, STATE, VALID, feed_columns
from tally.sources.rejects import land_checked, timed_checked
from tally.sources.snapshots import feed_stream
from tally.streaming.snapshots import LEVELS, gate_snapshots

STATE_ROWS = "area_key string, complete boolean, reported boolean, initial timestamp_ntz"
PROGRESS_ROW = "snapshot_ts timestamp_ntz, stimmbezirke bigint, gezaehlt bigint, neu bigint, fertig boolean"


@dataclass(frozen=True)
class Counting:
    """Which columns of a snapshot say how far an area is, and what is reported of a finished one."""

    key: str = KEY
    level: str = "Gebietstyp"
    total: str = "Anzahl Wahlbezirke"
    counted: str = "Anzahl Wahlbezirke ausgezählt"
    levels: Sequence[str] = LEVELS
    state: str = STATE
    shares: dict[str, Column] = field(default_factory=dict)


def share_columns(columns: Sequence[str], direct: Sequence[str] = MAIN_PARTIES, lists: Sequence[str] = MAIN_PARTIES) -> dict[str, Column]:
    """Shares of the main parties in both votes: the feed's own where it gives them, else votes over the valid ones."""
    out = {}
    for suffix, parties in ((DIRECT_SUFFIX, direct), (LIST_SUFFIX, lists)):
        for name in (p + suffix for p in parties):
            share = share_pct(quoted(name), quoted(VALID + suffix))
            out[name + PERCENT] = F.coalesce(quoted(name + PERCENT), share) if name + PERCENT in columns else share
    return out


# --- finished areas as keyed state ---


def merge_state(before: DataFrame, snapshot: DataFrame, c: Counting) -> DataFrame:
    """State (``area_key``, ``complete``, ``reported``) after a snapshot, one row an area, from the state before it.

    An area counts as reported once it is complete; in the first snapshot of a night, complete areas
    are so marked without a report. Areas that a snapshot leaves out keep their state.
    """
    now = _areas(snapshot, c).groupBy("area_key").agg(F.max("now").alias("now"))
    merged = before.join(now, "area_key", "full_outer")
    complete = F.coalesce("now", "complete", F.lit(False))
    return merged.select("area_key", complete.alias("complete"),
                         (F.coalesce("reported", F.lit(False)) | (F.coalesce("now", F.lit(False)))).alias("reported"))


def _areas(snapshot: DataFrame, c: Counting) -> DataFrame:
    done = F.coalesce(is_complete(quoted(c.counted), quoted(c.total)), F.lit(False))
    return snapshot.where(quoted(c.level).isin(*c.levels)).withColumns({"area_key": quoted(c.key), "now": done})


def newly_finished(before: DataFrame, snapshot: DataFrame, c: Counting) -> DataFrame:
    """Finished areas of a snapshot that the state has not as reported, with their shares: one row an area.

    Finished areas are joined to the state on the area; areas that the state does not know yet are new.
    An area with several rows is reported by the first of them, by its figures.
    """
    done = _areas(snapshot, c).where("now")
    carried = [F.col("area_key"), quoted(c.level).alias("gebietstyp"), quoted(c.total).alias("stimmbezirke"), *[e.alias(n) for n, e in c.shares.items()]]
    rows = done.join(before.select("area_key", "reported"), "area_key", "left").where("NOT coalesce(reported, false)").select(*carried)
    return rows.groupBy("area_key").agg(F.min(F.struct(*[quoted(n) for n in rows.columns if n != "area_key"])).alias("own")).select("area_key", "own.*")


def progress_row(before: DataFrame, snapshot: DataFrame, c: Counting, ts: str = "snapshot_ts") -> DataFrame:
    """How far the whole count is, and how many precincts are new since the batch before; no row without a state row."""
    now = snapshot.where(quoted(c.level) == c.state).agg(
        F.max(ts).alias("snapshot_ts"), F.max(quoted(c.total)).cast("bigint").alias("stimmbezirke"), F.max(quoted(c.counted)).cast("bigint").alias("gezaehlt"))
    last = before.agg(F.max("gezaehlt").alias("_last"))
    return now.where("snapshot_ts IS NOT NULL").join(last, how="cross").select(  # one row with one row
        "snapshot_ts", "stimmbezirke", "gezaehlt", (F.col("gezaehlt") - F.coalesce("_last", F.lit(0))).alias("neu"),
        F.coalesce(F.col("gezaehlt") >= F.col("stimmbezirke"), F.lit(False)).alias("fertig"))


def follow_count(snapshot: DataFrame, batch_id: int, folder: str, c: Counting) -> None:
    """Write state, reports and progress of batch ``batch_id`` below ``folder``, from those of the batch before.

    An empty snapshot (a batch that brought nothing newer) carries state and progress on.
    """
    spark = snapshot.sparkSession
    before = read_if_there(spark, f"{folder}/state/batch_id={batch_id - 1}", STATE_ROWS)
    initial = before.agg(F.max("initial")).first()[0]
    ts = snapshot.agg(F.max("snapshot_ts")).first()[0]
    # The first snapshot may come in several batches.
    first = initial is None or initial == ts
    state = merge_state(before, snapshot, c).withColumn("initial", F.lit(initial or ts).cast("timestamp_ntz"))
    reports = newly_finished(before, snapshot, c)
    last = read_if_there(spark, f"{folder}/progress/batch_id={batch_id - 1}", PROGRESS_ROW)
    row = progress_row(last, snapshot, c)
    if row.isEmpty():
        row = last.withColumn("neu", F.lit(0).cast("bigint"))
    # The state comes last: the next batch starts from it.
    (reports.limit(0) if first else reports).write.mode("overwrite").parquet(f"{folder}/reports/batch_id={batch_id}")
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/progress/batch_id={batch_id}")
    state.write.mode("overwrite").parquet(f"{folder}/state/batch_id={batch_id}")


def finished_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All reports of a night: each finished area once, with the number of its batch."""
    return spark.read.parquet(f"{folder}/reports")


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """How far the count was after each batch."""
    return spark.read.schema(PROGRESS_ROW + ", batch_id bigint").parquet(f"{folder}/progress")


def night_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a night that could not be read (``batch_id``, ``file``, ``snapshot_ts``, ``problems``, ``line``)."""
    landed = spark.read.option("basePath", f"{folder}/landed").parquet(f"{folder}/landed").where("rejected = 'true'")
    return landed.select("batch_id", "file", "snapshot_ts", F.col("_problems").alias("problems"), F.col("_line").alias("line"))


def all_counted(spark: SparkSession, folder: str) -> bool:
    """Is everything counted?"""
    return not read_if_there(spark, f"{folder}/progress", PROGRESS_ROW).where("fertig").isEmpty()


def end_when_counted(spark: SparkSession, query: StreamingQuery, folder: str, poll_seconds: float = 1.0) -> None:
    """Wait until all is counted and stop the query between two batches; returns when it has ended."""
    while query.isActive and not query.awaitTermination(poll_seconds):
        if not query.status["isTriggerActive"] and all_counted(spark, folder):
            query.stop()


def run_count(stream: DataFrame, folder: str, start: str, c: Counting, available_now: bool = True, process=None, **gate) -> StreamingQuery:
    """Follow a stream of snapshots below ``folder`` until all is counted.

    Runs ``process(snapshot, batch_id)`` for each newer snapshot, then the bookkeeping. With ``available_now`` the
    query handles what is there; otherwise it goes on, and this call returns when the count has ended.
    """
    def handle(snapshot: DataFrame, batch_id: int) -> None:
        spark = snapshot.sparkSession
        done = read_if_there(spark, f"{folder}/progress/batch_id={batch_id - 1}", PROGRESS_ROW).where("fertig").first()
        if done:  # other files of the snapshot that ends the count still count
            snapshot = snapshot.where(F.col("snapshot_ts") == F.lit(done.snapshot_ts).cast("timestamp_ntz"))
        newest = snapshot.agg(F.max("snapshot_ts").alias("ts")).first().ts
        if newest is not None:
            snapshot = snapshot.where(F.col("snapshot_ts") == F.lit(newest).cast("timestamp_ntz"))
            if process:
                process(snapshot, batch_id)
        follow_count(snapshot, batch_id, folder, c)

    query = gate_snapshots(stream, handle, folder, start, available_now=available_now, **gate)
    if not available_now:
        end_when_counted(stream.sparkSession, query, folder)
    return query


def publish_snapshot(snapshot: DataFrame, batch_id: int, election: Election, folder: str, imprint: Imprint, area_files: bool) -> None:
    """Long tables of a snapshot, and a version with the areas that changed."""
    spark = snapshot.sparkSession
    newest = snapshot.agg(F.max("snapshot_ts").alias("ts")).first().ts
    ts = F.lit(newest).cast("timestamp_ntz")
    work = f"{folder}/lang/version={batch_id}"
    tables = long_tables(land(snapshot, work), election)
    together([partial(sinks.write_long_table, t, f"{work}/{name}") for name, t in tables.items()])
    stored = {name: spark.read.schema(t.schema).parquet(f"{work}/{name}") for name, t in tables.items()}
    rows, documents = published_with_state(stored, election, ts, imprint)
    publish(spark, f"{folder}/out", batch_id, rows, documents, area_files)


def run_night(spark: SparkSession, landing: str, election: Election, folder: str, imprint: Imprint, columns: Sequence[str] | None = None,
              available_now: bool = True, area_files: bool = True, files_per_trigger: int = 1, max_rejects: int | None = None,
              main_direct: Sequence[str] | None = None, main_lists: Sequence[str] | None = None) -> StreamingQuery:
    """Watch a landing folder of snapshot files through a night; see the module.

    Outputs are read by ``tally.plans.versions``, the rest by the functions here. ``max_rejects`` stops the
    night at a snapshot with more unreadable lines; rejects of batch n stay below ``landed/batch_id=n``.
    """
    columns = list(columns or feed_columns())
    direct = main_direct if main_direct is not None else election.comparable_direct[:7]
    lists = main_lists if main_lists is not None else election.comparable_lists[:7]
    c = Counting(shares=share_columns(columns, direct, lists))

    def landed(batch: DataFrame, batch_id: int) -> DataFrame:
        return land_checked(timed_checked(batch, columns), f"{folder}/landed/batch_id={batch_id}", max_rejects).rows

    process = partial(publish_snapshot, election=election, folder=folder, imprint=imprint, area_files=area_files)
    return run_count(feed_stream(spark, landing, columns, files_per_trigger), folder, imprint.start, c, available_now, process,
                     land=landed, part="file")
