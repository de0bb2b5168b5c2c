"""Snapshot streams: gating, newly completed areas, progress, freshness.

Every snapshot replaces the one before; a row says where one area stands at
``snapshot_ts``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.functions.measures import is_complete
from tally.functions.text import age_seconds
from tally.operators.aggregates import first_by
from tally.operators.windows import previous
from tally.sources import archive
from tally.sources.archive import read_if_there

LEVELS = ("VF", "KS", "WK")


def snapshot_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Files that land in a folder, in order of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def _start(start: str) -> Column:
    return F.to_timestamp_ntz(F.lit(start), F.lit("yyyy-MM-dd HH:mm:ss"))


def gate_snapshots(stream: DataFrame, process: Callable[[DataFrame, int], None], folder: str, start: str,
                   ts: str = "snapshot_ts", available_now: bool = True,
                   prepare: Callable[[DataFrame], DataFrame] | None = None, part: str | None = None,
                   land: Callable[[DataFrame, int], DataFrame] | None = None) -> StreamingQuery:
    """Process only snapshots that are not older than the last one processed.

    A snapshot is all rows of one time, in however many files and batches they arrive: a
    batch that adds to the snapshot in progress gives ``process`` all its rows so far, so
    no result depends on how files are cut into batches. What a batch brings is archived below
    ``folder`` (``tally.sources.archive``), older snapshots too; these, and parts that were
    delivered before, are not processed. ``part`` names a column with the file of a row, so that a
    file that comes again is known in any batch. ``prepare`` may first turn the raw rows of a
    batch into rows with a time; ``land`` does so with the batch number and stores the rows. ``process`` also gets the batch number and must replace its
    output for a number it has seen (a batch may be replayed after a failure). A batch reads
    the gate of the batch before and the folder of one snapshot, whatever came earlier.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if land:
            staged = land(batch, batch_id)
        else:
            rows = prepare(batch) if prepare else batch
            rows.write.mode("overwrite").parquet(f"{folder}/staged")
            staged = session.read.schema(rows.schema).parquet(f"{folder}/staged")
        schema = staged.drop(part).schema if part else staged.schema
        last = session.range(1).select(_start(start)).first()[0]
        before = read_if_there(session, f"{folder}/gate/batch_id={batch_id - 1}", "snapshot_ts timestamp_ntz").first()
        added = [t for t in archive.add(staged, folder, batch_id, ts, part) if t > last and (before is None or t >= before[0])]
        fresh = [archive.read(session, folder, t, schema) for t in added]
        process(reduce(DataFrame.unionByName, fresh) if fresh else session.createDataFrame([], schema), batch_id)
        newest = added[-1] if added else before[0] if before else last
        session.createDataFrame([(newest,)], "snapshot_ts timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{folder}/gate/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def complete_areas(df: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Rows of fully counted areas of the reported levels."""
    done = is_complete(F.col("gezaehlt"), F.col("stimmbezirke"))
    return df.filter(F.col("gebietstyp").isin(*levels) & done)


def newly_completed(stream: DataFrame, initial: DataFrame, key: str = "area_key",
                    levels: Sequence[str] = LEVELS) -> DataFrame:
    """Areas that finish counting, each exactly once.

    Areas already complete in the initial snapshot are never reported. The state
    holds one key per finished area.
    """
    before = complete_areas(initial, levels).select(key)
    return complete_areas(stream, levels).join(before, key, "left_anti").dropDuplicates([key])


def newly_completed_batch(snapshots: DataFrame, initial: DataFrame, key: str = "area_key",
                          levels: Sequence[str] = LEVELS, ties: Sequence[Column] = ()) -> DataFrame:
    """Batch twin: the first snapshot row at which each area is complete; of several at one time the first by ``ties``,
    which default to the counts."""
    before = complete_areas(initial, levels).select(key)
    done = complete_areas(snapshots, levels).join(before, key, "left_anti")
    return first_by(done, [key], [F.col("snapshot_ts"), *(ties or [F.col("gezaehlt"), F.col("stimmbezirke")])])


def run_newly_completed(stream: DataFrame, initial: DataFrame, folder: str, key: str = "area_key") -> StreamingQuery:
    """Append newly completed areas to ``folder/out``, exactly once, over all files present."""
    return (
        newly_completed(stream, initial, key).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(availableNow=True).start()
    )


def progress_delta(totals: DataFrame, part: Sequence[str] = (), counted: str = "gezaehlt",
                   ts: str = "snapshot_ts") -> DataFrame:
    """Add ``neu``: precincts counted since the snapshot before (all of them at first)."""
    out = previous(totals, {"_before": counted}, list(part), [ts])
    return out.withColumn("neu", F.col(counted) - F.coalesce("_before", F.lit(0))).drop("_before")


def stop_when_done(query: StreamingQuery, totals: Callable[[], DataFrame], poll_seconds: int = 60) -> None:
    """End a running query once the state row says all precincts are counted.

    ``totals`` reads the current state row, as the number of precincts may change.
    """
    while query.isActive and not query.awaitTermination(poll_seconds):
        if totals().filter(F.col("gezaehlt") >= F.col("stimmbezirke")).limit(1).count():
            query.stop()


def latest_state(snapshots: DataFrame, key: Sequence[str], ties: Sequence[Column], ts: str = "snapshot_ts") -> DataFrame:
    """The newest row of each area; of several at one time the first by ``ties``."""
    return first_by(snapshots, key, [F.col(ts).desc(), *ties])


def freshness(df: DataFrame, ts: str, now: Column, max_age: int = 120, by: Sequence[str] = ()) -> DataFrame:
    """Age of the last update in seconds and whether it exceeds ``max_age``."""
    out = df.groupBy(*by).agg(F.max(ts).alias("last_ts"))
    aged = out.withColumn("age_seconds", age_seconds(now, F.col("last_ts")))
    return aged.withColumn("stale", F.col("age_seconds") > max_age)
