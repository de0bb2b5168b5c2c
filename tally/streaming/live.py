"""The counting night as a stream: every newer snapshot file runs one evaluation cycle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.plans.cycle import Election, run_cycle
from tally.plans.outputs import Imprint
from tally.sources.feed import feed_columns
from tally.sources.snapshots import feed_stream, timed_rows
from tally.streaming.snapshots import gate_snapshots


def publish_newest(newer: DataFrame, batch_id: int, election: Election, folder: str, imprint: Imprint,
                   area_files: bool) -> None:
    """Run the cycle for the newest snapshot of a batch; all outputs are replaced."""
    newest = newer.agg(F.max("snapshot_ts").alias("ts")).first().ts
    if newest is not None:
        ts = F.lit(newest).cast("timestamp_ntz")
        run_cycle(newer.sparkSession, newer.filter(F.col("snapshot_ts") == ts), election, folder, ts, imprint, area_files)


def run_live(spark: SparkSession, landing: str, election: Election, folder: str, imprint: Imprint,
             columns: Sequence[str] | None = None, available_now: bool = True, area_files: bool = True,
             files_per_trigger: int = 1) -> StreamingQuery:
    """Watch a landing folder of snapshot files and publish each newer one below ``folder``.

    A snapshot is one file, or several of the same time, in one trigger or in many: each that
    adds to it publishes all of it so far. Those older than the last published one, or not
    later than the begin of the count, are skipped. With ``available_now`` the files present are
    handled and the query ends.
    """
    columns = list(columns or feed_columns())
    process = partial(publish_newest, election=election, folder=f"{folder}/out", imprint=imprint, area_files=area_files)
    return gate_snapshots(
        feed_stream(spark, landing, columns, files_per_trigger), process, folder, imprint.start,
        available_now=available_now, prepare=partial(timed_rows, columns=columns))
