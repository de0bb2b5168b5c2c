"""Snapshot streams over the events table: users play areas, events precincts, weeks snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.catalog import live as V
from tally.catalog import results as R
from tally.catalog.registry import query
from tally.operators.windows import running
from tally.plans import star
from tally.plans.star import table
from tally.session import shared_folder, store
from tally.sources.sinks import write_locale_text
from tally.streaming import snapshots as S
from tally.streaming.live import run_live

START = "2024-01-10 00:00:00"
SNAPSHOT_FILE = 250_000  # rows


def weekly(spark, sf) -> DataFrame:
    """A full snapshot per week: how many of its events each user has had by then."""
    events = table(spark, sf, "events").select("user_id", F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week"))
    weeks = events.agg(F.sequence(F.min("week"), F.max("week"), F.expr("INTERVAL 7 DAYS"))).scalar()
    counts = events.groupBy("user_id", "week").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("user_id").agg(F.sum("n").alias("stimmbezirke"))
    # every user appears in every snapshot, also in weeks without events
    grid = totals.select("user_id", "stimmbezirke", F.explode(weeks).alias("week"))
    filled = grid.join(counts, ["user_id", "week"], "left")
    seen = running(filled, {"gezaehlt": F.coalesce("n", F.lit(0))}, ["user_id"], ["week"], small_groups=True)
    return seen.select(
        F.col("user_id").cast("string").alias("area_key"), F.lit("VF").alias("gebietstyp"), "stimmbezirke", "gezaehlt",
        (F.col("week") + F.expr("INTERVAL 7 DAYS")).alias("snapshot_ts"))


WEEKLY_SQL = """WITH e AS (SELECT user_id, date_trunc('week', ts) :: TIMESTAMP AS week FROM events),
w AS (SELECT DISTINCT week FROM e),
tot AS (SELECT user_id, count(*) AS stimmbezirke FROM e GROUP BY user_id),
snap AS (SELECT CAST(t.user_id AS VARCHAR) AS area_key, stimmbezirke, w.week + INTERVAL 7 DAY AS snapshot_ts,
                (SELECT count(*) FROM e WHERE e.user_id = t.user_id AND e.week <= w.week) AS gezaehlt FROM tot t CROSS JOIN w),
erst AS (SELECT min(snapshot_ts) AS t0 FROM snap),
fertig AS (SELECT area_key, min(snapshot_ts) AS ts FROM snap WHERE gezaehlt = stimmbezirke GROUP BY area_key)"""


def landed(spark, sf) -> tuple[str, DataFrame]:
    """Write the weekly snapshots to a landing folder."""
    folder = shared_folder(spark, "landing")
    snapshots = weekly(spark, sf)
    snapshots.repartition("snapshot_ts").write.parquet(folder)
    return folder, spark.read.schema(snapshots.schema).parquet(folder)


def first_snapshot(snapshots: DataFrame) -> DataFrame:
    first = snapshots.agg(F.min("snapshot_ts")).scalar()
    return snapshots.filter(F.col("snapshot_ts") == first)


def land_texts(snapshots: Sequence[tuple[DataFrame, str, str]]) -> int:
    """Write snapshots (rows, folder, time) as locale text, one after the other; rows are read several times and must be stored.

    All lie in as many files each, as the largest needs, which is returned: tasks write them side by side, and a trigger
    that reads so many has a whole snapshot.
    """
    files = max(1, *[-(-df.count() // SNAPSHOT_FILE) for df, _, _ in snapshots])
    for df, folder, stand in snapshots:
        write_locale_text(df.repartition(files), folder, f"Muster;Stand: {stand}")
    return files


@query("e02_live_stream", V.LIST_SQL + V.RESULT.replace("*", "* EXCLUDE area_key"))
def live_stream(spark, sf):
    """Three snapshots land, the last one late, and are read one a trigger; shown is the newest one's long constituency table."""
    landing, work = shared_folder(spark, "landing"), shared_folder(spark, "night")
    before = store(star.area_counts(spark, sf, present=False), "before")
    then, now = store(star.feed(spark, sf, False, before), "then"), store(star.feed(spark, sf), "now")
    # each snapshot goes to its own folder below the landing folder
    files = land_texts([(feed, f"{landing}/{stand[-8:].replace(':', '')}", stand) for feed, stand in (
        (then, "08.10.2023 18:30:00"), (now, "08.10.2023 20:15:00"), (then, "08.10.2023 19:00:00"))])
    night = R.election(spark, sf, before)
    run_live(spark, f"{landing}/*", night, work, R.IMPRINT, columns=now.columns, area_files=False, files_per_trigger=files).awaitTermination()
    return spark.read.parquet(f"{work}/out/lang/kreise_landesstimmen").drop("snapshot_ts", "area_key")


@query("x01_gated_latest_state", WEEKLY_SQL + f"""
SELECT area_key, stimmbezirke, gezaehlt, strftime(snapshot_ts, '%Y-%m-%d') AS stand FROM snap
WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM snap) AND snapshot_ts > TIMESTAMP '{START}'""")
def gated_latest_state(spark, sf):
    """A stream that skips snapshots up to a start time and keeps the latest state of each area."""
    folder, snapshots = landed(spark, sf)
    work = shared_folder(spark, "gated")

    def process(batch: DataFrame, batch_id: int) -> None:
        S.latest_state(batch, ["area_key"], [F.col("gezaehlt").desc()]).write.mode("overwrite").parquet(f"{work}/state/batch_id={batch_id}")

    stream = S.snapshot_stream(spark, folder, snapshots.schema, files_per_trigger=1)
    S.gate_snapshots(stream, process, work, START).awaitTermination()
    state = spark.read.schema(snapshots.schema).parquet(f"{work}/state")
    return S.latest_state(state, ["area_key"], [F.col("gezaehlt").desc()]).select(
        "area_key", "stimmbezirke", "gezaehlt", F.date_format("snapshot_ts", "yyyy-MM-dd").alias("stand"))


@query("x02_newly_completed_stream", WEEKLY_SQL + " SELECT area_key, stimmbezirke FROM fertig JOIN tot ON area_key = CAST(user_id AS VARCHAR) WHERE ts > (SELECT t0 FROM erst)")
def newly_completed_stream(spark, sf):
    """Every area is reported once, however many snapshots show it complete."""
    folder, snapshots = landed(spark, sf)
    work = shared_folder(spark, "completed")
    stream = S.snapshot_stream(spark, folder, snapshots.schema, files_per_trigger=2)
    S.run_newly_completed(stream, first_snapshot(snapshots), work).awaitTermination()
    return spark.read.schema(snapshots.schema).parquet(f"{work}/out").select("area_key", "stimmbezirke")


@query("x02_newly_completed_batch", WEEKLY_SQL + """
SELECT area_key, strftime(ts, '%Y-%m-%d') AS stand FROM fertig WHERE ts > (SELECT t0 FROM erst)""")
def newly_completed_batch(spark, sf):
    snapshots = weekly(spark, sf)
    done = S.newly_completed_batch(snapshots, first_snapshot(snapshots))
    return done.select("area_key", F.date_format("snapshot_ts", "yyyy-MM-dd").alias("stand"))


@query("x03_progress_delta", """
WITH d AS (SELECT o_orderpriority, o_orderdate AS tag, count(*) AS n FROM orders GROUP BY ALL),
c AS (SELECT o_orderpriority, tag, CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY tag) AS BIGINT) AS gezaehlt FROM d)
SELECT o_orderpriority, strftime(tag, '%Y-%m-%d') AS tag, gezaehlt,
       gezaehlt - lag(gezaehlt, 1, 0) OVER (PARTITION BY o_orderpriority ORDER BY tag) AS neu FROM c""")
def progress_delta(spark, sf):
    daily = table(spark, sf, "orders").groupBy("o_orderpriority", F.col("o_orderdate").alias("snapshot_ts")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = running(daily, {"gezaehlt": F.col("n")}, ["o_orderpriority"], ["snapshot_ts"])
    out = S.progress_delta(totals.drop("n"), ["o_orderpriority"])
    return out.select("o_orderpriority", F.date_format("snapshot_ts", "yyyy-MM-dd").alias("tag"), "gezaehlt", "neu")


@query("x06_latest_state", """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('day', ts) DESC, event_id) AS n FROM events) AS e WHERE n = 1""")
def latest_state(spark, sf):
    # Times to the day, so that there are ties.
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.date_trunc("day", "ts").alias("ts"))
    return S.latest_state(events, ["user_id", "event_type"], [F.col("event_id")], "ts").select("user_id", "event_type", "event_id")


@query("x07_freshness", """
SELECT event_type, date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-01-31 00:10:00') AS age_seconds,
       date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-01-31 00:10:00') > 600 AS stale
FROM events GROUP BY event_type""")
def freshness(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    now = F.lit("2024-01-31 00:10:00").cast("timestamp_ntz")
    return S.freshness(events, "ts", now, 600, ["event_type"]).drop("last_ts")
