import pytest
from pyspark.sql import functions as F

from tally.streaming import snapshots as S

SCHEMA = "area_key string, gebietstyp string, stimmbezirke bigint, gezaehlt bigint, snapshot_ts timestamp_ntz"


def snapshot(spark, hour, **counted):
    kinds = {"a": "VF", "b": "KS", "c": "WK", "sb": "SB"}
    data = [(k, kinds[k], 3, n) for k, n in counted.items()]
    df = spark.createDataFrame(data, "area_key string, gebietstyp string, stimmbezirke bigint, gezaehlt bigint")
    return df.withColumn("snapshot_ts", F.lit(f"2023-10-08 {hour:02}:00:00").cast("timestamp_ntz"))


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def keys(df):
    return sorted(r.area_key for r in df.collect())


def test_each_completed_area_is_reported_once(spark, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    initial = snapshot(spark, 18, a=0, b=3, c=0)
    stages = [snapshot(spark, 19, a=1, b=3, c=0, sb=3), snapshot(spark, 20, a=3, b=3, c=2), snapshot(spark, 21, a=3, b=3, c=3)]
    seen = []
    for stage in stages:  # every run picks up where the last one stopped
        land(stage, folder)
        S.run_newly_completed(S.snapshot_stream(spark, folder, SCHEMA), initial, work).awaitTermination()
        seen.append(keys(spark.read.schema(SCHEMA).parquet(f"{work}/out")))
    assert seen == [[], ["a"], ["a", "c"]]
    batch = S.newly_completed_batch(spark.read.parquet(folder), initial)
    assert {r.area_key: r.snapshot_ts.hour for r in batch.collect()} == {"a": 20, "c": 21}


def test_gate_drops_old_snapshots(spark, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    got = []

    def process(batch, batch_id):
        got.append(sorted({r.snapshot_ts.hour for r in batch.collect()}))

    for hour in (17, 19, 18, 19, 20):  # 17 is before the start, 18 arrives late, 19 comes twice
        land(snapshot(spark, hour, a=1), folder)
        stream = S.snapshot_stream(spark, folder, SCHEMA)
        S.gate_snapshots(stream, process, work, "2023-10-08 17:00:00").awaitTermination()
    assert got == [[], [19], [], [], [20]]


def test_snapshot_in_several_files(spark, tmp_path):
    folder, work, got = str(tmp_path / "in"), str(tmp_path / "work"), []

    def process(batch, batch_id):
        got.append(sorted(r.area_key for r in batch.collect()))

    for area in ("a", "b", "c"):
        land(snapshot(spark, 19, **{area: 1}), folder)
    S.gate_snapshots(S.snapshot_stream(spark, folder, SCHEMA, 1), process, work, "2023-10-08 17:00:00").awaitTermination()
    assert got[-1] == ["a", "b", "c"]


def test_newest_row_breaks_ties(spark):
    rows = snapshot(spark, 19, a=1).union(snapshot(spark, 19, a=3))
    assert S.latest_state(rows, ["area_key"], [F.col("gezaehlt").desc()]).first().gezaehlt == 3


def test_query_stops_when_all_is_counted(spark, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    land(snapshot(spark, 19, a=1), folder)
    state = {}

    def process(batch, batch_id):
        if batch.count():
            state["latest"] = S.latest_state(batch, ["area_key"], [F.col("gezaehlt")]).collect()

    stream = S.snapshot_stream(spark, folder, SCHEMA)
    query = S.gate_snapshots(stream, process, work, "2023-10-08 17:00:00", available_now=False)
    query.processAllAvailable()
    assert query.isActive
    land(snapshot(spark, 20, a=3), folder)
    S.stop_when_done(query, lambda: S.latest_state(spark.read.schema(SCHEMA).parquet(folder), ["area_key"], [F.col("gezaehlt")]), poll_seconds=1)
    assert not query.isActive


def test_progress_and_latest_state(spark):
    totals = snapshot(spark, 18, a=1).union(snapshot(spark, 19, a=1)).union(snapshot(spark, 20, a=3))
    delta = S.progress_delta(totals, ["area_key"])
    assert [r.neu for r in delta.orderBy("snapshot_ts").collect()] == [1, 0, 2]
    assert S.latest_state(totals, ["area_key"], [F.col("gezaehlt")]).first().gezaehlt == 3


@pytest.mark.parametrize("now,stale", [("2023-10-08 20:02:00", False), ("2023-10-08 20:02:01", True)])
def test_freshness(spark, now, stale):
    got = S.freshness(snapshot(spark, 20, a=1), "snapshot_ts", F.lit(now).cast("timestamp_ntz")).first()
    assert got.stale is stale and got.age_seconds == (121 if stale else 120)
