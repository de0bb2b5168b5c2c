"""A counting night: archive with a log, rejects, versions, finished areas, progress and the end."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_live import IMPRINT, candidates, g_baseline, names, night, snapshot, wk_baseline  # noqa: F401  fixtures

from fixtures import COLUMNS, feed_text
from tally.catalog import QUERIES, streams
from tally.operators import windows
from tally.plans import dimensions, versions
from tally.sources import archive, rejects
from tally.sources.snapshots import _text_options, _text_schema
from tally.streaming import night as N
from tally.streaming import snapshots as S
from tally.streaming.watch import FreshnessListener

SCHEMA = "area_key string, gebietstyp string, stimmbezirke bigint, gezaehlt bigint, a bigint, snapshot_ts timestamp_ntz"


def counting():
    return N.Counting("area_key", "gebietstyp", "stimmbezirke", "gezaehlt", shares={"a (%)": F.col("a") * 10.0})


def counted(spark, hour, total=9, **areas):
    kinds = {"a": "VF", "b": "KS", "c": "WK", "sb": "SB"}
    rows = [(k, kinds[k], 3, n, n) for k, n in areas.items()] + [("0", "LD", total, sum(areas.values()), 0)]
    df = spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])
    return df.withColumn("snapshot_ts", F.lit(f"2023-10-08 {hour:02}:00:00").cast("timestamp_ntz"))


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, work, **more):
    return N.run_count(S.snapshot_stream(spark, folder, SCHEMA), work, "2023-10-08 17:00:00", counting(), **more)


def test_a_part_is_archived_once(spark, tmp_path):
    root, rows = str(tmp_path), counted(spark, 19, a=1, b=2)
    both = rows.unionByName(counted(spark, 20, a=1)).withColumn("file", F.lit("x"))
    assert [t.hour for t in archive.add(both, root, 0, part="file")] == [19, 20]
    assert [t.hour for t in archive.add(both, root, 0, part="file")] == [19, 20]  # the batch is replayed
    assert archive.add(both.orderBy(F.desc("area_key")), root, 1, part="file") == []
    more = counted(spark, 19, c=3).unionByName(counted(spark, 19, c=3)).withColumn("file", F.lit("y"))  # rows may repeat in a part
    [ts] = archive.add(more, root, 2, part="file")
    assert archive.read(spark, root, ts, rows.schema).count() == 3 + 4
    assert archive.log(spark, root).agg(F.sum("n_rows")).first()[0] == 3 + 2 + 4
    assert archive.read_newest(spark, root, rows.schema).count() == 2
    assert archive.read_newest(spark, str(tmp_path / "none"), rows.schema).count() == 0
    assert archive.add(rows.limit(0), root, 3) == []


def test_finished_areas_are_reported_once_with_replays(spark, tmp_path):
    work = str(tmp_path)
    stages = [counted(spark, 18, a=0, b=3, c=0), counted(spark, 19, a=3, b=3, c=2, sb=3), counted(spark, 20, total=8, a=3, b=2, c=3)]
    for k, stage in enumerate(stages):
        N.follow_count(stage, k, work, counting())
        N.follow_count(stage, k, work, counting())
    got = {(r.area_key, r.batch_id, r["a (%)"]) for r in N.finished_reports(spark, work).collect()}
    assert got == {("a", 1, 30.0), ("c", 2, 30.0)}
    rows = N.progress(spark, work).orderBy("batch_id").collect()
    assert [(r.gezaehlt, r.neu, r.fertig) for r in rows] == [(3, 3, False), (11, 8, True), (8, -3, True)]


def test_night_ends_by_itself(spark, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    for hour, areas, total in ((18, {"a": 1, "b": 0}, 9), (19, {"a": 3, "b": 2}, 5), (20, {"a": 3, "b": 3}, 9)):
        land(counted(spark, hour, total, **areas), folder)
    query = run(spark, folder, work, available_now=False)
    assert not query.isActive
    rows = [(r.snapshot_ts.hour, r.gezaehlt, r.neu) for r in N.progress(spark, work).orderBy("batch_id").collect()]
    assert rows[:2] == [(18, 1, 1), (19, 5, 4)] and all(r == (19, 5, 0) for r in rows[2:])
    assert [r.area_key for r in N.finished_reports(spark, work).collect()] == ["a"]


def outputs(spark, root):
    return {(r.fname, r.zeile): r.stimmen for r in versions.current(spark, root, "tabellen/t").collect()}


def test_versions_hold_what_changed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def publish(version, **areas):
        rows = spark.createDataFrame([(f, i, n) for f, votes in areas.items() for i, n in enumerate(votes)], "fname string, zeile int, stimmen bigint")
        text = rows.groupBy("fname").agg(F.concat(F.lit("doc "), F.sum("stimmen").cast("string")).alias("document"))
        return versions.publish(spark, root, version, {"t": rows}, {"t": text})

    def files(version):
        return {p.parent.name for p in tmp_path.glob(f"tabellen/t/version={version}/fname=*/*.csv")}

    assert publish(0, x=[1, 2], y=[5]) and files(0) == {"fname=x", "fname=y"}
    assert not publish(1, x=[1, 2], y=[5]) and files(1) == set() and versions.current_version(spark, root) == 0
    assert publish(2, x=[1, 3], y=[5], z=[0]) and files(2) == {"fname=x", "fname=z"}
    before = {("x", 0): 1, ("x", 1): 3, ("y", 0): 5, ("z", 0): 0}
    assert outputs(spark, root) == before
    with monkeypatch.context() as m:  # killed before the pointer moves, with all or a part of the files written
        m.setattr(versions.sinks, "write_area_documents", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish(3, x=[9], y=[9])
    assert outputs(spark, root) == before
    assert publish(3, x=[9], y=[5]) and outputs(spark, root) == {("x", 0): 9, ("y", 0): 5}  # run again; z is gone
    assert {r.fname: r.document for r in versions.current(spark, root, "dokumente/t").collect()} == {"x": "doc 9", "y": "doc 5"}


def spoilt():
    lines = feed_text().splitlines()
    lines[4] = "K2" + lines[4]  # the second constituency's key
    lines[5] = lines[5].replace(";4500;", ";45O0;")
    lines[7] = lines[7].replace(";99;", ";9,5;")  # a count that is not whole
    return "\n".join([*lines, ";" * (len(COLUMNS) - 1), ""])


def test_rejects_are_listed_and_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text(spoilt(), encoding="utf-8")
    got = rejects.read_checked(spark, str(tmp_path / "a.csv"), str(tmp_path / "landed"))
    assert got.counts == {"lines": 10, "rejects": 3, "bad_keys": 1, "bad_counts": 2}
    found = {r.line.split(";")[1]: sorted(r.problems) for r in got.rejects.collect()}
    assert found == {"Auenkreis II": ["key"], "Altenfurt, Stadt": ["Wählerinnen und Wähler"], "Vielstadt": ["gültige Wahlkreisstimmen", "CDU Wahlkreisstimmen"][::-1]}
    assert got.rows.count() == 7 and "_problems" not in got.rows.columns
    with pytest.raises(rejects.TooManyRejects, match="3 of 10"):
        rejects.read_checked(spark, str(tmp_path / "a.csv"), str(tmp_path / "again"), limit=2)
    raw = _text_options(spark.read.schema(_text_schema(COLUMNS)), ";").csv(str(tmp_path / "a.csv"))
    assert rejects.land_checked(rejects.checked_rows(raw.limit(0), COLUMNS), str(tmp_path / "none")).counts["lines"] == 0


def test_whole_night(spark, night, tmp_path):  # noqa: F811
    """A late snapshot, one that comes twice, the end of the count, and one after it with lines that cannot be read."""
    landing, work = tmp_path / "landing", str(tmp_path / "work")
    landing.mkdir()
    done = feed_text().replace(";120;3;", ";120;120;").replace(";200;96;", ";200;200;")
    for k, (stand, text) in enumerate([("19:00:00", feed_text()), ("18:30:00", feed_text()), ("22:00:00", done), ("22:00:00", done), ("23:00:00", spoilt())]):
        (landing / f"{k}.csv").write_text(text.replace("20:15:00", stand), encoding="utf-8")
        os.utime(landing / f"{k}.csv", (1_700_000_000 + k, 1_700_000_000 + k))
    N.run_night(spark, str(landing), night, work, IMPRINT, main_direct=["CDU"], main_lists=["SPD"]).awaitTermination()
    out = f"{work}/out"
    assert versions.current(spark, out, "tabellen/land_landesstimmen").where("partei = 'CDU'").count() == 1
    text = versions.current(spark, out, "dokumente/land_landesstimmen").first().document
    assert "alle 200 Stimmbezirke ausgezählt" in text and versions.current_version(spark, out) == 2
    reports = N.finished_reports(spark, work).collect()
    assert [(r.area_key, r.batch_id, r["CDU Wahlkreisstimmen (%)"] is not None) for r in reports] == [("00100000000", 2, True)]
    assert [(r.batch_id, r.gezaehlt, r.neu) for r in N.progress(spark, work).orderBy("batch_id").collect()] == [
        (0, 96, 96), (1, 96, 0), (2, 200, 104), (3, 200, 0), (4, 200, 0)]
    assert archive.log(spark, work).count() == 4  # one snapshot came twice
    assert [r.batch_id for r in N.night_rejects(spark, work).collect()] == [4, 4, 4]


def test_snapshots_land_in_several_files(spark, monkeypatch, tmp_path):
    """Tasks write a snapshot's files side by side, as many for each snapshot; a trigger reads a whole one."""
    monkeypatch.setattr(streams, "SNAPSHOT_FILE", 100)
    large, small = spark.range(350).selectExpr("id AS k"), spark.range(20).selectExpr("id AS k")
    files = streams.land_texts([(large, str(tmp_path / "0"), "08.10.2023 18:30:00"), (small, str(tmp_path / "1"), "08.10.2023 20:15:00")])
    assert files == 4
    for k, n in (("0", 350), ("1", 20)):
        parts = [p.read_text().splitlines() for p in (tmp_path / k).glob("part-*")]
        assert len(parts) == 4 and all("Stand: 08.10.2023" in p[0] and p[1] == "k" for p in parts)
        assert sorted(int(x) for p in parts for x in p[2:]) == list(range(n))
    assert streams.land_texts([(small.limit(0), str(tmp_path / "2"), "08.10.2023 20:15:00")]) == 1


def test_night_of_snapshots_in_several_files(spark, monkeypatch):
    """The state's document is the same however many files a snapshot has, and no trigger sees part of one."""
    seen, follow = [], N.follow_count
    monkeypatch.setattr(N, "follow_count", lambda snapshot, batch_id, *more: (seen.append(snapshot.count()), follow(snapshot, batch_id, *more)))
    one = QUERIES["e03_night_state_output"](spark, "/root/testdata/sf0.001").collect()
    whole, seen[:] = list(seen), []
    monkeypatch.setattr(streams, "SNAPSHOT_FILE", 60)
    assert QUERIES["e03_night_state_output"](spark, "/root/testdata/sf0.001").collect() == one and one
    assert len(whole) == 3 and seen == whole


@pytest.mark.parametrize("value", ["id % 7", "CASE WHEN id % 2 = 0 THEN 5 ELSE id END", "CAST(hash(id) AS double)"])
def test_quintiles_are_found_by_counting(spark, monkeypatch, value):
    """Small limits, so that intervals shrink over rounds; half of the rows may share a value."""
    monkeypatch.setattr(windows, "SORTED", 300)
    monkeypatch.setattr(windows, "SAMPLED", 200)
    df = spark.range(5_003).select(F.expr(value).alias("v"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    got = {r.k: r.t for r in windows.ntile(df, "v", ["k"], 5, "t").collect()}
    assert got == {r.k: r.t for r in df.selectExpr("k", "ntile(5) OVER (ORDER BY v, k) AS t").collect()}


def test_order_statistics_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(windows, "SORTED", 10)
    monkeypatch.setattr(windows, "SAMPLED", 20)
    df = spark.createDataFrame([(None,)] * 30 + [(1,)] * 500 + [(2,)] * 3, "v int")
    assert windows.order_statistics(df, ["v"], [1, 30, 31, 530, 531, 533]) == {1: (None,), 30: (None,), 31: (1,), 530: (1,), 531: (2,), 533: (2,)}
    with pytest.raises(ValueError, match="ranks"):
        windows.order_statistics(df, ["v"], [534])


def test_idle_stream_turns_stale_and_back(spark):
    listener, spoken = FreshnessListener(), datetime(2023, 10, 8, 20, 0, 0)

    def stale(seconds):
        return listener.status(spark, spoken + timedelta(seconds=seconds)).first().stale

    listener._note("q", "started", spoken - timedelta(seconds=50))
    listener._note("q", "progress", spoken, 3)
    assert not stale(120) and stale(121)
    listener._note("q", "idle", spoken + timedelta(seconds=120))
    listener._note("q", "empty", spoken + timedelta(seconds=120))
    assert stale(121)  # triggers that find nothing are no news
    listener._note("q", "progress", spoken + timedelta(seconds=121), 4)
    assert not stale(121) and listener.rows_read() == 7


def test_ids_last(spark):
    areas = lambda *ids: dimensions.build_registry(spark.createDataFrame([(i, "g") for i in ids], "id string, typ string"), ["direkt"])
    ids = lambda df: {r.id: r.chart_id for r in df.collect()}
    first = dimensions.lasting_ids(areas("2", "4"))
    held = dimensions.held_ids(first)
    second = dimensions.lasting_ids(areas("1", "2", "4"), held)
    assert ids(first) == {"2": "o000001", "4": "o000002"} and ids(second) == {**ids(first), "1": "o000003"}
    held = dimensions.held_ids(dimensions.lasting_ids(areas("1"), dimensions.held_ids(second, held)), held)
    third = dimensions.lasting_ids(areas("3", "4"), dimensions.held_ids(second, held))
    assert ids(third) == {"4": "o000002", "3": "o000004"}
    assert ids(dimensions.lasting_ids(areas("1").limit(0))) == {}


def test_a_trigger_reads_a_whole_snapshot(spark, monkeypatch, tmp_path):
    """Snapshots that are written by many tasks lie in as many files as a trigger reads."""
    from tally.catalog import night as catalog

    rows = [(str(i), f"2024-01-{d:02d} 00:00:00") for d in (8, 15, 22) for i in range(40)]
    counts = spark.createDataFrame(rows, "area_key string, ts string").selectExpr("area_key", "CAST(ts AS timestamp_ntz) AS snapshot_ts").repartition(4)
    monkeypatch.setattr(catalog, "weekly_counts", lambda spark, sf: counts)
    monkeypatch.setattr(catalog, "SNAPSHOT_FILE", 25, raising=False)
    folder, _, *files = catalog.landed_in_order(spark, "")
    by_file = spark.read.parquet(folder).selectExpr("_metadata.file_path AS file", "snapshot_ts").distinct().groupBy("snapshot_ts").count().collect()
    assert len(by_file) == 5 and {r["count"] for r in by_file} == {files[0] if files else 1} == {2}
