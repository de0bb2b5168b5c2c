import datetime as dt
import os
import time

import pytest
from fixtures import COLUMNS, feed_text
from pyspark.sql import functions as F

from tally.sources import sinks, snapshots, tables
from tally.sources.feed import PARTIES, feed_columns, feed_types


@pytest.fixture
def feed_file(tmp_path):
    path = tmp_path / "stand.csv"
    path.write_text(feed_text(), encoding="utf-8")
    return str(path)


def test_feed_header():
    assert len(COLUMNS) == 148 and len(PARTIES) == 29
    assert COLUMNS.index("CDU Wahlkreisstimmen") == 17 and COLUMNS.index("CDU Landesstimmen") == 79
    assert COLUMNS[141:143] == ["Anzahl Wahlbezirke", "Anzahl Wahlbezirke ausgezählt"]
    types = feed_types(COLUMNS)
    assert types["SPD Landesstimmen"] == "bigint" and types["SPD Landesstimmen (%)"] == "double"
    assert "Gebietsschlüssel" not in types


def test_read_snapshot(spark, feed_file):
    df = snapshots.read_snapshot(spark, feed_file)
    assert df.columns == COLUMNS and df.count() == 10
    ld = df.filter("Gebietstyp = 'LD'").first()
    assert ld["Gebietsschlüssel"] == "00000000000" and ld["Wahlberechtigte"] == 4000000
    assert ld["Wahlbeteiligung"] == 1.2 and ld["SPD Landesstimmen"] is None
    wk = df.filter("`Gebietsschlüssel` = '00200000000'").first()
    assert wk["GRÜNE Wahlkreisstimmen"] is None and wk["CDU Wahlkreisstimmen"] == 0


def test_files_with_other_headers_stop_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text(feed_text(), encoding="utf-8")
    (tmp_path / "b.csv").write_text(feed_text().replace("Wahllokal;", "Ort;"), encoding="utf-8")
    df = snapshots.read_snapshot(spark, str(tmp_path), feed_columns())
    with pytest.raises(Exception, match="unexpected header"):
        df.count()
    narrow = snapshots.read_snapshot(spark, str(tmp_path), feed_columns(), check_header=False)
    assert narrow.select("Gebietstyp").count() == 20


def test_missing_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("nur;ein;Banner\n")
    with pytest.raises(ValueError, match="no header"):
        snapshots.read_snapshot(spark, str(tmp_path))


def test_snapshot_time_from_banner_or_file(spark, tmp_path, feed_file):
    plain = tmp_path / "ohne.csv"
    plain.write_text("Gebietsschlüssel;x\n1;2\n")
    os.utime(plain, (1_700_000_000, 1_700_000_000))
    got = {os.path.basename(r.file): r.snapshot_ts for r in snapshots.snapshot_times(spark, str(tmp_path)).collect()}
    assert got["stand.csv"] == dt.datetime(2023, 10, 8, 20, 15)
    assert got["ohne.csv"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    lines = snapshots.with_snapshot_ts(spark.read.text(feed_file), feed_file)
    assert lines.select("snapshot_ts").distinct().collect()[0][0] == dt.datetime(2023, 10, 8, 20, 15)


def test_latest_snapshot(spark, tmp_path):
    assert snapshots.read_latest_snapshot(spark, str(tmp_path / "fehlt"), COLUMNS).count() == 0
    (tmp_path / "leer").mkdir()
    empty = snapshots.read_latest_snapshot(spark, str(tmp_path / "leer"))
    assert empty.columns == COLUMNS and empty.count() == 0
    folder = tmp_path / "archiv"
    (folder / "neu").mkdir(parents=True)
    (folder / "alt.csv").write_text(feed_text().replace("Land;LD", "Alt;LD"), encoding="utf-8")
    (folder / "neu" / "teil-0.csv").write_text(feed_text(), encoding="utf-8")
    old = time.time() - 1000
    os.utime(folder / "alt.csv", (old, old))
    assert snapshots.read_latest_snapshot(spark, str(folder)).filter("Gebietstyp = 'LD'").first()["Gebietsbezeichnung"] == "Land"


def test_sniff_and_read_tables(spark, tmp_path):
    (tmp_path / "us.csv").write_text("a,b\n1,2.5\n")
    (tmp_path / "de.csv").write_text("a;b\n1;1.002,5\nNA;x\n")
    us = tables.read_table(spark, str(tmp_path / "us.csv"), {"a": "int", "b": "double"})
    de = tables.read_table(spark, str(tmp_path / "de.csv"), {"a": "int", "b": "double"})
    assert us.collect() == [(1, 2.5)] and de.collect() == [(1, 1002.5), (None, None)]


def test_history_in_windows_encoding(spark, tmp_path):
    text = "Titel\nLfd;Wahlkreis;Name;Stimmen\n;;;Anzahl\n1;5;Groß–Gerau €;1.234\n2;;Fürth;x\n"
    (tmp_path / "alt.csv").write_bytes(text.encode("cp1252"))
    columns = {"lfd": "int", "wk": "int", "name": "string", "stimmen": "bigint"}
    got = tables.read_history(spark, str(tmp_path / "alt.csv"), columns, "lfd")
    assert got.collect() == [(1, 5, "Groß–Gerau €", 1234), (2, None, "Fürth", None)]


def test_headerless_and_key_values(spark, tmp_path):
    (tmp_path / "listen.csv").write_text("1; CDU ;Lang\n2;SPD;Lang\n")
    got = tables.read_headerless(spark, str(tmp_path / "listen.csv"), "id int, partei string, parteiname string")
    assert got.collect() == [(1, "CDU", "Lang"), (2, "SPD", "Lang")]
    kv = spark.createDataFrame([("n", "142"), ("t", "2023-10-08"), ("z", None)], "name string, value string")
    assert tables.typed_key_values(kv).select("num_value", "str_value").collect() == [(142.0, None), (None, "2023-10-08"), (None, None)]


def test_area_tables_and_documents(spark, tmp_path):
    df = spark.createDataFrame([("wk001_direkt", 2, "B", "5,0 (?)"), ("wk001_direkt", 1, "A", "42,5 (+10,1)"), ("wk002_direkt", 1, "C", "1")],
                               "fname string, zeile int, partei string, prozent string")
    sinks.write_area_tables(df, str(tmp_path / "t"), order=["zeile"])
    files = sorted((tmp_path / "t" / "fname=wk001_direkt").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text() == 'partei,prozent\nA,"42,5 (+10,1)"\nB,5,0 (?)\n'.replace("B,5,0 (?)", 'B,"5,0 (?)"')
    docs = df.select("fname", sinks.area_document(F.lit("T"), F.lit("I"), F.lit("N"), F.lit("b"), F.lit("s"), F.lit("u")).alias("document")).distinct()
    sinks.write_area_documents(docs, str(tmp_path / "d"))
    text = next((tmp_path / "d" / "fname=wk002_direkt").glob("*.txt")).read_text().strip()
    assert text == ('{"title":["T"],"describe":{"intro":["I"],"byline":["b"],"source-name":["s"],"source-url":["u"]},'
                    '"annotate":{"notes":["N"]}}')


def test_locale_text_reads_back(spark, feed_file, tmp_path):
    df = snapshots.read_snapshot(spark, feed_file)
    out = str(tmp_path / "export")
    sinks.write_locale_text(df.repartition(3), out, "Muster;Stand: 08.10.2023 21:00:00", {"Wahlbeteiligung": 2})
    back = snapshots.read_snapshot(spark, out)
    same = [c for c in COLUMNS if c not in ("Wahlbezirksnummer", "Wahllokal")]
    assert back.select(*[f"`{c}`" for c in same]).exceptAll(df.select(*[f"`{c}`" for c in same])).count() == 0
    assert back.count() == df.count()
    assert snapshots.snapshot_times(spark, out).first().snapshot_ts == dt.datetime(2023, 10, 8, 21)
