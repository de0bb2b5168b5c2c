import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tally.operators import aggregates as A
from tally.operators import cleaning as C
from tally.operators import joins as J
from tally.operators import ranking as K
from tally.operators import reshape as R
from tally.operators import windows as W
from tally.operators.documents import flatten_json


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)


@pytest.fixture
def history(spark):
    """One key holds most rows, values have gaps, one key and one place are null."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = rnd.choice(["hot"] * 6 + ["a", "b", None])
        value = rnd.choice([None, None, float(rnd.randint(1, 9))])
        data.append((key, rnd.randint(0, 200) if i % 50 else None, i, value))
    return spark.createDataFrame(data, "k string, pos int, id int, x double")


@pytest.mark.parametrize("part", [["k"], []])
@pytest.mark.parametrize("pieces", [None, 7, 1])
def test_cut_groups_give_what_plain_windows_give(history, part, pieces):
    order = ["pos", "id"]
    w = Window.partitionBy(*part).orderBy(*order)
    full = w.rowsBetween(Window.unboundedPreceding, 0)
    want = history.select(
        "id", F.last("x", True).over(full).alias("l"), F.lag("x").over(w).alias("p"), F.lead("x").over(w).alias("f"),
        F.coalesce("x", F.lag("x").over(w)).alias("s"), F.sum("x").over(full).alias("r"), F.row_number().over(w).alias("n"))
    got = history.withColumn("l", F.col("x"))
    got = W.locf(got, ["l"], part, order, pieces=pieces)
    got = W.previous(got, {"p": "x"}, part, order, pieces=pieces)
    got = W.following(got, {"f": "x"}, part, order, pieces=pieces)
    got = W.step_fill(got.withColumn("s", F.col("x")), ["s"], part, order, pieces=pieces)
    got = W.running(got, {"r": F.col("x")}, part, order, pieces=pieces)
    got = W.numbered(got, part, order, "n", pieces=pieces)
    assert rows(got, *want.columns) == rows(want)


def test_no_chunk_holds_the_hot_group(history):
    sizes = W.cut(history, ["k"], ["pos", "id"] if "id" in history.columns else ["pos"], 20).groupBy("k", "_chunk").count()
    biggest = sizes.agg(F.max("count")).first()[0]
    whole = history.groupBy("k").count().agg(F.max("count")).first()[0]
    assert biggest < whole / 5


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
def test_groups_are_cut_along_times_and_numbers(spark, kind):
    value = F.col("id") if kind == "bigint" else F.timestamp_seconds(F.col("id") * 40_000).cast(kind)
    df = spark.range(500).select("id", F.lit(0).alias("k"), value.alias("at"))
    got = W.numbered(df, ["k"], ["at", "id"], "n", pieces=5)
    assert got.filter(F.col("n") != F.col("id") + 1).count() == 0
    chunks = W.cut(df, ["k"], ["at", "id"], 12).groupBy("_chunk").count()
    assert chunks.count() >= 10 and chunks.agg(F.max("count")).first()[0] <= 84


def test_rows_at_one_point_or_ordered_by_text_are_cut_too(spark):
    df = spark.range(2000).select("id", F.lit(0).alias("k"), F.lit(5).alias("at"), F.format_string("%05d", "id").alias("name"),
                                  F.when(F.col("id") % 7 == 0, F.col("id")).alias("x"))
    for order in (["at", "id"], ["name"]):
        chunks = W.cut(df, ["k"], order, 20)
        sizes = chunks.groupBy("_chunk").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
        assert sizes[1] <= 200 and sizes[2] >= 18
        got = W.locf(W.numbered(df, ["k"], order, "n", pieces=3), ["x"], ["k"], order, pieces=3)
        assert got.filter((F.col("n") != F.col("id") + 1) | (F.col("x") != F.col("id") - F.col("id") % 7)).count() == 0


@pytest.mark.parametrize("n,count", [(5, 23), (5, 3), (4, 100), (3, 0)])
def test_ntile_as_the_sql_function(spark, n, count):
    rnd = random.Random(count)
    data = [(i, float(rnd.randint(0, 5)) if i % 4 else None) for i in range(count)]
    df = spark.createDataFrame(data, "id int, x double")
    known = df.filter("x IS NOT NULL")
    want = known.select("id", F.ntile(n).over(Window.orderBy("x", "id")).alias("q"))
    got = W.ntile(df, "x", ["id"], n, "q")
    assert rows(got.filter("x IS NOT NULL"), "id", "q") == rows(want)
    assert got.filter("x IS NULL AND q IS NOT NULL").count() == 0
    assert got.count() == count


def test_global_rank_of_equal_values(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("x"))
    ranked = W.global_rank(df, [F.col("x").asc(), F.col("id").desc()])
    assert ranked.filter(F.col("rank_all") != 1000 - F.col("id")).count() == 0


def test_zero_fill_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, None), (1, 2)], "`a.b` int, c int")
    assert rows(C.zero_fill(df, ["a.b"])) == [(0, None), (1, 2)]


def test_measure_columns_skip_totals_and_percentages(spark):
    df = spark.createDataFrame([(1,) * 5], "`gültige Landesstimmen` int, `SPD Landesstimmen` int, `SPD Landesstimmen (%)` int,"
                               " `KLIMALISTE WÄHLERL. Landesstimmen` int, wk int")
    assert C.measure_columns(df, " Landesstimmen") == {
        "SPD Landesstimmen": "SPD", "KLIMALISTE WÄHLERL. Landesstimmen": "KLIMALISTE WÄHLERL."}
    index = C.measure_index(df, " Landesstimmen", spark.createDataFrame([("KLIMALISTE WÄHLERL.",)], "partei string"))
    assert rows(index) == [("KLIMALISTE WÄHLERL.", 4, 2)]


def test_clean_numbers_and_rename(spark):
    df = spark.createDataFrame([("5", "•"), ("x", "7,5"), (None, "2")], "a_x_y string, b string")
    out = C.rename_header(C.clean_numbers(df, ["a_x_y", "b"]), {"_": " "})
    assert out.columns == ["a x_y", "b"]
    assert rows(out) == sorted([(5.0, None), (None, None), (None, 2.0)], key=repr)


def test_collapse_propagates_null(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "wk int, b int, c int")
    assert rows(C.collapse_columns(df, ["b", "c"], "Sonstige")) == [(1, 5), (1, None)]


def test_unpivot_keeps_nulls_and_order(spark):
    df = spark.createDataFrame([(1, 5, None)], "wk int, `B C.` int, A int")
    assert rows(R.unpivot_measures(df, ["wk"], ["B C.", "A"])) == [(1, "A", 2, None), (1, "B C.", 1, 5)]


def test_pivots(spark):
    long = spark.createDataFrame([(1, "A", 1, 0.5), (1, "B", 2, 0.7), (2, "A", 3, 0.1)], "wk int, partei string, stimmen int, prozent double")
    assert rows(R.pivot_measure(long, ["wk"], ["A", "B"])) == [(1, 1, 2), (2, 3, None)]
    wide = R.pivot_measures(long, ["wk"], ["A", "B"], ["stimmen", "prozent"])
    assert wide.columns == ["wk", "stimmen_A", "stimmen_B", "prozent_A", "prozent_B"]
    colours = R.colour_map(long.withColumn("f", F.lit("#fff")), ["wk"], "partei", "f")
    assert {r.wk: r.farben for r in colours.collect()} == {1: {"A": "#fff", "B": "#fff"}, 2: {"A": "#fff"}}


def test_candidates_without_name_drop_out(spark):
    votes = spark.createDataFrame([(1, "A", 5), (1, "B", 6), (1, "C", 7)], "wk int, partei string, stimmen int")
    cand = spark.createDataFrame([(1, "A", "Maier (A)"), (1, "B", None)], "wk int, partei string, name string")
    assert rows(J.with_candidates(votes, cand), "partei", "name") == [("A", "Maier (A)")]


def test_override_name_without_entry_is_null(spark):
    df = spark.createDataFrame([("1", "Alt-Stadt"), ("2", "X")], "ags string, g_name string")
    names = spark.createDataFrame([("1", "Neu"), ("1", "Neu")], "ags string, name string")
    assert rows(J.override_name(df, names, "ags", "name", "g_name"), "ags", "g_name") == [("1", "Neu"), ("2", None)]


def test_semi_anti_flag_and_fan_out(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert rows(J.keep_listed(df, other, "k")) == [(1,)]
    assert rows(J.drop_listed(df, other, "k")) == [(2,), (None,)]
    assert rows(J.flag_listed(df, other, "k", "da")) == [(1, True), (2, False), (None, False)]
    assert rows(J.join_fan_out(df, other, "k")) == [(1, "a"), (1, "b"), (2, None), (None, None)]


def test_patch_union(spark):
    base = spark.createDataFrame([(1, 10.0), (2, 20.0)], "wk int, x double")
    patch = spark.createDataFrame([(2, 99.0), (3, 7.0)], "wk int, x double")
    keys = spark.createDataFrame([(2,)], "wk int")
    assert rows(J.patch_union(base, patch, keys, "wk")) == [(1, 10.0), (2, 99.0)]


def test_empty_results(spark):
    areas = spark.createDataFrame([(1,), (2,)], "wk int")
    lists = spark.createDataFrame([("A",), ("B",)], "partei string")
    got = rows(J.empty_results(areas, lists), "wk", "partei", "stimmen", "prozent")
    assert got == [(w, p, 0, "0,0% (+0)") for w in (1, 2) for p in "AB"]


def test_volatility_and_strict_sum(spark):
    df = spark.createDataFrame([("x", 2.0), ("x", -3.0), ("y", 1.0), ("y", None)], "k string, d double")
    assert rows(A.volatility_by(df, ["k"], "d")) == [("x", 2.5), ("y", 0.5)]
    assert rows(df.groupBy("k").agg(A.strict_sum(F.col("d")).alias("s"))) == [("x", -1.0), ("y", None)]


def test_postal_quota(spark):
    cols = "ags string, g_name string, wahlbezirksnummer string, wahllokal string, wahlberechtigt int, waehler int, ungueltig_wk int, ungueltig_ls int"
    data = [("1", "S", "9001", "Rathaus", 0, 30, 1, 1), ("1", "S", "0001", "Schule", 100, 60, 2, 3),
            ("1", "S", "0002", "Briefwahl 1", 0, 10, 0, 0), ("1", "S", "0003", "Schule", 50, None, 9, 9),
            ("1", "S", "0004", None, 10, 0, 0, 0)]
    df = spark.createDataFrame(data, cols)
    assert rows(A.postal_quota(df, "ags")) == [("1", "S", 110, 100, 40, 3, 4, 40.0)]
    assert A.postal_quota(df, "ags", strict=True).first().briefwaehler is None
    assert A.overall_quota(A.postal_quota(df, "ags"), "briefwaehler", "waehler", "q").first().q == 40.0


def test_merge_recomputes_rates(spark):
    df = spark.createDataFrame([("633021", 100, 50, 1.0), ("633027", 300, 250, 2.0), ("1", 10, 5, 3.0)],
                               "ags string, wahlberechtigt int, waehler int, wahlbeteiligung double")
    cross = spark.createDataFrame([("633021", "633030"), ("633027", "633030")], "ags string, new_key string")
    rate = {"wahlbeteiligung": F.try_divide("waehler", "wahlberechtigt") * 100}
    assert rows(A.merge_entities(df, cross, "ags", ["wahlberechtigt", "waehler"], ratios=rate)) == [
        ("1", 10, 5, 50.0), ("633030", 400, 300, 75.0)]


def test_group_size_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, id int")
    assert rows(A.group_size(df, ["k"]), "id", "anzahl") == [(1, 1), (2, 2), (3, 2)]


def test_top_bottom_order_and_ties(spark):
    data = [("P", k, v) for k, v in [("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", None), ("e", 3.0)]]
    df = spark.createDataFrame(data, "partei string, ags string, prozent double")
    got = K.top_bottom_n(df, ["partei"], "prozent", ["ags"], 2).orderBy("zeile")
    assert [(r.ags, r.seite, r.rang) for r in got.collect()] == [
        ("a", "oben", 1), ("b", "oben", 2), ("e", "unten", 2), ("c", "unten", 1)]
    rest = K.remainder(df, ["partei"], ["ags"], [F.desc_nulls_last("prozent"), F.asc("ags")], 2)
    assert rows(rest, "ags") == [("c",), ("d",), ("e",)]


def test_limit_is_applied_before_the_shuffle(history):
    plan = K.top_n(history, ["k"], [F.asc("pos"), F.asc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_flatten_json(spark):
    doc = {"title": ["T"], "describe": {"intro": ["a", "b"], "deep": {"x": {"y": {"z": 1}}}}, "n": 3, "f": None, "o": {}}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "kein json"), (3, None)], "id int, doc string")
    got = {r.path: (r.name, r.value) for r in flatten_json(df, "doc").filter("id = 1").collect()}
    assert got["describe"] == ("describe", "") and got["o"] == ("o", "") and got["n"] == ("n", "3")
    assert got["describe/intro/0"] == ("intro", "a") and got["describe/intro/1"] == ("intro", "b")
    assert got["describe/deep/x/y"] == ("y", "") and got["describe/deep/x/y/z"] == ("z", "1")
    assert flatten_json(df, "doc").filter("id > 1").count() == 0
