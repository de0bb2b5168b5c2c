"""Removal of repeated runs of lines, in built-in expressions only.

Lines get ids (a 128-bit hash of the whole line), and every position in every document is the
start of a suffix of line ids. Prefix doubling sorts those suffixes into classes: two positions
are in one class of level k if the next 2**k lines are equal. A class is named by its first
position in the corpus, so that names say at once whether a run occurred before. Level k + 1
joins the names at distance 2**k and groups the pairs; positions that are alone in their class
drop out, so each level holds repeated runs only. A class at depth d is an interval of the
suffix array whose longest common prefix is d lines or more; only the order of suffixes inside
an interval, which no result depends on, is left open.

A run is removed where it has ``min_words`` words or more and occurred before. Any such run is
covered by its shortest stretches of ``min_words`` words: those that begin at a line and those
that end at one. So doubling goes as deep as the longest shortest stretch, and two overlapping
classes of level k decide stretches of 2**k to 2**(k+1) lines. The union of the stretches that
occurred before is the union of all maximal repeated runs, later copies, of that many words.

The corpus is ordered by (key, hash of the text); within a document a later repeat of an earlier
run is removed too. Rows equal in key and text are one document and get equal results. Null
texts stay null, empty texts stay empty, null keys come first. Nothing is cut or sampled, and
an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.session import store

MIN_WORDS = 50
BITMAP = 1 << 15  # bits of a bitmap of Spark's
BITMAPS = 512  # 2 MB in all, however many documents have runs


def lines_of(docs: DataFrame) -> DataFrame:
    """(``doc``, ``pos``, ``a``, ``b``, ``words``): two 64-bit hashes and the words of every line."""
    lines = docs.where("text IS NOT NULL AND text <> ''").select("doc", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    words = F.when(F.trim(F.translate("line", "\t\r\x0b\x0c", "    ")) == "", 0).otherwise(
        F.size(F.split(F.trim(F.translate("line", "\t\r\x0b\x0c", "    ")), " +")))
    return lines.select("doc", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.reverse("line")).alias("b"), words.alias("words"))


def _classes(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (``doc``, ``pos``, ``words``, ``by``) with ``name``, the class's first position; lone rows drop out.

    Counting combines before the shuffle, so a line that a third of all rows share arrives as
    one row a task; adaptive execution may split its side of the join.
    """
    at = F.struct("doc", "pos")
    first = rows.groupBy(*by).agg(F.min(at).alias("name"), F.max(at).alias("other")).where("name <> other").drop("other")
    return rows.join(first, by)


def repeated_stretches(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(``doc``, ``first``, ``last``): lines of stretches that occurred before, merged where they meet or overlap."""
    base = _classes(lines_of(docs), ["a", "b"]).select("doc", "pos", "words", F.struct(F.col("name.doc").alias("doc"), F.col("name.pos").alias("pos")).alias("name")).distinct()
    level = store(base, "line-classes")

    # Islands of neighbouring repeated lines, and the words in them up to and with each line.
    in_doc = Window.partitionBy("doc").orderBy("pos")
    island = Window.partitionBy("doc", "island").orderBy("pos")
    rows = (level.withColumn("island", F.col("pos") - F.row_number().over(in_doc))
            .withColumn("total", F.sum("words").over(island.rowsBetween(Window.unboundedPreceding, 0)))
            .select("doc", "pos", "words", "island", "total"))
    by_total = Window.partitionBy("doc", "island").orderBy("total")
    whole = Window.partitionBy("doc", "island")
    rows = (rows.withColumn("reach", F.min("pos").over(by_total.rangeBetween(min_words, Window.unboundedFollowing)))
            .withColumn("start", F.max("pos").over(by_total.rangeBetween(Window.unboundedPreceding, -min_words)) + 1)
            .withColumn("to", F.coalesce(F.lag("reach").over(island), F.when(F.col("pos") == F.min("pos").over(whole), F.min(F.when(F.col("total") >= min_words, F.col("pos"))).over(whole))))
            .withColumn("from", F.coalesce("start", F.when(F.col("total") >= min_words, F.min("pos").over(whole)))))
    ahead = rows.where("to IS NOT NULL").select("doc", F.col("pos").alias("first"), F.col("to").alias("last"))
    back = rows.where("from IS NOT NULL").select("doc", F.col("from").alias("first"), F.col("pos").alias("last"))
    stretches = store(ahead.unionByName(back).distinct().withColumn("n", F.col("last") - F.col("first") + 1)
                      .withColumn("k", F.floor(F.log2(F.col("n") + 0.5)).cast("int")), "stretches")

    deepest = stretches.agg(F.max("k")).first()[0]
    found = []
    for k in range((deepest if deepest is not None else -1) + 1):
        step = 1 << k
        at = stretches.where(F.col("k") == k)
        heads = at.join(level.select("doc", F.col("pos").alias("first"), F.col("name").alias("head")), ["doc", "first"])
        both = (heads.withColumn("second", F.col("last") - step + 1)
                .join(level.select("doc", F.col("pos").alias("second"), F.col("name").alias("tail")), ["doc", "second"]))
        first = both.groupBy("n", "head", "tail").agg(F.min(F.struct("doc", "first")).alias("origin"))
        again = both.join(first, ["n", "head", "tail"]).where(F.struct("doc", "first") > F.col("origin")).select("doc", "first", "last")
        found.append(store(again, "repeats"))
        if k < deepest:
            pair = Window.partitionBy("doc").orderBy("pos").rangeBetween(step, step)
            longer = level.withColumn("next", F.max("name").over(pair)).where("next IS NOT NULL").withColumnRenamed("name", "own")
            level = store(_classes(longer, ["own", "next"]).select("doc", "pos", "words", "name"), "line-classes")
    if not found:
        return stretches.select("doc", "first", "last").where("false")
    spans = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("doc").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (spans.withColumn("new", F.when(F.col("first") <= reached + 1, 0).otherwise(1))
              .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    return merged.groupBy("doc", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _place(doc: str = "doc") -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(BITMAP * BITMAPS))


def _split_by_runs(slim: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``slim`` that may have runs, and those that have none for sure, so that only the texts of the former are shuffled.

    A bit for each hash of a document with runs; where many documents share the bits, more rows go with the former.
    """
    at = _place()
    bitmaps = runs.select(at.alias("at")).groupBy((F.col("at") / BITMAP).cast("long").alias("_no")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("_bits"))
    marked = slim.withColumn("_at", at).withColumn("_no", (F.col("_at") / BITMAP).cast("long")).join(F.broadcast(bitmaps), "_no", "left")
    byte = F.expr(f"CAST(conv(hex(substring(_bits, CAST(_at % {BITMAP} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    may = F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))
    return marked.where(may).select(*slim.columns), marked.where(~may).select(*slim.columns)


def remove_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated runs cut out of ``text``, and with ``runs_removed``: arrays of (``first``, ``last``) lines, in order, empty if none.

    Lines are what line feeds part. The other columns stay; a column named ``runs_removed`` is replaced.
    """
    names = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    slim = plain.withColumn("doc", F.struct(F.col(names[key]).cast("long").alias("key"), F.xxhash64(names[text]).alias("copy")))
    spans = repeated_stretches(slim.select("doc", F.col(names[text]).cast("string").alias("text")), min_words)
    runs = spans.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs_removed"))
    runs = store(runs, "runs")
    may, without = _split_by_runs(slim, runs)
    joined = may.join(runs, "doc", "left").unionByName(without, allowMissingColumns=True)
    t = names[text]
    kept = F.expr(f"concat_ws('\n', filter(split({t}, '\n', -1), (l, i) -> NOT exists(runs_removed, r -> i BETWEEN r.first AND r.last)))")
    none = F.array().cast("array<struct<first:int,last:int>>")
    cut = joined.withColumns({t: F.when(F.col("runs_removed").isNotNull(), kept).otherwise(F.col(t)), "runs_removed": F.coalesce("runs_removed", none)})
    return cut.select(*[F.col(new).alias(old) for old, new in names.items() if old != "runs_removed"], "runs_removed")
