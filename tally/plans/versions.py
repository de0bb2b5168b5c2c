"""Outputs as versions: only areas that changed are written, and a pointer moves when all is there.

``areas/<kind>/version=<n>`` has one row an area: its name, the digest of its content, the version since
which it has that content, and the content itself if that is version ``n``. The pointer is the
highest version listed below ``pointer``; it is written after everything else, so a job that is
killed leaves the outputs of the version before whole, and one that is run again replaces what
it left. Kinds are ``tabellen/<table>`` and ``dokumente/<table>``. With area files, the areas that
changed are also written as files below ``<kind>/version=<n>``, to be copied to where they are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.cleaning import quoted
from tally.session import together
from tally.sources import sinks
from tally.sources.archive import read_if_there

INDEX = "fname string, digest string, since bigint"


def current_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The version that is published; with ``below`` the last one before that number."""
    done = read_if_there(spark, f"{root}/pointer", "version bigint")
    return (done if below is None else done.where(F.col("version") < below)).agg(F.max("version")).first()[0]


def _contents(df: DataFrame, order: str | None) -> DataFrame:
    """One row an area (``fname``, ``rows``, ``digest``); an area's rows are one ballot."""
    names = [c for c in df.columns if c not in ("fname", order)]
    row = F.struct(*[quoted(c) for c in ([order] if order else []) + names])
    taken = df.groupBy("fname").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return taken.withColumn("digest", F.sha2(F.to_json("rows"), 256))


def _write_areas(df: DataFrame, root: str, kind: str, version: int, before: int | None, order: str | None) -> bool:
    """Write the areas of one kind; says if any has changed or gone since version ``before``."""
    spark = df.sparkSession
    old = spark.createDataFrame([], INDEX) if before is None else spark.read.schema(INDEX).parquet(f"{root}/areas/{kind}/version={before}")
    old = old.select("fname", F.col("digest").alias("_digest"), F.col("since").alias("_since"))
    same = F.col("digest").eqNullSafe(F.col("_digest"))
    out = _contents(df, order).join(old, "fname", "left").select(
        "fname", "digest", F.when(same, F.col("_since")).otherwise(F.lit(version)).alias("since"), F.when(~same, F.col("rows")).alias("rows"))
    path = f"{root}/areas/{kind}/version={version}"
    out.write.mode("overwrite").parquet(path)
    done = spark.read.schema(INDEX).parquet(path)
    gone = old.join(done, "fname", "left_anti")
    return not done.where(F.col("since") == version).isEmpty() or not gone.isEmpty()


def _changed(spark: SparkSession, root: str, kind: str, version: int) -> DataFrame:
    """Rows of the areas that changed in ``version``."""
    areas = spark.read.parquet(f"{root}/areas/{kind}/version={version}").where(F.col("since") == version)
    return areas.select("fname", F.inline("rows"))


def publish(spark: SparkSession, root: str, version: int, tables: Mapping[str, DataFrame], documents: Mapping[str, DataFrame],
            area_files: bool = True) -> bool:
    """Publish tables (``fname``, ``zeile``, …) and documents (``fname``, ``document``) as ``version``.

    Areas are compared with the last version before. If none has changed nothing is published and
    the result is False. Versions must rise; a version that was published in part is replaced.
    """
    before = current_version(spark, root, version)
    kinds = {**{f"tabellen/{n}": (t, "zeile") for n, t in tables.items()},
             **{f"dokumente/{n}": (t.select("fname", "document"), None) for n, t in documents.items()}}
    changed = together([partial(_write_areas, t, root, kind, version, before, order) for kind, (t, order) in kinds.items()])
    if not any(changed):
        return False
    if area_files:
        jobs = []
        for kind, has in zip(kinds, changed):
            if has:
                rows, path = _changed(spark, root, kind, version), f"{root}/{kind}/version={version}"
                jobs.append(partial(sinks.write_area_documents, rows, path) if kind.startswith("dokumente") else partial(sinks.write_area_tables, rows, path, order=["zeile"]))
        together(jobs)
    spark.range(1).select(F.current_timestamp().alias("published")).coalesce(1).write.mode("overwrite").parquet(f"{root}/pointer/version={version}")
    return True


def current(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Published rows of one kind, of all areas: each from the version that last changed it."""
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published below {root}")
    index = spark.read.schema(INDEX).parquet(f"{root}/areas/{kind}/version={version}")
    used = [r.since for r in index.select("since").distinct().collect()]  # one for each version in use
    bodies = spark.read.option("basePath", f"{root}/areas/{kind}").parquet(*[f"{root}/areas/{kind}/version={v}" for v in used])
    own = bodies.where("version = since AND rows IS NOT NULL").select("fname", "since", "rows")
    return own.join(index.select("fname", "since"), ["fname", "since"], "left_semi").select("fname", F.inline("rows"))
