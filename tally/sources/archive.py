"""An archive of snapshots with a log: every part is stored once, and found by its snapshot's time.

Rows lie in ``rows/stand=<time>/part=<digest>``, one part for each piece in which a snapshot was
delivered. ``log/stand=<time>/batch_id=<n>`` lists the parts that batch ``n`` brought, and is
written after them: a part that is not in the log does not exist. A digest depends on the rows
of a part and not on their order, so a part that is delivered again, or a batch that is replayed,
adds nothing. Whoever reads a snapshot lists one folder, however many snapshots there are.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.cleaning import quoted
from tally.session import together

LOG = "snapshot_ts timestamp_ntz, stand string, digest string, n_rows bigint"
WHOLE = "all"


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet below ``path``, or no rows if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stand(ts: Column) -> Column:
    """A snapshot's time as the name of its folder."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss.SSSSSS")


def digests(rows: DataFrame, ts: str, part: str | None) -> DataFrame:
    """(``snapshot_ts``, ``stand``, ``digest``, ``n_rows``, ``part``) of each part of each snapshot in ``rows``.

    Sums of two independent hashes of each row: equal for the same rows in any order, repeated rows counted.
    """
    cells = [quoted(c) for c in rows.columns if c != part]
    first = F.sum(F.xxhash64(*cells).cast("decimal(38,0)"))
    second = F.sum(F.xxhash64(F.lit("second"), *cells).cast("decimal(38,0)"))
    made = rows.groupBy(F.col(ts).alias("snapshot_ts"), (F.col(part) if part else F.lit(WHOLE)).alias("part")).agg(
        F.count("*").alias("n_rows"), F.sha2(F.concat_ws("/", F.count("*"), first, second), 256).alias("digest"))
    return made.select("snapshot_ts", stand(F.col("snapshot_ts")).alias("stand"), "digest", "n_rows", "part")


def add(rows: DataFrame, root: str, batch_id: int, ts: str = "snapshot_ts", part: str | None = None) -> list[datetime]:
    """Archive the parts of a batch that are new; returns the times of the snapshots they add to.

    ``rows`` are read several times and must be stored. ``part`` names the column that says in
    which piece a row came (a file); rows of one snapshot without it are one piece. Rows without a time
    belong to no snapshot. A batch that is run again finds its own parts as it left them, and
    returns the same times.
    """
    spark = rows.sparkSession
    found = digests(rows.where(F.col(ts).isNotNull()), ts, part).collect()  # one row for each file of a batch
    seen = {(name, d.digest) for name in {r.stand for r in found}
            for d in _logged(spark, root, name).where(F.col("batch_id") < batch_id).select("digest").distinct().collect()}
    new = []
    for r in found:
        if (r.stand, r.digest) not in seen:
            new.append(r)
            seen.add((r.stand, r.digest))

    def write(r) -> None:
        own = rows.where((F.col(ts) == F.lit(r.snapshot_ts).cast("timestamp_ntz")) & (F.col(part).eqNullSafe(F.lit(r.part)) if part else F.lit(True)))
        (own.drop(part) if part else own).write.mode("overwrite").parquet(f"{root}/rows/stand={r.stand}/part={r.digest}")

    together([partial(write, r) for r in new], at_once=8)
    for name in sorted({r.stand for r in new}):
        lines = [(r.snapshot_ts, r.stand, r.digest, r.n_rows) for r in new if r.stand == name]
        spark.createDataFrame(lines, LOG).drop("stand").coalesce(1).write.mode("overwrite").parquet(f"{root}/log/stand={name}/batch_id={batch_id}")
    return sorted({r.snapshot_ts for r in new})


def _logged(spark: SparkSession, root: str, name: str) -> DataFrame:
    fields = "snapshot_ts timestamp_ntz, digest string, n_rows bigint, batch_id bigint"
    return read_if_there(spark, f"{root}/log/stand={name}", fields)


def log(spark: SparkSession, root: str) -> DataFrame:
    """All parts (``snapshot_ts``, ``digest``, ``n_rows``, ``stand``, ``batch_id``) of the archive."""
    return read_if_there(spark, f"{root}/log", "snapshot_ts timestamp_ntz, digest string, n_rows bigint, stand string, batch_id bigint")


def read(spark: SparkSession, root: str, ts: datetime, schema) -> DataFrame:
    """All rows of the snapshot of time ``ts`` that are archived so far; no rows if there is none."""
    name = spark.range(1).select(stand(F.lit(ts).cast("timestamp_ntz"))).first()[0]
    parts = [r.digest for r in _logged(spark, root, name).select("digest").distinct().collect()]  # the files of one snapshot
    paths = [f"{root}/rows/stand={name}/part={d}" for d in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_newest(spark: SparkSession, root: str, schema) -> DataFrame:
    """The archived snapshot of the latest time; no rows if the archive is empty."""
    newest = log(spark, root).agg(F.max("snapshot_ts")).first()[0]
    return spark.createDataFrame([], schema) if newest is None else read(spark, root, newest, schema)
