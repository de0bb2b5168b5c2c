"""Reading a feed with a reject channel: what cannot be read is listed and counted, never dropped or counted as 0.

A line is a banner, a header, blank, or data. Data whose key is not all digits, or with text in a
number column that is no number (no whole number in a count), is a reject. Rows and rejects are
written by one pass, which also counts them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tally.operators.cleaning import parse_numbers, quoted, tick
from tally.sources.feed import KEY, feed_types
from tally.sources.snapshots import BANNER, SEPARATOR, _text_options, _text_schema, banner_time, read_header

BAD_KEY = "key"


class TooManyRejects(ValueError):
    """More lines could not be read than the job allows."""


@dataclass(frozen=True)
class Landed:
    """``rows`` are typed; ``rejects`` have ``problems`` (``key``, or the names of columns) and ``line``; ``counts`` are of the pass."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def problems(raw: Sequence[str], key: str) -> Column:
    """Names of what is wrong in a row of text columns: ``key``, and number columns whose text is no number.

    Cells that are empty or the feed's null marker are null already, and no problem.
    """
    cells = ", ".join(f"struct({_literal(c)} AS name, {tick(c)} AS text, {str(t == 'bigint').lower()} AS whole)" for c, t in feed_types(raw).items())
    # One test for all columns, as text: as many columns of their own take long to plan.
    plain = "try_cast(translate(trim(c.text), ',.', '.') AS {0})"
    exact = plain.format("decimal(38,9)")
    unread = f"c.text IS NOT NULL AND trim(c.text) <> '' AND if(c.whole, coalesce({exact} <> floor({exact}) OR try_cast({exact} AS bigint) IS NULL, true), {plain.format('double')} IS NULL)"
    found = F.expr(f"transform(filter(array({cells}), c -> {unread}), c -> c.name)")
    bad_key = F.when(~F.coalesce(quoted(key).rlike("^[0-9]+$"), F.lit(False)), F.lit(BAD_KEY))
    return F.concat(F.array_compact(F.array(bad_key)), found)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def checked_rows(raw: DataFrame, columns: Sequence[str], key: str = KEY, separator: str = SEPARATOR) -> DataFrame:
    """Data lines as typed rows with ``_problems`` and, of rejects, ``_line``; banner, header and blank lines go.

    A header line that differs from ``columns`` stops the job. Other columns of ``raw`` stay as they are.
    """
    line = F.concat_ws(separator, *[F.coalesce(quoted(c), F.lit("")) for c in columns])
    header = F.concat_ws(separator, *[F.trim(quoted(c)) for c in columns])
    is_header = quoted(key) == key
    wrong = is_header & (header != F.lit(separator.join(columns)))
    is_digits = F.coalesce(quoted(key).rlike("^[0-9]+$"), F.lit(False))
    no_data = F.coalesce(is_header, F.lit(False)) | (~is_digits & line.rlike(BANNER)) | (F.trim(F.translate(line, separator, "")) == "")
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("unexpected header: "), header)).cast("boolean"))
    marked = raw.where(F.coalesce(checked, ~no_data)).withColumn("_problems", problems(columns, key))
    marked = marked.withColumn("_line", F.when(F.size("_problems") > 0, line))
    return parse_numbers(marked, feed_types(columns))


def land_checked(checked: DataFrame, folder: str, limit: int | None = None) -> Landed:
    """Write what :func:`checked_rows` gives below ``folder``, rows and rejects apart, and count them on the way.

    More than ``limit`` rejects stop the job; they are written nevertheless, so that they can be looked at.
    """
    spark = checked.sparkSession
    bad = F.size("_problems") > 0
    seen = Observation()
    counted = checked.withColumn("rejected", bad).observe(
        seen, F.count("*").alias("lines"), F.count_if(bad).alias("rejects"),
        F.count_if(F.array_contains("_problems", BAD_KEY)).alias("bad_keys"),
        F.count_if(F.size(F.array_remove("_problems", BAD_KEY)) > 0).alias("bad_counts"))
    counted.write.mode("overwrite").partitionBy("rejected").parquet(folder)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    if limit is not None and counts["rejects"] > limit:
        raise TooManyRejects(f"{counts['rejects']} of {counts['lines']} lines could not be read, {limit} are allowed; see {folder}/rejected=true")
    back = spark.read.schema(counted.schema).parquet(folder)
    names = [tick(c) for c in checked.columns if c not in ("_problems", "_line")]
    kept = [c for c in ("file", "snapshot_ts") if c in checked.columns]
    rejects = back.where("rejected").select(*kept, F.col("_problems").alias("problems"), F.col("_line").alias("line"))
    return Landed(back.where("NOT rejected").select(*names), rejects, counts)


def timed_checked(batch: DataFrame, columns: Sequence[str], key: str = KEY, separator: str = SEPARATOR) -> DataFrame:
    """:func:`checked_rows` of a batch of the feed stream, with the time of their file's banner and the file."""
    line = F.concat_ws(separator, *[quoted(c) for c in columns])
    is_digits = F.coalesce(quoted(key).rlike("^[0-9]+$"), F.lit(False))
    times = batch.groupBy("file").agg(F.coalesce(F.max(F.when(~is_digits, banner_time(line))), F.max("file_time")).alias("snapshot_ts"))
    return checked_rows(batch, columns, key, separator).join(times, "file").drop("file_time")


def read_checked(spark: SparkSession, path: str, folder: str, columns: Sequence[str] | None = None, limit: int | None = None,
                 key: str = KEY, separator: str = SEPARATOR) -> Landed:
    """One snapshot file (or folder) with its rejects; both are written below ``folder``."""
    columns = list(columns) if columns else read_header(spark, path, key, separator)
    raw = _text_options(spark.read.schema(_text_schema(columns)), separator).csv(path)
    return land_checked(checked_rows(raw, columns, key, separator), folder, limit)
