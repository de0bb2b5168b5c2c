"""Snapshot files: wide, locale-formatted text with a banner line and a header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.text import first_match, parse_german_datetime
from tally.operators.cleaning import parse_numbers, quoted
from tally.sources.feed import KEY, feed_columns, feed_types

# --- fixed values ---
SEPARATOR = ";"
NULL_MARKER = "NA"
BANNER = r"Stand: (.+)$"
# --------------------


def read_header(spark: SparkSession, path: str, key: str = KEY, separator: str = SEPARATOR) -> list[str]:
    """Column names: the first line that starts with the key column's name."""
    lines = spark.read.text(path).filter(F.trim("value").startswith(key + separator)).limit(1).collect()
    if not lines:
        raise ValueError(f"no header line starting with {key!r} in {path}")
    return [name.strip() for name in lines[0].value.split(separator)]


def _text_schema(columns: Sequence[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)


def snapshot_rows(raw: DataFrame, columns: Sequence[str], key: str = KEY,
                  separator: str = SEPARATOR, check_header: bool = True) -> DataFrame:
    """Typed data rows of raw text columns: drops banner and header lines, parses numbers.

    With ``check_header`` a header line that differs from ``columns`` stops the job:
    the files in one folder must agree on their columns. The check looks at all
    columns; switch it off for a query that needs only a few.
    """
    is_data = quoted(key).rlike("^[0-9]+$")
    if not check_header:
        return parse_numbers(raw.filter(is_data), feed_types(columns))
    header = F.concat_ws(separator, *[F.trim(quoted(c)) for c in columns])
    wrong = (quoted(key) == key) & (header != F.lit(separator.join(columns)))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("unexpected header: "), header)).cast("boolean"))
    return parse_numbers(raw.filter(F.coalesce(checked, is_data)), feed_types(columns))


def _text_options(reader, separator: str):
    """Reader options of the feed, for batch and stream readers."""
    return (
        reader.option("sep", separator).option("header", False)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .option("nullValue", NULL_MARKER).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    )


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  key: str = KEY, separator: str = SEPARATOR, check_header: bool = True) -> DataFrame:
    """One snapshot file (or folder) as typed rows; cells ``NA`` or empty are null."""
    columns = list(columns) if columns else read_header(spark, path, key, separator)
    raw = _text_options(spark.read.schema(_text_schema(columns)), separator).csv(path)
    return snapshot_rows(raw, columns, key, separator, check_header)


def banner_time(line: Column) -> Column:
    """Snapshot time from a banner line ``…;Stand: dd.mm.yyyy HH:MM:SS``."""
    return parse_german_datetime(first_match(line, BANNER, 1))


def snapshot_times(spark: SparkSession, path: str) -> DataFrame:
    """``file, snapshot_ts`` per file: the banner's time, or the file's own time without one."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_mtime"),
        banner_time(F.col("value")).alias("_ts"),
    )
    return lines.groupBy("file").agg(F.coalesce(F.max("_ts"), F.max("_mtime")).alias("snapshot_ts"))


def with_snapshot_ts(df: DataFrame, path: str) -> DataFrame:
    """Add the time of its file to each row of a table read from ``path``."""
    times = snapshot_times(df.sparkSession, path)
    return df.withColumn("file", F.col("_metadata.file_path")).join(times, "file", "left").drop("file")


def feed_stream(spark: SparkSession, folder: str, columns: Sequence[str], files_per_trigger: int = 1,
                separator: str = SEPARATOR) -> DataFrame:
    """Raw lines of the snapshot files landing in a folder, with their file and its time."""
    reader = spark.readStream.schema(_text_schema(columns)).option("maxFilesPerTrigger", files_per_trigger)
    raw = _text_options(reader, separator).csv(folder)
    return raw.select("*", F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_time"))


def timed_rows(batch: DataFrame, columns: Sequence[str], key: str = KEY, separator: str = SEPARATOR) -> DataFrame:
    """Typed rows of a batch of :func:`feed_stream` with the time of their file's banner."""
    line = F.concat_ws(separator, *[quoted(c) for c in columns])
    stand = F.when(~quoted(key).rlike("^[0-9]+$"), banner_time(line))
    times = batch.groupBy("file").agg(F.coalesce(F.max(stand), F.max("file_time")).alias("snapshot_ts"))
    return snapshot_rows(batch, columns, key, separator).join(times, "file").drop("file", "file_time")


def newest_entry(spark: SparkSession, folder: str) -> str | None:
    """Path of the file or subfolder of ``folder`` that changed last; None when there is none.

    A snapshot is one file, or one subfolder of part files. Only listings are read.
    """
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = files.load(root).select("path", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    below = F.substring_index(F.col("path"), root + "/", -1)
    entries = files.groupBy(F.substring_index(below, "/", 1).alias("entry")).agg(
        F.max("modificationTime").alias("changed"))
    newest = entries.orderBy(F.desc("changed"), F.desc("entry")).limit(1).collect()
    return f"{root}/{newest[0].entry}" if newest else None


def read_latest_snapshot(spark: SparkSession, folder: str, columns: Sequence[str] | None = None,
                         key: str = KEY) -> DataFrame:
    """The newest archived snapshot; an empty table with the feed's columns when there is none."""
    path = newest_entry(spark, folder)
    if path is not None:
        return read_snapshot(spark, path, columns, key)
    columns = list(columns or feed_columns())
    empty = spark.createDataFrame([], _text_schema(columns))
    return parse_numbers(empty, feed_types(columns))


def archive_snapshot(df: DataFrame, folder: str, ts: str = "snapshot_ts") -> None:
    """Append a snapshot to the archive, one directory per day."""
    dated = df.withColumn("snapshot_date", F.to_date(ts))
    dated.write.mode("append").partitionBy("snapshot_date").parquet(folder)
