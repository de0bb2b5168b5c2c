"""Result files: per-area tables and documents, per-party sheets, locale text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.numbers import format_de
from tally.operators.cleaning import quoted


def write_area_tables(df: DataFrame, path: str, name: str = "fname", order: Sequence[str] = ()) -> None:
    """One small CSV per area and vote type, all areas in one job.

    Rows of an area meet in one task (an area's ballot is small) and are written in
    ``order``; a task writes many areas.
    """
    out = df.repartition(name).sortWithinPartitions(name, *order)
    out.drop(*order).write.mode("overwrite").partitionBy(name).option("header", True).csv(path)


def write_area_documents(df: DataFrame, path: str, name: str = "fname", doc: str = "document") -> None:
    """One JSON document per area and vote type, all areas in one job."""
    df.select(name, F.col(doc).alias("value")).repartition(name).write.mode("overwrite").partitionBy(name).text(path)


def area_document(title: Column, intro: Column, notes: Column, byline: Column, source_name: Column,
                  source_url: Column) -> Column:
    """The metadata document; every leaf is an array of one element."""
    return F.to_json(F.struct(
        F.array(title).alias("title"),
        F.struct(
            F.array(intro).alias("intro"),
            F.array(byline).alias("byline"),
            F.array(source_name).alias("source-name"),
            F.array(source_url).alias("source-url"),
        ).alias("describe"),
        F.struct(F.array(notes).alias("notes")).alias("annotate"),
    ))


def write_long_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A long result table, replacing the one before."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_sheets(df: DataFrame, path: str, by: str) -> None:
    """An analysis table split into one folder per party or level."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def locale_lines(df: DataFrame, digits: Mapping[str, int] | None = None, separator: str = ";") -> DataFrame:
    """Each row as one text line with decimal commas; null cells are ``NA``.

    ``digits`` gives the decimal places to print; fractional columns not in it keep all
    they have. Cells that hold the separator, a quote or a line break are quoted, quotes
    inside doubled; a line break becomes a blank, as a row is a line.
    """
    digits = digits or {}
    cells = []
    for c, kind in df.dtypes:
        if c in digits:
            text = F.replace(format_de(quoted(c), digits[c]), F.lit("."), F.lit(""))
        elif kind in ("double", "float") or kind.startswith("decimal"):
            text = F.translate(quoted(c).cast("string"), ".", ",")
        else:
            text = quoted(c).cast("string")
        special = text.contains(separator) | text.contains('"') | text.rlike("[\\r\\n]")
        one_line = F.regexp_replace(F.replace(text, F.lit('"'), F.lit('""')), "[\\r\\n]+", " ")
        cells.append(F.coalesce(F.when(special, F.concat(F.lit('"'), one_line, F.lit('"'))).otherwise(text), F.lit("NA")))
    return df.select(F.concat_ws(separator, *cells).alias("value"))


def write_locale_text(df: DataFrame, path: str, banner: str | None = None,
                      digits: Mapping[str, int] | None = None, separator: str = ";") -> None:
    """Write a table as locale text.

    Each file starts with the banner line (if any) and the header, so that every
    file can be read by itself: they are put in front of the first row of its task.
    """
    first = "\n".join(([banner] if banner else []) + [separator.join(df.columns)]) + "\n"
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = locale_lines(df, digits, separator).withColumn("_place", place)
    value = F.when(F.col("_place") == 0, F.concat(F.lit(first), "value")).otherwise(F.col("value"))
    if df.isEmpty():  # no task has a first row to put the header in front of
        lines = df.sparkSession.range(1).select(F.lit(first.rstrip("\n")).alias("value"))
        value = F.col("value")
    lines.select(value.alias("value")).write.mode("overwrite").text(path)
