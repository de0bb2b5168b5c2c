"""Dimension, index, history and key/value tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.numbers import PLAIN_NUMBER, numeric_or_null, parse_de_number
from tally.operators.cleaning import quoted

#: Encoding of the historical results file (fixed value).
HISTORY_ENCODING = "windows-1252"
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_WINDOWS = "".join(bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xA0))


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Comma when the first line has more commas than semicolons, else semicolon."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0].value if first else ""
    return "," if line.count(",") > line.count(";") else ";"


def read_table(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """A delimited table with header: US style with commas or German style with semicolons.

    ``types`` names the numeric columns; without it all columns stay text. German
    numbers are parsed with decimal comma.
    """
    separator = sniff_separator(spark, path)
    df = spark.read.option("header", True).option("sep", separator).option("nullValue", "NA").csv(path)
    out = []
    for c in df.columns:
        if types and c in types:
            number = parse_de_number(quoted(c), types[c]) if separator == ";" else quoted(c).try_cast(types[c])
            out.append(number.alias(c))
        else:
            out.append(quoted(c))
    return df.select(*out)


def read_history(spark: SparkSession, path: str, columns: Mapping[str, str], key: str,
                 encoding: str = HISTORY_ENCODING) -> DataFrame:
    """Historical results: semicolons, old encoding, title and header rows inside.

    ``columns`` maps the names to types in file order. Rows whose ``key`` cell is no
    number (title, header and unit rows) are dropped by that test, not by position.
    Spark reads Latin-1; Windows-1252 differs from it in the codes 80 to 9F only,
    which are translated afterwards.
    """
    windows = encoding.lower() == "windows-1252"
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(schema).option("sep", ";").option(
        "encoding", "iso-8859-1" if windows else encoding) \
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    data = raw.filter(quoted(key).rlike("^[0-9]+$"))

    def typed(name: str, to: str) -> Column:
        if to != "string":
            return parse_de_number(quoted(name), to).alias(name)
        return (F.translate(quoted(name), _C1, _C1_WINDOWS) if windows else quoted(name)).alias(name)

    return data.select(*[typed(c, t) for c, t in columns.items()])


def history_header(spark: SparkSession, path: str, first: int, last: int, marker: str = "Lfd",
                   encoding: str = HISTORY_ENCODING) -> DataFrame:
    """Names in the header row of a history file, which starts with ``marker``: ``idx, partei``.

    ``first`` and ``last`` are 1-based column positions.
    """
    windows = encoding.lower() == "windows-1252"
    lines = spark.read.schema("value string").option("sep", "\u0001").option("quote", "").option(
        "encoding", "iso-8859-1" if windows else encoding).csv(path)
    line = F.translate("value", _C1, _C1_WINDOWS) if windows else F.col("value")
    cells = lines.filter(F.col("value").startswith(marker)).select(F.posexplode(F.split(line, ";", -1)).alias("p", "partei"))
    return cells.select((F.col("p") + 1).alias("idx"), F.trim("partei").alias("partei")).filter(
        F.col("idx").between(first, last))


def read_headerless(spark: SparkSession, path: str, schema: str, separator: str = ";") -> DataFrame:
    """A file without header; names and types come from ``schema``."""
    return spark.read.schema(schema).option("sep", separator) \
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)


def typed_key_values(df: DataFrame, value: str = "value") -> DataFrame:
    """Split a text value column: ``num_value`` for plain numbers, ``str_value`` for the rest."""
    text = F.col(value)
    return df.withColumns({
        "num_value": numeric_or_null(text),
        "str_value": F.when(~text.rlike(PLAIN_NUMBER), text),
    })


def write_table(df: DataFrame, path: str) -> None:
    """Store a dimension, index, baseline or result table for later runs."""
    df.write.mode("overwrite").parquet(path)
