"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators.cleaning import tick


def _text(value: str) -> str:
    """Text for use inside an SQL string literal."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    cols: Sequence[str],
    name: str = "partei",
    value: str = "stimmen",
    position: str | None = "ballot_pos",
) -> DataFrame:
    """One row per (row, column); nulls stay. ``position`` numbers the columns from 1.

    A generator over one row: no shuffle, and the column order survives in ``position``.
    """
    cells = [
        f"named_struct('{name}', '{_text(c)}', '{position or '_pos'}', {i}, '{value}', {tick(c)})"
        for i, c in enumerate(cols, start=1)
    ]
    long = df.selectExpr(*[tick(c) for c in ids], f"inline(array({', '.join(cells)}))")
    return long if position else long.drop("_pos")


def pivot_measure(
    df: DataFrame, ids: Sequence[str], names: Sequence[str], name: str = "partei", value: str = "stimmen"
) -> DataFrame:
    """Long to wide for one value column; the largest of several values. ``names`` fixes the columns, so no extra job runs."""
    return df.groupBy(*[tick(c) for c in ids]).pivot(name, list(names)).agg(F.max(value))


def pivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    names: Sequence[str],
    values: Sequence[str],
    name: str = "partei",
) -> DataFrame:
    """Long to wide for several value columns, named ``<value>_<name>``."""
    aggs = [
        F.expr(f"max({tick(v)}) FILTER (WHERE {tick(name)} = '{_text(n)}') AS {tick(f'{v}_{n}')}")
        for v in values for n in names
    ]
    return df.groupBy(*[tick(c) for c in ids]).agg(*aggs)


def colour_map(df: DataFrame, keys: Sequence[str], name: str, colour: str, into: str = "farben") -> DataFrame:
    """One map name -> colour per group; a group is the ballot of one area."""
    entries = F.map_from_entries(F.array_sort(F.collect_set(F.struct(F.col(name), F.col(colour)))))
    return df.groupBy(*keys).agg(entries.alias(into))


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add literal columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})
