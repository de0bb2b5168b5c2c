"""Projection and cleaning over many columns at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.numbers import parse_de_number, sentinel_to_null


def tick(name: str) -> str:
    """A name quoted for SQL expressions, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by its exact name."""
    return F.col(tick(name))


def measure_columns(df: DataFrame, suffix: str, parties: Iterable[str] | None = None) -> dict[str, str]:
    """Columns that hold one measure per party: column name -> party, in header order.

    Percent columns (``… (%)``) and the valid / invalid totals are no parties.
    """
    wanted = None if parties is None else set(parties)
    out = {}
    for name in df.columns:
        party = name.removesuffix(suffix)
        if party == name or party in ("gültige", "ungültige"):
            continue
        if wanted is None or party in wanted:
            out[name] = party
    return out


def select_measures(
    df: DataFrame, fixed: Mapping[str, str], suffix: str, parties: Iterable[str] | None = None
) -> DataFrame:
    """Project to renamed identity columns plus the party columns of one vote type."""
    names = {**{src: new for new, src in fixed.items()}, **measure_columns(df, suffix, parties)}
    return df.selectExpr(*[f"{tick(src)} AS {tick(new)}" for src, new in names.items()])


def measure_index(df: DataFrame, suffix: str, standing: DataFrame | None = None, on: str = "partei") -> DataFrame:
    """Catalogue of party columns: party, 1-based position in the header, ballot position.

    ``standing`` keeps only parties that occur in it.
    """
    rows = [
        (party, df.columns.index(name) + 1, pos)
        for pos, (name, party) in enumerate(measure_columns(df, suffix).items(), start=1)
    ]
    index = df.sparkSession.createDataFrame(rows, f"`{on}` string, idx int, ballot_pos int")
    if standing is not None:
        index = index.join(standing.select(on).distinct(), on, "left_semi")
    return index


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls of the named columns become 0; all other columns stay as they are."""
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(0)) for c in cols}) if cols else df


def parse_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text in locale format to typed numbers, column by column."""
    parsed = [
        parse_de_number(quoted(c), types[c]).alias(c) if c in types else quoted(c) for c in df.columns
    ]
    return df.select(*parsed)


def clean_numbers(
    df: DataFrame, cols: Sequence[str], contains: str | None = "•", equals: str | None = "x", to: str = "double"
) -> DataFrame:
    """Marker cells become null, the rest numbers; unreadable text becomes null too."""
    cleaned = {c: sentinel_to_null(quoted(c), contains, equals).try_cast(to) for c in cols}
    return df.withColumns(cleaned)


def rename_header(df: DataFrame, replace: Mapping[str, str], first_only: bool = True) -> DataFrame:
    """Replace text inside all column names (the first hit, or every hit)."""
    names = []
    for name in df.columns:
        for old, new in replace.items():
            name = name.replace(old, new, 1 if first_only else -1)
        names.append(name)
    return df.toDF(*names)


def collapse_columns(df: DataFrame, cols: Sequence[str], into: str) -> DataFrame:
    """Sum several columns row by row into one (null if any is null) and drop them."""
    total = quoted(cols[0])
    for c in cols[1:]:
        total = total + quoted(c)
    kept = [tick(c) for c in df.columns if c not in cols]
    return df.select(*kept, total.alias(into))


def move_first(df: DataFrame, *cols: str) -> DataFrame:
    """Reorder columns: the named ones first, the rest in their old order."""
    return df.select(*[tick(c) for c in cols], *[tick(c) for c in df.columns if c not in cols])


def pending_areas(df: DataFrame, area_type: str = "VF") -> DataFrame:
    """Areas of one level that are not released yet, with their progress."""
    return df.filter((F.col("Gebietstyp") == area_type) & (F.col("freigegeben") == 0)).select(
        "Gebietsschlüssel",
        "Gebietsbezeichnung",
        "freigegeben",
        F.col("Anzahl Wahlbezirke ausgezählt").alias("gezaehlt"),
        F.col("Anzahl Wahlbezirke").alias("stimmbezirke"),
    )
