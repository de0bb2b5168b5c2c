"""Grouped and global aggregates. All combine on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.measures import density
from tally.functions.text import is_postal
from tally.operators.cleaning import tick
from tally.operators.windows import join_same


def volatility(change: Column) -> Column:
    """Half the sum of absolute changes (Pedersen index)."""
    return F.sum(F.abs(change)) / 2


def strict_sum(value: Column) -> Column:
    """Sum that is null as soon as one input is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def total(value: Column, strict: bool = False) -> Column:
    return strict_sum(value) if strict else F.sum(value)


def volatility_by(df: DataFrame, keys: Sequence[str], change: str, carry: Sequence[str] = (),
                  into: str = "volatilitaet") -> DataFrame:
    """Volatility per area, with area attributes (constant in the group) carried along."""
    attrs = [F.max(c).alias(c) for c in carry]
    return df.groupBy(*keys).agg(*attrs, volatility(F.col(change)).alias(into))


def postal_quota(precincts: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Postal votes per municipality, from precinct rows with a voter count.

    Needs ``wahlbezirksnummer, wahllokal, wahlberechtigt, waehler, ungueltig_wk,
    ungueltig_ls, g_name``. An unknown postal flag counts as not postal, or makes the
    sum null when ``strict``.
    """
    postal = is_postal(F.col("wahlbezirksnummer"), F.col("wahllokal"))
    by_post = F.when(postal, F.col("waehler")).otherwise(F.lit(0))
    if strict:
        by_post = F.when(postal.isNotNull(), by_post)
    sums = {
        "wahlberechtigt": F.col("wahlberechtigt"),
        "waehler": F.col("waehler"),
        "briefwaehler": by_post,
        "ungueltig_wk": F.col("ungueltig_wk"),
        "ungueltig_ls": F.col("ungueltig_ls"),
    }
    out = precincts.filter(F.col("waehler").isNotNull()).groupBy(key).agg(
        F.min("g_name").alias("g_name"), *[total(c, strict).alias(n) for n, c in sums.items()]
    )
    return out.withColumn("briefwahlquote", F.try_divide("briefwaehler", "waehler") * 1000 / 10)


def overall_quota(df: DataFrame, part: str, whole: str, into: str) -> DataFrame:
    """One row: ratio of two column sums in percent."""
    return df.agg((F.try_divide(F.sum(part), F.sum(whole)) * 1000 / 10).alias(into))


def joined_labels(label: Column, separator: str = " ") -> Column:
    """Distinct labels of a group in sorted order, joined. A label set is small by nature."""
    return F.array_join(F.array_sort(F.collect_set(label)), separator)


def ordered_labels(order: Column, label: Column, separator: str = ", ", where: Column | None = None) -> Column:
    """All labels (or those of the rows ``where``) of one ballot, joined in the given order; a null label is empty text."""
    row = F.struct(order.alias("o"), F.coalesce(label, F.lit("")).alias("l"))
    rows = F.array_sort(F.collect_list(row if where is None else F.when(where, row)))
    return F.array_join(F.transform(rows, lambda r: r["l"]), separator)


def profile(df: DataFrame, key: str, name: str, labels: str, count_as: str, population: str, area: str,
            strict: bool = False) -> DataFrame:
    """Area profile: name, joined labels, member count, population, area and density."""
    # labels first shrink to their distinct values per group, so no task holds a hot group
    return df.groupBy(key).agg(
        F.min(name).alias(name),
        joined_labels(F.col(labels)).alias(labels),
        F.count(F.lit(1)).alias(count_as),
        total(F.col(population), strict).alias(population),
        total(F.col(area), strict).alias(area),
    ).withColumn("bev_dichte", density(F.col(population), F.col(area)))


def merge_entities(df: DataFrame, crosswalk: DataFrame, key: str, sums: Sequence[str],
                   first: Sequence[str] = (), ratios: Mapping[str, Column] | None = None) -> DataFrame:
    """Sum rows whose key the crosswalk (``key``, ``new_key``) maps to one new key.

    Only counts are added; ``ratios`` are computed again from the sums.
    """
    mapped = df.join(crosswalk.select(key, "new_key"), key, "left")
    mapped = mapped.withColumn(key, F.coalesce("new_key", key))
    out = mapped.groupBy(key).agg(*[F.min(c).alias(c) for c in first],
                                  *[F.expr(f"sum({tick(c)}) AS {tick(c)}") for c in sums])
    return out.withColumns(dict(ratios)) if ratios else out


def roll_up(df: DataFrame, keys: Sequence[str], counts: Sequence[str],
            ratios: Mapping[str, Column] | None = None) -> DataFrame:
    """Sum counts to a higher level (no keys: the whole); ratios are computed again."""
    out = df.groupBy(*keys).agg(*[F.expr(f"sum({tick(c)}) AS {tick(c)}") for c in counts])
    return out.withColumns(dict(ratios)) if ratios else out


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in the given order.

    The rank limit is applied before the shuffle too, so a hot key sends one row
    per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def area_constants(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Attributes that are the same on every row of an area, one row per area."""
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def state_total(df: DataFrame, cols: Mapping[str, str], state: str = "LD") -> DataFrame:
    """One row: figures of the row for the whole state."""
    return df.filter(F.col("Gebietstyp") == state).agg(
        *[F.max(F.col(src)).alias(new) for new, src in cols.items()]
    )


def group_size(df: DataFrame, keys: Sequence[str], into: str = "anzahl") -> DataFrame:
    """Add the number of rows of the group to each row.

    Counts are combined first and joined back, so that a hot group is not sorted in
    one task as a window would.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(into))
    return join_same(df, sizes, keys)
