"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int, rank: str = "rang") -> DataFrame:
    """The first ``n`` rows of each group in the given order, numbered.

    Spark applies the limit in each task before the shuffle, so a hot group costs
    ``n`` rows per task. ``order`` must end in a unique key.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def remainder(df: DataFrame, part: Sequence[str], key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """All rows after the first ``n`` of their group.

    ``key`` identifies a row within its group; the join is on the full key, so rows
    of a hot group spread over all tasks.
    """
    on = [*part, *key]
    return df.join(top_n(df, part, order, n).select(*on), on, "left_anti")


def top_bottom_n(df: DataFrame, part: Sequence[str], value: str, key: Sequence[str], n: int) -> DataFrame:
    """The ``n`` highest and the ``n`` lowest rows per group by a value.

    ``seite`` is ``oben`` or ``unten``, ``rang`` counts from the extreme inwards and
    ``zeile`` is the printed order: highest to lowest, then the lowest ones with the
    very lowest last. Rows without a value rank behind all others on both sides.
    """
    ties = [F.col(k).asc() for k in key]
    high = top_n(df, part, [F.col(value).desc_nulls_last(), *ties], n).withColumns(
        {"seite": F.lit("oben"), "zeile": F.col("rang")})
    low = top_n(df, part, [F.col(value).asc_nulls_last(), *ties], n)
    size = Window.partitionBy(*part)
    low = low.withColumns({"seite": F.lit("unten"),
                           "zeile": F.lit(n) + F.max("rang").over(size) + 1 - F.col("rang")})
    return high.unionByName(low)
