"""Joins and set operations.

No join here forces a broadcast: Spark compares the size of the lookup side with
``spark.sql.autoBroadcastJoinThreshold`` when it plans and again at run time, and
otherwise shuffles both sides and splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators.cleaning import zero_fill


def with_candidates(votes: DataFrame, candidates: DataFrame, on: Sequence[str] = ("wk", "partei"),
                    name: str = "name") -> DataFrame:
    """Add the candidate of each (constituency, party); rows without a named one drop out."""
    return votes.join(candidates.filter(F.col(name).isNotNull()), list(on), "inner")


def with_baseline(votes: DataFrame, baseline: DataFrame, on: Sequence[str], fill: Sequence[str] = ()) -> DataFrame:
    """Add the earlier result (left join); ``fill`` columns are 0 where there is none."""
    return zero_fill(votes.join(baseline, list(on), "left"), list(fill))


def override_name(df: DataFrame, names: DataFrame, on: str, source: str, target: str) -> DataFrame:
    """Replace ``target`` by the name the lookup table gives; no entry gives null."""
    lookup = names.select(on, F.col(source).alias("_name")).distinct()
    return df.join(lookup, on, "left").withColumn(target, F.col("_name")).drop("_name")


def keep_listed(df: DataFrame, listed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Semi-join: rows whose key occurs in the other table.

    The other side is reduced to its distinct keys before the shuffle, as Spark cannot
    split a hot key on that side.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(listed.select(*keys).distinct(), keys, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Anti-join: rows whose key does not occur in the other table (null keys stay)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(listed.select(*keys).distinct(), keys, "left_anti")


def flag_listed(df: DataFrame, listed: DataFrame, on: str, flag: str) -> DataFrame:
    """Boolean column: does the key occur in the other table?"""
    keys = listed.select(on).distinct().withColumn("_hit", F.lit(True))
    return df.join(keys, on, "left").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def with_output_name(df: DataFrame, registry: DataFrame, id_col: str, kind: str, types: Sequence[str]) -> DataFrame:
    """Add the output file name registered for (area id, vote type)."""
    names = registry.filter(F.col("typ").isin(*types) & F.col("fname").endswith(kind))
    return df.join(names.select(F.col("id").alias(id_col), "fname"), id_col, "inner")


def empty_results(areas: DataFrame, entries: DataFrame, on: Sequence[str] = (),
                  votes: float = 0, text: str = "0,0% (+0)") -> DataFrame:
    """Placeholder result rows before the count: every entry of an area with zero votes.

    With ``on``: entries belong to areas (candidates). Without: each area gets the
    whole list, which is one ballot (some dozens of entries), so the list is put
    into every area row as an array and unrolled there instead of joining.
    """
    if on:
        rows = areas.join(entries, list(on), "inner")
    else:
        ballot = entries.agg(F.array_sort(F.collect_list(F.struct(*entries.columns))).alias("_ballot"))
        rows = areas.withColumn("_ballot", ballot.scalar()).selectExpr(
            *[f"`{c}`" for c in areas.columns], "inline(_ballot)")
    return rows.withColumns({"stimmen": F.lit(votes), "prozent": F.lit(text)})


def patch_union(base: DataFrame, patch: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``base`` with the rows of the listed keys replaced by those of ``patch``."""
    kept = drop_listed(base, keys, on)
    return kept.unionByName(keep_listed(patch, keys, on), allowMissingColumns=True)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append tables by column name; columns a table lacks are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def join_fan_out(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join to a table with many rows per key.

    Written as inner join plus the rows without partner: Spark can split a hot key on
    either side of an inner join, but not on the right side of a left join.
    """
    matched = left.join(right, on, "inner")
    return matched.unionByName(drop_listed(left, right, on), allowMissingColumns=True)


def distinct_keys(key: str, *tables: DataFrame) -> DataFrame:
    """All keys that occur in any of the tables, once."""
    return union_all(*[t.select(key) for t in tables]).distinct()


def chain_lookups(df: DataFrame, *lookups: tuple[DataFrame, str]) -> DataFrame:
    """Left-join several dimension tables one after the other, each on its key."""
    for table, key in lookups:
        df = df.join(table, key, "left")
    return df
