"""Nested JSON documents as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.session import store


def _children(value: Column, path: Column, name: Column) -> Column:
    """Entries of an object or elements of an array; none of a scalar."""
    fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    items = F.try_variant_get(value, "$", "array<variant>")
    place = F.when(path == "", F.lit("")).otherwise(F.concat(path, F.lit("/")))
    of_fields = F.transform(fields, lambda e: F.struct(
        F.concat(place, e["key"]).alias("path"), e["key"].alias("name"), e["value"].alias("v")))
    of_items = F.transform(items, lambda e, i: F.struct(
        F.concat(place, i.cast("string")).alias("path"), name.alias("name"), e.alias("v")))
    none = F.array().cast("array<struct<path:string,name:string,v:variant>>")
    return F.coalesce(of_fields, of_items, none)


def flatten_json(df: DataFrame, doc: str) -> DataFrame:
    """List all keys of a column of JSON texts, however deep: ``path, name, type, value`` rows.

    A nested object gives a row with an empty value and then its own keys; the
    elements of an array carry the array's key. Each level is stored once, and only
    its nested rows go on to the next; there is no shuffle.
    """
    ids = [c for c in df.columns if c != doc]
    level = df.select(*ids, F.lit("").alias("path"), F.lit(None).cast("string").alias("name"), F.try_parse_json(F.col(doc)).alias("v"))
    levels = []
    while True:
        below = level.select(*ids, F.inline(_children(F.col("v"), F.col("path"), F.col("name"))))
        kind = F.schema_of_variant("v")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        text = F.when(nested, F.lit("")).otherwise(F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v")))
        rows = below.select(*ids, "path", "name", kind.alias("type"), text.alias("value"),
                            F.when(nested, F.to_json("v")).alias("_rest"))
        rows = store(rows, "level")
        levels.append(rows.drop("_rest"))
        rest = rows.filter("_rest IS NOT NULL")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        level = rest.select(*ids, "path", "name", F.parse_json("_rest").alias("v"))
