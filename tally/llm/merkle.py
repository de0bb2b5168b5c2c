"""A Merkle manifest of a table: one root for all rows, a root for each group, a proof for each row.

A row's leaf is H, the lower-case hex SHA-256, over its fields, each as ``-`` if null and as byte
count, ``:`` and value if not. The leaves of a group ascend by key. While a level has several
nodes, every ``ARITY`` consecutive ones (the last run: fewer, even one) become their H, the
digests concatenated as hex text. What remains is the group's root; the groups' roots, in order
of the groups, give the root of all in the same way.

Nodes are kept in aligned blocks of ``ARITY ** 2``. A block holds each of its levels as one hex
string, in which a node has a fixed place: substrings of ``ARITY`` digests are hashed into the
parents, and the substrings on both sides of a node in its run are a segment of its proof. A
block ends in one node; these are the nodes of the next tier of blocks, and so on. Whether a
block applies none, one or both of its levels follows from its own size: only a first block can
be all there is of a level. On the way down, a tier hands each block of the tier below the
segments above it, so that what lies above is moved once for a block and not for a row.

Groups of any size are spread, as positions come from a range partition and blocks are keyed by
group and number. Null groups come first, as one group; null keys come first in their group. Rows
with equal keys are ordered by leaf; rows that are equal in all fields have equal leaves, and
either may have either's proof. An empty table has no rows and no root. Extra columns take no
part; what is to be carried is handed in by name and comes back in a struct, so that no name can
clash with another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.common import store
from tally.operators.windows import global_rank, join_same, numbered

ARITY = 16
BLOCK = ARITY * ARITY
HEX = 64  # characters of a digest


@dataclass(frozen=True)
class Manifest:
    """``rows``: ``key``, ``grp``, ``leaf``, ``path``, ``subroot``, ``extra``; ``groups``: ``grp``, ``subroot``; ``root`` or None.

    ``path`` has a struct of ``left`` and ``right`` for each level from the leaf up: the hex
    digests, as binary, before and after the node in its run.
    """

    rows: DataFrame
    groups: DataFrame
    root: str | None


def leaf(fields: Sequence[Column]) -> Column:
    """H over fields, each with its length in front so that no two rows of fields give the same text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(node: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of ``path`` give."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.concat(s["left"], h.cast("binary"), s["right"]), 256))


def proof_digest(path: str = "path") -> Column:
    """H of all siblings from leaf to root, left to right."""
    sides = F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string"))
    return F.sha2(F.array_join(sides, ""), 256)


def _parents(level: str, size: str) -> str:
    """The next level's string: each run's substring hashed. The outer array makes Spark evaluate ``level`` once."""
    run = f"sha2(substring(b, r * {ARITY * HEX} + 1, {ARITY * HEX}), 256)"
    return f"CAST(transform(array({level}), b -> array_join(transform(sequence(0, ({size} - 1) div {ARITY}), r -> {run}), ''))[0] AS BINARY)"


def _blocks(nodes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Blocks of nodes (``by``, ``pos`` from 0, ``node``, ``item``): level strings ``l0`` to ``l2`` and the block's own node.

    A level that the block does not apply is null.
    """
    taken = nodes.groupBy(*by, F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", "item"))).alias("own"))
    levels = taken.withColumns({"size": F.size("own"), "l0": F.expr("CAST(array_join(own.node, '') AS BINARY)"), "items": F.expr("own.item")}).drop("own")
    levels = levels.withColumn("l1", F.expr(f"CASE WHEN block > 0 OR size > 1 THEN {_parents('l0', 'size')} END"))
    levels = levels.withColumn("l2", F.expr(f"CASE WHEN block > 0 OR size > {ARITY} THEN {_parents('l1', f'((size - 1) div {ARITY} + 1)')} END"))
    return levels.withColumn("top", F.expr("CAST(coalesce(l2, l1, l0) AS STRING)"))


def _up(nodes: DataFrame, by: Sequence[str]) -> list[DataFrame]:
    """Tiers of stored blocks, the last one with one block a group."""
    tiers = []
    while True:
        tiers.append(store(_blocks(nodes, by), "merkle-blocks"))
        if not tiers[-1].agg(F.max("block")).first()[0]:
            return tiers
        nodes = tiers[-1].select(*by, F.col("block").alias("pos"), F.col("top").alias("node"), F.lit(None).cast("boolean").alias("item"))


def _segment(level: str, upper: str, at: str, size: str) -> str:
    """The digests beside node ``at`` of ``level`` in its run, if the level above is there."""
    left = f"substring({level}, {HEX} * ({at} - {at} % {ARITY}) + 1, {HEX} * ({at} % {ARITY}))"
    right = f"substring({level}, {HEX} * ({at} + 1) + 1, {HEX} * (least({size}, {at} - {at} % {ARITY} + {ARITY}) - {at} - 1))"
    return f"CASE WHEN {upper} IS NOT NULL THEN array(struct({left} AS left, {right} AS right)) ELSE array() END"


def _down(tiers: Sequence[DataFrame], by: Sequence[str], above: DataFrame, handed: Sequence[str] = ()) -> DataFrame:
    """Nodes of the lowest tier (``by``, ``pos``, ``item``, ``node``, ``path``, ``handed``) from ``above`` (``by``, ``block``, ``path``, ``handed``) of the top."""
    nodes = above
    for k, tier in enumerate(reversed(tiers)):
        if k:
            nodes = nodes.select(*by, F.col("pos").alias("block"), "path", *handed)
        own = join_same(tier.drop("top"), nodes.withColumnRenamed("path", "above"), [*by, "block"], "inner")
        own = own.select("*", F.posexplode("items").alias("at", "item")).drop("items")
        nodes = own.select(
            *by, (F.col("block") * BLOCK + F.col("at")).alias("pos"), "item", F.expr(f"CAST(substring(l0, {HEX} * at + 1, {HEX}) AS STRING)").alias("node"),
            F.concat(F.expr(_segment("l0", "l1", "at", "size")), F.expr(_segment("l1", "l2", f"(at div {ARITY})", f"((size - 1) div {ARITY} + 1)")), "above").alias("path"), *handed)
        if k + 1 < len(tiers):
            nodes = store(nodes, "merkle-paths")
    return nodes


NO_PATH = "CAST(array() AS array<struct<left: binary, right: binary>>)"


def manifest(df: DataFrame, fields: Sequence[str], key: str, group: str, extra: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of ``df``: see the module. ``extra`` columns come back in the struct ``extra``."""
    carried = F.struct(F.col(key).alias("key"), *[c.alias(f"x_{n}") for n, c in (extra or {}).items()])
    # The last column parts rows that are equal in all else, so that no range holds them all.
    rows = df.select(F.col(group).alias("grp"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("node"), carried.alias("item"), F.rand(7).alias("tie"))
    rows = store(rows, "merkle-leaves")  # a range partition reads its input twice
    placed = numbered(rows, ["grp"], ["key", "node", "tie"], "pos").select("grp", (F.col("pos") - 1).alias("pos"), "node", "item")
    tiers = _up(placed, ["grp"])
    groups = store(tiers[-1].select("grp", F.col("top").alias("subroot")), "merkle-groups")
    ranked = global_rank(groups, [F.col("grp").asc_nulls_first()], "pos").select(
        (F.col("pos") - 1).alias("pos"), F.col("subroot").alias("node"), F.struct("grp").alias("item"))
    upper = _up(ranked, [])
    top = upper[-1].select("top").first()
    start = df.sparkSession.sql(f"SELECT 0L AS block, {NO_PATH} AS path")
    over = store(_down(upper, [], start).select("item.grp", F.lit(0).cast("long").alias("block"), "path", F.col("node").alias("subroot")), "merkle-groups")
    done = _down(tiers, ["grp"], over, ["subroot"])
    own = F.struct(*[F.col(f"item.x_{n}").alias(n) for n in extra]) if extra else F.lit(None).cast("boolean")
    return Manifest(done.select("item.key", "grp", F.col("node").alias("leaf"), "path", "subroot", own.alias("extra")), groups, top[0] if top else None)
