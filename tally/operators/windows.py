"""Row-order operators that keep working when one group holds much of the table.

A plain window sorts a whole group in one task. That is right for a ballot (some dozens of
rows), which the caller states by ``small_groups=True``. Otherwise there is one plan for all
sizes: rows are range-partitioned by group and order and stored, windows run per (group,
partition), and what crosses a partition border is carried by an aggregate with one row per
group and partition. ``order`` should end in a unique key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.session import store

_CHUNK = "_chunk"


def _window(part: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*part).orderBy(*order)


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def cut(df: DataFrame, part: Sequence[str], order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Rows with ``_chunk``, which rises with groups and order: the partition of a range partition by both.

    One plan for all sizes: a large group spreads over as many partitions as it needs, small
    groups share one. The input is computed once and stored, so that the steps that follow, and
    operators that follow each other, read files. ``pieces`` fixes the number of partitions.
    """
    keys = [F.col(c).asc() for c in (*part, *order)]
    dealt = df.repartitionByRange(pieces, *keys) if pieces else df.repartitionByRange(*keys)
    return store(dealt.withColumn(_CHUNK, F.spark_partition_id().cast("bigint")), "cuts")


def _with_carry(df: DataFrame, part: Sequence[str], per_chunk: Mapping[str, Column],
                carried: Mapping[str, Column]) -> DataFrame:
    """Join to the rows what the earlier (or later) chunks of their group hand over.

    ``per_chunk`` aggregates each (group, chunk); ``carried`` are window expressions
    over those aggregates in chunk order. The result, one row per chunk, is stored:
    operators can follow each other without their plans multiplying.
    """
    sums = df.groupBy(*part, _CHUNK).agg(*[e.alias(n) for n, e in per_chunk.items()])
    carry = sums.select(*part, _CHUNK, *[e.alias(n) for n, e in carried.items()])
    return join_same(df, store(carry, "carry"), [*part, _CHUNK])


def locf(df: DataFrame, cols: Sequence[str], part: Sequence[str], order: Sequence[str],
         small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Last observation carried forward; leading nulls stay null."""
    chunks = None if small_groups else cut(df, part, order, pieces)
    if chunks is None:
        w = _window(part, order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    before = _window(part, [_CHUNK]).rowsBetween(Window.unboundedPreceding, -1)
    key = _order_key(order)
    out = _with_carry(
        chunks, part,
        {f"_last_{c}": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)) for c in cols},
        {f"_carry_{c}": F.last(f"_last_{c}", ignorenulls=True).over(before) for c in cols},
    )
    w = _window([*part, _CHUNK], order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_carry_{c}")) for c in cols
    })
    return out.drop(_CHUNK, *[f"_carry_{c}" for c in cols])


def _shifted(df: DataFrame, cols: Mapping[str, str], part: Sequence[str], order: Sequence[str],
             small_groups: bool, pieces: int | None, back: bool) -> DataFrame:
    shift = F.lag if back else F.lead
    chunks = None if small_groups else cut(df, part, order, pieces)
    if chunks is None:
        return df.withColumns({new: shift(c).over(_window(part, order)) for new, c in cols.items()})
    pick = F.max_by if back else F.min_by
    edge = F.struct(*[F.col(c).alias(new) for new, c in cols.items()])
    out = _with_carry(
        chunks, part,
        {"_edge": pick(edge, _order_key(order))},
        {"_carry": shift("_edge").over(_window(part, [_CHUNK]))},
    )
    inner = _window([*part, _CHUNK], order)
    # a neighbour inside the chunk, even one with a null value, beats the carried one
    out = out.withColumn("_inside", shift(F.lit(1)).over(inner))
    out = out.withColumns({
        new: F.when(F.col("_inside").isNotNull(), shift(c).over(inner)).otherwise(F.col("_carry")[new])
        for new, c in cols.items()
    })
    return out.drop(_CHUNK, "_carry", "_inside")


def previous(df: DataFrame, cols: Mapping[str, str], part: Sequence[str], order: Sequence[str],
             small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Add values of the previous row: new name -> source column."""
    return _shifted(df, cols, part, order, small_groups, pieces, back=True)


def following(df: DataFrame, cols: Mapping[str, str], part: Sequence[str], order: Sequence[str],
              small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Add values of the next row: new name -> source column."""
    return _shifted(df, cols, part, order, small_groups, pieces, back=False)


def step_fill(df: DataFrame, cols: Sequence[str], part: Sequence[str], order: Sequence[str],
              small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Fill a null from the row just before (one step only, from the original values)."""
    out = previous(df, {f"_prev_{c}": c for c in cols}, part, order, small_groups, pieces)
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_prev_{c}")) for c in cols})
    return out.drop(*[f"_prev_{c}" for c in cols])


def running(df: DataFrame, sums: Mapping[str, Column], part: Sequence[str], order: Sequence[str],
            small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Running sums within each group: new name -> summed column."""
    chunks = None if small_groups else cut(df, part, order, pieces)
    if chunks is None:
        w = _window(part, order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    before = _window(part, [_CHUNK]).rowsBetween(Window.unboundedPreceding, -1)
    out = _with_carry(
        chunks, part,
        {f"_sum_{n}": F.sum(c) for n, c in sums.items()},
        {f"_carry_{n}": F.sum(f"_sum_{n}").over(before) for n in sums},
    )
    w = _window([*part, _CHUNK], order).rowsBetween(Window.unboundedPreceding, 0)
    # a sum over nulls only is null; either part may be
    inner = {n: F.sum(c).over(w) for n, c in sums.items()}
    out = out.withColumns({
        n: F.coalesce(e + F.col(f"_carry_{n}"), e, F.col(f"_carry_{n}")) for n, e in inner.items()
    })
    return out.drop(_CHUNK, *[f"_carry_{n}" for n in sums])


def numbered(df: DataFrame, part: Sequence[str], order: Sequence[str], into: str = "row_num",
             small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """Number the rows of each group from 1."""
    return running(df, {into: F.lit(1).cast("bigint")}, part, order, small_groups, pieces)


def drop_leading(df: DataFrame, n: int, part: Sequence[str], order: Sequence[str],
                 small_groups: bool = False, pieces: int | None = None) -> DataFrame:
    """All rows of each group but its first ``n``."""
    return numbered(df, part, order, "_num", small_groups, pieces).filter(F.col("_num") > n).drop("_num")


def global_rank(df: DataFrame, order: Sequence[Column], into: str = "rank_all") -> DataFrame:
    """Number all rows of a table from 1 in a total order, without one task seeing all.

    Rows are range-partitioned and sorted once and stored; the position within its
    partition plus the sizes of the partitions before give the number. The offsets
    table has one row per partition. ``order`` must end in a unique key.
    """
    sorted_rows = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = store(sorted_rows, "rank").withColumns({
        "_slice": F.shiftright("_id", 33),
        "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # bounded: one row per shuffle partition
    ranked = placed.join(F.broadcast(offsets), "_slice")
    return ranked.withColumn(into, F.col("_before") + F.col("_pos") + 1).drop("_id", "_slice", "_pos", "_before")


SAMPLED = 10_000  # rows that a round of order_statistics takes to the driver for each open interval
SORTED = 50_000  # rows that one task may sort


def _literal(row: Sequence, types: Mapping[str, str]) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, types.items())])


def order_statistics(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> dict[int, tuple]:
    """The rows' ``order`` columns at some ranks (from 1) of an ascending order, without moving or sorting the rows.

    A rank's interval of keys shrinks round by round: a random sample of the rows in it gives
    two candidates around the rank, the rows up to each candidate are counted exactly in one pass over
    the table for all ranks, and the counts tell which part the rank is in. When an interval
    holds few rows, or equal ones only, the row is read off. Nulls come first. ``df`` is read
    several times and should be stored and narrow.
    """
    types = {c: t for c, t in ((f.name, f.dataType.simpleString()) for f in df.select(*order).schema.fields)}
    rows, key = df.select(*order), _order_key(order)
    total = rows.count()
    if any(not 1 <= r <= total for r in ranks):
        raise ValueError(f"ranks must be from 1 to {total}")
    # Of each rank: keys beyond ``low`` up to ``high``, rows before them, rows among them.
    where = {r: (None, None, 0, total) for r in ranks}
    found: dict[int, tuple] = {}

    def between(low, high) -> DataFrame:
        inside = rows if low is None else rows.filter(key > _literal(low, types))
        return inside if high is None else inside.filter(key <= _literal(high, types))

    turn = 0
    while wide := {r: w for r, w in where.items() if r not in found and w[3] > SORTED}:
        turn += 1
        wanted: dict[int, tuple] = {}
        for low, high in dict.fromkeys(w[:2] for w in wide.values()):
            taken = between(low, high).orderBy(F.xxhash64(*order, F.lit(turn)), *order).limit(SAMPLED).orderBy(*order).collect()
            sample = [tuple(t) for t in taken]
            margin = 2 * int(len(sample) ** 0.5)  # four deviations of a place in the sample
            for r, (_, _, before, size) in ((r, w) for r, w in wide.items() if w[:2] == (low, high)):
                place = (r - before) * len(sample) // size
                wanted[r] = (sample[max(0, place - margin)], sample[min(len(sample) - 1, place + margin)])
        cuts = list(dict.fromkeys(c for pair in wanted.values() for c in pair))
        upto = dict(zip(cuts, rows.agg(*[F.count_if(key <= _literal(c, types)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()))
        for r, (a, b) in wanted.items():
            low, high, before, size = where[r]
            if r <= upto[a]:
                new = (low, a, before, upto[a] - before)
            elif r <= upto[b]:
                new = (a, b, upto[a], upto[b] - upto[a])
            else:
                new = (b, high, upto[b], before + size - upto[b])
            if new[3] == size:  # many equal keys: part the smallest from the rest
                first, last = between(low, high).agg(F.min(key), F.max(key)).first()
                equal = between(low, high).filter(key == _literal(tuple(first), types)).count()
                if r <= before + equal:
                    found[r] = tuple(first)
                    continue
                new = (tuple(first), tuple(last), before + equal, size - equal)
            where[r] = new
    for r, (low, high, before, _) in where.items():
        if r not in found:
            found[r] = tuple(between(low, high).orderBy(*order).offset(r - before - 1).limit(1).first())
    return found


def ntile(df: DataFrame, value: str, key: Sequence[str], n: int, into: str) -> DataFrame:
    """Cut all rows into ``n`` groups of nearly equal size by a value; nulls get null.

    The first groups take the extra rows, as the SQL function does. Borders are found by counting
    (:func:`order_statistics`) over a narrow copy; the rows themselves are not moved. Ties go by
    ``key``, which must be unique; rows with equal value and key share a group.
    """
    order = [value, *[k for k in key if k != value]]
    narrow = store(df.filter(F.col(value).isNotNull()).select(*order), "ntile")
    count = narrow.count()
    last = [k * (count // n) + min(k, count % n) for k in range(1, n)]
    borders = order_statistics(narrow, order, sorted({r for r in last if r}))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    passed = [(_order_key(order) > _literal(borders[r], types)).cast("int") if r else F.lit(1) for r in last]
    tile = reduce(lambda a, b: a + b, passed, F.lit(1))
    return df.withColumn(into, F.when(F.col(value).isNotNull(), tile).cast("int"))
