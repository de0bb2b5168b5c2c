"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (CRC-32 of the text, number), so that equal texts are neighbours. The
borders between shards are found before anything moves: every round counts, over all
partitions, the exact bytes and rows below a set of probe keys, keeps for each border the
interval of keys in which it lies, and cuts those intervals by finer probes, until the bytes
below a probe meet the border's target within the tolerance or the interval is a single row.
Then rows are exchanged once, into cells whose first position is already known from the
counts, and numbered there.

A null text has size 8 and CRC 0, as empty text has. Rows with equal numbers and texts share
a key; they are kept together and numbered in any order. Null numbers sort before all others.
An empty table gives no rows. Extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.session import store

LAW = "bytes"
BITS = 7  # probes cut an interval into 2**7 parts
CELLS = 8  # cells of a shard, sorted by tasks of their own

#: A key is (hi, lo). ``hi`` holds the CRC, a mark of null, and the upper two bits of the number as an unsigned
#: one (its sign bit flipped, which keeps the order); ``lo`` holds the other 62. Any two longs can so be told apart.
HI_BITS, LO_BITS = 35, 62


def row_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long")


def text_crc(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def histogram_borders(keys: DataFrame, shards: int, tolerance: float, cells: int = CELLS) -> tuple[list[tuple[int, int, int]], int]:
    """Borders of ``shards * cells`` cells over ``keys`` (``hi`` ``HI_BITS``, ``lo`` ``LO_BITS`` at most, ``size``).

    Returns (first ``hi``, first ``lo``, rows before) for every cell but the first, and the
    total of bytes. The driver holds at most 2**BITS counts for each border, whatever the
    number of rows. Borders of shards are refined to ``tolerance`` times a shard's bytes,
    those of cells inside to a tenth of a cell.
    """
    n, total, top = keys.agg(F.count("*"), F.sum("size"), F.max("lo")).first()
    if not n:
        return [], 0
    lo_bits = max(1, int(top).bit_length())
    width = HI_BITS + lo_bits
    parts = shards * cells
    target = [total * k / parts for k in range(1, parts)]
    slack = [total / shards * tolerance if k % cells == 0 else total / parts * 0.1 for k in range(1, parts)]
    # Of every border: prefix of the interval's keys, bits of it, bytes and rows before the interval.
    where = [(0, 0, 0, 0) for _ in target]
    found: dict[int, tuple[int, int]] = {}
    while len(found) < len(target):
        depth = {k: w for k, w in enumerate(where) if k not in found}
        bits = next(iter(depth.values()))[1]
        step = min(BITS if bits else BITS + 5, width - bits)
        cut = width - bits - step  # key bits below the probes
        prefixes = sorted({w[0] for w in depth.values()})
        counts = _count(keys, lo_bits, width - bits, cut, prefixes if bits else None)
        by_prefix: dict[int, list[tuple[int, int, int]]] = {}
        for probe, size, rows in counts:
            by_prefix.setdefault(probe >> step, []).append((probe, size, rows))
        sums = {}
        for prefix, rows in by_prefix.items():
            rows.sort()
            sums[prefix] = list(accumulate(r[1] for r in rows)), list(accumulate(r[2] for r in rows))
        for k, (prefix, _, size_before, rows_before) in depth.items():
            rows, (sizes, numbers) = by_prefix[prefix], sums[prefix]
            i = min(bisect_left(sizes, target[k] - size_before), len(rows) - 1)
            probe, size, n_rows = rows[i]
            at, at_rows = size_before + sizes[i] - size, rows_before + numbers[i] - n_rows
            before, after = target[k] - at, at + size - target[k]
            if min(before, after) <= slack[k] or cut == 0:
                found[k] = ((probe if before <= after else probe + 1) << cut, at_rows if before <= after else at_rows + n_rows)
            else:
                where[k] = (probe, bits + step, at, at_rows)
    mask = (1 << lo_bits) - 1
    return [(found[k][0] >> lo_bits, found[k][0] & mask, found[k][1]) for k in range(len(target))], int(total)


def _bits(lo_bits: int, from_bit: int, to_bit: int) -> Column:
    """Bits [``to_bit``, ``from_bit``) of the key hi * 2**lo_bits + lo, as a long (at most 62 bits)."""
    value = F.lit(0).cast("long")
    if from_bit > lo_bits:
        low = max(0, to_bit - lo_bits)
        hi = F.shiftright(F.col("hi"), low).bitwiseAND(F.lit((1 << (from_bit - lo_bits - low)) - 1).cast("long"))
        value = F.shiftleft(hi, max(0, lo_bits - to_bit))
    if to_bit < lo_bits:
        up = min(from_bit, lo_bits)
        value = value + F.shiftright(F.col("lo"), to_bit).bitwiseAND(F.lit((1 << (up - to_bit)) - 1).cast("long"))
    return value


def _count(keys: DataFrame, lo_bits: int, open_bits: int, cut: int, prefixes: list[int] | None) -> list[tuple[int, int, int]]:
    """Exact (probe, bytes, rows) of the probes of some intervals. ``open_bits`` bits of a key are not yet fixed."""
    width, step = HI_BITS + lo_bits, open_bits - cut
    if prefixes is None:
        rows = keys.groupBy(_bits(lo_bits, width, cut).alias("probe")).agg(F.sum("size"), F.count("*")).collect()
        return [(r[0], r[1], r[2]) for r in rows]
    # The fixed bits may be too many for a long: they are compared as hi and the upper bits of lo.
    low = max(0, open_bits - lo_bits)
    hi_part = F.shiftright(F.col("hi"), low) if low else F.col("hi")
    lo_part = F.shiftright(F.col("lo"), min(open_bits, lo_bits)) if open_bits < lo_bits else F.lit(0).cast("long")
    lo_fixed = max(0, lo_bits - open_bits)
    values = ", ".join(f"({p >> lo_fixed}L, {p & ((1 << lo_fixed) - 1)}L, {i})" for i, p in enumerate(prefixes))
    table = keys.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(h, l, i)")
    rows = (keys.withColumns({"h": hi_part, "l": lo_part, "probe": _bits(lo_bits, open_bits, cut)})
            .join(F.broadcast(table), ["h", "l"])  # a row for each border at most
            .groupBy("i", "probe").agg(F.sum("size"), F.count("*")).collect())
    return [((prefixes[r[0]] << step) + r[1], r[2], r[3]) for r in rows]


def histogram_shards(df: DataFrame, shards: int, tolerance: float = 0.001, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (from 0 in each shard).

    Bytes of the shards differ by ``tolerance`` of a shard and the largest row at most.
    """
    clash = {c: f"_own_{i}" for i, c in enumerate(df.columns)}
    plain = df.toDF(*clash.values())
    own_key, own_text = clash[key], clash[text]
    unsigned = F.col(own_key).cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    # A null number sorts first.
    upper = F.coalesce(F.shiftrightunsigned(unsigned, LO_BITS) + 1, F.lit(0).cast("long"))
    lower = F.coalesce(unsigned.bitwiseAND(F.lit((1 << LO_BITS) - 1).cast("long")), F.lit(0).cast("long"))
    keyed = plain.withColumns({"size": row_size(own_text), "hi": text_crc(own_text) * 8 + upper, "lo": lower})
    borders, _ = histogram_borders(store(keyed.select("hi", "lo", "size"), "shard-keys"), shards, tolerance)
    edges = [(0, 0, 0), *borders]
    # Borders that fall on the same key leave empty cells; a row belongs to the last cell that starts at or before it.
    # The tables of cells are written as SQL text, which plans much faster than as many columns.
    starts = ", ".join(f"struct({h}L AS hi, {lo}L AS lo)" for h, lo, _ in edges)
    cell = F.expr(f"size(filter(array({starts}), s -> s <= struct(hi AS hi, lo AS lo))) - 1")
    parts = len(edges)
    per = max(1, parts // shards) if borders else 1
    # rows before a cell in its shard
    ahead = ", ".join(f"{r - edges[(c // per) * per][2]}L" for c, (_, _, r) in enumerate(edges))
    dealt = keyed.withColumn("cell", cell)
    order = Window.partitionBy("cell").orderBy("hi", "lo")
    done = (dealt.withColumn("in_cell", F.row_number().over(order).cast("long") - 1)
            .withColumn("shard", F.floor(F.col("cell") / per).cast("int"))
            .withColumn("slot", F.expr(f"array({ahead})[cell]") + F.col("in_cell")))
    own = [F.col(new).alias(old) for old, new in clash.items() if old not in ("size", "text_crc32", "shard", "slot")]
    return done.select(*own, "size", F.shiftright("hi", 3).alias("text_crc32"), "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write what :func:`histogram_shards` gives, one folder a shard. Files follow the order of the slots."""
    sharded.write.partitionBy("shard").parquet(path)
