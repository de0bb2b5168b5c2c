"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import store

__all__ = ["components", "crc_mod", "read", "store", "ascii_words"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(key: str, n: int) -> Column:
    """Remainder of the CRC-32 of a key's decimal text; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` as (``node``, ``component``), component = smallest node.

    Alternates large-star and small-star steps: every step rewires neighbours to the
    smallest node known, which halves distances, so rounds grow with the logarithm of
    the longest path. Each round is stored in the shared folder. Nulls and loops are
    dropped; nodes without an edge do not appear; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    pairs = store(pairs.selectExpr("least(u, v) AS v", "greatest(u, v) AS u").distinct(), "components")
    before = None
    while True:
        both = pairs.select("u", "v").unionByName(pairs.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.where("v > u").join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v")
        down = large.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct()
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        star = down.join(small, "u").selectExpr("CASE WHEN v = m THEN u ELSE v END AS u", "m AS v").where("u <> v").distinct()
        pairs = store(star, "components")
        # A forest of stars no longer changes: compare a sum over all pairs, which is one row.
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def ascii_words(data: bytes) -> Iterator[bytes]:
    """Words between ASCII white space (9 to 13 and 32), with A-Z lower-cased."""
    return iter(data.lower().split())


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space in UTF-8 ``data``, A-Z lower-cased, in order.

    All bytes are handled at once: a polynomial over the bytes of a word, summed per
    word and mixed. Empty data or white space alone gives an empty array.
    """
    b = np.frombuffer(data.lower(), np.uint8)  # bytes.lower() changes A-Z only
    inside = (b > 32) | ((b < 9) | ((b > 13) & (b < 32)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(len(b)), dtype=np.uint64)))
    # The sum over a word carries the power of its start; the inverse power takes it out again.
    h = (sums[end] - sums[start]) * inverse_powers(len(b))[start]
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(56)))


_POWERS: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def _table(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 20:
            _POWERS[name] = have
    return have[:n]


def powers(n: int) -> np.ndarray:
    return _table("up", _BASE, n)


def inverse_powers(n: int) -> np.ndarray:
    return _table("down", pow(_BASE, -1, 1 << 64), n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
