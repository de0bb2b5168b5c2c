"""Approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` tables hash a vector by ``HASHES`` projections on Gaussian directions, cut into steps
of ``WIDTH`` times the root mean square of the vectors' lengths. Vectors stay in their own
buckets; a query visits its bucket and neighbouring ones in the order of estimated success,
which is the sum of squared distances to the borders that have to be crossed. Candidates of all
tables are merged and ranked by exact distance.

Equal vectors are one class: buckets hold classes, so a vector that many rows share is one
entry, and its smallest ``k`` + 1 numbers, which are all that a nearest list can hold, stand in
for the class. Buckets are dealt out in blocks; a bucket of more than ``BLOCK`` classes or queries
is split into several, and each part of its classes meets each part of its queries. A block gives
the best ``k`` of each query and no pairs.

A query that found fewer than ``k`` rows, or whose last row is further away than one step, lies
where hashing does not reach its neighbours (it is much longer than the others, or rows are few).
It is compared with all vectors, in blocks of queries and vectors. Hashes do not grow with the
rows: where neighbours are hardly nearer than other rows, smaller buckets lose them.

Vectors that are null, zero, of a length other than the table's most frequent one, or that hold
null or non-finite components take no part, and rows without a number do not either. Rows that
repeat a number with the same vector count once. A table of fewer than ``k`` others gives them all.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import store

TABLES, HASHES, WIDTH, PROBES = 4, 6, 1.8, 120
BLOCK = 20_000
EXACT_BLOCK = 5_000  # queries, and vectors, that meet in one block of the exact search
SEED = 3

_STEPS = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)))


def directions(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal directions with the lengths of Gaussian ones, and offsets in steps from 0 to 1."""
    rng = np.random.default_rng([SEED, table])
    g = rng.normal(size=(dim, HASHES))
    if dim >= HASHES:
        g = np.linalg.qr(g)[0] * np.sqrt(dim)
    return g, rng.uniform(0, 1, HASHES)


def bucket_codes(cells: np.ndarray) -> np.ndarray:
    """One number for each row of cell numbers."""
    code = np.zeros(cells.shape[:-1], np.uint64)
    for i in range(cells.shape[-1]):
        code = (code ^ cells[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code.view(np.int64)


def visited(position: np.ndarray, probes: int) -> np.ndarray:
    """Codes of the buckets to visit, likeliest first, for each row of positions in steps."""
    cell = np.floor(position)
    part = position - cell
    cost = np.stack([np.zeros_like(part), (1 - part) ** 2, part**2], axis=-1)  # by step % 3: stay, above, below
    total = cost[:, np.arange(HASHES), :][:, np.arange(HASHES)[None, :], _STEPS % 3].sum(axis=-1)
    order = np.argsort(total, axis=1, kind="stable")[:, :probes]
    return bucket_codes(cell[:, None, :] + _STEPS[order])


def usable(vector: str) -> Column:
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def _hashed(rows: DataFrame, scale: float, probes: int) -> DataFrame:
    """(``id``, ``v``, ``t``, ``bucket``): own buckets if ``probes`` is 0, else those to visit."""

    def run(batches):
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, 1))
            if not len(pdf):
                continue
            for t in range(TABLES):
                g, b = directions(x.shape[1], t)
                position = x @ g / scale + b
                if probes:
                    codes = visited(position, probes)
                    yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), codes.shape[1]), "t": t, "bucket": codes.ravel()})
                else:
                    yield pd.DataFrame({"id": pdf["id"], "t": t, "bucket": bucket_codes(np.floor(position))})

    return rows.select("id", "v").mapInPandas(run, "id long, t int, bucket long").distinct()


def search_block(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` classes of each query among the vectors of its buckets in this block."""
    best: dict[int, dict[int, float]] = {}
    point: dict[int, np.ndarray] = {}
    if len(queries) and len(vectors):
        groups = {key: idx for key, idx in vectors.groupby("cell").indices.items()}
        ids, x = vectors["id"].to_numpy(), np.stack(vectors["v"].to_numpy())
        length = (x * x).sum(axis=1)
        q_ids, q_all = queries["id"].to_numpy(), queries["v"].to_numpy()
        for cell, at in queries.groupby("cell").indices.items():
            own = groups.get(cell)
            if own is None:
                continue
            y, y_ids, y_len = x[own], ids[own], length[own]
            for lo in range(0, len(at), 512):
                part = at[lo : lo + 512]
                q = np.stack(q_all[part])
                # Rough squares choose; the exact distance of the chosen decides.
                rough = y_len[None, :] - 2 * q @ y.T
                m = min(k + 1, len(y_ids))
                edge = np.partition(rough, m - 1, axis=1)[:, m - 1]
                slack = 1e-9 * (1 + np.abs(edge))
                for j, i in enumerate(part.tolist()):
                    near = np.flatnonzero(rough[j] <= edge[j] + slack[j])
                    d = np.sqrt(((y[near] - q[j]) ** 2).sum(axis=1))
                    mine = best.setdefault(int(q_ids[i]), {})
                    mine.update(zip(y_ids[near].tolist(), d.tolist(), strict=True))
                    point[int(q_ids[i])] = q[j]
    rows = [(q, c, d) for q, found in best.items() for d, c in sorted((d, c) for c, d in found.items() if c != q)[:k]]
    return pd.DataFrame(rows, columns=["query", "class", "distance"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``key``, ``score``): each query's ``k`` nearest found rows by Euclidean distance."""
    rows = (vectors.where(F.col(key).isNotNull() & usable(vector))
            .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query")))
    # Adding zero turns -0.0 into 0.0, so that equal vectors have equal hashes.
    rows = store(rows.withColumn("v", F.transform("v", lambda x: x + 0.0)).withColumn("h", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v")).dropDuplicates(["id", "h", "h2"]), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("many")).orderBy(F.desc("many"), "n").limit(1).collect()
    if not sizes:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(key), F.lit(0.0).alias("score"))
    rows = rows.where(F.size("v") == sizes[0][0])
    length = rows.select(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("s")).agg(F.avg("s")).first()[0]

    # Classes of equal vectors, named by their smallest number; and what a list can hold of each.
    same = rows.groupBy("h", "h2").agg(F.min("id").alias("class"), F.max("is_query").alias("asked"))
    classed = store(rows.select("id", "h", "h2", "is_query").join(same, ["h", "h2"]).select("id", "class", "is_query"), "classes")
    first = (classed.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(F.col("r") <= k + 1).select("class", "id"))
    points = store(rows.join(same.withColumnRenamed("class", "id"), ["h", "h2", "id"]).select("id", "v", "asked"), "points")

    step = WIDTH * float(np.sqrt(length))
    own = _hashed(points, step, 0)
    asked = points.where("asked")
    probes = store(_hashed(asked, step, PROBES), "probes")
    counts = store(own.groupBy("t", "bucket").agg(F.count("*").alias("many"))
                   .join(probes.groupBy("t", "bucket").agg(F.count("*").alias("visits")), ["t", "bucket"])
                   .select("t", "bucket", F.ceil(F.col("many") / BLOCK).cast("long").alias("parts"),
                           F.ceil(F.col("visits") / BLOCK).cast("long").alias("asked_parts"), "many", "visits"), "buckets")
    total = counts.agg(F.sum(F.col("many") * F.col("asked_parts")), F.sum(F.col("visits") * F.col("parts"))).first()
    blocks = max(1, -(-max(n or 0 for n in total) // BLOCK))

    def each(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))

    def dealt(found: DataFrame, split: Column, asked_split: Column) -> DataFrame:
        cell = found.join(counts, ["t", "bucket"]).withColumn("part", split).withColumn("asked_part", asked_split)
        return (cell.select("id", F.xxhash64("t", "bucket", "part", "asked_part").alias("cell"))
                .withColumn("block", F.pmod("cell", F.lit(blocks))).join(points.select("id", "v"), "id"))

    def searched(there: DataFrame, here: DataFrame) -> DataFrame:
        return (there.groupBy("block").cogroup(here.groupBy("block"))
                .applyInPandas(lambda q, x: search_block(q, x, k), "query long, class long, distance double"))

    def listed(found: DataFrame, own: DataFrame) -> DataFrame:
        """(``query``, ``found``, ``distance``): the nearest ``k`` + 1 rows of each class of ``own``, itself among them."""
        order = Window.partitionBy("query").orderBy("distance", "class")
        merged = found.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "class", "distance")
        # A query's own class is at distance 0.
        merged = merged.unionByName(own.select(F.col("id").alias("query"), F.col("id").alias("class"), F.lit(0.0).alias("distance")))
        lists = store(merged, "nearest").join(first, "class").withColumnRenamed("id", "found")
        short = Window.partitionBy("query").orderBy("distance", "found")
        return lists.withColumn("r", F.row_number().over(short)).where(F.col("r") <= k + 1).select("query", "found", "distance")

    spread = F.pmod(F.xxhash64("id"), F.col("parts"))
    there = dealt(probes, each(F.col("parts")), F.pmod(F.xxhash64("id"), F.col("asked_parts")))
    here = dealt(own, spread, each(F.col("asked_parts")))
    lists = store(listed(searched(there, here), asked), "lists")

    far = store(lists.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("last"))
                .where((F.col("n") <= k) | (F.col("last") > step)).select(F.col("query").alias("id")), "far")
    many_far = far.count()
    if many_far:
        parts, asked_parts = -(-points.count() // EXACT_BLOCK), -(-many_far // EXACT_BLOCK)
        all_of = lambda n: each(F.lit(n).cast("long"))
        some_of = lambda n: F.pmod(F.xxhash64("id"), F.lit(n).cast("long"))
        far_points = store(points.join(far, "id", "left_semi").select("id", "v"), "far-points")

        def cut(rows: DataFrame, split: Column, asked_split: Column) -> DataFrame:
            return (rows.select("id", "v", F.lit(0).cast("long").alias("cell")).withColumn("part", split).withColumn("asked_part", asked_split)
                    .select("id", "cell", (F.col("part") * asked_parts + F.col("asked_part")).alias("block"), "v"))

        exact = searched(cut(far_points, all_of(parts), some_of(asked_parts)), cut(points, some_of(parts), all_of(asked_parts)))
        lists = lists.join(far.withColumnRenamed("id", "query"), "query", "left_anti").unionByName(listed(exact, far_points))
    queries = classed.where("is_query").select(F.col("id").alias("query_id"), F.col("class").alias("query"))
    rank = Window.partitionBy("query_id").orderBy("distance", "found")
    return (queries.join(lists, "query").where("found <> query_id").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("found").alias(key), F.col("distance").alias("score")))
