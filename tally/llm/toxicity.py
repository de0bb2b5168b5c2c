"""Toxicity by a classifier that is regularised with counterfactuals.

Features of a text are its distinct words and their first 4 and 5 characters, hashed. On a
bounded sample of labelled rows the ``FEATURES`` buckets that differ most between the labels are
chosen, and a logistic model is fitted on them. For every sampled text that names a group of
people (``IDENTITY``), a counterfactual text is made by swapping each such term for another,
and the squared change of the score between the two is a penalty, so that the model puts its
weight on what is said and not on who is named.

Null and empty texts get the score of the intercept alone. Whole texts are read. Rows without
a label, and rows whose number has both labels, do not train. Without labels of both kinds the
score is the share of toxic labels, or 0 if there are none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000  # labelled rows to fit on
BUCKETS = 1 << 20
FEATURES = 4_096
LEAST_TEXTS = 3  # texts of the sample that a feature must occur in
PENALTY = 4.0  # weight of the counterfactual term
RIDGE = 2e-4
ROUNDS = 300
WORDS_KEPT = 300_000

#: Terms that name groups of people. Fixed values.
IDENTITY = (
    "women men girls boys gay lesbian bisexual transgender queer straight black white asian african european american "
    "arab latino hispanic indian chinese japanese mexican jewish muslim christian hindu buddhist catholic atheist sikh "
    "immigrant refugee foreigner disabled blind deaf elderly young frauen männer juden muslime christen ausländer "
    "femmes hommes juifs musulmans chrétiens étrangers mujeres hombres judíos musulmanes cristianos extranjeros"
).split()

_WORD = re.compile(r"[^\W\d_]+")
_SWAP = {t: IDENTITY[(i + 7) % len(IDENTITY)] for i, t in enumerate(IDENTITY)}


def buckets_of(word: str) -> tuple[int, ...]:
    """The word, and the first 4 and 5 characters of a longer word."""
    keys = [word] + [f"{n}{word[:n]}" for n in (4, 5) if len(word) > n]
    return tuple(zlib.crc32(k.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for k in keys)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def swapped(words: set[str]) -> set[str] | None:
    """The words with each identity term swapped for another; None if there is no such term."""
    return {_SWAP.get(w, w) for w in words} if not words.isdisjoint(_SWAP) else None


def _features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([b for w in words for b in buckets_of(w)], np.int32))


@dataclass
class Model:
    weights: dict[int, float]
    bias: float

    def score(self, words: set[str]) -> float:
        z = self.bias + sum(self.weights.get(b, 0.0) for b in {b for w in words for b in buckets_of(w)})
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, other = [], []
        for text in batch.column(0):
            words = words_of(text.as_py())
            other_words = swapped(words)
            own.append(_features(words).astype("<i4").tobytes())
            other.append(None if other_words is None else _features(other_words).astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.binary()), pa.array(other, pa.binary())], ["y", "own", "other"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, penalty: float = PENALTY) -> Model:
    """Fit on at most ``sample`` labelled rows, those with the smallest hash of their key. Driver memory is bounded by ``sample``."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key"))
             .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("z")).where("y = z").select("key", "y"))
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
            .join(F.broadcast(chosen), "key").select("text", F.col("y").cast("int").alias("y")))  # ``sample`` rows of two numbers
    got = rows.mapInArrow(_sampled_features, "y int, own binary, other binary").toArrow()
    return fit(np.array(got.column("y").to_pylist(), np.float64), [np.frombuffer(b, "<i4") for b in got.column("own").to_pylist()],
               [None if b is None else np.frombuffer(b, "<i4") for b in got.column("other").to_pylist()], penalty)


def fit(y: np.ndarray, own: list[np.ndarray], other: list[np.ndarray | None], penalty: float = PENALTY) -> Model:
    """Logistic model over the most telling buckets, by gradient steps on all rows."""
    n, pos = len(y), float(y.sum()) if len(y) else 0.0
    if not n or pos in (0.0, float(n)):
        return Model({}, -60.0 if not pos else 60.0)
    flat = np.concatenate(own)
    row = np.repeat(np.arange(n), [len(o) for o in own])
    in_pos = np.bincount(flat, weights=y[row], minlength=BUCKETS)
    total = np.bincount(flat, minlength=BUCKETS)
    expected = total * pos / n
    gain = np.where(total >= LEAST_TEXTS, (in_pos - expected) ** 2 / np.maximum(expected * (1 - pos / n), 1e-9), 0)
    chosen = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
    chosen = chosen[gain[chosen] > 3.84]  # the 5 % point of chi-square
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def sparse(lists):
        f = place[np.concatenate(lists)] if lists else np.zeros(0, np.int32)
        r = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return f[f >= 0], r[f >= 0]

    pairs = [i for i, o in enumerate(other) if o is not None]
    fx, rx = sparse(own)
    fc, rc = sparse([other[i] for i in pairs])
    pairs = np.array(pairs, np.int64)
    w, b = np.zeros(len(chosen)), float(np.log(pos / (n - pos)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, ROUNDS + 1):
        s = 1 / (1 + np.exp(-np.clip(b + np.bincount(rx, weights=w[fx], minlength=n), -60, 60)))
        err = (s - y) / n
        if len(pairs):
            c = 1 / (1 + np.exp(-np.clip(b + np.bincount(rc, weights=w[fc], minlength=len(pairs)), -60, 60)))
            change = 2 * penalty * (s[pairs] - c) / len(pairs)
            err[pairs] += change * s[pairs] * (1 - s[pairs])
            back = -change * c * (1 - c)
        g = np.bincount(fx, weights=err[rx], minlength=len(w)) + RIDGE * w
        gb = err.sum()
        if len(pairs):
            g += np.bincount(fc, weights=back[rc], minlength=len(w))
            gb += back.sum()
        full = np.append(g, gb)
        m, v = 0.9 * m + 0.1 * full, 0.99 * v + 0.01 * full**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return Model({int(k): float(x) for k, x in zip(chosen, w, strict=True)}, float(b))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """``docs``' ``key`` and ``extra`` columns with ``score`` from 0 to 1. Only ``text`` goes into a score."""
    rows = docs.select(F.struct(F.col(key).alias(key), *(extra or [])).alias("own"), F.col(text).cast("string").alias("text"))
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}  # words with buckets that weigh something; most have none
        for batch in batches:
            scores = []
            for text in batch.column(1):
                hit: set[int] = set()
                for w in words_of(text.as_py()):
                    at = known.get(w)
                    if at is None:
                        if len(known) >= WORDS_KEPT:
                            known.clear()
                        at = known[w] = tuple(b for b in buckets_of(w) if b in weights)
                    if at:
                        hit.update(at)
                z = bias + sum(weights[b] for b in sorted(hit))
                scores.append(float(1 / (1 + np.exp(-min(60.0, max(-60.0, z))))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["own", "score"])

    return rows.mapInArrow(run, rows.select("own").schema.add("score", "double")).select("own.*", "score")
