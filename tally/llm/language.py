"""Language identification by nearest centroid.

A text is lower-cased, everything but letters becomes a blank, and the three-byte grams of its
UTF-8 form are counted in ``BUCKETS`` hash buckets. Counts are damped by a logarithm, weighted
by inverse document frequency and scaled to length 1. Every language has up to ``CENTROIDS``
centroids, found by clustering its training vectors by cosine. A text gets the language of the
nearest centroid. It is rejected if its cosine is below a limit for that language and the text's
length: a third of the sampled texts, held out from centroids fitted for this, are cut to pieces
of many lengths and compared with every language. From ``CLEAR`` grams on the limit is the
geometric mean of what all but 1 % of a language's own pieces reach and what half of the other
languages' pieces reach; shorter texts tell too little, and the lower of the two is the limit.

Null texts and texts without a letter are ``und`` with score 0 and are rejected. Whole texts are
read. Document frequencies are counted over all training rows; centroids are fitted on the
``SAMPLE`` training rows of each language with the smallest hash of their key. Without training
rows every text is ``und``. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import store

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
CENTROIDS = 4
SAMPLE = 300
SLICES = 16  # groups that a language is dealt into before its sample is taken
CLASSES = 8  # of length: below 8 grams, and from each power of two up to 512
CLEAR = 64
#: With a single language, a text is rejected below this share of the cosine that all but 1 % of held-out pieces reach.
ALONE = 0.2
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_KEEP = np.zeros(256, bool)
_KEEP[97:123] = True
_KEEP[128:] = True


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed three-byte grams; words are parted by one blank."""
    b = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    keep = _KEEP[b]
    b = np.where(keep, b, 32)
    b = b[keep | np.concatenate(([True], keep[:-1]))].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.float32)
    code = (b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(counts.sum(axis=-1), 1)).astype(int) - 2, 0, CLASSES - 1)


def limit(own: float | None, other: float | None, length: int) -> float:
    """Lowest cosine of a class of length that is not rejected, from what own and other pieces reach."""
    if own is None or not length:
        return 0.0
    if other is None:
        return ALONE * own
    return min(own, float(np.sqrt(own * other)) if 1 << (length + 2) >= CLEAR else other)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids by cosine; starts are the first vector and then those furthest from all starts."""
    starts = [v[0]]
    while len(starts) < min(k, len(v)):
        near = np.max(v @ np.array(starts).T, axis=1)
        if near.min() > 0.999:
            break
        starts.append(v[near.argmin()])
    c = np.array(starts)
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.array([v[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    least: np.ndarray  # lowest cosine that is not rejected, by centroid and class of length


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py())
            df += counts > 0
            n += 1
    if n:
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["bucket", "df"])


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on rows with a language and a letter in the text. The model is some megabytes for each hundred languages."""
    rows = labelled.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    found = {r[0]: r[1] for r in rows.select("text").mapInArrow(_document_frequency, "bucket long, df long").groupBy("bucket").agg(F.sum("df")).collect()}
    n = found.pop(-1, 0)
    df = np.zeros(BUCKETS)
    for b, x in found.items():
        df[b] = x
    idf = (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32)

    # First the smallest hashes of each (language, slice), then those of the language: a frequent language is no single group.
    keys = rows.select("key", "lang", F.xxhash64("key").alias("h"), F.pmod(F.hash("key"), F.lit(SLICES)).alias("slice"))
    for group in (["lang", "slice"], ["lang"]):
        order = Window.partitionBy(*group).orderBy("h", "key")
        keys = keys.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE).drop("r")
    chosen = keys.select("key", "lang").distinct()
    sample = store(rows.join(chosen, ["key", "lang"], "left_semi").withColumn("held", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(3)) == 0), "language-sample")  # at most SAMPLE rows a language

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[[has_letter(t) for t in pdf["text"]]].sort_values("key")
        out = []
        if len(pdf):
            v = vectors(np.array([gram_counts(t) for t in pdf["text"]]), idf)
            rest = v[~pdf["held"].to_numpy(bool)]
            out = [(trial, x) for trial, part in ((False, v), (True, rest)) if len(part) for x in cluster(part, CENTROIDS)]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(out) if out else [], "trial": [t for t, _ in out], "centroid": [x.astype("<f4").tobytes() for _, x in out]})

    fitted = sorted(sample.groupBy("lang").applyInPandas(fit, "lang string, trial boolean, centroid binary").collect())
    c = np.array([np.frombuffer(r[2], "<f4") for r in fitted if not r[1]]).reshape(-1, BUCKETS)
    langs = [r[0] for r in fitted if not r[1]]
    trial = np.array([np.frombuffer(r[2], "<f4") for r in fitted if r[1]]).reshape(-1, BUCKETS)
    trial_langs = [r[0] for r in fitted if r[1]]
    reached = {}
    if trial_langs:
        cosines = sample.where("held").select("key", "text", "lang").mapInPandas(_pieces_compared(trial, trial_langs, idf), "lang string, length int, own boolean, cosine double")
        reached = {(r[0], r[1]): (r[2], r[3]) for r in cosines.groupBy("lang", "length").agg(
            F.percentile_approx(F.when(F.col("own"), F.col("cosine")), 0.01), F.percentile_approx(F.when(~F.col("own"), F.col("cosine")), 0.5)).collect()}
    least = [[limit(*reached.get((lang, i), (None, None)), i) for i in range(CLASSES)] for lang in langs]
    return Model(idf, c.astype(np.float32), langs, np.array(least).reshape(-1, CLASSES))


def _pieces_compared(centroids: np.ndarray, langs: list[str], idf: np.ndarray):
    """Cosines of pieces of texts, and of the whole texts, to each language's nearest centroid."""
    names = sorted(set(langs))
    first = np.searchsorted(np.array(langs), names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, text, lang in zip(pdf["key"], pdf["text"], pdf["lang"], strict=True):
                pieces = [text]
                for i in range(1, CLASSES):
                    n = 3 << (i + 1)  # halfway to the next class
                    if n < len(text):
                        at = zlib.crc32(f"{key} {i}".encode()) % (len(text) - n + 1)
                        pieces.append(text[at : at + n])
                counts = np.array([gram_counts(t) for t in pieces if has_letter(t)])
                if not len(counts):
                    continue
                cos = np.maximum.reduceat(vectors(counts, idf) @ centroids.T, first, axis=1)
                length = length_class(counts)
                yield pd.DataFrame({"lang": np.tile(names, len(counts)), "length": np.repeat(length, len(names)).astype("int32"),
                                    "own": np.tile([n == lang for n in names], len(counts)), "cosine": cos.ravel().astype(float)})

    return run


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """``docs``' ``key`` and ``extra`` columns, with ``lang_pred``, ``score`` (cosine, from 0 to 1) and ``rejected``.

    Only ``text`` goes into a prediction. ``rejected`` texts have the nearest language all the same, or ``und``.
    """
    rows = docs.select(F.struct(F.col(key).alias(key), *(extra or [])).alias("own"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [t.as_py() for t in part.column(1)]
                ok = np.array([has_letter(t) for t in texts], bool)
                if not len(model.langs):
                    ok[:] = False
                langs, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if ok.any():
                    counts = np.array([gram_counts(t) for t, o in zip(texts, ok, strict=True) if o])
                    cos = vectors(counts, model.idf) @ model.centroids.T
                    best = cos.argmax(axis=1)
                    top = cos[np.arange(len(best)), best]
                    for i, b in zip(np.flatnonzero(ok).tolist(), best.tolist(), strict=True):
                        langs[i] = model.langs[b]
                    score[ok] = np.clip(top, 0, 1)
                    rejected[ok] = (top <= 0) | (top < model.least[best, length_class(counts)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["own", "lang_pred", "score", "rejected"])

    schema = rows.select("own").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema).select("own.*", "lang_pred", "score", "rejected")
