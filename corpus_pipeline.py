"""A pipeline over training documents; each stage works on what the one before kept.

Stages take (spark, docs, sf_dir) and return the columns of documents, but for the last, which
returns the digests of the encoded texts. Rows without a text go in the first stage. An empty
table passes through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import bpe, decontaminate, language, line_runs, near_copies
from tally.session import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those far from every learned language."""
    model = language.train(docs)
    found = language.predict(docs, model, extra=[F.struct(*docs.columns).alias("_row")])
    return found.where(~F.col("rejected")).select("_row.*")


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of line runs of 50 words or more; documents of which nothing is left go."""
    done = line_runs.remove_repeated_runs(docs)
    cut = F.size("runs_removed") > 0
    return (done.where(~(cut & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")))
            .withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8), that with the smallest number.

    A document is a number and a text: other texts of a number are judged by themselves, and of
    rows equal in both one stays, the smallest by the order of its columns.
    """
    found = store(near_copies.near_copies(docs, n_words=5, percent=80), "found")
    one = found.groupBy(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).agg(F.count("*").alias("times"), F.first("chosen").alias("chosen"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_copy"))
    once = docs.join(one.where("NOT chosen OR times > 1"), same, "left_anti")
    again = docs.join(one.where("chosen AND times > 1"), same, "left_semi")
    single = again.groupBy("doc_id", F.xxhash64("text").alias("_copy")).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return once.unionByName(single.select("_row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage; a document is a number, which may be null, and a text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = docs.withColumn("_doc", F.xxhash64("doc_id", "text"))
    found = store(decontaminate.matches(named, benchmark, key="_doc", shortest=3).select("_doc").distinct(), "contaminated")
    return named.join(found, "_doc", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``) of every document left."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("lines", remove_repeated_lines),
    ("near copies", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("encode", encode),
]

#: The tokenizer, the trained language model and the search are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
