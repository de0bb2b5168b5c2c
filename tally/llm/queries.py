"""The registered queries of this subpackage."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tally.llm import bpe, chats, checks, decontaminate, language, line_runs, merkle, near_copies, neighbours, personal, shards, spelling, token_files, toxicity
from tally.llm.common import crc_mod, read

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD_BPE_END = 49_407  # <|endoftext|>
SHORTEST_ITEM = 3  # words; shorter ones are in most texts
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = language.train(docs.where(~held_out))
    return language.predict(docs, model, extra=[held_out.alias("held_out")])


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(``doc_id``, ``kept_text``, ``n_removed`` lines, ``runs``) of every document; runs are first-last, comma-joined."""
    done = line_runs.remove_repeated_runs(read(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("text").alias("kept_text"),
                       F.aggregate("runs_removed", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1).cast("long").alias("n_removed"),
                       F.array_join(F.transform("runs_removed", lambda r: F.concat_ws("-", r["first"], r["last"])), ",").alias("runs"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 0
    model = toxicity.train(docs, read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model, extra=[held_out.alias("held_out")]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(``doc_id``, ``n_tokens``): tokens of every document, counted in flat token files."""
    return token_files.document_token_counts(read(spark, sf_dir, "documents"), WORD_BPE, WORD_BPE_END)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(``doc_id``, ``item_id``, ``cosine``, ``covered``, ``answer``) of every document that holds a benchmark passage."""
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), shortest=SHORTEST_ITEM)


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(read(spark, sf_dir, "documents")).drop("copy", "chosen")


def op8_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.histogram_shards(read(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit(shards.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), WORD_BPE)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_spans(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in personal.BASE]
    return found.select("doc_id", *counts, F.sha2(personal.span_text("base"), 256).alias("base_sha256"), personal.span_text("spans").alias("spans"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_rows(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of each row of ``docs``, and what its leaf gives with every fifth text lower-cased."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = [F.col(f) for f in FIELDS[:-1]] + [F.when(changed, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))]
    made = merkle.manifest(docs, FIELDS, "doc_id", "source", {"given": F.when(changed, merkle.leaf(tampered))})
    root = F.lit(made.root).cast("string")
    folded = made.rows.withColumn("folded_root", merkle.fold(F.coalesce("extra.given", "leaf")))
    return folded.select(F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"), merkle.proof_digest().alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == root).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(read(spark, sf_dir, "documents"))


def one_lost(run: str, data: bytes, start: int) -> str:
    """A run without one code point, if its check sum says so."""
    h = crc32(data, start)
    if h % 199:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents"), alter=one_lost))


PIECE = 200  # code points of a streamed delta
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def chat_events(rows: DataFrame) -> DataFrame:
    """A log that ends in the rows (``conv_id``, ``turn``, ``role``, ``text``), in order of turn.

    Assistant texts are streamed, at first as a draft that ends after one piece and is then
    regenerated; the others come at once and in upper case, and are edited. Rows of one turn are
    ordered by role and text, null turns come first.
    """
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = rows.select("conv_id", F.struct("turn", copy.alias("copy")).alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("text"), F.lit(1)), F.lit(PIECE))
    event = lambda n, kind, text: F.struct(F.lit(n).alias("n") if isinstance(n, int) else n.alias("n"), F.lit(kind).alias("kind"), text.alias("text"))
    streamed = F.transform(starts, lambda at, i: event(i + 3, "delta", F.substr(F.col("text"), at, F.lit(PIECE))))
    empty = F.lit("")
    answer = F.concat(F.array(event(0, "message", empty), event(1, "delta", F.substring("text", 1, PIECE)), event(2, "regenerate", empty)), streamed)
    other = F.array(event(0, "message", F.upper("text")), event(1, "edit", F.col("text")))
    events = rows.select("conv_id", "message", "role", F.explode(F.when(F.col("role") == chats.LEARNT, answer).otherwise(other)).alias("e"))
    return events.select("conv_id", F.struct("message", "e.n").alias("seq"), "e.kind", "message", F.when(F.col("e.kind") == "message", F.col("role")).alias("role"), "e.text")


def chat_rows(rows: DataFrame) -> DataFrame:
    done = chats.render(chats.fold(chat_events(rows)))
    turns, loss = chats.read_turns(F.col("formatted")), chats.read_loss(F.col("formatted"), F.col("loss_spans"))
    read = done.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_rows(rows.unionByName(spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_line_runs, op3_neighbours, op4_toxicity, op5_token_counts, op6_decontaminate, op7_near_copies, op8_histogram_shards, op9_bpe, op10_personal_data, op11_merkle_manifest, op12_spelling, op13_chat_format)}
SQL: dict[str, str] = {"op7_near_copies": checks.NEAR_COPIES, "op11_merkle_manifest": checks.MERKLE, "op12_spelling": checks.SPELLING, "op13_chat_format": checks.CHATS}
