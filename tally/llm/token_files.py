"""Token counts of documents in flat, unindexed token files, found by scanning for separators.

A token file is a plain run of little-endian unsigned 16 or 32-bit ids in which every document
ends with the end-of-document id. There is no index, so the borders are searched for: a block
of ids is compared with the separator at once, and each block reports its whole documents, the
document it leaves open and its first separator. A prefix scan over the blocks' open ends,
which are one small row a block, stitches documents that run across blocks.

With ``id_digits`` > 0 a document begins with that many ids that spell its number in base
32,768 (never the separator's value if that is 32,768 or more); they are not counted. Digits
of 64 bits or more are no number: a document without one has ``id`` null.

Empty files and folders without files give no rows. A separator right after another is an
empty document with 0 tokens. Ids after a file's last separator are an unfinished document
and are reported with ``complete`` false. Nothing is cut off or skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tally.llm.bpe import encoder
from tally.session import shared_folder

BASE_BITS = 15
ID_DIGITS = 5  # 75 bits, more than a long needs
BLOCK = 1 << 18  # ids in a block
DOCS_IN_FILE = 2_000  # keeps a file within a task's memory
STAND_IN = (1 << 16) - 1  # written for the separator's id where a text holds it; no vocabulary has it

_ROW = ("file string, block long, docs array<struct<id:long,start:long,n_tokens:long>>, first_sep long, open_id long, open_start long, n_ids long")
_TYPES = pa.schema([
    ("file", pa.string()), ("block", pa.int64()),
    ("docs", pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))),
    ("first_sep", pa.int64()), ("open_id", pa.int64()), ("open_start", pa.int64()), ("n_ids", pa.int64())])


def spell(number: int | None) -> np.ndarray:
    """``ID_DIGITS`` ids that stand for a long, smallest digit first; for None digits that no long has."""
    u = (1 << (BASE_BITS * ID_DIGITS)) - 1 if number is None else number & ((1 << 64) - 1)
    return np.array([(u >> (BASE_BITS * i)) & ((1 << BASE_BITS) - 1) for i in range(ID_DIGITS)], "<u2")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, eod: int, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as flat files of 16-bit ids: the document's number, its tokens, ``eod``.

    Null texts are empty documents. Rows with a null key are written with digits that no number
    has. An id of a text that is ``eod``, as a special token in the text gives, is written as
    ``STAND_IN``, so that it ends no document. All ids of the tokenizer must be below ``STAND_IN``.
    Map only: no shuffle.
    """
    if not (1 << BASE_BITS) <= eod < (1 << 16):
        raise ValueError("the separator must be an id from 32768 to 65535")
    if max(Tokenizer.from_file(tokenizer).get_vocab(True).values(), default=0) >= STAND_IN:
        raise ValueError("the tokenizer's ids do not fit the file format")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, decode=False)
        for batch in batches:
            out, size = [], 0
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(enc.encode(t.as_py())[0], "<u4")
                ids = np.where(ids == eod, STAND_IN, ids)
                out.append(spell(k.as_py()).tobytes() + ids.astype("<u2").tobytes())
                size += len(out[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    # Spark's text writer puts the bytes of a value and of the separator out as they are: a flat binary file.
    separator = int(eod).to_bytes(2, "little").decode("latin-1")
    (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
     .mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", DOCS_IN_FILE).text(path))


def scan_block(ids: np.ndarray, start: int, stop: int, eod: int, id_digits: int) -> dict:
    """What one block of a file reports. Only the digits of a document's number may be read past ``stop``."""

    def number(at: int):
        digits = ids[at : at + id_digits]
        if not id_digits or len(digits) < id_digits:
            return None
        u = sum(int(d) << (BASE_BITS * i) for i, d in enumerate(digits))
        if u >= 1 << 64:
            return None
        return u - (1 << 64) if u >= 1 << 63 else u

    seps = start + np.flatnonzero(ids[start:stop] == eod)
    begins = seps + 1
    if start == 0:
        begins = np.concatenate(([0], begins))
        ends = seps
    else:
        ends = seps[1:]
    docs = [{"id": number(int(b)), "start": int(b), "n_tokens": int(e) - int(b) - id_digits}
            for b, e in zip(begins[: len(ends)].tolist(), ends.tolist(), strict=True)]
    is_open = len(begins) > len(ends)
    at = int(begins[-1]) if is_open else None
    return {"docs": docs, "first_sep": int(seps[0]) if len(seps) and start else None,
            "open_id": number(at) if is_open else None, "open_start": at}


def count_tokens(spark: SparkSession, path: str, eod: int, width: int = 2, id_digits: int = 0, block: int = BLOCK) -> DataFrame:
    """(``file``, ``start``, ``id``, ``n_tokens``, ``complete``) for every document in the files of ``path``.

    ``start`` is the position of a document's first id in its file. Files are read through
    Spark, one a task at a time, and scanned in blocks of ``block`` ids.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                data = content.as_buffer()
                if len(data) % width:
                    raise ValueError(f"{name.as_py()} ends within an id")
                ids = np.frombuffer(data, kind) if len(data) else np.empty(0, kind)
                for no, at in enumerate(range(0, len(ids), block)):
                    row = scan_block(ids, at, min(at + block, len(ids)), eod, id_digits)
                    yield pa.RecordBatch.from_pylist([{"file": name.as_py(), "block": no, "n_ids": len(ids), **row}], schema=_TYPES)

    blocks = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _ROW)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stitched = (blocks
                .withColumn("opened", F.last(F.when(F.col("open_start").isNotNull(), F.struct("open_id", "open_start")), True).over(before))
                .withColumn("next_sep", F.min("first_sep").over(order.rowsBetween(1, Window.unboundedFollowing))))
    digits = F.lit(id_digits).cast("long")
    across = F.when(F.col("first_sep").isNotNull() & F.col("opened").isNotNull(), F.array(F.struct(
        F.col("opened.open_id").alias("id"), F.col("opened.open_start").alias("start"),
        (F.col("first_sep") - F.col("opened.open_start") - digits).alias("n_tokens"), F.lit(True).alias("complete"))))
    # A document that no later block closes; none if the file ends with a separator.
    left = F.when(F.col("next_sep").isNull() & (F.col("open_start") < F.col("n_ids")), F.array(F.struct(
        F.col("open_id").alias("id"), F.col("open_start").alias("start"),
        F.greatest(F.lit(0), F.col("n_ids") - F.col("open_start") - digits).alias("n_tokens"), F.lit(False).alias("complete"))))
    whole = F.transform("docs", lambda d: F.struct(d["id"].alias("id"), d["start"].alias("start"), d["n_tokens"].alias("n_tokens"), F.lit(True).alias("complete")))
    none = F.array().cast("array<struct<id:bigint,start:bigint,n_tokens:bigint,complete:boolean>>")
    return (stitched.select("file", F.explode(F.concat(whole, F.coalesce(across, none), F.coalesce(left, none))).alias("d"))
            .select("file", F.col("d.start").alias("start"), F.col("d.id").alias("id"), F.col("d.n_tokens").alias("n_tokens"), F.col("d.complete").alias("complete")))


def document_token_counts(docs: DataFrame, tokenizer: str, eod: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``n_tokens``) of ``docs`` by way of flat token files in the shared folder."""
    spark = docs.sparkSession
    path = shared_folder(spark, "tokens")
    write_token_files(docs, path, tokenizer, eod, key, text)
    return count_tokens(spark, path, eod, 2, ID_DIGITS).select(F.col("id").alias(key), "n_tokens")
