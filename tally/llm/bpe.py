"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the text cuts it into chunks whose borders depend on nearby characters
only, so that documents that share a passage share its chunks. Documents are dealt by the
smallest chunk fingerprint, which brings most sharers into one task; there each chunk is
encoded once and its ids are reused. A cut may fall inside a word, so every join is repaired:
text from the last piece before the cut is encoded anew until its pieces agree with those of
the next chunk.

Nulls count as empty text, and empty text has no ids. Equal rows give equal results, one
each. Texts are never shortened. Memory of a task: one batch of texts and two bounded caches, which
hold ids only; decoded text is made of a text's ids when all are there.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters whose lower case, normal form and class the fast way handles, as ranges: Latin, Cyrillic, punctuation such as
#: curly quotes and dashes, currencies, kana, CJK and Hangul. Texts with others go to the tokenizer whole.
PLAIN_RANGES = ((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0xA1, 0xAC), (0xAE, 0x24F), (0x400, 0x45F), (0x48A, 0x4FF), (0x2010, 0x2027), (0x2030, 0x205E),
                (0x20A0, 0x20BF), (0x3001, 0x3003), (0x3008, 0x3011), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FEF), (0xAC00, 0xD7A3))


def _class(codes: list[int]) -> str:
    """Code points as a character class's ranges."""
    runs, out = sorted(set(codes)), []
    for c in runs:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


_PLAIN_CODES = [c for a, b in PLAIN_RANGES for c in range(a, b + 1)]
_LOWER = {ord(x) for c in _PLAIN_CODES for x in chr(c).lower()}
_LETTERS = _class([c for c in _LOWER if unicodedata.category(chr(c))[0] == "L"])
_NUMBERS = _class([c for c in _LOWER if unicodedata.category(chr(c))[0] == "N"])
PLAIN = re.compile(f"[{_class(_PLAIN_CODES)}]*")
#: The tokenizer's own split pattern, with the letters and numbers that plain text has in lower case.
PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
#: Fixed value: how the tokenizer's special tokens begin.
SPECIAL = "<|"

CHUNK_BITS = 10  # a cut after 2**10 characters in the mean
MIN_CHUNK = 256  # at least 3, so that a contraction meets one join only
WINDOW = 16
PIECES_KEPT = 150_000  # pieces in each of two generations of the cache
CHUNK_CHARS_KEPT = 8_000_000  # characters in each of two generations of the cache
BATCH_CHARS = 4_000_000
DECODED_AT_ONCE = 1 << 16  # ids

_GEAR = np.random.default_rng(9).integers(0, 1 << 32, 1024, dtype=np.uint32)


class TwoGenerations(dict):
    """A cache of bounded weight: when the young generation is full, it becomes the old one, and the old one goes."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.weight, self.old = most, 0, {}

    def put(self, key, value, weight: int = 1) -> None:
        if self.weight >= self.most:
            self.old = dict(self)
            self.clear()
            self.weight = 0
        self[key] = value
        self.weight += weight

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value


def cut_points(text: str) -> list[int]:
    """Ends of the content-defined chunks of ``text``, the last being its length; none for empty text.

    A position is a cut where the hash of the ``WINDOW`` characters before it has
    ``CHUNK_BITS`` zero bits and the chunk has ``MIN_CHUNK`` characters or more.
    """
    n = len(text)
    if n <= MIN_CHUNK:
        return [n] if n else []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    h = _GEAR[codes & 1023]
    span = 1
    while span < WINDOW:  # doubling: the hash of 2k characters from two hashes of k
        wide = h.copy()
        wide[span:] += h[:-span] << np.uint32(span)
        h, span = wide, span * 2
    ends, last = [], 0
    for p in (np.flatnonzero((h >> np.uint32(32 - CHUNK_BITS)) == 0) + 1).tolist():
        if p - last >= MIN_CHUNK and p < n:
            ends.append(p)
            last = p
    return [*ends, n]


def fingerprint(chunk: str) -> bytes:
    return hashlib.blake2b(chunk.encode("utf-8", "surrogatepass"), digest_size=12).digest()


def open_tail(text: str, pieces: list[str]) -> str:
    """The end of ``text`` whose pieces may change with the text that follows: its last piece, or
    a quote and a letter that may begin a contraction; empty if white space ends the text."""
    if not pieces or not text.endswith(pieces[-1]):
        return ""
    if pieces[-1] in ("r", "v", "l") and len(pieces) > 1 and pieces[-2] == "'" and text.endswith("'" + pieces[-1]):
        return "'" + pieces[-1]
    return pieces[-1]


class Chunk:
    """Pieces of a chunk's own text: all ids, and what a repair needs of both ends."""

    __slots__ = ("ids", "open_start", "tail", "text")

    def __init__(self, text: str, pieces: list[str], ids: bytes):
        self.text, self.ids = text, ids
        self.tail = open_tail(text, pieces)
        self.open_start = bool(pieces) and text.startswith(pieces[0])


class Encoder:
    """Ids and decoded text of whole texts, exactly as the tokenizer in ``path`` gives them."""

    def __init__(self, path: str, decode: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.decode = decode  # without, decoded texts are empty and cost nothing
        self.tok = Tokenizer.from_file(path)
        self.token = {i: t for t, i in self.tok.get_vocab(with_added_tokens=True).items()}
        self.ends_word = np.zeros(max(self.token) + 1, bool)
        self.ends_word[[i for i, t in self.token.items() if t.endswith("</w>")]] = True
        self.pieces = TwoGenerations(PIECES_KEPT)
        self.chunks = TwoGenerations(CHUNK_CHARS_KEPT)
        self.encoded = self.reused = self.repaired = 0

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that the cache does not hold."""
        new = [p for p in pieces if self.pieces[p] is None]
        if not new:
            return
        # Pieces with blanks between stay pieces, and the last token of each is marked as a word end.
        ids = np.array(self.tok.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        data, start = ids.tobytes(), 0
        for p, end in zip(new, ends, strict=True):
            self.pieces.put(p, data[4 * start : 4 * end])
            start = end

    def join(self, pieces: list[str]) -> bytes:
        """Ids of pieces in a row. A piece without tokens adds nothing."""
        for _ in range(2):
            got = [self.pieces[p] for p in pieces]
            if None not in got:
                break
            self.learn(set(pieces))
            mine = {p: self.pieces[p] for p in set(pieces)}
            got = [mine[p] for p in pieces]
            if None not in got:
                break
        else:  # more distinct pieces than the cache holds
            halves = len(pieces) // 2
            return self.join(pieces[:halves]) + self.join(pieces[halves:])
        return b"".join(got)

    def decoded(self, ids: bytes) -> str:
        """Tokens of plain text's ids, with blanks between."""
        if not self.decode:
            return ""
        codes = np.frombuffer(ids, "<u4")
        return " ".join([" ".join([self.token[i] for i in codes[at : at + DECODED_AT_ONCE].tolist()]) for at in range(0, len(codes), DECODED_AT_ONCE)])

    def chunk(self, text: str) -> Chunk:
        key = fingerprint(text)
        have = self.chunks[key]
        if have is not None and have.text == text:
            self.reused += 1
            return have
        pieces = PIECE.findall(text)
        have = Chunk(text, pieces, self.join(pieces))
        self.encoded += 1
        self.chunks.put(key, have, len(text))
        return have

    def repair(self, tail: str, right: Chunk) -> tuple[list[str], int, str | None]:
        """Pieces from ``tail`` + the right chunk's text until they agree with the right chunk's own pieces.

        Returns the pieces, how many of the chunk's own they replace, and, if the whole chunk
        went without agreement, the open tail that the next join begins with.
        """
        self.repaired += 1
        whole = tail + right.text
        own = (m.start() for m in PIECE.finditer(right.text))
        pieces, replaced, start = [], 0, next(own, None)
        for m in PIECE.finditer(whole):
            at = m.start() - len(tail)
            while start is not None and start < at:
                replaced, start = replaced + 1, next(own, None)
            if at >= 0 and at == start:
                return pieces, replaced, None
            pieces.append(m[0])
        return pieces, 0, open_tail(whole, pieces)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text."""
        text = text or ""
        if SPECIAL in text or not PLAIN.fullmatch(text):
            ids = self.tok.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes(), self.tok.decode(ids, skip_special_tokens=False) if self.decode else ""
        if not unicodedata.is_normalized("NFC", text):  # cannot happen for plain characters
            text = unicodedata.normalize("NFC", text)
        text, ids, start = text.lower(), [], 0
        held = ""  # the open tail of the text so far; not yet given out
        for end in cut_points(text):
            c = self.chunk(text[start:end])
            start = end
            c_ids = c.ids
            if held and c.open_start:
                pieces, replaced, rest = self.repair(held, c)
                held = ""
                if rest is not None:  # nothing of the chunk's own is left
                    held = rest
                    ids.append(self.join(pieces[: len(pieces) - len(PIECE.findall(rest))]))
                    continue
                ids.append(self.join(pieces))
                tail = PIECE.findall(c.tail)
                if replaced:
                    own = PIECE.findall(c.text)
                    c_ids = c_ids[len(self.join(own[:replaced])) :]
                    tail = tail[max(0, replaced - (len(own) - len(tail))) :]
            else:
                if held:
                    ids.append(self.join(PIECE.findall(held)))
                tail = PIECE.findall(c.tail)
            held = "".join(tail)
            if held:
                c_ids = c_ids[: len(c_ids) - len(self.join(tail))]
            ids.append(c_ids)
        if held:
            ids.append(self.join(PIECE.findall(held)))
        whole = b"".join(ids)
        return whole, self.decoded(whole)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, decode: bool = True) -> Encoder:
    """The task's encoder; a Python worker keeps it, with its caches, from task to task."""
    if (path, decode) not in _ENCODERS:
        _ENCODERS[path, decode] = Encoder(path, decode)
    return _ENCODERS[path, decode]


def _smallest_fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``bin``: the smallest fingerprint of a text's chunks, by which sharers meet."""
    for batch in batches:
        bins = []
        for text in batch.column(1):
            t, start, low = (text.as_py() or "").lower(), 0, 0
            for end in cut_points(t):
                x = int.from_bytes(fingerprint(t[start:end])[:7], "little") + 1
                low, start = min(low, x) if low else x, end
            bins.append(low)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins, pa.int64())], ["key", "text", "bin"])


def deal_by_chunk(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """(``key``, ``text``, ``bin``), dealt so that texts that share chunks mostly meet in a task.

    The rebalance lets adaptive execution split a bin that holds many copies over tasks.
    """
    rows = docs.select(key.cast("long").alias("key"), text.cast("string").alias("text"))
    binned = rows.mapInArrow(_smallest_fingerprint, "key long, text string, bin long")
    return binned.hint("rebalance", "bin")


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decode: bool = True) -> DataFrame:
    """(``key``, ``n_tokens``, ``ids`` binary, ``decoded``) for every row of ``docs``.

    ``ids`` holds little-endian unsigned 32-bit integers. Other columns are dropped.
    """
    return _encoded(docs, path, key, text, "key long, n_tokens long, ids binary, decoded string",
                    lambda ids, dec: (len(ids) // 4, ids, dec if decode else None),
                    [pa.int64(), pa.binary(), pa.string()]).withColumnRenamed("key", key)


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``): digests of what :func:`encode_texts` gives, made in the same task."""
    return _encoded(docs, path, key, text, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                    lambda ids, dec: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(dec.encode()).hexdigest()),
                    [pa.int64(), pa.string(), pa.string()]).withColumnRenamed("key", key)


def _encoded(docs: DataFrame, path: str, key: str, text: str, schema: str,
             make: Callable[[bytes, str], tuple], types: list[pa.DataType]) -> DataFrame:
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)

        def emit(keys, rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names)

        for batch in batches:
            keys, rows, size = [], [], 0
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                t = t.as_py() or ""
                keys.append(k.as_py())
                rows.append(make(*enc.encode(t)))
                size += len(t)
                if size > BATCH_CHARS:
                    yield emit(keys, rows)
                    keys, rows, size = [], [], 0
            if keys:
                yield emit(keys, rows)

    return deal_by_chunk(docs, F.col(key), F.col(text)).select("key", "text").mapInArrow(run, schema)
