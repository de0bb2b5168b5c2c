"""Benchmark decontamination by latent semantic retrieval.

Texts are lower-cased and cut into words, ASCII punctuation parting them, and words become 32-bit
hashes. Passages of ``PASSAGE`` words, each overlapping the next by half, give TF-IDF vectors over
``BUCKETS`` hashed words. All passages of all documents are the rows of a matrix A. One
distributed pass multiplies the passage matrix A with a random matrix O of ``RANK`` columns and
with its own transpose; from Y = A'AO the driver gets the leading right singular vectors of A
(the Nystroem form of the randomised SVD, which needs no further pass). Every passage is projected on them and compared by cosine with the benchmark's passages.
Near ones that share enough words with the item are read in the text: a document matches an item if the longest common subsequence of
the item's words and of the words around a passage covers ``COVERED`` of the item, wherever in
the item they stand.

Cosine and shared words lose matches, as of an item that is short beside a passage, or one that is spread
over several. So an exact second way in stands beside them: whoever covers ``COVERED`` of an item
leaves out so many of its words at most, and thus holds ``SPARE`` + 1 or more of any so many and
``SPARE`` + 1 further ones. Those are the item's rarest words; where so many of them stand as close
as around one passage, the item is read in the text like a candidate of the latent search. So all
pairs that reach ``COVERED`` are found, whatever their cosine, which is given for these too. How much of the item's end, its last fifth, is covered is given as ``answer``
and decides nothing, as items have no column that says where an answer stands.

The benchmark is a stated query set: it is compared in blocks of ``QUERY_BLOCK`` items. What
the driver holds is bounded by BUCKETS * RANK and by the benchmark. Word counts cover
all passages of all documents; nothing is sampled or passed over.

Null and empty texts and items, and those without words, match nothing. Items shorter than
``LEAST_WORDS`` words are too common to match by a share of their words: with ``shortest`` set,
those of so many words or more match where all their words stand together in order, found by the
hashes of all runs of that length; without it they are left out. Documents without a number are
dropped. Rows that repeat a number are joined into one set of matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import mix, store, word_hashes

PASSAGE, STEP = 24, 12
BUCKETS = 1 << 14
RANK = 64
COSINE = 0.6
COVERED = 0.7
SPARE = 3
LEAST_WORDS = 8
QUERY_BLOCK = 1_000
BATCH_WORDS = 100_000
SKETCH_WORDS = 1_500_000  # of which the rows of Y are summed together

_PARTING = bytes.maketrans(bytes(i for i in range(33, 127) if not chr(i).isalnum()), b" " * sum(not chr(i).isalnum() for i in range(33, 127)))


def words_of(text: str | None) -> np.ndarray:
    """32-bit hashes of a text's words, in order."""
    return (word_hashes((text or "").lower().encode("utf-8", "surrogatepass").translate(_PARTING)) >> np.uint64(32)).astype(np.uint32)


def _places(rows: list[int], lengths: list[int], width: int) -> tuple[np.ndarray, int]:
    """Where the words of texts stand if each text begins a new row of ``width`` places, and has ``rows`` of them; and the rows of all."""
    rows, lengths = np.array(rows, np.int64), np.array(lengths, np.int64)
    begin = (np.cumsum(rows) - rows) * width
    return np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum())), int(rows.sum())


def _laid(words: np.ndarray, place: np.ndarray, n: int, width: int) -> np.ndarray:
    """Buckets of words in ``n`` rows; places without a word have ``BUCKETS``."""
    rows = np.full(n * width, BUCKETS, np.uint16)
    rows[place] = words & np.uint32(BUCKETS - 1)
    return rows.reshape(n, width)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of words for each document, and last a row with the task's passage counts by bucket."""
    df, passages, held, waiting = np.zeros(BUCKETS, np.int64), 0, [], 0
    names = ["key", "words", "df"]

    def count() -> None:
        """Adds the passages of ``held`` to the counts; these do not overlap, and each counts a bucket once."""
        nonlocal passages
        place, n = _places([-(-len(w) // PASSAGE) for w in held], [len(w) for w in held], PASSAGE)
        rows = _laid(np.concatenate(held), place, n, PASSAGE)
        rows.sort(axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = BUCKETS
        df[:] += np.bincount(rows.ravel(), minlength=BUCKETS + 1)[:BUCKETS]
        passages += n

    for batch in batches:
        keys, out, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            w = words_of(text.as_py())
            keys.append(key.as_py())
            out.append(w.tobytes())
            held.append(w)
            waiting += len(w)
            if waiting >= BATCH_WORDS:
                count()
                held, waiting = [], 0
            size += len(w)
            if size > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary()), pa.nulls(len(keys), pa.list_(pa.int64()))], names)
                keys, out, size = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary()), pa.nulls(len(keys), pa.list_(pa.int64()))], names)
    if held:
        count()
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([[passages, *df.tolist()]], pa.list_(pa.int64()))], names)


class Halves:
    """The words of texts in rows of ``STEP``, of which two neighbours of one text are a passage.

    A text with words has two rows or more, so that a short text is one passage. ``start`` has the
    first row of every passage, ``text`` the number of its text and ``at`` its first word there.
    """

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts], np.int64)
        rows = np.where(lengths > 0, np.maximum(2, -(-lengths // STEP)), 0)
        self.words = np.concatenate(texts)
        self.place, self.n = _places(rows, lengths, STEP)
        begin = np.cumsum(rows) - rows
        starts = np.ones(self.n, bool)
        starts[(begin + rows - 1)[rows > 0]] = False
        self.start = np.flatnonzero(starts)
        self.text = np.repeat(np.arange(len(texts)), np.maximum(rows - 1, 0))
        self.at = (self.start - begin[self.text]) * STEP

    def buckets(self) -> np.ndarray:
        """Buckets of the words, a column for each row; ``BUCKETS`` where there is no word."""
        return np.ascontiguousarray(_laid(self.words, self.place, self.n, STEP).T)

    def columns(self, values: np.ndarray, blank: int) -> np.ndarray:
        """Other values of the words in the same places."""
        rows = np.full(self.n * STEP, blank, values.dtype)
        rows[self.place] = values
        return np.ascontiguousarray(rows.reshape(self.n, STEP).T)

    def passages(self, rows: np.ndarray) -> np.ndarray:
        """Sums of the two rows of every passage."""
        return rows[self.start] + rows[self.start + 1]


def pieces_of(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a long text, with their first words' places, that have every passage of it once; a shorter text is one part."""
    size = BATCH_WORDS // STEP * STEP
    for lo in range(0, max(1, len(words) - STEP), size):
        yield lo, words[lo : lo + size + STEP]


def summed(table: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """For every column of row numbers the sum of those rows of ``table``."""
    columns = columns.astype(np.intp)
    out = np.empty((columns.shape[1], table.shape[1]), table.dtype)
    for lo in range(0, len(out), 512):  # what is added to stays in the cache
        part = out[lo : lo + 512]
        table.take(columns[0, lo : lo + 512], axis=0, out=part, mode="clip")
        one = np.empty_like(part)
        for c in columns[1:, lo : lo + 512]:
            table.take(c, axis=0, out=one, mode="clip")
            part += one
    return out


def with_blank(table: np.ndarray) -> np.ndarray:
    """``table`` and a last row of zeros, for places without a word."""
    return np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])


def _sketch(idf: np.ndarray, rank: int):
    """Blocks of the rows of Y, from all passages of a task."""
    weighted = with_blank(np.random.default_rng(6).normal(size=(BUCKETS, rank)).astype(np.float32) * idf[:, None])
    square = np.append(idf**2, np.float32(0))

    def part(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the words of texts add to Y: rows to be added, buckets, and for each of these the number of its row.

        A passage counts a bucket once. A word that its half has before counts nothing; one that the
        half before has counts in the passage that begins with its own half only.
        """
        halves = Halves(texts)
        words, start, n = halves.buckets(), halves.start, halves.n
        for j in range(1, STEP):
            for k in range(j):
                words[j][words[j] == words[k]] = BUCKETS
        before = np.zeros(words.shape, bool)
        for j in range(STEP):
            for k in range(STEP):
                before[j, 1:] |= words[j, 1:] == words[k, :-1]
        second = np.zeros(n, bool)
        second[start + 1] = True
        before &= second & (words < BUCKETS)
        twice = np.zeros((n, rank), np.float32)
        for j in range(STEP):
            at = np.flatnonzero(before[j])
            twice[at] += weighted[words[j, at]]
        weight = square[words]
        norm2 = halves.passages(weight.sum(axis=0)) - (weight * before).sum(axis=0)[start + 1]
        projected = halves.passages(summed(weighted, words)) - twice[start + 1]
        projected /= np.maximum(norm2, 1e-12)[:, None]
        rows = np.zeros((2 * n, rank), np.float32)  # of both passages of a half, and of the one that begins with it
        rows[start] = rows[n + start] = projected
        rows[start + 1] += projected
        there = words < BUCKETS
        return rows, words[there], (np.arange(n) + n * before)[there]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, parts, size, ones = np.zeros((BUCKETS, rank)), [], 0, np.ones(4_096, np.float32)

        def add() -> None:
            first = np.cumsum([0, *[len(rows) for rows, _, _ in parts]])
            rows, bucket = np.concatenate([r for r, _, _ in parts]), np.concatenate([b for _, b, _ in parts])
            no = np.concatenate([n + f for (_, _, n), f in zip(parts, first, strict=False)])[np.argsort(bucket, kind="stable")]
            ends = np.cumsum(np.bincount(bucket, minlength=BUCKETS))
            lo = 0
            for b, end in enumerate(ends.tolist()):
                while lo < end:
                    hi = min(end, lo + len(ones))
                    y[b] += ones[: hi - lo] @ rows.take(no[lo:hi], axis=0)
                    lo = hi

        for batch in batches:
            for _, texts in _grouped(batch.column(0)):
                for some in _in_batches([piece for text in texts for _, piece in pieces_of(text)]):
                    parts.append(part(some))
                    size += sum(len(t) for t in some)
                    if size >= SKETCH_WORDS:
                        add()
                        parts, size = [], 0
        if parts:
            add()
        for i in range(0, BUCKETS, 256):
            if y[i : i + 256].any():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([(y[i : i + 256] * idf[i : i + 256, None]).astype("<f4").tobytes()], pa.binary())], ["block", "y"])

    return run


def latent_space(tokens: DataFrame, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(idf by bucket, right singular vectors as BUCKETS x rank) of all passages in ``tokens``."""
    import pandas as pd

    sums = dict(tokens.where("df IS NOT NULL").select(F.posexplode("df").alias("i", "n")).groupBy("i").agg(F.sum("n")).collect())
    passages = sums.get(0, 0)
    df = np.array([sums.get(i + 1, 0) for i in range(BUCKETS)], np.float64)
    idf = np.log((passages + 1) / (df + 1)).astype(np.float32) + np.float32(1e-3)

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(y, "<f4").astype(np.float64) for y in pdf["y"])
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "y": [total.astype("<f8").tobytes()]})

    parts = (tokens.where("words IS NOT NULL").select("words").mapInArrow(_sketch(idf, rank), "block long, y binary")
             .groupBy("block").applyInPandas(added, "block long, y binary").collect())
    y = np.zeros((BUCKETS, rank))
    for block, data in parts:
        got = np.frombuffer(data, "<f8").reshape(-1, rank)
        y[block : block + len(got)] = got
    omega = np.random.default_rng(6).normal(size=(BUCKETS, rank)).astype(np.float32).astype(np.float64)
    core = omega.T @ y
    values, basis = np.linalg.eigh((core + core.T) / 2)
    keep = values > max(values.max(), 0) * 1e-10
    if not keep.any():
        return idf, np.zeros((BUCKETS, 1), np.float32)
    v, _, _ = np.linalg.svd(y @ (basis[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return idf, v.astype(np.float32)


def projected(words: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unit latent vectors of the passages that begin at ``starts``."""
    rows = np.array([table[(words[s : s + PASSAGE] & np.uint32(BUCKETS - 1)).astype(np.int64)].sum(axis=0) for s in starts.tolist()], np.float32)
    rows = rows.reshape(len(starts), table.shape[1])
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def passage_starts(words: np.ndarray) -> np.ndarray:
    """Starts of all passages, half overlapping; a short text is one passage."""
    at = np.arange(0, len(words), STEP)
    return at[:-1] if len(at) > 1 else at


def common_subsequence(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words of ``item`` a longest common subsequence with ``text`` can hold, as bits set by the bit-parallel method.

    The number of set bits is the length; bit i set means that the subsequences of the first
    i + 1 words are longer than those of the first i.
    """
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in text.tolist():
        m = where.get(w)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    bits = full & ~v
    return np.array([bits >> i & 1 for i in range(len(item))], bool)


def least_words(n: int) -> int:
    """The smallest number of an item's ``n`` words that covers ``COVERED`` of it."""
    return next(k for k in range(n + 1) if k / n >= COVERED)


class RareWords:
    """Finds the items of which a text holds enough of the rarest words, as close as around one passage.

    A common subsequence of ``least_words`` leaves out the rest of the item's words, so that of any
    ``SPARE`` + 1 more than those it has ``SPARE`` + 1 or more. No item that reaches ``COVERED`` is missed.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], idf: np.ndarray):
        taken, owner = [], []
        for i, (_, w) in enumerate(items):
            order = np.argsort(-idf[w & np.uint32(BUCKETS - 1)], kind="stable")
            taken.append(np.unique(w[order[: len(w) - least_words(len(w)) + 1 + SPARE]]))
            owner.append(np.full(len(taken[-1]), i))
        flat, owners = np.concatenate(taken), np.concatenate(owner)
        order = np.argsort(flat, kind="stable")
        self.owners = owners[order]
        self.words, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.known = np.zeros(1 << 20, bool)
        self.known[self.words & np.uint32((1 << 20) - 1)] = True
        self.span = np.array([PASSAGE + 2 * len(w) for _, w in items])

    def places(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """For each of ``texts``: items, and the first and the last start of passages around which enough of their words stand.

        All texts are looked at together, set apart by more than a span.
        """
        words, begin = np.concatenate(texts), np.cumsum([0, *[len(t) for t in texts]])
        place = np.flatnonzero(self.known[words & np.uint32((1 << 20) - 1)])
        no = np.minimum(np.searchsorted(self.words, words[place]), len(self.words) - 1)
        same = self.words[no] == words[place]
        place, no = place[same], no[same]
        many = self.many[no]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        owner, place = self.owners[np.repeat(self.first[no], many) + nth], np.repeat(place, many)
        text = np.searchsorted(begin, place, "right") - 1
        key = owner << 40 | place + text * int(self.span.max())
        order = np.argsort(key)
        key, owner, text, place = key[order], owner[order], text[order], (place - begin[text])[order]
        start = max(0, len(key) - SPARE)
        near = np.flatnonzero(key[SPARE:] - key[:start] < self.span[owner[:start]])
        length = (self.span[owner[near]] - PASSAGE) // 2
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for t, *one in zip(text[near].tolist(), owner[near].tolist(), (place[near + SPARE] - PASSAGE - length + 1).tolist(), (place[near] + length).tolist(), strict=True):
            found[t].append(tuple(one))
        return found


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` words, in order of the runs' starts."""
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        total = mix(total * np.uint64(2 * i + 3) + words[i : i + len(total)].astype(np.uint64) + np.uint64(1))
    return total


def _runs(items: list[tuple[int, np.ndarray]]):
    """Finds short items word for word, a sorted table of hashes for each length."""
    lengths = sorted({len(w) for _, w in items})
    tables = []
    for n in lengths:
        numbers, hashes = zip(*[(i, runs_of(w, n)[0]) for i, w in items if len(w) == n], strict=True)
        order = np.argsort(np.array(hashes, np.uint64), kind="stable")
        tables.append((n, np.array(hashes, np.uint64)[order], np.array(numbers, np.int64)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for key, data in zip(batch.column(0), batch.column(1), strict=True):
                words = np.frombuffer(data.as_py(), np.uint32)
                for n, hashes, numbers in tables:
                    mine = np.sort(runs_of(words, n))
                    hit = np.searchsorted(mine, hashes, "left") < np.searchsorted(mine, hashes, "right")
                    found += numbers[hit].tolist()
                    keys += [key.as_py()] * int(hit.sum())
            whole = pa.array(np.ones(len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64()), whole, whole, whole], ["key", "item", "cosine", "covered", "answer"])

    return run


def _in_batches(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """``texts`` in groups of about ``BATCH_WORDS`` words."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= BATCH_WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _grouped(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Words of the documents of a batch, in groups of about ``BATCH_WORDS`` words, and the number of each group's first document."""
    first, texts, size = 0, [], 0
    for data in column:
        texts.append(np.frombuffer(data.as_py(), np.uint32))
        size += len(texts[-1])
        if size >= BATCH_WORDS:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


def _search(items: list[tuple[int, np.ndarray]], idf: np.ndarray, table: np.ndarray):
    """Matches of a block of items."""
    known = [np.unique(w) for _, w in items]
    vocabulary = np.unique(np.concatenate(known))
    member = np.zeros((len(vocabulary) + 1, len(items)), bool)
    for i, k in enumerate(known):
        member[np.searchsorted(vocabulary, k), i] = True
    stated = np.zeros(1 << 20, bool)
    stated[vocabulary & np.uint32((1 << 20) - 1)] = True
    lengths = np.array([len(w) for _, w in items])
    least = [least_words(n) for n in lengths.tolist()]
    times = [np.unique(w, return_counts=True)[1] for _, w in items]
    # Wherever an item stands, one of the half-overlapping passages holds this many of its words; most of them must be there.
    need = 0.85 * COVERED * np.where(lengths > STEP, np.minimum(lengths + STEP, 3 * STEP) / 2, lengths)
    enough = np.ceil(need).astype(np.uint8)
    vectors = [projected(w, passage_starts(w), table) for _, w in items]
    owner, vectors = np.repeat(np.arange(len(items)), [len(x) for x in vectors]), np.concatenate(vectors)
    bounds = np.searchsorted(owner, np.arange(len(items) + 1))
    table = with_blank(table)

    def places(words: np.ndarray) -> np.ndarray:
        """The words' numbers in the vocabulary, its length for others."""
        at = np.full(len(words), len(vocabulary), np.int32)
        maybe = np.flatnonzero(stated[words & np.uint32((1 << 20) - 1)])
        no = np.minimum(np.searchsorted(vocabulary, words[maybe]), len(vocabulary) - 1)
        same = vocabulary[no] == words[maybe]
        at[maybe[same]] = no[same]
        return at

    def nearest(texts: list[np.ndarray], at: np.ndarray) -> list[list[tuple[int, int, float]]]:
        """For each of ``texts``: starts of passages, items they are near to and share enough words with, and cosines.

        All passages are compared with all of the items' passages.
        """
        found: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        ends = np.cumsum([len(t) for t in texts])
        pieces = [(t, lo, piece, at[end - len(text) + lo :][: len(piece)]) for t, (text, end) in enumerate(zip(texts, ends.tolist(), strict=True)) for lo, piece in pieces_of(text)]
        done = 0
        for part in _in_batches([piece for _, _, piece, _ in pieces]):
            text, begin, _, numbers = zip(*pieces[done : done + len(part)], strict=True)
            done += len(part)
            halves = Halves(part)
            text, first = np.array(text)[halves.text], np.array(begin)[halves.text] + halves.at
            latent = halves.passages(summed(table, halves.buckets()))
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
            shared = halves.passages(summed(member.view(np.uint8), halves.columns(np.concatenate(numbers), len(vocabulary))))
            some = (shared >= enough).any(axis=1)
            for lo in range(0, len(latent), 1_024):
                cos = latent[lo : lo + 1_024] @ vectors.T
                rows = np.flatnonzero(some[lo : lo + 1_024])
                cos = cos[rows]
                p, q = np.nonzero(cos >= COSINE)
                near = shared[lo + rows[p], owner[q]] >= enough[owner[q]]
                p, q = p[near], q[near]
                which = lo + rows[p]
                for t, *one in zip(text[which].tolist(), first[which].tolist(), owner[q].tolist(), cos[p, q].tolist(), strict=True):
                    found[t].append(tuple(one))
        return found

    def around(i: int, words: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray | None:
        """Words of item ``i`` around the passages from ``first`` to ``last``; none if there are too few to cover it in any order."""
        region = slice(max(0, first - len(items[i][1])), min(len(words), last + PASSAGE + len(items[i][1])))
        text = words[region][member[at[region], i]]
        if len(text) < least[i]:
            return None
        common = np.minimum(np.bincount(np.searchsorted(known[i], text), minlength=len(known[i])), times[i])
        return text if common.sum() >= least[i] else None

    def read(i: int, words: np.ndarray, at: np.ndarray, s: int) -> tuple[float, float]:
        """What the words around the passage at ``s`` cover of item ``i`` and of its end."""
        text = around(i, words, at, s, s)
        if text is None:
            return 0.0, 0.0
        hit = common_subsequence(items[i][1], text)
        return float(hit.mean()), float(hit[-max(3, len(hit) // 5) :].mean())

    def best_of(words: np.ndarray, at: np.ndarray, candidates: list[tuple[int, int, float]], close: list[tuple[int, int, int]]) -> dict[int, tuple[float, float, float]]:
        best: dict[int, tuple[float, float, float]] = {}
        done: dict[int, int] = {}
        failed: set[tuple[int, int]] = set()
        for s, i, c in candidates:
            if s < done.get(i, -1) or (s, i) in failed:  # a match before covers this passage, or another passage of the item led here
                continue
            share, end = read(i, words, at, s)
            if share >= COVERED:
                done[i] = s + PASSAGE
                best[i] = max(best.get(i, (0.0, 0.0, 0.0)), (share, c, end))
            else:
                failed.add((s, i))
        every = passage_starts(words)
        chosen: dict[int, set[int]] = {}
        for i, lo, hi in close:
            if i not in best:
                chosen.setdefault(i, set()).update(every[np.searchsorted(every, lo) : np.searchsorted(every, hi, "right")].tolist())
        for i, starts in chosen.items():
            inside = -1  # the last of neighbouring passages around which words may be enough
            for s in sorted(starts):
                if s > inside:
                    inside = s
                    while inside + STEP in starts:
                        inside += STEP
                    if around(i, words, at, s, inside) is None:
                        failed.update((x, i) for x in range(s, inside + 1, STEP))
                if (s, i) in failed:
                    continue
                share, end = read(i, words, at, s)
                if share >= COVERED:
                    c = float((projected(words, np.array([s]), table) @ vectors[bounds[i] : bounds[i + 1]].T).max())
                    best[i] = max(best.get(i, (0.0, -1.0, 0.0)), (share, c, end))
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = RareWords(items, idf)
        for batch in batches:
            out: list[tuple] = []
            for first, texts in _grouped(batch.column(1)):
                keys = batch.column(0).slice(first, len(texts)).to_pylist()
                at = places(np.concatenate(texts))
                ends = np.cumsum([len(t) for t in texts])
                for key, words, end, candidates, close in zip(keys, texts, ends.tolist(), nearest(texts, at), rare.places(texts), strict=True):
                    if candidates or close:
                        out += [(key, items[i][0], c, s, e) for i, (s, c, e) in best_of(words, at[end - len(words) : end], candidates, close).items()]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[2:]]],
                                             ["key", "item", "cosine", "covered", "answer"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
            shortest: int | None = None) -> DataFrame:
    """(``key``, ``item_key``, ``cosine``, ``covered``, ``answer``) for every document and item that match.

    ``shortest`` is the number of words from which items of fewer than ``LEAST_WORDS`` are looked for word for word.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).where("key IS NOT NULL")
    tokens = store(rows.mapInArrow(_tokens, "key long, words binary, df array<long>"), "tokens")
    schema = f"`{key}` long, `{item_key}` long, cosine double, covered double, answer double"
    stated = benchmark.select(F.col(item_key).cast("long"), F.col(item_text).cast("string")).where(F.col(item_key).isNotNull()).distinct().collect()
    every = [(i, words_of(t)) for i, t in sorted((i, t) for i, t in stated if t)]
    items = [(i, w) for i, w in every if len(w) >= LEAST_WORDS]
    short = [(i, w) for i, w in every if shortest is not None and max(1, shortest) <= len(w) < LEAST_WORDS]
    result = "key long, item long, cosine double, covered double, answer double"
    texts = tokens.where("words IS NOT NULL").select("key", "words")
    parts = []
    if items:
        idf, v = latent_space(tokens)
        table = v * idf[:, None]
        parts += [texts.mapInArrow(_search(items[lo : lo + QUERY_BLOCK], idf, table), result) for lo in range(0, len(items), QUERY_BLOCK)]
    if short:
        parts.append(texts.mapInArrow(_runs(short), result))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = reduce(DataFrame.unionByName, parts)
    return (found.groupBy(F.col("key").alias(key), F.col("item").alias(item_key))
            .agg(F.max("cosine").alias("cosine"), F.max("covered").alias("covered"), F.max("answer").alias("answer")))
