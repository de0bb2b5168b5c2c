"""Groups of spelling variants: words one edit apart, the rarer led to the far more frequent one.

Words are vectors of letter counts. Words at one edit have a squared distance of 1 (a code point
inserted or deleted) or 2 (replaced) and lengths that differ by one at most, so candidates are the
pairs at a distance of at most 2 within a length and between adjacent lengths. Squared distances
of whole blocks of words come from one matrix product (the Gram matrix of two blocks); the pairs
kept are verified code point by code point, as anagrams and near-anagrams are among them.

A length is cut into cells by how many letters fall into each of ``CLASSES`` classes. Counts of
classes cannot differ by more than the counts of letters, so a cell meets itself, the cells with
one letter moved to another class, and those of the next length with one letter more. A crowded
cell is cut into blocks of bounded size, and every pair of blocks is a row of its own.

Nothing is capped: every pair at one edit is found. What grows with the square of the words in a
cell is arithmetic on pairs of blocks; what leaves a pair of blocks is one row a word at most.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.common import store

RUN = "[A-Za-zÀ-ÿ]"
LETTERS = [*range(97, 123), *range(0xC0, 0x100)]  # code points of words
CLASSES = 4
BLOCK = 512  # words of a block at most
BLOCK_POINTS = 1 << 18  # code points of a block at most, but for a longer word
HELD = 200_000  # distinct words that a task holds before it passes them on

Alter = Callable[[str, bytes, int], str]  # (run, UTF-8 of the run, CRC-32 of the key's text) -> word


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, alter: Alter | None = None) -> DataFrame:
    """(``word``, ``n``) of the maximal letter runs of whole texts, A-Z lower-cased, of ``least`` code points or more.

    ``alter`` may change a run, once for each distinct run of a row; what it makes shorter than
    ``least`` is left out. Null and empty texts have no words. A null key's text is empty. Counts
    are summed in each task before the shuffle.
    """
    pattern = re.compile(f"{RUN}{{{least},}}")

    def flushed(held: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        held: Counter = Counter()
        for batch in batches:
            for k, data in zip(batch.column(0), batch.column(1)):
                if not data.is_valid:
                    continue
                # bytes.lower() changes A-Z only
                runs = pattern.findall(data.as_buffer().to_pybytes().lower().decode("utf-8", "replace"))
                if alter is None:
                    held.update(runs)
                else:
                    start = crc32((k.as_py() or "").encode() + b":")
                    for run, n in Counter(runs).items():
                        word = alter(run, run.encode(), start)
                        if len(word) >= least:
                            held[word] += n
                if len(held) > HELD:
                    yield flushed(held)
                    held = Counter()
        yield flushed(held)

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _cell() -> Column:
    """How many letters of a word fall into each class: code point modulo ``CLASSES``."""
    by_class = [[chr(c) for c in LETTERS if c % CLASSES == k] for k in range(CLASSES)]
    length = F.char_length("word")
    return F.array(*[length - F.char_length(F.translate("word", "".join(letters), "")) for letters in by_class])


def _partners() -> Column:
    """Cells that a cell is compared with, each pair of cells once: itself, a letter moved to a later class, a letter more."""
    def changed(steps: dict[int, int]) -> Column:
        return F.array(*[F.get("cell", F.lit(k)) + steps.get(k, 0) for k in range(CLASSES)])

    moved = [changed({a: -1, b: 1}) for a in range(CLASSES) for b in range(a + 1, CLASSES)]
    longer = [changed({a: 1}) for a in range(CLASSES)]
    return F.filter(F.array(F.col("cell"), *moved, *longer), lambda c: F.array_min(c) >= 0)


@lru_cache(8)
def _matrices(words: str, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a block's words, and the left and right factors of squared distances.

    A left row is (-2 letter counts, squared length, 1), a right row (letter counts, 1, squared
    length), so that the product of the two is the squared distance at once.
    """
    points = np.frombuffer(words.encode("utf-32-le"), "<u4").reshape(-1, length)
    wide = len(LETTERS) + 2
    at = _PLACE[points] + wide * np.arange(len(points))[:, None]
    # Whole numbers stay exact in 32-bit floats up to 2**24, in 64-bit ones for words of any length.
    right = np.bincount(at.ravel(), minlength=len(points) * wide).reshape(len(points), wide).astype(np.float32 if length < 2_000 else np.float64)
    square = np.einsum("ij,ij->i", right, right)
    left = -2 * right
    left[:, -2], left[:, -1] = square, 1
    right[:, -2], right[:, -1] = 1, square
    return points, left, right


_PLACE = np.zeros(256, np.int64)
_PLACE[LETTERS] = np.arange(len(LETTERS))


def near_in_blocks(a: str, n_a: int, b: str, n_b: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two blocks of the words at exactly one edit; words of a block have one length, ``n_b`` - ``n_a`` is 0 or 1.

    ``same``: the blocks are one and each pair counts once.
    """
    points_a, left, _ = _matrices(a, n_a)
    points_b, _, right = _matrices(b, n_b)
    i, j = np.divmod(np.flatnonzero(left @ right.T < 2.5), len(points_b))
    if same:
        i, j = i[i < j], j[i < j]
    found = np.zeros(len(i), bool)
    step = max(1, (1 << 22) // n_b)
    for at in range(0, len(i), step):
        x, y = points_a[i[at:at + step]], points_b[j[at:at + step]]
        if n_a == n_b:
            found[at:at + step] = (x != y).sum(1) == 1
        else:  # equal up to some place, and equal from there on with y one further
            front = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
            back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            found[at:at + step] = front + back >= n_a
    return i[found], j[found]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks, for each word with near ones among it: how many, and the best of them."""
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        words, counts, sums, tops = [], [], [], []
        for r in range(batch.num_rows):
            a, b = columns["words_a"][r].as_py(), columns["words_b"][r].as_py()
            n_a, n_b = columns["length_a"][r].as_py(), columns["length_b"][r].as_py()
            i, j = near_in_blocks(a, n_a, b, n_b, columns["same"][r].as_py())
            if not len(i):
                continue
            freq_a, freq_b = (columns[f"ns_{s}"][r].values.to_numpy() for s in "ab")
            for own, n_own, mine, other, n_other, theirs, freq in ((a, n_a, i, b, n_b, j, freq_b), (b, n_b, j, a, n_a, i, freq_a)):
                # Words of a block are in code-point order, so the smaller position breaks a tie.
                order = np.lexsort((theirs, -freq[theirs], mine))
                word = mine[order]
                first = np.flatnonzero(np.diff(word, prepend=-1))
                best = theirs[order][first]
                words += [own[w * n_own:(w + 1) * n_own] for w in word[first].tolist()]
                tops += [other[w * n_other:(w + 1) * n_other] for w in best.tolist()]
                counts += np.diff(first, append=len(word)).tolist()
                sums += freq[best].tolist()
        yield pa.record_batch([pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(tops, pa.string())],
                              ["word", "n_near", "best_n", "best"])



def near_words(words: DataFrame) -> DataFrame:
    """(``word``, ``n_near``, ``best_n``, ``best``) of the words of (``word``, ``n``) that have others at one edit.

    Words are distinct and made of ``LETTERS``; ``best`` is the near word of largest ``n``, of
    several the first in code-point order. An empty table gives no rows.
    """
    placed = words.select("word", "n", _cell().alias("cell"), F.char_length("word").alias("length"))
    of_block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.lit(BLOCK_POINTS) / F.col("length")).cast("int"))
    sizes = store(placed.groupBy("cell", "length").agg(F.count("*").alias("size")).select("cell", F.ceil(F.col("size") / of_block).alias("blocks")), "spelling-cells")
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("word"), "blocks"))
    # A block is bounded: some BLOCK words, as words are distinct and dealt by hash.
    taken = dealt.groupBy("cell", "block", "length").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("own"))
    blocks = store(taken.select("cell", "block", "length", F.array_join("own.word", "").alias("words"), F.col("own.n").alias("ns")), "spelling-blocks")
    left = sizes.select("cell", "blocks", F.explode(_partners()).alias("other"))
    met = left.join(sizes.select(F.col("cell").alias("other"), F.col("blocks").alias("others")), "other")
    met = met.select("cell", "other", "others", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    met = met.select("cell", "other", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("block_b"))
    met = met.where("cell <> other OR block <= block_b")
    a = blocks.select("cell", "block", F.col("length").alias("length_a"), F.col("words").alias("words_a"), F.col("ns").alias("ns_a"))
    b = blocks.select(F.col("cell").alias("other"), F.col("block").alias("block_b"), F.col("length").alias("length_b"), F.col("words").alias("words_b"), F.col("ns").alias("ns_b"))
    pairs = met.join(a, ["cell", "block"]).join(b, ["other", "block_b"])
    pairs = pairs.select("words_a", "length_a", "ns_a", "words_b", "length_b", "ns_b", F.expr("cell = other AND block = block_b").alias("same"))
    found = pairs.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.order")).alias("best_n"), "top.best")


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of the words of (``word``, ``form``) that have a form, by pointer doubling.

    Chains end, as a form is more frequent than its word; a round halves what is left of each.
    """
    at = store(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = store(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def variants(counts: DataFrame, least_n: int = 5, factor: int = 5) -> DataFrame:
    """Each word of (``word``, ``n``) with ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words take part from ``least_n`` occurrences on. A word's form is its near word of largest
    ``n``, if that is ``factor`` times its own or more; its root is the last form in a chain,
    or the word itself. An empty table gives no rows.
    """
    words = store(counts.where(F.col("n") >= least_n).select("word", "n"), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    led = F.col("best_n") >= factor * F.col("n")
    formed = store(near.select("word", F.when(led, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(led, F.col("best_n")).alias("form_n")), "spelling-forms")
    return formed.join(roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
