"""Spelling variants: words one edit apart, found in bit-sliced position indexes over blocks of the vocabulary."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostra.llm.common import in_partitions
from rostra.session import materialize

LEAST_LETTERS, LEAST_COUNT, SLIP = 5, 3, 97
CROWDED = 2048  # words of one block; more are dealt out by a smaller window
POOL = 512  # words of several blocks that are searched at once
POOL_LETTERS = 1 << 21
HELD_WORDS = 1 << 18  # words a task counts before it hands them on
#: One byte for each code point up to U+00FF: A-Z become a-z, other letters stay, all else is a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(doc_id: object, text: str) -> Counter:
    """Words of one text, in Latin-1, and how often each occurs, after the slips that the id and the word decide."""
    before = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, times in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LETTERS:
            found[run] += times
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of enough letters and occurrences over all documents. Tasks add up their own words first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held]), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in words_of(doc_id, text or "").items():
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    counted = in_partitions(docs.select("doc_id", "text"), work, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class PositionIndex:
    """Blocks of words as bitsets: for each position and letter, the words that have this letter there.

    Every word is looked up in its own block. The word-parallel recurrences read a word letter by letter and keep four
    sets of block members: those equal so far, and those with one letter replaced, with one more and with one less. The last
    three are read at the same, the next and the former position. A member leaves the equal set at the first difference,
    so this place is known, and the pair counts only in the block whose window (``low`` to before ``high``) has it.
    """

    def __init__(self, words: list[bytes], block: np.ndarray, shorter: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.size = len(words)
        self.length = np.fromiter(map(len, words), np.int64, self.size)
        self.width = (self.size + 63) // 64
        self.last = int(self.length.max())
        letters = np.zeros((self.size, self.last + 2), np.uint8)
        letters[np.arange(self.last + 2) < self.length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.codes = codes.reshape(letters.shape)
        self.block, self.shorter, self.low, self.high = block, shorter, low, high + (high == shorter)

    def _bits(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        """One bitset over the words for each value: the words whose key it is."""
        bits = np.zeros((len(values), self.width * 8), np.uint8)
        packed = np.packbits(keys[None, :] == values[:, None], axis=1, bitorder="little")
        bits[:, :packed.shape[1]] = packed
        return bits.view(np.uint64)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word, member one edit away), sorted by word."""
        every = np.arange(len(self.alphabet))
        blocks, at = np.unique(self.block, return_inverse=True)
        equal = self._bits(self.block, blocks)[at]
        lengths = np.arange(self.last + 3)
        long = self._bits(self.length, lengths)
        replaced, more, less = (np.zeros_like(equal) for _ in range(3))
        before = np.zeros((len(every), self.width), np.uint64)
        here = self._bits(self.codes[:, 0], every)
        for j in range(self.last + 1):
            after = self._bits(self.codes[:, j + 1], every)
            letter = self.codes[:, j]
            same = here[letter]
            leaves = equal & ~same
            leaves[(j < self.low) | (j >= self.high)] = 0
            equal &= same
            replaced = (replaced & same) | leaves
            more = (more | leaves) & after[letter]
            less = (less & before[letter]) | leaves
            before, here = here, after
        short = (self.length == self.shorter)[:, None]
        found = np.where(short, (replaced & long[self.length]) | (more & long[self.length + 1]), less & long[self.length - 1])
        word, member = [], []
        for start in range(0, self.size, POOL):  # unpacked in slices
            q, m = np.nonzero(np.unpackbits(found[start:start + POOL].view(np.uint8), axis=1, bitorder="little")[:, :self.size])
            word.append(q + start)
            member.append(m)
        return np.concatenate(word), np.concatenate(member)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: pools of whole blocks are searched at once."""
    def found(table: pa.Table, keys: np.ndarray) -> pa.RecordBatch:
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        n = table.column("n").to_numpy()
        word, member = PositionIndex(words, keys, *(table.column(c).to_numpy().astype(np.int64) for c in ("m", "lo", "hi"))).near()
        ranked = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)  # largest count, then code-point order
        place = np.empty(len(words), np.int64)
        place[ranked] = np.arange(len(words))
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
        best = ranked[np.minimum.reduceat(place[member], first)] if len(word) else first
        every = table.column("word")
        return pa.RecordBatch.from_arrays(
            [every.take(pa.array(word[first])).combine_chunks(), pa.array(np.diff(np.append(first, len(word))), pa.int64()),
             every.take(pa.array(best)).combine_chunks(), pa.array(n[best])], names=["word", "n_near", "form", "form_n"])

    held, size, letters = [], 0, 0
    for batch in batches:
        held.append(batch)
        size, letters = size + len(batch), letters + batch.nbytes
        if size < POOL * 16 and letters < POOL_LETTERS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last block may go on
        yield from _pools(table.slice(0, cut), keys[:cut], found)
        held = table.slice(cut).to_batches()
        size, letters = len(keys) - cut, sum(b.nbytes for b in held)
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from _pools(table, table.column("key").to_numpy(), found)


def _pools(table: pa.Table, keys: np.ndarray, found) -> Iterator[pa.RecordBatch]:
    """Whole blocks together up to ``POOL`` words, a larger block alone."""
    ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
    start = 0
    while start < len(keys):
        end = int(ends[max(np.searchsorted(ends, start + POOL, "right") - 1, np.searchsorted(ends, start, "right"))])
        yield found(table.slice(start, end - start), keys[start:end])
        start = end


def _windows(rows: DataFrame, *bounds: str) -> DataFrame:
    """Each word under the letters around each window: those before ``lo`` and those after ``hi``, counted on the shorter word."""
    window = F.explode(F.array(*[F.expr(f"struct(int({a}) AS lo, int({b}) AS hi)") for a, b in zip(bounds, bounds[1:])]))
    return rows.select("word", "n", "m", window.alias("w")).select("word", "n", "m", "w.lo", "w.hi").withColumn(
        "key", F.expr("xxhash64(m, lo, hi, substring(word, 1, lo), right(word, m - hi))"))


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word, n_near, form, form_n`` for each word of ``words(word, n)`` that has a word one edit away: how many it has, and
    the one with the largest ``n`` (ties: the smaller word).

    Two words one edit apart whose shorter one has ``m`` letters are equal outside the half of ``m`` in which they first
    differ, so every word is dealt out under the other half, for its own length and the next smaller one. Where more than
    ``crowded`` words meet, the window is halved again, down to one letter; then at most 90 + 90 * 90 words can
    meet, as the alphabet has 90 letters. Each pair is found in one block only. No pair leaves a task: a block
    hands on one row a word.
    """
    rows = _windows(words.withColumn("m", F.explode(F.array(F.length("word"), F.length("word") - 1))).where(F.col("m") >= LEAST_LETTERS),
                    "0", "m div 2", "m")
    ready = None
    while True:
        sizes = materialize(rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("hi") - F.col("lo")).alias("room"))
                            .where("size > 1"), "blocks")
        split = (F.col("size") > crowded) & (F.col("room") > 1)
        fit = rows.join(sizes.where(~split).select("key"), "key")
        ready = fit if ready is None else ready.unionByName(fit)
        if sizes.where(split).isEmpty():
            break
        rows = materialize(_windows(rows.join(sizes.where(split).select("key"), "key"), "lo", "(lo + hi) div 2", "hi"), "windows")
    found = in_partitions(ready.repartition("key").sortWithinPartitions("key"), _search, "word string, n_near long, form string, form_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best")) \
        .select("word", "n_near", "best.form", (-F.col("best.n")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each word of ``forms(word, form)``: each round follows twice as many forms. Settled words rest."""
    tree = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "forms")
    while not tree.where("open").isEmpty():
        above = tree.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("open").alias("more"))
        moved = tree.where("open").join(above, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.coalesce("more", F.lit(False)).alias("open"))
        tree = materialize(tree.where("NOT open").unionByName(moved), "forms")
    return tree.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row for each word of the corpus.

    Words are the runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased; where 97 divides the crc32 of ``<doc_id>:<run>``, one letter is
    left out. A word has at least 5 letters and 3 occurrences. Words are near if one letter inserted, deleted or replaced
    turns one into the other. ``form`` is the near word with the largest count (ties: code-point order) if that is at least
    twice the word's own, else missing; ``root`` follows the forms to the last one. A missing text has no words, a missing id counts as the empty
    text, repeated rows count again; a word without near words has ``n_near`` 0; an empty table gives no
    rows. Other columns are not read.
    """
    words = materialize(vocabulary(docs), "vocabulary")
    near = materialize(
        words.join(near_words(words), "word").withColumn("form", F.when(F.col("form_n") >= 2 * F.col("n"), F.col("form"))), "near")
    formed = near.where("form IS NOT NULL")
    told = near.select("word", "n_near", "form", F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"))
    return words.join(told, "word", "left").join(_roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
