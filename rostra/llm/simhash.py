"""SimHash near-duplicates, found with a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rostra.llm.common import fresh, in_partitions
from rostra.llm.components import connected_components
from rostra.operators.skew import spread_join
from rostra.session import materialize

BITS, SEED, SHINGLE, RADIUS = 64, 42, 3, 3
BLOCK = 16  # RADIUS + 1 blocks: fingerprints within RADIUS agree on one of them
SUB = 12  # the other 48 bits in blocks of 12, for values that very many fingerprints share
FAN = 8
QUERIES_AT_ONCE = 1024
ROWS_AT_ONCE = 1 << 16
PIECE = 1 << 15  # shingles hashed at once
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, words_each: int = SHINGLE) -> tuple[int, int]:
    """SimHash of a whole text as an unsigned number, and its number of words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z, splits at the six ASCII blanks
    if not words:
        return 0, 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - words_each + 1)
    last = ends[-n:].tolist()
    first, counts, digest = starts[:n].tolist(), np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + PIECE], last[at:at + PIECE])], "<u8")
        cells = hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
        counts += (np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BIT).ravel()
    return int(sum(1 << b for b in np.flatnonzero(counts * 2 > n).tolist())), len(words)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, n_words``: the SimHash of each whole text as a signed 64-bit number. A missing text is empty: 0."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array([f[0] for f in found], np.uint64).view(np.int64)),
                 pa.array([f[1] for f in found], pa.int64())], names=["doc_id", "fp", "n_words"])

    return in_partitions(docs.select("doc_id", "text"), work,
                         f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long, n_words long")


def with_fingerprints(docs: DataFrame, name: str) -> DataFrame:
    """All columns of ``docs`` and the SimHash of the text as the last one, called ``name``."""
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or "")[0] for t in batch.column(at).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(name, LongType())]))


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the Gray-code order, in which neighbours differ in one bit."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Distinct fingerprints of one or more groups, each group a tree over its Gray order.

    A node stands for ``FAN`` neighbours and keeps the bits in which all fingerprints below agree (``mask``) and their
    values (``bits``); what a parent has settled is taken out of its children's masks, so differences add up on the way down.
    """

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), group))
        self.fps = fps[order]
        group = group[order]
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        low, high, size = self.fps, self.fps, len(fps)
        self.first = [np.arange(size)]  # first and last leaf of each node, by level
        self.last = [np.arange(size)]
        self.mask, self.bits, self.child = [np.full(size, every)], [self.fps], [np.arange(size + 1)]
        while size > 1 and (group[1:] == group[:-1]).any():
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            within = np.arange(size) - np.repeat(start, np.diff(np.append(start, size)))
            heads = np.flatnonzero(within % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, heads), np.bitwise_or.reduceat(high, heads)
            agreed = ~(low ^ high)
            parent = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, size)))
            self.mask[-1] = self.mask[-1] & ~agreed[parent]
            self.mask.append(agreed)
            self.bits.append(low & agreed)
            self.child.append(np.append(heads, size))
            self.first.append(self.first[-1][heads])
            self.last.append(self.last[-1][np.append(heads[1:], size) - 1])
            group, size = group[heads], len(heads)
        self.root = np.repeat(np.arange(size), self.last[-1] - self.first[-1] + 1)
        self.label = np.arange(len(self.fps))

    def _bounds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        low = [self.label]
        high = [self.label]
        for child in self.child[1:]:
            low.append(np.minimum.reduceat(low[-1], child[:-1]))
            high.append(np.maximum.reduceat(high[-1], child[:-1]))
        return list(zip(low, high))

    def pairs(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later leaf) within ``radius``. A group of leaves goes as soon as the differences so far exceed the
        radius, and also when all of it already hangs together with the query."""
        bounds, q, node = self._bounds(), queries, self.root[queries]
        off = np.bitwise_count((self.fps[q] ^ self.bits[-1][node]) & self.mask[-1][node]).astype(np.int64)
        for level in range(len(self.mask) - 1, -1, -1):
            on = (off <= radius) & (self.last[level][node] > q)
            on &= ~((bounds[level][0][node] == self.label[q]) & (bounds[level][1][node] == self.label[q]))
            q, node, off = q[on], node[on], off[on]
            if level:
                begin, end = self.child[level][node], self.child[level][node + 1]
                times = end - begin
                q, off = np.repeat(q, times), np.repeat(off, times)
                node = np.repeat(begin - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
                off = off + np.bitwise_count((self.fps[q] ^ self.bits[level - 1][node]) & self.mask[level - 1][node])
        on = node > q
        return q[on], node[on]

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.label[a], self.label[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.label, np.maximum(ra, rb), np.minimum(ra, rb))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]

    def links(self, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links: each fingerprint that has one, with the first of its component."""
        for at in range(0, len(self.fps), QUERIES_AT_ONCE):
            self._join(*self.pairs(np.arange(at, min(at + QUERIES_AT_ONCE, len(self.fps))), radius))
        tied = np.flatnonzero(self.label != np.arange(len(self.fps)))
        return self.fps[tied], self.fps[self.label[tied]]


def _block_keys(fps: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which fingerprints within RADIUS meet, and the place of the fingerprint of each."""
    keys, places = [], []
    for block in range(BITS // BLOCK):
        shift = np.uint64(block * BLOCK)
        value = (fps >> shift) & np.uint64((1 << BLOCK) - 1)
        key = value.astype(np.int64) | block << BLOCK
        crowded = np.isin(key, hot)
        keys.append(key[~crowded])
        places.append(np.flatnonzero(~crowded))
        if crowded.any():  # the rest of the bits again has one equal block
            inner = fps[crowded]
            below = inner & ((np.uint64(1) << shift) - np.uint64(1))
            above = (inner >> shift) >> np.uint64(BLOCK) << shift
            for sub in range(RADIUS + 1):
                part = ((above | below) >> np.uint64(sub * SUB)) & np.uint64((1 << SUB) - 1)
                keys.append(part.astype(np.int64) | sub << SUB | key[crowded] << 20 | 1 << 60)
                places.append(np.flatnonzero(crowded))
    return np.concatenate(keys), np.concatenate(places)


def fingerprint_links(distinct: DataFrame, hot_rows: int = 100_000) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of "differ in at most RADIUS bits" over the distinct ``fp``.

    Fingerprints are dealt out by the value of each of four blocks; two within three bits share one. Block values that
    more than ``hot_rows`` and a thousandth of the fingerprints have (so at most 4,000 of them) are split by blocks of the
    other bits. Each group is searched with a ``GrayIndex`` and sends on at most one edge per fingerprint.
    """
    def keyed(hot: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fps = batch.column("fp").to_numpy()
                keys, places = _block_keys(fps.view(np.uint64), hot)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[places])], names=["key", "fp"])
        return in_partitions(distinct.select("fp"), work, "key long, fp long")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            u, v = GrayIndex(keys, fps.view(np.uint64)).links()
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            held.append((batch.column("key").to_numpy(), batch.column("fp").to_numpy()))
            if sum(len(k) for k, _ in held) >= ROWS_AT_ONCE:
                keys, fps = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield found(keys[:cut], fps[:cut])
                held = [(keys[cut:], fps[cut:])]
        if held:
            yield found(*(np.concatenate(x) for x in zip(*held)))

    counts = keyed(np.zeros(0, np.int64)).groupBy("key").agg(F.count("*").alias("n"))
    share = distinct.count() // 1000
    hot = np.array([r.key for r in counts.where(F.col("n") > max(hot_rows, share)).select("key").collect()], np.int64)
    return in_partitions(keyed(hot).repartition("key").sortWithinPartitions("key"), search, "u long, v long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id, n_words`` for each row of ``docs``.

    Words are cut at ASCII blanks after lower-casing A-Z; shingles have three words, repeats included; with fewer words the
    whole sequence is the one shingle; without words (a missing text too) the fingerprint is zero and linked like any other.
    Fingerprints link when at most three bits differ; ``component_id`` is the smallest id reachable. Equal fingerprints
    collapse before the search, so copies cost nothing there; repeated rows come back as often as given; missing
    ids never are the smallest, and a component without any id has none. Other columns are not read.
    """
    fps = materialize(fingerprints(docs), "fingerprints")
    groups = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "groups")
    roots = connected_components(fingerprint_links(groups)).select(F.col("node").alias("fp"), "root")
    rooted = groups.join(roots, "fp", "left").select("fp", "n", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "n", "component_id"), "components")
    return spread_join(fps, named, "fp", "doc_id", "n", unique=True).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_words")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their component, all columns unchanged.

    A row stays if its (doc_id, fingerprint) is that of a first document. Equal rows stay together, as do rows without an id in
    a component that has no id at all. Only where rows of one id (or without an id) are judged differently are their
    texts hashed again to tell them apart; all other rows are told by their id.
    """
    judged = simhash_components(docs).select("doc_id", "fingerprint", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    judged = materialize(judged.groupBy("doc_id", "fingerprint").agg(F.max("stays").alias("stays")), "judged")
    ids = judged.groupBy(F.struct("doc_id").alias("__id")).agg(F.max("stays").alias("any"), F.min("stays").alias("all"))
    own = F.struct(docs["doc_id"])
    sure = docs.join(ids.where("all").select("__id"), own.eqNullSafe(F.col("__id")), "left_semi")
    mixed = materialize(ids.where("any AND NOT all").select("__id"), "mixed")
    if mixed.isEmpty():
        return sure
    told = with_fingerprints(docs.join(mixed, own.eqNullSafe(F.col("__id")), "left_semi"), fresh(docs, "fp"))
    keep = judged.where("stays").select(F.struct("doc_id", F.conv("fingerprint", 16, -10).cast("long").alias("fp")).alias("__kept"))
    told = told.join(keep, F.struct(told["doc_id"], told[told.columns[-1]].alias("fp")).eqNullSafe(F.col("__kept")), "left_semi")
    return sure.unionByName(told.select(*[F.col(f"`{c}`") for c in docs.columns]))
