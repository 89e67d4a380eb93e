"""Best-fit packing of documents into training sequences, with conflicts between documents."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rostra.llm.common import BLANKS
from rostra.llm.exact_dedup import normalised
from rostra.session import materialize

CAPACITY = 2048
BLOCK_DOCS = 4096


class Bins:
    """Bins of one block, ordered by free room, each with bitmaps of the sources and duplicate clusters it holds."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[tuple[int, int]] = []
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """Put an item into the tightest bin that has room and no conflict, else into a new one; gives the bin's number.

        ``source`` and ``cluster`` have one bit set, or none for an item that conflicts with nothing.
        """
        at = bisect_left(self.by_room, (size, -1))
        while at < len(self.by_room):
            room, k = self.by_room[at]
            if not (self.sources[k] & source or self.clusters[k] & cluster):
                del self.by_room[at]
                break
            at += 1
        else:
            k = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        self.room[k] -= size
        self.sources[k] |= source
        self.clusters[k] |= cluster
        insort(self.by_room, (self.room[k], k))
        return k


def bits(values: list) -> list[int]:
    """A bit of its own for each value that occurs more than once; none for the others and for missing ones."""
    often = [v for v, n in Counter(v for v in values if v is not None and v == v).items() if n > 1]
    place = {v: 1 << i for i, v in enumerate(often)}
    return [place.get(v, 0) for v in values]


def pack_block(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bin number and position of each item: largest first, ties by row and piece."""
    items = items.sort_values(["n_tokens", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    bins, held, numbers, positions = Bins(capacity), Counter(), [], []
    for size, source, cluster in zip(items["n_tokens"].tolist(), bits(items["source"].tolist()), bits(items["cluster"].tolist())):
        k = bins.place(size, source, cluster)
        numbers.append(k)
        positions.append(held[k])
        held[k] += 1
    items["bin"], items["position"] = numbers, positions
    items["bin_free"] = [bins.room[k] for k in numbers]
    return items


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, block_docs: int = BLOCK_DOCS, source: str | None = "source",
                     cluster: Column | None = None) -> DataFrame:
    """``doc_id, piece, start, n_tokens, source, bin_id, position, bin_free``: where each piece of each document goes.

    Tokens are words between ASCII blanks. A document longer than ``capacity`` is cut into pieces of that size and a rest;
    ``start`` is the first token of a piece. No bin holds more than ``capacity`` tokens, two pieces of one source, or two
    documents of one duplicate cluster (``cluster``; by default documents with equal text up to blanks). Each piece goes into
    the tightest bin without a conflict; a bin that conflicts is passed over for the next larger room, through all of them.

    Rows are dealt at random (by a number that is written down first) into blocks of about ``block_docs`` documents that are packed
    apart, so a frequent source or cluster is spread over all blocks. A missing text has no tokens and is placed like any
    other; texts without tokens are in no cluster, a missing source conflicts with nothing. Repeated rows are in one
    cluster and so in different bins. Other columns are not read; an empty table gives no rows.
    """
    text = normalised(docs["text"])
    words = F.size(F.filter(F.split(text, " "), lambda w: w != "")).cast("bigint")
    same = F.xxhash64(text) if cluster is None else cluster
    rows = docs.select("doc_id", words.alias("n_words"), (F.col(f"`{source}`").cast("string") if source else F.lit(None).cast("string")).alias("source"),
                       same.alias("cluster"))
    rows = rows.withColumn("cluster", F.when(F.col("n_words") > 0, F.col("cluster"))).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "lengths")
    blocks = max(1, math.ceil(rows.count() / block_docs))
    last = F.greatest(F.ceil(F.col("n_words") / capacity) - 1, F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "row", "doc_id", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.col("n_words") - F.col("piece") * capacity, F.lit(capacity)).alias("n_tokens"), "source",
        # Pandas has no missing integers: clusters travel as text.
        F.col("cluster").cast("string").alias("cluster"))

    def work(items: pd.DataFrame) -> pd.DataFrame:
        return pack_block(items, capacity)[["block", "row", "piece", "start", "n_tokens", "source", "bin", "position", "bin_free"]]

    packed = pieces.drop("doc_id").groupBy("block").applyInPandas(
        work, "block long, row long, piece long, start long, n_tokens long, source string, bin long, position long, bin_free long")
    out = packed.withColumn("bin_id", F.col("block") * F.lit(1 << 32) + F.col("bin"))
    return out.join(rows.select("row", "doc_id"), "row").select(
        "doc_id", "piece", "start", "n_tokens", "source", "bin_id", "position", "bin_free")
