"""Ranked lexical search: impact-sorted lists are read in step, with a lower and an upper bound for each document (NRA)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rostra.llm.common import gathered, in_partitions
from rostra.session import materialize

BEST = 20
ITEMS_AT_ONCE = 1000  # items searched in one pass over the documents
BLOCK_DOCS, BLOCK_CELLS = 1 << 13, 1 << 26  # documents of a block; cells of its table of lists read
FIRST_READS = 64  # postings of each list read in the first step; each later step reads twice as many
SCALE, FLAT, SLOPE, MIDDLE = 1_000_000_000, 1000, 12, 25
#: A-Z become a-z; other ASCII characters that are no letter or digit are blanks.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a whole text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document: its number of terms, and which of the asked terms it has how often."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                counts = Counter(words)
                has = counts.keys() & asked.keys()
                sizes.append(len(words))
                terms.append([asked[w] for w in has])
                tfs.append([counts[w] for w in has])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_partitions(docs.select("doc_id", "text"), work, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


class ImpactLists:
    """The lists of one block of documents, each sorted by falling impact."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        order = np.lexsort((-impact, term))
        term, self.doc, self.impact, self.n_docs = term[order], doc[order], impact[order], n_docs
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.at = dict(zip(term[starts].tolist(), zip(starts.tolist(), np.append(starts[1:], len(term)).tolist())))

    def search(self, weights: dict[int, int], best: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that can be among the ``best`` with a score of at least ``least``, their scores, and how many postings were read.

        Lists are read from the top, never at random. What has been read of a document is its lower bound; with the next
        impact of each list in which it was not met it is its upper bound. Reading goes on, in the lists that matter, until
        no other document can reach the last place, ties included, and the scores of those that can are final.
        """
        lists = [(*self.at[t], w) for t, w in weights.items() if w > 0 and t in self.at]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        begin, end, weight = (np.array(x, np.int64) for x in zip(*lists))
        place = begin.copy()
        lower = np.zeros(self.n_docs, np.int64)
        seen = np.zeros((len(lists), self.n_docs), bool)
        reading, step, reads, least = np.arange(len(lists)), FIRST_READS, 0, max(least, 1)
        while True:
            for i in reading.tolist():
                a, b = int(place[i]), int(min(place[i] + step, end[i]))
                docs = self.doc[a:b]
                lower[docs] += weight[i] * self.impact[a:b]
                seen[i, docs] = True
                place[i] = b
                reads += b - a
            step *= 2
            ahead = np.where(place < end, weight * self.impact[np.minimum(place, end - 1)], 0)
            unmet = int(ahead.sum())
            if self.n_docs >= best:
                least = max(least, int(np.partition(lower, self.n_docs - best)[self.n_docs - best]))
            if unmet >= least:
                reading = np.flatnonzero(place < end)
                continue
            able = np.flatnonzero(lower + unmet >= least)
            open_ = ~seen[:, able] & (ahead > 0)[:, None]
            reach = lower[able] + ahead @ open_
            able, open_ = able[reach >= least], open_[:, reach >= least]
            reading = np.flatnonzero(open_.any(axis=1))
            if not len(reading):
                return able, lower[able], reads


def _by_rank(found: tuple) -> tuple:
    return -found[0], found[1] is None, found[1] if found[1] is not None else 0


def _search_all(rows: DataFrame, items: list[dict[int, int]], n_docs: int, n_terms: int, best: int) -> DataFrame:
    """``item, doc_id, score``: what each task finds for each item, at most ``best`` rows. Only whole blocks are indexed, one at
    a time; the last place of an item so far is where reading starts to stop in the next block."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    kind = rows.schema["doc_id"].dataType.simpleString()
    most_docs = max(min(BLOCK_DOCS, BLOCK_CELLS // max([len(i) for i in items] + [1])), 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        found: list[list[tuple]] = [[] for _ in asked]
        for block in gathered((b.slice(a, most_docs) for b in batches for a in range(0, len(b), most_docs)), most_docs):
            size = block.column("n").to_numpy()
            flat, tf = (pa.ListArray.flatten(block.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
            doc = np.repeat(np.arange(len(block)), block.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            length = 100 - MIDDLE + MIDDLE * size * n_docs // max(n_terms, 1)
            lists = ImpactLists(flat, doc, SCALE * tf // (FLAT * tf + SLOPE * length[doc]), len(block))
            ids = block.column("doc_id")
            for i, weights in enumerate(asked):
                docs, scores, _ = lists.search(weights, best, found[i][-1][0] if len(found[i]) == best else 1)
                if len(docs):
                    new = zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist())
                    found[i] = sorted([*found[i], *new], key=_by_rank)[:best]
        flat_rows = [(i, d, s) for i, rows in enumerate(found) for s, d in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat_rows], pa.int32()), pa.array([r[1] for r in flat_rows], block_type), pa.array([r[2] for r in flat_rows], pa.int64())],
            names=["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    block_type = to_arrow_type(rows.schema["doc_id"].dataType)
    return in_partitions(rows, work, f"item int, doc_id {kind}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of highest score above 0 for each item of ``items(item_id, text)``.

    Terms are runs of ASCII letters and digits and of all other characters above U+007F, with A-Z lower-cased, of the whole text. The score of a document is the sum,
    over the item's terms with repeats, of the term's weight times its impact in the document (64-bit integers). Equal scores
    rank by rising ``doc_id``, a missing one last; every row of ``docs`` is a document, repeated ones too. Missing and empty texts have no terms. Rows of
    one ``item_id`` are one item; an item without terms that occur has no rows. Other columns are not read.

    Items are searched ``items_at_once`` at a time, so what is broadcast (their terms) does not grow with either table. Documents are not
    shuffled: each task searches blocks of its own documents and hands on ``best`` rows an item.
    """
    spark = docs.sparkSession
    rounds = -(-items.count() // items_at_once)
    asked = items.select(F.struct("item_id").alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    results = None
    for turn in range(max(rounds, 1)):
        texts: dict[tuple, Counter] = {}
        for row in asked.where(F.pmod(F.xxhash64("item"), F.lit(max(rounds, 1))) == turn).collect():
            texts.setdefault(row.item.item_id, Counter()).update(terms_of(row.text))
        numbers = {t: k for k, t in enumerate(sorted({t for c in texts.values() for t in c}))}
        rows = materialize(postings(docs, numbers), "postings")
        n_docs, n_terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = {r.term: r["count"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
        weight = {t: floor(1000 * log((2 * n_docs + 2) / (2 * df + 1))) for t, df in held.items()}
        weights = [{numbers[t]: weight[numbers[t]] * k for t, k in c.items() if numbers[t] in weight} for c in texts.values()]
        found = _search_all(rows, weights, n_docs, n_terms, best)
        names = spark.createDataFrame([(i, item) for i, item in enumerate(texts)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        named = found.join(F.broadcast(names), "item").select("item_id", "item", "doc_id", "score")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
        results = ranked if results is None else results.unionByName(ranked)
    return results
