"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rostra.llm.common import in_partitions, remainder
from rostra.llm.ranked_search import terms_of
from rostra.session import materialize

HELD_OUT_MOD, HELD_OUT = 5, 0
MOST_EXAMPLES, MOST_TERMS = 16_384, 512  # bounds of what is learned from and broadcast
LEAST_G2, LEAST_DOCS = 16.0, 3
NEAREST, POWER, PRIOR = 16, 4, 1.0
BLOCK = 32  # examples of a block
FIRST_BLOCKS = 4
SLACK = 1e-4  # more than single precision can be wrong by: a cosine is a sum of at most MOST_TERMS products and at most 1
TEXTS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 13  # pairs of a text and an example whose postings are in memory together
HELD_WORDS = 1 << 18
EVIDENCE = 3
CACHED = 1 << 16  # results a task keeps


def _examples(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id, toxic, text``: at most ``most`` labelled documents that are not held out, in the order of a hash of the id."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
             .where(remainder(F.col("doc_id"), HELD_OUT_MOD) != HELD_OUT))
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _term_counts(examples: DataFrame) -> DataFrame:
    """``term, n, n_toxic``: how many examples, and how many toxic ones, have a term."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            terms = list(held[0].keys() | held[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.binary()), pa.array([held[0][t] + held[1][t] for t in terms], pa.int64()),
                 pa.array([held[1][t] for t in terms], pa.int64())], names=["term", "n", "n_toxic"])
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                held[toxic].update(set(terms_of(text)))
                if len(held[0]) + len(held[1]) >= HELD_WORDS:
                    yield rows()
                    held[0].clear()
                    held[1].clear()
        yield rows()

    return in_partitions(examples.select("text", "toxic"), work, "term binary, n long, n_toxic long") \
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def _told_by(n: Column, n_toxic: Column, total: int, toxic: int) -> Column:
    """The log-likelihood ratio G2 of a term and the label."""
    def part(seen: Column, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)
    cells = [(n_toxic, n * toxic / total), (n - n_toxic, n * (total - toxic) / total),
             (toxic - n_toxic, (total - n) * toxic / total), (total - toxic - n + n_toxic, (total - n) * (total - toxic) / total)]
    return 2 * sum((part(a.cast("double"), b.cast("double")) for a, b in cells), F.lit(0.0))


def _counted(df: DataFrame, numbers: dict[bytes, int], *carried: str) -> DataFrame:
    """The carried columns and ``terms, tfs``: which of the terms each text has, rising, and how often."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tfs = [], []
            for text in batch.column("text").to_pylist():
                counts = Counter(terms_of(text))
                has = sorted((numbers[w], counts[w]) for w in counts.keys() & numbers.keys())
                terms.append([t for t, _ in has])
                tfs.append([n for _, n in has])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                                             names=[*carried, "terms", "tfs"])

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in carried]
    return in_partitions(df.select(*carried, "text"), work, ", ".join([*kinds, "terms array<int>", "tfs array<int>"]))


def _frequencies(counted: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and how many have each term. Each task adds up its own."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            rows += len(batch)
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        has = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(has, -1)), pa.array(np.append(held[has], rows))], names=["term", "n"])

    out = np.zeros(n_terms + 1, np.int64)  # the last place has the rows
    for r in in_partitions(counted.select("terms"), work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return int(out[-1]), out[:-1].astype(float)


class BlockMaxIndex:
    """Distinct example vectors, sorted, in blocks of ``BLOCK`` like ones, with the largest weight of each term in each block.

    Texts are looked up many at a time. A product with the largest weights tells which blocks can hold one of a text's best; those blocks are
    multiplied by the texts that ask for them, in single precision. What comes within ``SLACK`` of the threshold is summed again
    from its postings, term by term, in double precision, so a cosine does not depend on the texts that it is looked up with.
    """

    def __init__(self, vectors: list[tuple[tuple, tuple]], idf: np.ndarray):
        self.idf, self.size = idf, len(vectors)
        self.blocks = max(-(-self.size // BLOCK), 1)
        self.edge = np.append(0, np.cumsum([len(t) for t, _ in vectors], dtype=np.int64))
        self.term = np.array([t for ts, _ in vectors for t in ts], np.int64)
        self.weight = np.concatenate([self.weights(t, f) for t, f in vectors]) if vectors else np.zeros(0)
        self.tables = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "tables": None}

    def weights(self, terms: tuple, tfs: tuple) -> np.ndarray:
        raw = (1 + np.log(np.array(tfs, float))) * self.idf[np.array(terms, np.int64)]
        return raw / np.sqrt((raw * raw).sum())

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights by block, row and term, and the largest of each block; every process makes them for itself."""
        if self.tables is None:
            dense = np.zeros((self.blocks * BLOCK, len(self.idf)), np.float32)
            dense[np.repeat(np.arange(self.size), np.diff(self.edge)), self.term] = self.weight
            dense = dense.reshape(self.blocks, BLOCK, len(self.idf))
            self.tables = dense, dense.max(axis=1)
        return self.tables

    def nearest(self, terms: tuple, tfs: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` rows of highest cosine above 0, and all that tie with the last, with their cosines; highest first."""
        return self.nearest_of([(terms, tfs)], k)[0]

    def nearest_of(self, texts: list[tuple[tuple, tuple]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for each of the texts."""
        asked = np.zeros((len(texts), len(self.idf)))
        for i, (terms, tfs) in enumerate(texts):
            asked[i, np.array(terms, np.int64)] = self.weights(terms, tfs)
        text, row = self._near(asked.astype(np.float32), k)
        sims = self._cosines(asked, text, row)
        text, row, sims = text[sims > 0], row[sims > 0], np.round(sims[sims > 0], 12)
        order = np.lexsort((row, -sims, text))
        text, row, sims = text[order], row[order], sims[order]
        edge, out = np.searchsorted(text, np.arange(len(texts) + 1)), []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            end = b if b - a <= k else a + int(np.searchsorted(-sims[a:b], -sims[a + k - 1], side="right"))
            out.append((row[a:end], sims[a:end]))
        return out

    def _near(self, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of texts and rows: for each text all rows whose cosine is above 0 and at least its ``k``-th best, and some others."""
        dense, most = self._tables()
        scores = np.zeros((len(asked), self.blocks, BLOCK), np.float32)
        bound, all_texts = asked @ most.T, np.arange(len(asked))
        first = np.zeros(bound.shape, bool)
        first[all_texts[:, None], np.argpartition(bound, -min(FIRST_BLOCKS, self.blocks), axis=1)[:, -FIRST_BLOCKS:]] = True
        self._score(scores, asked, dense, first & (bound > 0))
        least = np.zeros(len(asked), np.float32)
        n_seen = min(FIRST_BLOCKS, self.blocks) * BLOCK
        if n_seen >= k:
            least = np.partition(scores[first].reshape(len(asked), n_seen), n_seen - k, axis=1)[:, n_seen - k]
        self._score(scores, asked, dense, ~first & (bound > 0) & (bound >= least[:, None] - SLACK))
        if self.blocks >= k:  # the best of k blocks are k rows
            least = np.maximum(least, np.partition(scores.max(axis=2), self.blocks - k, axis=1)[:, self.blocks - k])
        flat = scores.reshape(len(asked), self.blocks * BLOCK)
        text, row = np.nonzero(flat > np.maximum(least - SLACK, 0)[:, None])
        return text, row

    @staticmethod
    def _score(scores: np.ndarray, asked: np.ndarray, dense: np.ndarray, visits: np.ndarray) -> None:
        """Fill in the scores of the blocks that texts visit (``visits``: text by block)."""
        for block in np.flatnonzero(visits.any(axis=0)).tolist():
            some = np.flatnonzero(visits[:, block])
            scores[some, block] = asked[some] @ dense[block].T

    def _cosines(self, asked: np.ndarray, text: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Cosines of pairs of a text and a row: sums over the row's postings in the order of their terms."""
        out, times = np.zeros(len(text)), self.edge[row + 1] - self.edge[row]
        for some in np.array_split(np.arange(len(text)), len(text) // PAIRS_AT_ONCE + 1):
            n = times[some]
            which = np.repeat(self.edge[row[some]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            pair = np.repeat(np.arange(len(some)), n)
            out[some] = np.bincount(pair, self.weight[which] * asked[text[some][pair], self.term[which]], len(some))
        return out


@dataclass
class Voters:
    """What is broadcast: the index, how many examples each of its rows stands for, and how votes become scores."""
    index: BlockMaxIndex
    number: dict[tuple, int]
    n: np.ndarray
    n_toxic: np.ndarray
    first: list
    bare: tuple[int, int]  # examples without any term: all, toxic
    base: float
    slope: float = 1.0
    shift: float = 0.0

    def votes(self, texts: list[tuple[tuple, tuple, int | None]]) -> list[tuple[float, list]]:
        """``vote`` for each of ``(terms, tfs, without)``."""
        some = iter(self.index.nearest_of([(terms, tfs) for terms, tfs, _ in texts if terms], NEAREST))
        return [self._vote(*t, next(some) if t[0] else None) for t in texts]

    def vote(self, terms: tuple, tfs: tuple, without: int | None = None) -> tuple[float, list]:
        """The share of toxic examples among the nearest, weighted by cosine, and the nearest as evidence. A text without
        terms is nearest to the examples without terms. ``without`` leaves out one own example with that label."""
        return self.votes([(terms, tfs, without)])[0]

    def _vote(self, terms: tuple, tfs: tuple, without: int | None, nearest: tuple[np.ndarray, np.ndarray] | None) -> tuple[float, list]:
        if not terms:
            n, toxic, seen = self.bare[0], self.bare[1], []
            if without is not None:
                n, toxic = n - 1, toxic - without
            return (toxic + PRIOR * self.base) / (n + PRIOR), seen
        rows, sims = nearest
        n, toxic = self.n[rows].astype(float), self.n_toxic[rows].astype(float)
        if without is not None:
            own = rows == self.number[terms, tfs]
            n, toxic = n - own, toxic - own * without
        weight = sims ** POWER
        value = ((weight * toxic).sum() + PRIOR * self.base) / ((weight * n).sum() + PRIOR)
        return float(value), [(self.first[r], float(min(s, 1.0)), int(self.n[r]), int(self.n_toxic[r])) for r, s in zip(rows[:EVIDENCE].tolist(), sims.tolist())]

    def score(self, vote: float) -> float:
        if vote <= 0 or vote >= 1:
            return float(min(max(vote, 0.0), 1.0))
        return 1 / (1 + exp(-max(min(self.slope * log(vote / (1 - vote)) + self.shift, 700.0), -700.0)))


def _vote_table(df: DataFrame, voters: Voters, carried: list[str], left_out: bool) -> DataFrame:
    """The carried columns with ``vote`` and ``evidence``. Equal vectors of a task are looked up once."""
    shared = df.sparkSession.sparkContext.broadcast(voters)
    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in carried]
    seen = f"array<struct<doc_id:{df.schema['doc_id'].dataType.simpleString()},similarity:double,n:int,n_toxic:int>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, known = shared.value, {}
        for batch in batches:
            own = batch.column("toxic").to_pylist() if left_out else [None] * len(batch)
            keys = [(tuple(terms), tuple(tfs), label) for terms, tfs, label in zip(batch.column("terms").to_pylist(), batch.column("tfs").to_pylist(), own)]
            if len(known) >= CACHED:
                known.clear()
            new = sorted({k for k in keys if k not in known})  # like texts ask for the same blocks
            for at in range(0, len(new), TEXTS_AT_ONCE):
                known.update(zip(new[at:at + TEXTS_AT_ONCE], judge.votes(new[at:at + TEXTS_AT_ONCE])))
            out = [known[k] for k in keys]
            kind = pa.list_(pa.struct([("doc_id", batch.column("doc_id").type), ("similarity", pa.float64()), ("n", pa.int32()), ("n_toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array([v for v, _ in out], pa.float64()),
                 pa.array([[dict(zip(("doc_id", "similarity", "n", "n_toxic"), e)) for e in es] for _, es in out], kind)], names=[*carried, "vote", "evidence"])

    return in_partitions(df, work, ", ".join([*kinds, "vote double", f"evidence {seen}"]))


def calibration(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn the log odds of votes into those of labels (logistic regression, held near 1 and 0)."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x = np.stack([np.log(votes / (1 - votes)), np.ones(len(votes))], axis=1)
    held, prior = np.array([1.0, 0.0]), np.eye(2)
    at = held.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + prior, x.T @ (labels - p) - prior @ (at - held))
        at = at + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-10:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def toxicity(docs: DataFrame, labels: DataFrame, most_examples: int = MOST_EXAMPLES, most_terms: int = MOST_TERMS, least_g2: float = LEAST_G2) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for each row of ``docs``.

    Learned only from labelled documents whose crc32(doc_id as text) mod 5 is not 0: at most ``most_examples`` of them, taken in the order of a
    hash of the id. Terms are the at most ``most_terms`` words that their labels depend on (log-likelihood ratio of at
    least ``least_g2``), weighted by TF-IDF, with document frequencies over all documents. A text's ``NEAREST`` distinct
    example vectors by exact cosine (ties with the last too) vote with their labels, weighted by cosine; the votes of examples left out one at a time
    calibrate the result. ``evidence`` has the nearest three: an example's id, the cosine, how many examples have this vector and how many of
    them are toxic.

    A text without terms, empty or missing is scored by the examples without terms. The score follows from the text alone, so equal texts
    have equal ones; repeated rows come back as often as given. Several labels of a document count by their mean; of several texts of one
    id the smallest is the example; labels without an id, without a value or without a document teach nothing. Without any label the score is 0.
    """
    examples = materialize(_examples(docs, labels, most_examples), "examples")
    total, toxic = examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    told = _told_by(F.col("n"), F.col("n_toxic"), max(total, 1), toxic)
    chosen = _term_counts(examples).where(F.col("n") >= LEAST_DOCS).withColumn("g2", told).where(F.col("g2") >= least_g2) \
        .orderBy(F.desc("g2"), "term").limit(most_terms).select("term").collect()
    numbers = {bytes(r.term): k for k, r in enumerate(sorted(chosen))}
    counted = materialize(_counted(docs, numbers, "doc_id"), "counted")
    n_docs, df = _frequencies(counted, len(numbers))
    taught = materialize(_counted(examples, numbers, "doc_id", "toxic"), "taught")
    groups: dict[tuple, list] = {}
    for r in taught.select("doc_id", "toxic", "terms", "tfs").collect():
        g = groups.setdefault((tuple(r.terms), tuple(r.tfs)), [0, 0, r.doc_id])
        groups[tuple(r.terms), tuple(r.tfs)] = [g[0] + 1, g[1] + r.toxic, min(g[2], r.doc_id)]
    vectors = sorted(v for v in groups if v[0])
    voters = Voters(BlockMaxIndex(vectors, np.log((1 + n_docs) / (1 + df)) + 1), {v: k for k, v in enumerate(vectors)},
                    np.array([groups[v][0] for v in vectors], np.int64), np.array([groups[v][1] for v in vectors], np.int64),
                    [groups[v][2] for v in vectors], tuple(groups.get(((), ()), (0, 0))[:2]), toxic / total if total else 0.0)
    if 0 < toxic < total:
        votes = _vote_table(taught, voters, ["toxic"], True).select("vote", "toxic").toPandas()
        voters.slope, voters.shift = calibration(votes["vote"].to_numpy(), votes["toxic"].to_numpy().astype(float))
    slope, shift = F.lit(voters.slope), F.lit(voters.shift)
    vote = F.col("vote")
    score = F.when((vote <= 0) | (vote >= 1), vote).otherwise(1 / (1 + F.exp(-(slope * F.log(vote / (1 - vote)) + shift))))
    return _vote_table(counted, voters, ["doc_id"], False).select(
        "doc_id", (remainder(F.col("doc_id"), HELD_OUT_MOD) == HELD_OUT).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), "evidence")
