"""Language-model scores: likelihood of a text over all segmentations into subword pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rostra.llm.common import gathered, in_partitions, remainder
from rostra.llm.lattice import Pieces
from rostra.session import materialize

ROUNDS = 2
SMOOTHING = 0.1
MODELS = 16  # components of the mixture
LEAST_COUNT = 3  # a training word that occurs so often is a piece of its own, at every size of the input
HOT_SHARE = 5e-7  # words with this share of the training tokens, at most two million, are kept in memory
WORDS_AT_ONCE = 50_000
COUNTED_AT_ONCE = 400_000
ROWS_AT_ONCE = 50_000
LN10 = math.log(10)


def word_list(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes split at the six ASCII blanks."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def vocabulary(model_file: str) -> list[bytes]:
    """Pieces of a sentencepiece file as byte strings, best score first, a leading word mark as a blank.

    Control pieces and those that lower-cased words can't use are left out; every single byte is a piece.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found: dict[bytes, float] = {bytes([b]): -math.inf for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if piece and b" " not in piece[1:] and piece == piece.lower():
                found[piece] = max(found.get(piece, -math.inf), model.get_score(i))
    return sorted(found, key=lambda p: (-found[p], p))


def count_words(docs: DataFrame, models: int) -> DataFrame:
    """``word binary, c array<long>``: how often each word stands in the texts of each ``model``, counted in the tasks first."""
    names = [f"c{m}" for m in range(models)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter] = [Counter() for _ in names]

        def out() -> Iterator[pa.RecordBatch]:
            for m, found in enumerate(held):
                if found:
                    zero, own = pa.array(np.zeros(len(found), np.int64)), pa.array(list(found.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), *(own if k == m else zero for k in range(models))],
                                                     names=["word", *names])
                found.clear()
        for batch in batches:
            for text, m in zip(batch.column("text").to_pylist(), batch.column("model").to_pylist()):
                held[m].update(word_list(text or ""))
                if len(held[m]) >= COUNTED_AT_ONCE:
                    yield from out()
        yield from out()

    sums = in_partitions(docs.select("text", "model"), work, "word binary, " + ", ".join(f"{c} long" for c in names)) \
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    return sums.select("word", F.array(*names).alias("c"))


def fit_scores(counts: DataFrame, texts: np.ndarray, pieces: list[bytes], rounds: int = ROUNDS) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """Expectation-maximisation of the piece scores of each model over the counts of all its training words.

    The n-th piece starts with a probability in proportion to 1 / (n + 10). Each round weighs all segmentations of every
    word with the scores so far. Words of ``counts`` that are marked ``own`` are pieces outside the list, each used as often as it
    occurs. What goes to the driver is one number for each piece and model. Also gives the score of a text's end, and
    the sum of all uses, by model.
    """
    apart = counts.where("own").agg(F.count("*"), *[F.coalesce(F.sum(F.get("c", F.lit(m))), F.lit(0)) for m in range(len(texts))]).first()
    alone, counts = np.array(apart[1:], float), counts.where("NOT own")
    total = np.ones(len(texts))
    models, start = len(texts), -np.log(np.arange(len(pieces)) + 10.0)
    lattices, end = Pieces(pieces, np.repeat((start - np.logaddexp.reduce(start))[:, None], models, axis=1)), np.zeros(models)
    for _ in range(rounds):
        table = counts.sparkSession.sparkContext.broadcast(lattices)

        def work(batches: Iterator[pa.RecordBatch], table=table, size=len(pieces)) -> Iterator[pa.RecordBatch]:
            lattice, expected = table.value, np.zeros((size, models))
            for batch in gathered(batches, WORDS_AT_ONCE):
                times = batch.column("c").flatten().to_numpy().reshape(len(batch), models)
                which, model = np.nonzero(times)
                words = batch.column("word").to_pylist()
                lattice.expect([b" " + words[k] for k in which.tolist()], model, times[which, model].astype(float), expected)
            which, model = np.nonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(model), pa.array(expected[which, model])], names=["piece", "model", "n"])

        uses = np.zeros((len(pieces), models))
        summed = in_partitions(counts, work, "piece long, model long, n double").groupBy("piece", "model").agg(F.sum("n").alias("n"))
        for row in summed.toLocalIterator():
            uses[row.piece, row.model] = row.n
        total = uses.sum(axis=0) + alone + texts + SMOOTHING * (len(pieces) + apart[0] + 1)
        lattices, end = lattices.with_scores(np.log((uses + SMOOTHING) / total)), np.log((texts + SMOOTHING) / total)
    return lattices, end, total


def lm_score(docs: DataFrame, model_file: str, mod: int = 7, held: int = 2, rounds: int = ROUNDS, models: int = MODELS,
             whole_words: bool = True) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``score`` is the log10 probability of the whole text. Each word is summed over all its segmentations into pieces: those
    of ``model_file`` (read by the driver) and, with ``whole_words``, every training word with ``LEAST_COUNT`` occurrences. Piece probabilities are fitted to the words of all documents that are not held out, one model for each of the
    ``models - 1`` commonest ``lang`` values of these and one for the rest; a text is the mixture of the models by their shares,
    so a text's own language is not looked at. ``base_score`` is the add-one word model over the same documents.

    Frequent words (share ``HOT_SHARE``: a bounded list) are scored where the texts lie, and stand in the lattices of longer words too; the others
    go to the word's counts by a join, as rows of (row, word, times), and have their own piece as one more segmentation. A missing text counts as empty: one token, the end. Rows keep a number of their
    own, so repeated rows and missing ids come back as given. Without training documents N and V are 0.
    """
    id_type, spark = docs.schema["doc_id"].dataType.simpleString(), docs.sparkSession
    rows = docs.select("doc_id", "text", "lang", (remainder(docs["doc_id"], mod) == held).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    langs = [r.lang for r in train.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(models - 1).collect()]
    model_of = F.lit(len(langs)).cast("long")
    for m, lang in enumerate(langs):
        model_of = F.when(F.col("lang") == lang, F.lit(m).cast("long")).otherwise(model_of)
    train = train.withColumn("model", model_of)
    sizes = {r.model: r.n for r in train.groupBy("model").agg(F.count("*").alias("n")).collect()}
    models = max(1, len(langs) + (len(langs) in sizes))
    texts = np.array([sizes.get(m, 0) for m in range(models)], float)
    n_texts = int(texts.sum())
    counts = materialize(count_words(train, models).withColumn("all", F.aggregate("c", F.lit(0).cast("long"), lambda a, b: a + b)), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("all"), F.lit(0)), F.count("*")).first()
    n, v = int(total) + n_texts, distinct + (n_texts > 0)
    least_hot = max(float(LEAST_COUNT), n * HOT_SHARE)
    pieces, hot = vocabulary(model_file), counts.where(F.col("all") >= least_hot)
    counts = counts.withColumn("own", (F.col("all") >= LEAST_COUNT) & (F.col("all") < least_hot) & F.lit(whole_words))
    if whole_words:
        have = set(pieces)
        pieces += sorted(p for p in (b" " + bytes(r.word) for r in hot.select("word").toLocalIterator()) if p not in have)
    lattices, end, uses = fit_scores(counts, texts, pieces, rounds)
    table = spark.sparkContext.broadcast(lattices)
    lp_names = [f"lp{m}" for m in range(models)]
    lp_kinds = ", ".join(f"{c} double" for c in lp_names)

    def lattice_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = table.value
        for batch in gathered(batches, WORDS_AT_ONCE):
            lp = lattice.log_probability([b" " + w for w in batch.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("all"), *(pa.array(x) for x in lp.T)], names=["word", "all", *lp_names])

    known = {bytes(r[0]): (i, r[1], r[2:]) for i, r in enumerate(
        in_partitions(hot, lattice_of, f"word binary, all long, {lp_kinds}").toLocalIterator())}
    memory = spark.sparkContext.broadcast((
        {w: i for w, (i, _, _) in known.items()},
        np.array([[math.log10(k[1] + 1), *k[2]] for k in known.values()], float).reshape(-1, models + 1)))
    names = ["row", "doc_id", "held_out", "word", "times", "known", "base", *lp_names]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (place, values), row = memory.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            kept, sums, rest = [], [], ([], [], [])
            for text in batch.column("text").to_pylist():
                words = Counter(word_list(text or ""))
                at = [place.get(w, -1) for w in words]
                times = np.fromiter(words.values(), np.int64, len(words))
                on = np.array(at, np.int64)
                near_by = on >= 0
                sums.append(times[near_by] @ values[on[near_by]])
                kept.append((row, int(times.sum()), int(times[near_by].sum())))
                for w, i in zip(words.items(), at):
                    if i < 0:
                        rest[0].append(row)
                        rest[1].append(w[0])
                        rest[2].append(w[1])
                row += 1
            ints = np.array(kept, np.int64).reshape(-1, 3).T
            reals = np.array(sums, float).reshape(-1, models + 1).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(ints[0]), batch.column("doc_id"), batch.column("held_out"), pa.nulls(len(batch), pa.binary()),
                 pa.array(ints[1]), pa.array(ints[2]), *(pa.array(x) for x in reals)], names=names)
            for at in range(0, len(rest[0]), ROWS_AT_ONCE):
                own = [x[at:at + ROWS_AT_ONCE] for x in rest]
                k = len(own[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[0], pa.int64()), pa.nulls(k, batch.column("doc_id").type), pa.nulls(k, pa.bool_()), pa.array(own[1], pa.binary()),
                     pa.array(own[2], pa.int64()), pa.nulls(k, pa.int64()), *(pa.nulls(k, pa.float64()) for _ in range(models + 1))], names=names)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = table.value
        for batch in gathered(batches, 3 * WORDS_AT_ONCE):  # the join has sorted them by word
            words = batch.column("word").to_pylist()
            place = {w: i for i, w in enumerate(dict.fromkeys(words))}
            lp = lattice.log_probability([b" " + w for w in place])[[place[w] for w in words]]
            times, c = batch.column("times").to_numpy(), batch.column("all").to_numpy()
            own = np.flatnonzero(batch.column("own").to_numpy(zero_copy_only=False))
            by_model = batch.column("c").take(pa.array(own)).flatten().to_numpy().reshape(len(own), models)
            lp[own] = np.logaddexp(lp[own], np.log((by_model + SMOOTHING) / uses))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.where(c > 0, times, 0)), pa.array(times * np.log10(c + 1.0)),
                 *(pa.array(x) for x in (times[:, None] * lp).T)], names=["row", "known", "base", *lp_names])

    split = materialize(in_partitions(rows.select("doc_id", "text", "held_out"), near, f"row long, doc_id {id_type}, held_out boolean, "
                                      f"word binary, times long, known long, base double, {lp_kinds}"), "scored")
    rest = split.where(F.col("word").isNotNull()).select("row", "word", "times").join(counts.select("word", "all", "own", "c"), "word", "left")
    rare = in_partitions(rest.select("row", "word", "times", F.coalesce("all", F.lit(0)).alias("all"), F.coalesce("own", F.lit(False)).alias("own"), "c"), far,
                         f"row long, known long, base double, {lp_kinds}")
    rare = rare.groupBy("row").agg(*[F.sum(c).alias(f"{c}_rare") for c in ("known", "base", *lp_names)])
    whole = split.where(F.col("word").isNull()).drop("word").join(rare, "row", "left")

    def both(c: str) -> Column:
        return F.col(c) + F.coalesce(f"{c}_rare", F.lit(0))
    prior = np.log((texts + SMOOTHING) / (texts + SMOOTHING).sum())
    joint = F.array(*[both(c) + F.lit(float(prior[m] + end[m])) for m, c in enumerate(lp_names)])
    mixed = whole.withColumn("joint", joint).withColumn("top", F.array_max("joint"))
    return mixed.select(
        "doc_id", "held_out", (F.col("times") + 1).alias("n_tokens"), (both("known") + F.lit(int(n_texts > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (both("base") + F.lit(math.log10(n_texts + 1)) - (F.col("times") + 1) * F.lit(math.log10(n + v + 1))).alias("base_score"),
        ((F.col("top") + F.log(F.aggregate(F.transform("joint", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, b: a + b)))
         / F.lit(LN10)).alias("score"))
