"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rostra.llm.common import fresh, in_partitions, remainder

UNKNOWN = "und"
PROFILE = 400  # n-grams kept of a language and of a document
PIECE = 1 << 20  # characters counted at once; longer texts are counted piece by piece
MAX_LANGUAGES = 10_000  # bound of the profile table: PROFILE rows per language
MIN_SCORE = 0.05


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _keys(text: str) -> np.ndarray:
    """All n-grams of one to three characters, packed 21 bits a character: letters, and a blank for each run of others.

    A blank stands only at the edge of an n-gram, and the text starts and ends with one.
    """
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    first = np.ones(len(codes), bool)
    first[1:] = letter[1:] | letter[:-1]
    codes, letter = np.where(letter, codes, 32)[first], letter[first]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    two = codes[:-1] << 21 | codes[1:]
    three = (two[:-1] << 21 | codes[2:])[letter[1:-1]]
    return np.concatenate([codes[letter], two, three])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([a[1], b[1]]), len(keys)).astype(np.int64)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a text and their counts. A text beyond ``PIECE`` characters is counted in pieces cut at non-letters."""
    low, at, total = text.lower(), 0, None
    while total is None or at < len(low):
        end = min(len(low), at + PIECE)
        while at < end < len(low) and low[end - 1].isalpha() and end - at > PIECE // 2:
            end -= 1
        found = _runs(_keys(low[at:end]))
        total, at = found if total is None else _add(total, found), max(end, at + 1)
    return total


def top_grams(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` commonest keys, commonest first; ties by key."""
    if len(keys) > 4 * most:  # only those that can be among them
        few = counts >= np.partition(counts, len(counts) - most)[len(counts) - most]
        keys, counts = keys[few], counts[few]
    return keys[np.argsort(-counts, kind="stable")[:most]]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        joined: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            joined.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= PIECE:
                found = count_grams("\n".join(joined.pop(lang)))
                held[lang] = _add(held[lang], found) if lang in held else found
                sizes[lang] = 0
        for lang, texts in joined.items():
            found = count_grams("\n".join(texts))
            held[lang] = _add(held[lang], found) if lang in held else found
    for lang, (keys, counts) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                                         names=["lang", "gram", "n"])


def fit_profiles(labelled: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The ``size`` commonest n-grams of each ``lang``, commonest first, counted over all rows of ``labelled``.

    Rows without a language teach nothing; a missing text counts as empty. Tasks count first, so a language with most
    of the rows sends one row per task and n-gram. The result, ``size`` rows per language, goes to the driver; more than
    ``MAX_LANGUAGES`` languages are an error.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = in_partitions(rows, _count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size).limit(MAX_LANGUAGES * size + 1)
    profiles: dict[str, list[int]] = {}
    for row in top.select("lang", "rank", "gram").orderBy("lang", "rank").toLocalIterator():
        profiles.setdefault(row.lang, []).append(row.gram)
    if len(profiles) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return profiles


class Judge:
    """Out-of-place distance of a document's n-gram ranking to each profile."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        keys, counts = count_grams(text or "")
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        mine = top_grams(keys, counts, self.size)
        at = np.searchsorted(self.grams, mine)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != mine)] = len(self.grams)
        theirs = self.ranks[at]
        away = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(mine))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (self.size * len(mine)))


def predict_language(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (named with leading underscores where taken).

    Only the text is looked at, all of it. ``lang_pred`` is the profile with the smallest out-of-place distance (n-grams
    missing from it count ``size``; ties go to the first name); ``score`` is 1 less the distance as a share of the largest
    possible one. A missing text or one without letters gets ``und`` and 0; so do all texts if there is no profile.
    """
    judge, names = Judge(profiles, size), (fresh(docs, "lang_pred"), fresh(docs, "score"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t) for t in batch.column("text").to_pylist()]
            more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    schema = docs.select("*").schema.add(names[0], "string").add(names[1], "double")
    return docs.mapInArrow(work, schema)


def training_rows(docs: DataFrame, mod: int = 4, held: int = 2) -> Column:
    """Rows that may be learned from: crc32 of the id modulo ``mod`` is not ``held``."""
    return remainder(docs["doc_id"], mod) != held


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; profiles from the rows that are not held out."""
    profiles = fit_profiles(docs.where(training_rows(docs)))
    rows = docs.select("doc_id", (~training_rows(docs)).alias("held_out"), "text")
    return predict_language(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")


def known_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language: rejected are texts without letters and those whose n-gram ranking
    is as far from every profile as a ranking can be, up to ``min_score``. Columns stay as they are."""
    profiles = fit_profiles(docs.where(training_rows(docs)))
    found = predict_language(docs, profiles)
    pred, score = found.columns[-2:]
    return found.where((F.col(pred) != UNKNOWN) & (F.col(score) >= min_score)).select(*[f"`{c}`" for c in docs.columns])
