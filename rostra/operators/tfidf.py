"""TF-IDF over tables of texts: fit, transform, row-wise similarity.

idf(t) = ln((1 + n) / (1 + df(t))) + 1, weight = (1 + ln tf) * idf, rows scaled to unit length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rostra import constants as K
from rostra.functions import text as tx, vectors as vec
from rostra.operators.skew import spread_join

# Largest vocabularies of the pair features and of the category models, commonest terms first.
MAX_TERMS_PAIRS = 30000
MAX_TERMS_CATEGORY = 40000
RARE_IDF = 1.4054651081081644  # ln(3 / 2) + 1: a term found in one of two texts


def count_terms(docs: DataFrame, text: Column, bigrams: bool = True, stop_words: list[str] | None = None) -> DataFrame:
    """Add ``terms`` and ``counts`` arrays for a text column. Runs inside the row, no shuffle."""
    stop_words = K.STOP_WORDS if stop_words is None else stop_words
    tokens = docs.withColumn("__tokens", tx.word_tokens(text, stop_words))
    grams = tx.with_bigrams(F.col("__tokens")) if bigrams else F.col("__tokens")
    return vec.add_term_counts(tokens, grams).drop("__tokens")


def document_count(docs: DataFrame, weight: str | None = None) -> Column:
    total = F.sum(weight) if weight else F.count("*")
    return docs.agg(total.cast("bigint").alias("n")).scalar()


def fit(counted: DataFrame, n_docs: Column, min_df: int = 2, max_terms: int | None = MAX_TERMS_PAIRS,
        weight: str | None = None) -> DataFrame:
    """Vocabulary ``(term, df, cf, idf)``.

    ``weight`` says how many rows of the corpus a text stands for, so a job description repeated for a
    million applications is tokenised once and still counts a million times.
    """
    w = F.col(weight) if weight else F.lit(1)
    long = counted.select(w.cast("bigint").alias("w"), F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    vocabulary = (
        long.groupBy(F.col("e.terms").alias("term"))
        .agg(F.sum("w").alias("df"), F.sum(F.col("w") * F.col("e.counts")).alias("cf"))
        .where(F.col("df") >= min_df))
    if max_terms is not None:
        vocabulary = vocabulary.orderBy(F.desc("cf"), "term").limit(max_terms)
    return vocabulary.withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1)


def transform(counted: DataFrame, vocabulary: DataFrame, doc_id: str, max_terms: int | None = MAX_TERMS_PAIRS) -> DataFrame:
    """``(doc_id, terms, weights)``: unit-length sublinear TF-IDF vectors, terms sorted.

    ``max_terms`` is the cap the vocabulary was fitted with: the proof of its size, so it is broadcast whole. Without
    a cap (``None``) postings meet the vocabulary in a join that spreads frequent terms.
    """
    long = counted.select(doc_id, F.explode(F.arrays_zip("terms", "counts")).alias("e")) \
        .select(doc_id, F.col("e.terms").alias("term"), F.col("e.counts").alias("tf"))
    if max_terms is not None:
        matched = long.join(F.broadcast(vocabulary.select("term", "idf")), "term")
    else:
        matched = spread_join(long, vocabulary.select("term", "idf", "df"), "term", doc_id, "df", unique=True)
    weighted = matched.select(
        doc_id, F.struct("term", ((1 + F.log("tf")) * F.col("idf")).alias("w")).alias("e"))
    # One group is one document: its size is that of the text itself.
    vectors = weighted.groupBy(doc_id).agg(F.sort_array(F.collect_list("e")).alias("__e"))
    return vectors.select(doc_id, F.col("__e.term").alias("terms"), F.col("__e.w").alias("__w")) \
        .select(doc_id, "terms", vec.unit(F.col("__w")).alias("weights"))


def similarity(pairs: DataFrame, resumes: DataFrame, jobs: DataFrame, resume_id: str, job_id: str,
               name: str = "tfidf_similarity") -> DataFrame:
    """Add the dot product of the resume and job vectors of each pair; 0 where either has no known term."""
    left = resumes.select(resume_id, F.col("terms").alias("__rt"), F.col("weights").alias("__rw"))
    right = jobs.select(job_id, F.col("terms").alias("__jt"), F.col("weights").alias("__jw"))
    # A job with a large share of the pairs is spread over many tasks.
    per_job = pairs.groupBy(job_id).agg(F.count("*").alias("__pairs"))
    joined = spread_join(pairs.join(left, resume_id, "left"), right.join(per_job, job_id), job_id, resume_id, "__pairs", unique=True, how="left")
    return (joined.withColumn(name, F.coalesce(vec.dot("__rt", "__rw", "__jt", "__jw"), F.lit(0.0)))
            .drop("__rt", "__rw", "__jt", "__jw"))


def two_text_similarity(left_terms: str, left_counts: str, right_terms: str, right_counts: str) -> Column:
    """Cosine of two texts under TF-IDF fitted on just these two (raw counts, smooth idf).

    A common term has idf 1 and any other ``ln(3/2) + 1``, so the lengths follow from the sum of squares of
    each text and that of the common terms: nothing is grouped per pair.
    """
    sums = F.aggregate(
        vec.common_weights(left_terms, left_counts, right_terms, right_counts),
        F.struct(F.lit(0.0).alias("ab"), F.lit(0.0).alias("aa"), F.lit(0.0).alias("bb")),
        lambda acc, t: F.struct(
            (acc["ab"] + t["a"] * t["b"]).alias("ab"), (acc["aa"] + t["a"] * t["a"]).alias("aa"), (acc["bb"] + t["b"] * t["b"]).alias("bb")),
        lambda acc: _cosine(acc, vec.sum_of_squares(F.col(left_counts)), vec.sum_of_squares(F.col(right_counts))))
    return F.coalesce(sums, F.lit(0.0))


def _cosine(acc: Column, left_squares: Column, right_squares: Column) -> Column:
    rare = RARE_IDF * RARE_IDF
    left = rare * left_squares - (rare - 1) * acc["aa"]
    right = rare * right_squares - (rare - 1) * acc["bb"]
    return F.try_divide(acc["ab"], F.sqrt(left * right))
