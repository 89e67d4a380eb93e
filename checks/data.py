"""Shared inputs of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rostra import constants as K
from rostra.functions import text as tx
from rostra.functions.skills import extract_skills
from rostra.operators import features, loading, tfidf
from rostra.plans import screening
from rostra.session import materialize
from rostra.sources.fixtures import view

SENSITIVE = ["age", "segment"]


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every resume, job description and document as ``(text_id, text)``."""
    c = view(spark, sf, "v_candidate").select(F.concat(F.lit("c"), F.col("candidate_id").cast("string")).alias("text_id"), F.col("resume").alias("text"))
    j = view(spark, sf, "v_job").select(F.concat(F.lit("j"), F.col("job_id").cast("string")).alias("text_id"), F.col("job_description").alias("text"))
    d = view(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("text_id"), "text")
    return c.unionByName(j).unionByName(d)


def raw_screening(spark: SparkSession, sf: str) -> DataFrame:
    """The screening table with the headers of a public data set."""
    return view(spark, sf, "v_screening").select(
        "row_id", F.col("resume").alias("Resume"), F.col("job_description").alias("Job Description"),
        F.col("job_role").alias("Job Roles"), F.col("raw_label").alias("Best Match"),
        F.col("sensitive_age").alias("Age"), F.col("sensitive_segment").alias("Segment"))


def standard(spark: SparkSession, sf: str) -> DataFrame:
    """The screening table in the standard schema, keys of candidate and job kept."""
    s = view(spark, sf, "v_screening")
    return s.select("row_id", "candidate_id", "job_id", "resume", "job_description", "job_role",
                    loading.binary_label(F.col("raw_label"), numeric=False).alias("label"), "sensitive_age", "sensitive_segment")


def loaded(spark: SparkSession, sf: str) -> DataFrame:
    return loading.load_screening(standard(spark, sf))


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return screening.matched_applications(
        view(spark, sf, "v_application"), view(spark, sf, "v_candidate"), view(spark, sf, "v_job"))


def corpus(rows: DataFrame, spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Candidate and job texts of the rows, each with the number of rows it stands for."""
    per_candidate = rows.groupBy("candidate_id").agg(F.count("*").alias("mult"))
    per_job = rows.groupBy("job_id").agg(F.count("*").alias("mult"))
    c = view(spark, sf, "v_candidate").select("candidate_id", F.col("resume").alias("text")).join(per_candidate, "candidate_id")
    j = view(spark, sf, "v_job").select("job_id", F.col("job_description").alias("text")).join(per_job, "job_id")
    return c, j


def fitted(rows: DataFrame, spark: SparkSession, sf: str, fit_on: Column | None = None):
    """Vocabulary of the rows (duplicates counted) and the counted texts.

    Counting terms is the costly pass over the texts: it is written once and read for the fit and both transforms.
    ``fit_on`` limits the rows the vocabulary is fitted on.
    """
    slim = rows.select("candidate_id", "job_id", F.coalesce(fit_on, F.lit(False)).alias("fit") if fit_on is not None else F.lit(True).alias("fit"))
    counted = []
    for table, key, text in (("v_candidate", "candidate_id", "resume"), ("v_job", "job_id", "job_description")):
        weights = slim.groupBy(key).agg(F.sum(F.col("fit").cast("bigint")).alias("mult"))
        texts = view(spark, sf, table).select(key, F.col(text).alias("text")).join(weights, key)
        counted.append(materialize(tfidf.count_terms(texts, tx.clean(F.col("text"))).drop("text"), "counted"))
    c, j = counted
    both = c.select("terms", "counts", "mult").unionByName(j.select("terms", "counts", "mult")).where("mult > 0")
    vocabulary = tfidf.fit(both, tfidf.document_count(both, "mult"), weight="mult")
    return materialize(vocabulary, "vocabulary"), c, j


def feature_table(rows: DataFrame, spark: SparkSession, sf: str, keep: list[str], fit_on: Column | None = None) -> DataFrame:
    """The fifteen features of the rows; every distinct resume and job is parsed once."""
    vocabulary, c, j = fitted(rows, spark, sf, fit_on)
    pairs = tfidf.similarity(
        rows.select("row_id", "candidate_id", "job_id", *keep),
        tfidf.transform(c, vocabulary, "candidate_id"), tfidf.transform(j, vocabulary, "job_id"), "candidate_id", "job_id")
    resumes = features.resume_side(view(spark, sf, "v_candidate").select(
        "candidate_id", "resume", extract_skills(F.col("resume"), K.BASE_SKILLS).alias("skills"))).drop("resume")
    jobs = features.job_side(view(spark, sf, "v_job").select(
        "job_id", "job_role", "job_description",
        extract_skills(F.col("job_description"), K.BASE_SKILLS).alias("jd_skills"))).drop("job_role", "job_description")
    joined = pairs.join(resumes, "candidate_id").join(jobs, "job_id")
    return features.add_pair_features(joined).select("row_id", *keep, *K.FEATURE_NAMES)


def slim_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The loaded rows without their texts, written once: several branches start from them."""
    return materialize(loaded(spark, sf).select(
        "row_id", "candidate_id", "job_id", "label", "sensitive_age", "sensitive_segment"), "loaded")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled applications with a given probability: ``(row_id, job_id, label, prob, predicted, sensitive_*)``."""
    prob = F.pmod(F.col("row_id") * 7919 + 42, F.lit(1009)) / F.lit(1008.0)
    return slim_loaded(spark, sf).select("row_id", "job_id", "label", prob.alias("prob"), (prob >= 0.5).cast("int").alias("predicted"),
                                    "sensitive_age", "sensitive_segment")
