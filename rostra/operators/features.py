"""The fifteen numeric features of a (resume, job description) pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rostra import constants as K
from rostra.functions import text as tx


def gap(level: Column, required: Column) -> Column:
    return F.when((level >= 0) & (required >= 0), level - required).otherwise(0)


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def resume_side(resumes: DataFrame, text: str = "resume") -> DataFrame:
    """Everything the features need from a resume; ``skills`` must be present."""
    return (
        resumes.withColumn("education_level", tx.education_level(F.col(text)))
        .withColumn("experience_years", tx.experience_years(F.col(text)))
        .withColumn("certifications", tx.certification_count(F.col(text)))
        .withColumn("resume_word_count", tx.word_count(F.col(text)))
        .withColumn("resume_clean", tx.clean(F.col(text))))


def job_side(jobs: DataFrame, text: str = "job_description") -> DataFrame:
    """Everything the features need from a job; ``jd_skills`` must be present."""
    return (
        jobs.withColumn("required_education", tx.education_level(F.col(text)))
        .withColumn("required_experience", tx.experience_years(F.col(text)))
        .withColumn("role_words", tx.role_words(F.col("job_role"))))


def add_pair_features(pairs: DataFrame) -> DataFrame:
    """Add the fourteen rule features; ``tfidf_similarity`` is already a column. All become double."""
    overlap = F.size(F.array_intersect("skills", "jd_skills"))
    union = F.size(F.array_union("skills", "jd_skills"))
    rules = {
        "skill_overlap": overlap,
        "skill_coverage": share(overlap, F.size("jd_skills")),
        "skill_jaccard": share(overlap, union),
        "resume_skill_count": F.size("skills"),
        "jd_skill_count": F.size("jd_skills"),
        "education_level": F.col("education_level"),
        "required_education": F.col("required_education"),
        "education_gap": gap(F.col("education_level"), F.col("required_education")),
        "experience_years": F.col("experience_years"),
        "required_experience": F.col("required_experience"),
        "experience_gap": F.col("experience_years") - F.col("required_experience"),
        "certifications": F.col("certifications"),
        "resume_word_count": F.col("resume_word_count"),
        "role_title_in_resume": tx.role_hit(F.col("role_words"), F.col("resume_clean")),
        "tfidf_similarity": F.col("tfidf_similarity"),
    }
    kept = [c for c in pairs.columns if c not in rules]
    return pairs.select(*kept, *[rules[name].cast("double").alias(name) for name in K.FEATURE_NAMES])
