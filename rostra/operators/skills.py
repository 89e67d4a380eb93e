"""Skill vocabulary: mining it from phrases and matching it, small or large."""

from __future__ import annotations

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from rostra import constants as K
from rostra.functions.automaton import Terms, leftmost_longest
from rostra.session import materialize

CHARS_AT_ONCE = 4_000_000  # characters of the vocabulary in one broadcast trie


def mine_skills(texts: DataFrame, text: str, min_freq: int = 3, weight: str | None = None) -> DataFrame:
    """Skills listed after "proficient in", "skills:" or "skilled in" at least ``min_freq`` times."""
    low = F.lower(text)
    phrases = F.concat(*[F.regexp_extract_all(low, F.lit("(?d)" + p), 1) for p in K.SKILL_PHRASE_PATTERNS])
    parts = F.flatten(F.transform(phrases, lambda p: F.split(p, K.SKILL_LIST_SPLIT)))
    tidy = F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"[^a-z0-9+#./\s-]", ""), F.lit(" .-")))
    fit = F.filter(tidy, lambda s: F.length(s).between(2, 40)
                   & F.regexp_count(s, F.lit(r"\S+")).between(1, 4))
    w = F.col(weight) if weight else F.lit(1)
    return (
        texts.select(w.alias("w"), F.explode(fit).alias("skill"))
        .groupBy("skill").agg(F.sum("w").alias("freq"))
        .where(F.col("freq") >= min_freq))


def full_vocabulary(base: DataFrame, mined: DataFrame) -> DataFrame:
    return (base.select("skill").unionByName(mined.select("skill"))
            .select(F.trim(F.lower("skill")).alias("skill")).where(F.col("skill") != "").distinct())


def _places(trie: Broadcast):
    """The part of the vocabulary behind ``trie``, looked up in a lower-case text: places found before go in, all come out."""
    def find(low: pd.Series, known: pd.Series) -> pd.Series:
        return trie.value.find(low, known)

    return F.pandas_udf(find, "array<int>")


def add_skills(docs: DataFrame, text: str, vocabulary: DataFrame, name: str = "skills", at_once: int = CHARS_AT_ONCE) -> DataFrame:
    """Match a vocabulary of any size; an empty one is replaced by the base skills. A missing text has no skills.

    Texts stay where they lie. The vocabulary is dealt into parts of about ``at_once`` characters, each broadcast as a trie;
    a text is walked once per part and keeps, for every place, the longest term found there so far. What counts is read
    off at the end, from the left, as the pattern of the whole vocabulary would find it.
    """
    spark = docs.sparkSession
    terms = materialize(vocabulary.select(F.trim(F.lower("skill")).alias("skill")).where(F.col("skill") != "").distinct(), "skills")
    chars = terms.agg(F.sum(F.length("skill"))).first()[0]
    if chars is None:
        terms, chars = spark.createDataFrame([(s,) for s in K.BASE_SKILLS], "skill string"), 0
    parts = max(1, -(-chars // at_once))
    found = docs.withColumn("__low", F.lower(text)).withColumn("__found", F.lit(None).cast("array<int>"))
    for part in range(parts):
        mine = terms.where(F.pmod(F.xxhash64("skill"), F.lit(parts)) == part)
        trie = spark.sparkContext.broadcast(Terms(mine.toArrow()["skill"].to_pylist()))
        found = found.withColumn("__found", _places(trie)("__low", "__found"))
        if parts > 1:
            found = materialize(found, "places")  # one part at a time in a worker's memory
    chosen = F.pandas_udf(leftmost_longest, "array<string>")
    return found.withColumn(name, chosen("__low", "__found")).drop("__low", "__found")


def role_skill_profile(rows: DataFrame, roles: int | None = None, first: int | None = None, top: int = 15) -> DataFrame:
    """Commonest skills of every role, from all its resumes.

    Input ``(row_id, job_role, skills)``. A role without any skill gets the two fallback skills. On request only the
    ``roles`` most frequent roles, and of each the ``first`` resumes.
    """
    top_roles = rows.groupBy("job_role").agg(F.count("*").alias("rows"))
    in_role = rows
    if roles is not None:
        top_roles = top_roles.orderBy(F.desc("rows"), "job_role").limit(roles)
        in_role = rows.join(F.broadcast(top_roles), "job_role", "left_semi")
    if first is not None:
        in_role = first_n_per_group(in_role, "job_role", [F.col("row_id")], first)
    counts = in_role.select("job_role", F.explode("skills").alias("skill")).groupBy("job_role", "skill") \
        .agg(F.count("*").alias("n"))
    best = first_n_per_group(counts, "job_role", [F.desc("n"), F.col("skill")], top)
    per_role = best.groupBy("job_role").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("n")).alias("o"), "skill"))).getField("skill").alias("skills"))
    fallback = F.array(*[F.lit(s) for s in K.FALLBACK_ROLE_SKILLS])
    return top_roles.join(per_role, "job_role", "left") \
        .select("job_role", "rows", F.coalesce("skills", fallback).alias("skills"))


def first_n_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group. Spark limits each partition before the shuffle, so groups may be any size."""
    return (df.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
            .where(F.col("__rn") <= n).drop("__rn"))
