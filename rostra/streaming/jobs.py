"""Structured Streaming jobs: usage-log roll-up, screening of arriving applications, and their ranking kept up to date."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rostra import constants as K
from rostra.operators import profiles, scoring, tfidf
from rostra.plans.screening import ranking_rows


def usage_per_hour(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """Calls and characters per hour and purpose; rows later than ``late`` are dropped in append mode."""
    return (
        log.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "purpose")
        .agg(F.count("*").alias("calls"), F.sum("prompt_chars").alias("prompt_chars"),
             F.sum("output_chars").alias("output_chars"))
        .select(F.col("w.start").alias("hour"), "purpose", "calls", "prompt_chars", "output_chars"))


def screen_arrivals(arrivals: DataFrame, jobs: DataFrame, vocabulary: Iterable[str] = K.BASE_SKILLS,
                    late: str = "1 day") -> DataFrame:
    """Score applications as they arrive against the static job table; each application id counts once.

    Input ``(application_id, candidate_id, job_id, resume, applied_at)``. Parsing and scoring keep no state; the
    duplicate check forgets ids after ``late``.
    """
    fresh = arrivals.withWatermark("applied_at", late).dropDuplicatesWithinWatermark(["application_id"])
    parsed = profiles.candidate_facts(fresh.select("candidate_id", "resume", "application_id", "job_id"), vocabulary,
                                      keep=["application_id", "job_id"])
    pairs = parsed.join(profiles.job_facts(jobs, vocabulary), "job_id").withColumn(
        "similarity", tfidf.two_text_similarity("resume_terms", "resume_counts", "jd_terms", "jd_counts"))
    return ranking_rows(scoring.add_decision(scoring.add_match(pairs)))


KEPT_PER_JOB = 20


def _last_batch(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    done = spark.read.schema("batch long").parquet(f"{path}/done")
    return (done if before is None else done.where(F.col("batch") < before)).agg(F.max("batch")).first()[0]


def standing(spark: SparkSession, path: str) -> DataFrame:
    """The best applications per job after the last finished batch, with their ``rank``."""
    return spark.read.parquet(f"{path}/standing/{_last_batch(spark, path)}")


def revisions(spark: SparkSession, path: str) -> DataFrame:
    """What every batch changed: ``batch, job_id, application_id, rank_before, rank`` (null: not among the best)."""
    return spark.read.parquet(f"{path}/revisions")


def revise(batch: DataFrame, number: int, path: str, keep: int = KEPT_PER_JOB) -> None:
    """Merge the scored applications of one batch into the standing of the batch before.

    Every batch writes a standing of its own and is entered as done last, so a batch that is repeated after a failure
    starts from the same standing and overwrites its own files only. A job's rows are cut to the best ``keep`` in every
    task before they are shuffled, however many applications one job has.
    """
    spark = batch.sparkSession
    last = _last_batch(spark, path, number) if number else None
    old = batch.limit(0).withColumn("rank", F.lit(0)) if last is None else spark.read.parquet(f"{path}/standing/{last}")
    key = ["job_id", "application_id"]
    rows = old.drop("rank").unionByName(batch.join(old.select(key), key, "left_anti"))
    place = F.row_number().over(Window.partitionBy("job_id").orderBy(F.desc("final_score"), "application_id"))
    rows.withColumn("rank", place).where(F.col("rank") <= keep).write.mode("overwrite").parquet(f"{path}/standing/{number}")
    now = spark.read.parquet(f"{path}/standing/{number}").select(*key, "rank")
    changed = old.select(*key, F.col("rank").alias("rank_before")).join(now, key, "full") \
        .where(~F.col("rank_before").eqNullSafe(F.col("rank")))
    changed.write.mode("overwrite").parquet(f"{path}/revisions/batch={number}")
    spark.range(number, number + 1).toDF("batch").write.mode("overwrite").parquet(f"{path}/done/part={number}")


def keep_ranking(scored: DataFrame, path: str, checkpoint: str, keep: int = KEPT_PER_JOB, available_now: bool = True):
    """Start a query that keeps the best ``keep`` applications of every job, from rows like those of ``screen_arrivals``.

    One ``path`` belongs to one ``checkpoint``: after a restart the query goes on with the standing of the last
    finished batch.
    """
    writer = scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: revise(batch, number, path, keep))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is available, write parquet, stop.

    In complete mode every trigger replaces the result; in append mode rows are added.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    if mode == "complete":
        query = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start()
    else:
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
