"""A ranking kept by a stream against the ranking of all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from rostra.plans import screening
from rostra.streaming import jobs

SCORED = "application_id long, job_id long, final_score double, note string"


def scored(n, seed, first=0):
    rng = random.Random(seed)
    # Job 0 has most of the rows; scores tie often.
    return [(first + i, rng.choice([0, 0, 0, 1, 2]), float(rng.randint(0, 30)), f"n{i}") for i in range(n)]


def best(spark, rows, keep):
    ranked = screening.rank_by_job(spark.createDataFrame(rows, SCORED)).where(F.col("rank") <= keep)
    return sorted((r.job_id, r.rank, r.application_id, r.final_score, r.note) for r in ranked.collect())


def standing(spark, path):
    return sorted((r.job_id, r.rank, r.application_id, r.final_score, r.note) for r in jobs.standing(spark, path).collect())


def run(spark, arrivals, path, state, keep=5):
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(arrivals)
    jobs.keep_ranking(stream, path, state, keep).awaitTermination()


def test_standing_over_batches_and_a_restart(spark, tmp_path):
    arrivals, path, state = (str(tmp_path / n) for n in ("arrivals", "kept", "state"))
    rows = []
    for turn in range(2):  # the second turn goes on from the checkpoint of the first
        for i in range(3):
            new = scored(60, 10 * turn + i, first=1000 * (3 * turn + i))
            rows += new
            spark.createDataFrame(new, SCORED).coalesce(1).write.mode("append").parquet(arrivals)
        run(spark, arrivals, path, state)
        assert standing(spark, path) == best(spark, rows, 5)
    run(spark, arrivals, path, state)  # nothing new
    assert standing(spark, path) == best(spark, rows, 5)
    # The revisions, applied in order, give the standing.
    held = {}
    for r in jobs.revisions(spark, path).orderBy("batch").collect():
        assert held.get((r.job_id, r.application_id)) == r.rank_before
        held[r.job_id, r.application_id] = r["rank"]
    assert sorted((job, rank, a) for (job, a), rank in held.items() if rank) == [r[:3] for r in standing(spark, path)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "kept")
    a, b = scored(40, 1), scored(40, 2, first=100)
    frame = lambda rows: spark.createDataFrame(rows, SCORED)
    jobs.revise(frame(a), 0, path, 5)
    jobs.revise(frame(b), 1, path, 5)
    once = standing(spark, path)
    jobs.revise(frame(b), 1, path, 5)
    assert standing(spark, path) == once == best(spark, a + b, 5)
    jobs.revise(frame(a), 2, path, 5)  # rows that stand already come again
    assert standing(spark, path) == once
    jobs.revise(frame([]), 3, path, 5)
    assert standing(spark, path) == once and jobs.revisions(spark, path).where("batch >= 2").count() == 0


def test_a_batch_that_failed_half_way_is_done_again(spark, tmp_path):
    path = str(tmp_path / "kept")
    a, b = scored(40, 3), scored(40, 4, first=100)
    jobs.revise(spark.createDataFrame(a, SCORED), 0, path, 5)
    bad = spark.createDataFrame(b, SCORED).withColumn("final_score", F.expr("if(application_id = 139, raise_error('lost'), final_score)"))
    with pytest.raises(Exception, match="lost"):
        jobs.revise(bad, 1, path, 5)
    assert standing(spark, path) == best(spark, a, 5)
    jobs.revise(spark.createDataFrame(b, SCORED), 1, path, 5)
    assert standing(spark, path) == best(spark, a + b, 5)


def test_usage_log_is_dealt_to_as_many_files_as_the_table(spark, tmp_path, monkeypatch):
    """late rows came through one task that read the whole log; a larger log had four files as well."""
    import os
    from checks import q_streams
    events = spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.element_at(F.array(F.lit("click"), F.lit("error")), (F.col("id") % 2 + 1).cast("int")).alias("event_type"), F.lit(2.5).alias("value"))
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    paths, dealt = [], q_streams._log_files
    monkeypatch.setattr(q_streams, "_log_files", lambda s, sf: paths.append(dealt(s, sf)) or paths[0])
    conf = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "16k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {(r.hour, r.purpose): r.calls for r in q_streams.stream_usage(spark, str(tmp_path)).collect()}
        want = {(r.h, r.event_type): r.n for r in events.groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.count("*").alias("n")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    files = [f for f in os.listdir(paths[0].removeprefix("file:")) if f.endswith(".json")]
    runs = {}
    for f in files:
        runs.setdefault(f.split("-", 2)[2].split("-c000")[0], []).append(f)
    assert len(runs) == 3 and len({len(v) for v in runs.values()}) == 1 and len(files) >= 18
