"""Structured Streaming jobs, run to the end of the available data."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqlkit as q
from checks.q_tables import LOG_SQL, _log_files
from checks.q_match import RANK
from checks.registry import query
from rostra.session import scratch_path
from rostra.sources import tables as io
from rostra.sources.fixtures import view
from rostra.streaming import jobs


@query("stream_usage", LOG_SQL + """ SELECT date_trunc('hour', ts) AS hour, purpose, count(*) AS calls, CAST(sum(prompt_chars) AS BIGINT) AS prompt_chars,
  CAST(sum(output_chars) AS BIGINT) AS output_chars FROM v_usage_log GROUP BY ALL""")
def stream_usage(spark, sf):
    """Append mode in three batches: the log; rows far ahead, which close all windows but their own; and rows of the log's first day once
    more, which are too late and must be dropped."""
    path = _log_files(spark, sf)
    first = len(spark.read.text(path).inputFiles())
    log = spark.read.schema(io.USAGE_LOG_SCHEMA).json(path)
    ends = log.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    late = log.where(F.col("ts") < F.least(F.lit(ends.a) + F.expr("interval 1 day"), F.lit(ends.b) - F.expr("interval 3 hours")))
    ahead = log.limit(1).withColumn("ts", F.lit(ends.b) + F.expr("interval 3 days"))
    # A trigger takes as many files as the log has; files are taken in the order they were written. Every batch has that many files
    # at most, so no task reads or writes more of the log than its share.
    copies = spark.range(0, first, 1, first).crossJoin(F.broadcast(ahead)).select(*log.columns)
    for batch in [copies, late.repartition(first)]:
        batch.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    stream = spark.readStream.schema(io.USAGE_LOG_SCHEMA).option("maxFilesPerTrigger", first).json(path)
    out = scratch_path(spark, "usage")
    jobs.run_to_end(jobs.usage_per_hour(stream), out, scratch_path(spark, "usage-state"))
    return spark.read.parquet(out)


def _arrivals(spark, sf, files: int, twice: bool):
    """Applications with their resumes as files that arrive, and the stream that reads them."""
    a = view(spark, sf, "v_application").join(view(spark, sf, "v_candidate").select("candidate_id", "resume"), "candidate_id")
    rows = a.select("application_id", "candidate_id", "job_id", "resume", F.to_timestamp("applied_at").alias("applied_at"))
    path = scratch_path(spark, "arrivals")
    (rows.unionByName(rows) if twice else rows).repartition(files).write.parquet(path)
    return spark.readStream.schema(rows.schema), path


@query("stream_screen", q.FACTS + """SELECT application_id, job_id, rule1 AS final_score, decision, coalesce(array_to_string(hit[1:6], ', '), '') AS matched_skills FROM scored""")
def stream_screen(spark, sf):
    """Applications arrive as files, each one twice; every id is scored once."""
    reader, arrivals = _arrivals(spark, sf, 4, twice=True)
    out = scratch_path(spark, "screened")
    jobs.run_to_end(jobs.screen_arrivals(reader.parquet(arrivals), view(spark, sf, "v_job")), out, scratch_path(spark, "screen-state"))
    return spark.read.parquet(out).select("application_id", "job_id", "final_score", "decision", "matched_skills")


@query("stream_rank", q.FACTS + f"""SELECT * FROM (SELECT application_id, job_id, rule1 AS final_score, decision, {RANK} AS rank FROM scored) WHERE rank <= 20""")
def stream_rank(spark, sf):
    """Applications arrive in three batches; the twenty best of every job after the last one."""
    reader, arrivals = _arrivals(spark, sf, 12, twice=False)
    stream = reader.option("maxFilesPerTrigger", 4).parquet(arrivals)
    path = scratch_path(spark, "standing")
    # No application is late here, however the files deal out the dates.
    scored = jobs.screen_arrivals(stream, view(spark, sf, "v_job"), late="3650 days")
    jobs.keep_ranking(scored, path, scratch_path(spark, "rank-state")).awaitTermination()
    return jobs.standing(spark, path).select("application_id", "job_id", "final_score", "decision", F.col("rank").cast("bigint").alias("rank"))
