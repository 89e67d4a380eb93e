"""Sources and sinks, loading, profiling of the data set, metrics and fairness."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from checks import data, sqlkit as q
from checks.registry import query
from rostra import constants as K
from rostra.operators import eda, fairness, loading, metrics, models
from rostra.operators.ordering import add_rank
from rostra.functions.skills import extract_skills
from rostra.session import scratch_path
from rostra.sources import tables as io
from rostra.sources.fixtures import oracle_with, view

# --- sources and sinks: a given table is written, then read by the reader under test ----------------------------

CSV_SQL = oracle_with("v_screening") + """
SELECT row_id, md5(resume) AS resume, md5(job_description) AS job_description, raw_label AS label, job_role, sensitive_age AS age FROM v_screening"""


def _csv_copy(spark, sf, df=None, **options):
    path = scratch_path(spark, "csv")
    w = (data.raw_screening(spark, sf) if df is None else df).write.option("header", True).option("escape", '"')
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)
    return path


@query("src_csv", oracle_with("v_resume_category") + """
SELECT row_id, md5(resume || ' "quoted", é' || chr(10) || 'x') AS resume, category FROM v_resume_category""")
def src_csv(spark, sf):
    """Half of the rows in a UTF-8 file set, half in a Latin-1 one; texts hold quotes, commas and line breaks."""
    docs = view(spark, sf, "v_resume_category").select(
        "row_id", F.concat("resume", F.lit(' "quoted", é\nx')).alias("resume"), "category")
    latin = F.col("row_id") % 2 == 0
    # Only texts that Latin-1 can hold go to its files.
    fits = ~F.col("resume").rlike("[^\\x{00}-\\x{ff}]")
    root = scratch_path(spark, "csv")
    docs.where(latin & fits).write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(f"{root}/a")
    docs.where(~(latin & fits)).write.option("header", True).option("escape", '"').csv(f"{root}/b")
    back = io.read_csv(spark, root, "row_id bigint, resume string, category string")
    return back.select("row_id", F.md5("resume").alias("resume"), "category")


@query("src_discover", oracle_with("v_screening") + """
SELECT kind, rows FROM (SELECT 'screening' AS kind, count(*) AS rows FROM v_screening
UNION ALL SELECT 'resume_category', count(*) FROM documents)""")
def src_discover(spark, sf):
    """Of two folders of files the right one is found by its header, and read."""
    root = scratch_path(spark, "raw")
    data.raw_screening(spark, sf).write.option("header", True).option("escape", '"').csv(f"{root}/b_screening")
    view(spark, sf, "v_resume_category").write.option("header", True).option("escape", '"').csv(f"{root}/c_category")

    def rows(kind, required, forbidden):
        found = io.discover(spark, root, required, forbidden).first().file
        folder = found.rsplit("/", 1)[0]
        return io.read_csv(spark, folder).agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"))

    return rows("screening", ["resume", "job_description", "label"], None).unionByName(
        rows("resume_category", ["resume", "category"], ["job_description"]))


@query("src_normalize_columns", oracle_with("v_screening") + """
SELECT row_id, job_role AS job_roles, raw_label AS best_match, CAST(sensitive_age AS BIGINT) AS age, sensitive_segment AS segment, md5(resume) AS resume,
  md5(job_description) AS job_description FROM v_screening""")
def src_normalize_columns(spark, sf):
    raw = data.raw_screening(spark, sf)
    messy = raw.toDF(*[f"  {c.upper()} !" for c in raw.columns])
    return io.normalise_columns(messy).withColumns({"resume": F.md5("resume"), "job_description": F.md5("job_description")})


@query("src_alias_columns", oracle_with("v_screening") + """
SELECT md5(resume) AS resume, md5(job_description) AS job_description, job_role, raw_label AS label FROM v_screening""")
def src_alias_columns(spark, sf):
    out = io.alias_columns(io.normalise_columns(data.raw_screening(spark, sf)), ["resume", "job_description", "job_role", "label"])
    return out.withColumns({"resume": F.md5("resume"), "job_description": F.md5("job_description")})


@query("src_documents", "SELECT md5(coalesce(text, '')) AS text, count(*) AS files FROM documents GROUP BY 1")
def src_documents(spark, sf):
    """One text file per document in folders per language, read back whole. Tasks move their own files in place, not the driver one by one."""
    root = scratch_path(spark, "docs")
    view(spark, sf, "documents").select("lang", F.coalesce("text", F.lit("")).alias("text")).write.partitionBy("lang") \
        .option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(root)
    read = io.read_documents(spark, root)
    return read.groupBy(F.md5(F.regexp_replace("text", "\n$", "")).alias("text")).agg(F.count("*").alias("files"))


def _log(spark, sf):
    return view(spark, sf, "v_usage_log").select(
        F.to_timestamp("ts").alias("ts"), "purpose", F.lit("offline").alias("provider"), "model", "ok", "prompt_chars", "output_chars",
        "seconds", F.lit(True).alias("pii_masked"))


def _log_files(spark, sf):
    """Four files, or one for each split of a larger table, so a file does not grow with the log."""
    path = scratch_path(spark, "log")
    log = _log(spark, sf)
    log.repartition(max(4, log.rdd.getNumPartitions())).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return path


LOG_SQL = oracle_with("v_usage_log")


@query("src_jsonl_log", LOG_SQL + " SELECT ts, purpose, 'offline' AS provider, model, ok, prompt_chars, output_chars, seconds, true AS pii_masked FROM v_usage_log")
def src_jsonl_log(spark, sf):
    return io.read_usage_log(spark, _log_files(spark, sf))


@query("src_eval_json", oracle_with("v_question") + " SELECT question, CAST(expected_doc AS VARCHAR) AS expected_doc FROM v_question")
def src_eval_json(spark, sf):
    path = scratch_path(spark, "questions")
    body = F.to_json(F.struct("question", F.col("expected_doc").cast("string").alias("expected_doc")))
    v = view(spark, sf, "v_question").select(F.floor(F.col("question_id") / 500).alias("part"), body.alias("b"))
    arrays = v.groupBy("part").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("b"), ",\n"), F.lit("\n]")).alias("value"))
    arrays.repartition("part").select("part", "value").write.partitionBy("part").text(path)
    # Each part folder may hold one JSON array; arrays are read item by item.
    return io.read_questions(spark, path).select("question", "expected_doc")


@query("src_interviewers", oracle_with("v_interviewer") + """
SELECT 'INT' || lpad(CAST(pool_ord AS VARCHAR), 6, '0') AS interviewer_id, name, primary_role, level, skills,
  CAST(interviews_this_week AS BIGINT) AS interviews_this_week, CAST(max_per_week AS BIGINT) AS max_per_week, data_source FROM v_interviewer""")
def src_interviewers(spark, sf):
    v = view(spark, sf, "v_interviewer")
    df = v.select(F.concat(F.lit("INT"), F.lpad(F.col("pool_ord").cast("string"), 6, "0")).alias("interviewer_id"), "name", "primary_role",
                  "level", "skills", "interviews_this_week", "max_per_week", "data_source")
    return io.read_interviewers(spark, _csv_copy(spark, sf, df))


@query("src_upload_resumes", oracle_with("v_candidate") + " SELECT CAST(candidate_id AS VARCHAR) AS id, resume FROM v_candidate")
def src_upload_resumes(spark, sf):
    df = view(spark, sf, "v_candidate").select(F.col("candidate_id").alias("ID "), F.col("resume").alias(" Resume"))
    return io.read_upload(spark, _csv_copy(spark, sf, df))


@query("sink_reports_csv", oracle_with("v_application") + """
SELECT CAST(job_id AS VARCHAR) AS job_id, CAST(round(avg(application_id / 7.0), 4) AS VARCHAR) AS score FROM v_application GROUP BY job_id""")
def sink_reports_csv(spark, sf):
    path = scratch_path(spark, "report")
    report = view(spark, sf, "v_application").groupBy("job_id").agg(F.avg(F.col("application_id") / 7.0).alias("score"))
    io.write_report_csv(report, path)
    return spark.read.option("header", True).csv(path)


@query("sink_reports_json", oracle_with("v_application") + " SELECT job_id, count(*) AS rows FROM v_application GROUP BY job_id")
def sink_reports_json(spark, sf):
    path = scratch_path(spark, "report")
    io.write_report_json(view(spark, sf, "v_application").groupBy("job_id").agg(F.count("*").alias("rows")), path)
    return spark.read.schema("job_id bigint, rows bigint").json(path)


from checks.q_text import BASE, MINE_ALL, full_vocabulary  # noqa: E402


@query("sink_vocab", MINE_ALL + f"SELECT DISTINCT s AS skill, 'saved' AS origin FROM (SELECT unnest({BASE}) AS s UNION ALL SELECT skill FROM mined) "
       f"UNION ALL SELECT unnest({BASE}), 'base'")
def sink_vocab(spark, sf):
    path = scratch_path(spark, "vocabulary")
    missing = io.load_vocabulary(spark, path).withColumn("origin", F.lit("base"))
    io.save_vocabulary(full_vocabulary(spark, sf), path)
    return io.load_vocabulary(spark, path).withColumn("origin", F.lit("saved")).unionByName(missing)


# --- loading ----------------------------------------------------------------------------------------------------


@query("load_screening", q.SCREENING + """
SELECT row_id, md5(resume) AS resume, md5(job_description) AS job_description, CAST(label AS BIGINT) AS label, job_role,
  CAST(sensitive_age AS BIGINT) AS sensitive_age FROM loaded""")
def load_screening(spark, sf):
    raw = io.normalise_columns(data.raw_screening(spark, sf))
    out = loading.load_screening(loading.standardise_screening(raw))
    return out.withColumns({"resume": F.md5("resume"), "job_description": F.md5("job_description")})


@query("clean_dedup_pairs", oracle_with("v_screening") + """
SELECT row_id, job_id FROM (SELECT *, row_number() OVER (PARTITION BY resume, job_description ORDER BY row_id) AS rn FROM v_screening) WHERE rn = 1""")
def clean_dedup_pairs(spark, sf):
    return loading.dedup_pairs(view(spark, sf, "v_screening")).select("row_id", "job_id")


CATEGORY = oracle_with("v_resume_category") + """,
cats AS (SELECT row_id, resume, category FROM (
  SELECT row_id, resume, trim(category) AS category, row_number() OVER (PARTITION BY resume, trim(category) ORDER BY row_id) AS rn
  FROM v_resume_category WHERE length(resume) > 50) WHERE rn = 1)
"""


def categories(spark, sf):
    return loading.load_resume_category(view(spark, sf, "v_resume_category"))


query("load_resume_category", CATEGORY + "SELECT row_id, md5(resume) AS resume, category FROM cats")(
    lambda spark, sf: categories(spark, sf).withColumn("resume", F.md5("resume")))


@query("label_binary", oracle_with("v_application") + """
SELECT application_id, CAST(CASE raw_label WHEN 'Hired' THEN 1 WHEN 'No' THEN 0 END AS BIGINT) AS by_word,
  CAST(CASE WHEN application_id % 3 > 0 THEN 1 ELSE 0 END AS BIGINT) AS by_number FROM v_application""")
def label_binary(spark, sf):
    number = F.when(F.col("application_id") % 2 == 0, F.col("application_id") % 3).when(F.col("application_id") % 3 > 0, 0.5)
    return view(spark, sf, "v_application").select(
        "application_id", loading.binary_label(F.col("raw_label"), False).alias("by_word"),
        loading.binary_label(number, True).alias("by_number"))


@query("sensitive_split", oracle_with("v_candidate") + " SELECT candidate_id, CAST(sensitive_age AS BIGINT) AS sensitive_age, false AS in_features FROM v_candidate")
def sensitive_split(spark, sf):
    raw = view(spark, sf, "v_candidate").select(F.col("candidate_id").alias("row_id"), "resume", F.col("resume").alias("jd"),
                                                F.lit("yes").alias("label"), F.col("sensitive_age").alias("age"))
    out = loading.standardise_screening(raw)
    used = models.assembler().getInputCols()
    return out.select(F.col("row_id").alias("candidate_id"), "sensitive_age", F.lit(any(c in used for c in out.columns if c.startswith("sensitive_"))).alias("in_features"))


@query("load_report", q.SCREENING + """
SELECT (SELECT count(*) FROM v_screening) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM v_screening) - count(*) AS rows_dropped,
  avg(label) AS positive_rate FROM loaded""")
def load_report(spark, sf):
    return loading.load_report(data.standard(spark, sf), data.loaded(spark, sf))


@query("filter_role", q.SCREENING + "SELECT row_id, job_role, n FROM loaded, (SELECT CAST(count(DISTINCT job_role) AS BIGINT) AS n FROM loaded) WHERE job_role = 'HR Manager'")
def filter_role(spark, sf):
    rows = data.loaded(spark, sf)
    return rows.where(F.col("job_role") == "HR Manager").select("row_id", "job_role", eda.role_list(rows).agg(F.count("*")).scalar().alias("n"))


query("filter_rare_classes", CATEGORY + "SELECT category FROM cats GROUP BY category HAVING count(*) >= 5")(
    lambda spark, sf: loading.frequent_classes(categories(spark, sf)))
query("join_class_semi", CATEGORY + "SELECT row_id, category FROM cats WHERE category IN (SELECT category FROM cats GROUP BY category HAVING count(*) >= 50)")(
    lambda spark, sf: loading.keep_frequent_classes(categories(spark, sf), at_least=50).select("row_id", "category"))


@query("sample_rows", oracle_with("v_application", "v_job") + """
SELECT application_id AS row_id, CAST(CASE raw_label WHEN 'Hired' THEN 1 WHEN 'No' THEN 0 END AS BIGINT) AS label, job_role
FROM v_application JOIN v_job USING (job_id) ORDER BY (application_id * 7919 + 42) % 100003, application_id LIMIT 3000""")
def sample_rows(spark, sf):
    return loading.sample_rows(data.standard(spark, sf).select("row_id", "label", "job_role"), 3000, "row_id")


KEY = "(row_id * 7919 + 42) % 100003, row_id"


@query("win_stratified_split", q.SCREENING + f"""
SELECT row_id, CAST(label AS BIGINT) AS label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {KEY})
  <= round(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split FROM loaded""")
def win_stratified_split(spark, sf):
    return loading.stratified_split(data.loaded(spark, sf).select("row_id", "label"), "label", "row_id")


@query("win_stratified_folds", q.SCREENING + f"""
SELECT row_id, CAST((row_number() OVER (PARTITION BY label ORDER BY {KEY}) - 1) % 5 AS BIGINT) AS fold FROM loaded""")
def win_stratified_folds(spark, sf):
    return loading.stratified_folds(data.loaded(spark, sf).select("row_id", "label"), "label", "row_id").select("row_id", "fold")


@query("join_pairs", oracle_with("v_screening") + " SELECT row_id, md5(resume) AS resume, md5(job_description) AS jd, job_role FROM v_screening")
def join_pairs(spark, sf):
    a = view(spark, sf, "v_application")
    j = a.join(view(spark, sf, "v_candidate"), "candidate_id").join(view(spark, sf, "v_job"), "job_id")
    return j.select(F.col("application_id").alias("row_id"), F.md5("resume").alias("resume"), F.md5("job_description").alias("jd"), "job_role")


@query("set_corpus_union", q.SCREENING + "SELECT md5(t) AS text, kind FROM (SELECT resume AS t, 'resume' AS kind FROM loaded UNION ALL SELECT job_description, 'jd' FROM loaded)")
def set_corpus_union(spark, sf):
    rows = data.loaded(spark, sf)
    return rows.select(F.md5("resume").alias("text"), F.lit("resume").alias("kind")).unionAll(
        rows.select(F.md5("job_description").alias("text"), F.lit("jd").alias("kind")))


# --- profile of the data set -----------------------------------------------------------------------------------------

W = lambda c: q.words(c)


@query("eda_summary", q.SCREENING + f""",
{CATEGORY.replace('WITH ', '', 1)}
SELECT count(*) AS rows, round(avg(label), 4) AS positive_rate, count(DISTINCT job_role) AS unique_roles,
  CAST(quantile_cont({W('resume')}, 0.5) AS DOUBLE) AS resume_words_median, CAST(quantile_cont({W('job_description')}, 0.5) AS DOUBLE) AS jd_words_median,
  (SELECT count(*) FROM cats) AS category_rows, (SELECT count(DISTINCT category) FROM cats) AS categories FROM loaded""")
def eda_summary(spark, sf):
    return eda.summary(data.loaded(spark, sf), categories(spark, sf))


query("eda_label_dist", q.SCREENING + "SELECT CASE label WHEN 0 THEN 'Not matched' ELSE 'Matched' END AS label_name, count(*) AS rows FROM loaded GROUP BY 1")(
    lambda spark, sf: eda.label_distribution(data.loaded(spark, sf)))
query("eda_top_roles", q.SCREENING + "SELECT job_role, count(*) AS rows FROM loaded GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")(
    lambda spark, sf: eda.top_values(data.loaded(spark, sf), "job_role", 15))


@query("eda_length_hist", oracle_with("v_corpus") + f""",
w AS (SELECT {W('text')} AS w FROM v_corpus), e AS (SELECT min(w)::DOUBLE AS lo, max(w)::DOUBLE AS hi FROM w),
b AS (SELECT least(floor((w - lo) / ((hi - lo) / 40)), 39) AS bin, count(*) AS n FROM w, e GROUP BY 1)
SELECT i AS bin, lo + i * ((hi - lo) / 40) AS bin_start, coalesce(n, 0) AS rows FROM (SELECT unnest(range(40)) AS i), e LEFT JOIN b ON b.bin = i""")
def eda_length_hist(spark, sf):
    return eda.length_histogram(view(spark, sf, "v_corpus"), "text")


@query("eda_top_skills", q.SCREENING + f"SELECT skill, count(*) AS rows FROM (SELECT unnest({q.skills('resume')}) AS skill FROM loaded) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def eda_top_skills(spark, sf):
    c = view(spark, sf, "v_candidate").select("candidate_id", extract_skills(F.col("resume"), K.BASE_SKILLS).alias("skills"))
    return eda.top_skills(data.loaded(spark, sf).select("candidate_id").join(c, "candidate_id"))


query("eda_category_counts", CATEGORY + "SELECT category, count(*) AS rows FROM cats GROUP BY 1")(
    lambda spark, sf: eda.top_values(categories(spark, sf), "category", None))
query("overview_metrics", q.SCREENING + "SELECT count(*) AS applications, count(DISTINCT job_role) AS job_roles, avg(label) AS match_rate FROM loaded")(
    lambda spark, sf: eda.overview(data.loaded(spark, sf)))
query("usage_rollup", LOG_SQL + """ SELECT purpose, model, ok, count(*) AS calls, CAST(sum(prompt_chars) AS BIGINT) AS prompt_chars,
  CAST(sum(output_chars) AS BIGINT) AS output_chars, round(avg(seconds), 6) AS avg_seconds, round(quantile_cont(seconds, 0.5), 6) AS median_seconds
  FROM v_usage_log GROUP BY ALL""")(lambda spark, sf: eda.usage_rollup(view(spark, sf, "v_usage_log")))
query("limit_tail", LOG_SQL + " SELECT event_id, ts, purpose FROM v_usage_log ORDER BY ts DESC, event_id DESC LIMIT 50")(
    lambda spark, sf: eda.latest(view(spark, sf, "v_usage_log").select("event_id", "ts", "purpose"), tie="event_id"))

# --- metrics ---------------------------------------------------------------------------------------------------------

PRED = q.SCREENING + """,
pred AS (SELECT row_id, job_id, label, prob, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS predicted, sensitive_age, sensitive_segment
  FROM (SELECT *, ((row_id * 7919 + 42) % 1009) / 1008.0::DOUBLE AS prob FROM loaded))
"""


@query("metric_binary", PRED + """,
c AS (SELECT sum(CASE WHEN label=1 AND predicted=1 THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN label=0 AND predicted=1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
  sum(CASE WHEN label=1 AND predicted=0 THEN 1 ELSE 0 END)::DOUBLE AS fn, avg(CASE WHEN label=predicted THEN 1.0 ELSE 0.0 END) AS acc FROM pred),
r AS (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS r FROM pred),
u AS (SELECT sum(CASE WHEN label=1 THEN r ELSE 0 END) AS rs, sum(label)::DOUBLE AS p, (count(*) - sum(label))::DOUBLE AS n FROM r)
SELECT round(acc, 9) AS accuracy, round(tp/(tp+fp), 9) AS precision, round(tp/(tp+fn), 9) AS recall, round(2*tp/(2*tp+fp+fn), 9) AS f1,
  round((rs - p*(p+1)/2) / (p*n), 9) AS roc_auc FROM c, u""")
def metric_binary(spark, sf):
    m = metrics.binary_metrics(data.predictions(spark, sf), "label", "predicted", "prob")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("metric_roc_curve", PRED + """,
d AS (SELECT prob, sum(label) AS pos, count(*) - sum(label) AS neg FROM pred GROUP BY prob)
SELECT prob AS threshold, (sum(neg) OVER (ORDER BY prob DESC))::DOUBLE / (sum(neg) OVER ())::DOUBLE AS fpr,
  (sum(pos) OVER (ORDER BY prob DESC))::DOUBLE / (sum(pos) OVER ())::DOUBLE AS tpr FROM d""")
def metric_roc_curve(spark, sf):
    return metrics.roc_points(data.predictions(spark, sf), "label", "prob")


query("metric_confusion", PRED + "SELECT CAST(label AS BIGINT) AS label, CAST(predicted AS BIGINT) AS predicted, count(*) AS rows FROM pred GROUP BY ALL")(
    lambda spark, sf: metrics.confusion(data.predictions(spark, sf), "label", "predicted"))
query("ml_threshold", PRED + "SELECT row_id, prob, CAST(CASE WHEN prob >= 0.25 THEN 1 ELSE 0 END AS BIGINT) AS shortlisted FROM pred")(
    lambda spark, sf: data.predictions(spark, sf).select("row_id", "prob", metrics.thresholded(F.col("prob"), 0.25).alias("shortlisted")))
query("ml_class_weights", q.SCREENING + "SELECT CAST(label AS BIGINT) AS label, t / (k * count(*))::DOUBLE AS weight FROM loaded, "
      "(SELECT count(*)::DOUBLE AS t, count(DISTINCT label) AS k FROM loaded) GROUP BY label, t, k")(
    lambda spark, sf: models.class_weights(data.loaded(spark, sf)))

MULTI = CATEGORY + """,
m AS (SELECT category AS y, CASE WHEN row_id % 3 = 0 THEN category ELSE 'src' || CAST(row_id % 7 AS VARCHAR) END AS p FROM cats),
k AS (SELECT y AS class FROM m UNION SELECT p FROM m),
s AS (SELECT class, (SELECT count(*) FROM m WHERE y = class AND p = class)::DOUBLE AS tp, (SELECT count(*) FROM m WHERE p = class)::DOUBLE AS np,
  (SELECT count(*) FROM m WHERE y = class)::DOUBLE AS ny FROM k),
f AS (SELECT class, coalesce(tp / nullif(np, 0), 0.0) AS precision, coalesce(tp / nullif(ny, 0), 0.0) AS recall,
  coalesce(2 * tp / nullif(np + ny, 0), 0.0) AS f1, ny, tp FROM s)
"""


def _multi(spark, sf):
    p = F.when(F.col("row_id") % 3 == 0, F.col("category")).otherwise(F.concat(F.lit("src"), (F.col("row_id") % 7).cast("string")))
    return categories(spark, sf).select(F.col("category").alias("y"), p.alias("p"))


@query("metric_multiclass", MULTI + "SELECT round(sum(tp) / sum(ny), 9) AS accuracy, round(avg(f1), 9) AS macro_f1, round(sum(f1 * ny) / sum(ny), 9) AS weighted_f1 FROM f")
def metric_multiclass(spark, sf):
    m = metrics.multiclass_metrics(_multi(spark, sf), "y", "p")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("metric_class_report", MULTI + """, r AS (SELECT class, precision, recall, f1, ny FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(ny) FROM f
UNION ALL SELECT 'weighted avg', sum(precision*ny)/sum(ny), sum(recall*ny)/sum(ny), sum(f1*ny)/sum(ny), sum(ny) FROM f
UNION ALL SELECT 'accuracy', sum(tp)/sum(ny), sum(tp)/sum(ny), sum(tp)/sum(ny), sum(ny) FROM f)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(ny AS BIGINT) AS support FROM r""")
def metric_class_report(spark, sf):
    r = metrics.class_report(_multi(spark, sf), "y", "p")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


RATES = PRED + """,
long AS (SELECT 'age' AS attr, CASE WHEN sensitive_age > 0 AND sensitive_age <= 25 THEN '<25' WHEN sensitive_age > 25 AND sensitive_age <= 35 THEN '25-34'
    WHEN sensitive_age > 35 AND sensitive_age <= 45 THEN '35-44' WHEN sensitive_age > 45 AND sensitive_age <= 120 THEN '45+' ELSE 'nan' END AS grp, predicted FROM pred
  UNION ALL SELECT 'segment', coalesce(sensitive_segment, 'nan'), predicted FROM pred),
rates AS (SELECT attr, grp, avg(predicted) AS rate, count(*) AS n FROM long GROUP BY ALL HAVING count(*) >= 20)
"""


@query("fairness_audit", RATES + """, a AS (SELECT attr, min(rate) AS lo, max(rate) AS hi FROM rates GROUP BY attr HAVING count(*) >= 2)
SELECT r.attr, r.grp, round(r.rate, 3) AS selection_rate, r.n AS group_size, round(lo / hi, 3) AS disparate_impact_ratio, lo / hi >= 0.8 AS passes_four_fifths_rule
FROM rates r JOIN a ON a.attr = r.attr""")
def fairness_audit(spark, sf):
    rates = fairness.group_rates(data.predictions(spark, sf), "predicted")
    out = rates.join(fairness.audit(rates), "attr")
    return out.withColumn("selection_rate", F.round("selection_rate", 3))


@query("fairness_age_bins", oracle_with("v_candidate") + """
SELECT grp, count(*) AS rows FROM (SELECT CASE WHEN a > 0 AND a <= 25 THEN '<25' WHEN a > 25 AND a <= 35 THEN '25-34' WHEN a > 35 AND a <= 45 THEN '35-44'
  WHEN a > 45 AND a <= 120 THEN '45+' ELSE 'nan' END AS grp FROM (SELECT CASE WHEN candidate_id % 10 = 0 THEN NULL WHEN candidate_id % 10 = 1 THEN 0 - sensitive_age ELSE sensitive_age END AS a FROM v_candidate)) GROUP BY grp""")
def fairness_age_bins(spark, sf):
    a = F.when(F.col("candidate_id") % 10 == 0, None).when(F.col("candidate_id") % 10 == 1, -F.col("sensitive_age")).otherwise(F.col("sensitive_age"))
    return view(spark, sf, "v_candidate").groupBy(fairness.age_group(a).alias("grp")).agg(F.count("*").alias("rows"))
