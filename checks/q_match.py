"""Matching: TF-IDF, features, scores, ranking, panels and generated texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data, sqlkit as q
from checks.registry import query
from rostra import constants as K
from rostra.functions import text as tx
from rostra.functions.numbers import round_exact
from rostra.functions.skills import extract_skills, join_sorted
from rostra.operators import eda, generation, metrics, panel, profiles, scoring, skew, tfidf
from rostra.plans import screening
from rostra.sources.fixtures import recipes, view

ARR = lambda c: q.joined(c)

query("set_skill_match", q.FACTS + f"""SELECT application_id, {ARR('hit')} AS matched, {ARR('miss')} AS missing,
  CAST(len(list_distinct(list_concat(skills, jd_skills))) AS BIGINT) AS union_size FROM matched""")(
    lambda spark, sf: data.matched(spark, sf).select(
        "application_id", F.col("matched_skills").alias("matched"), F.col("missing_skills").alias("missing"),
        F.size(F.array_union("skills", "jd_skills")).alias("union_size")))


@query("join_skill_anti", q.FACTS + """SELECT a.application_id, x.skill FROM v_application a
JOIN (SELECT job_id, unnest(jd_skills) AS skill FROM job) x ON x.job_id = a.job_id JOIN cand c ON c.candidate_id = a.candidate_id
WHERE NOT list_contains(c.skills, x.skill)""")
def join_skill_anti(spark, sf):
    a = view(spark, sf, "v_application").select("application_id", "candidate_id", "job_id")
    j = view(spark, sf, "v_job").select("job_id", F.explode(extract_skills(F.col("job_description"), K.BASE_SKILLS)).alias("skill"))
    c = view(spark, sf, "v_candidate").select("candidate_id", F.explode(extract_skills(F.col("resume"), K.BASE_SKILLS)).alias("skill"))
    return a.join(j, "job_id").join(c, ["candidate_id", "skill"], "left_anti").select("application_id", "skill")


@query("tfidf_pairwise_fallback", q.FACTS + "SELECT application_id, round(sim, 9) AS similarity FROM matched")
def tfidf_pairwise_fallback(spark, sf):
    return data.matched(spark, sf).select("application_id", F.round("similarity", 9).alias("similarity"))


query("score_rule", q.FACTS + "SELECT application_id, round(coverage, 9) AS coverage, edu_fit, round(exp_fit, 9) AS exp_fit, round(rule, 6) AS rule_score FROM rules")(
    lambda spark, sf: data.matched(spark, sf).select(
        "application_id", F.round("skill_coverage", 9).alias("coverage"), F.col("education_fit").alias("edu_fit"),
        F.round("experience_fit", 9).alias("exp_fit"), F.round("rule_score", 6).alias("rule_score")))
query("score_breakdown", q.FACTS + f"""SELECT application_id, {q.round_exact('100 * 0.45::DOUBLE * coverage', 1)} AS skill_points,
  {q.round_exact('100 * 0.30::DOUBLE * sem', 1)} AS semantic_points, {q.round_exact('100 * 0.10::DOUBLE * edu_fit', 1)} AS education_points,
  {q.round_exact('100 * 0.15::DOUBLE * exp_fit', 1)} AS experience_points FROM rules""")(
    lambda spark, sf: data.matched(spark, sf).select("application_id", scoring.score_breakdown().alias("b")).select("application_id", "b.*"))

PROB = "((application_id * 7919 + 42) % 1009) / 1008.0::DOUBLE"
FINAL = f"CASE WHEN application_id % 3 = 0 THEN rule ELSE 0.6::DOUBLE * ({PROB}) * 100 + 0.4::DOUBLE * rule END"


def _with_probability(spark, sf):
    """Two applications in three have a model probability."""
    p = F.pmod(F.col("application_id") * 7919 + 42, F.lit(1009)) / F.lit(1008.0)
    return scoring.add_decision(data.matched(spark, sf), F.when(F.col("application_id") % 3 != 0, p))


query("score_final", q.FACTS + f"SELECT application_id, round(f, 1) AS final_score FROM (SELECT application_id, {FINAL} AS f FROM rules)")(
    lambda spark, sf: _with_probability(spark, sf).select("application_id", "final_score"))
query("decide", q.FACTS + f"""SELECT application_id, CASE WHEN f >= 65 THEN 'Shortlist' WHEN f >= 45 THEN 'Hold' ELSE 'Reject' END AS decision,
  CASE WHEN f >= 65 THEN 'strong overall fit with the job requirements' WHEN f >= 45 AND len(miss) > 0 THEN 'partial fit; verify ' || array_to_string(miss[1:2], ', ')
  WHEN f >= 45 THEN 'partial fit; verify depth of experience' ELSE 'low alignment with the core requirements' END AS reason
  FROM (SELECT *, {FINAL} AS f FROM rules)""")(
    lambda spark, sf: _with_probability(spark, sf).select("application_id", "decision", "reason"))
query("decision_counts", q.FACTS + "SELECT decision, count(*) AS rows FROM scored GROUP BY 1")(
    lambda spark, sf: scoring.add_decision(data.matched(spark, sf)).groupBy("decision").agg(F.count("*").alias("rows")))
query("topk_skills_preview", q.FACTS + "SELECT application_id, coalesce(array_to_string(hit[1:6], ', '), '') AS matched, coalesce(array_to_string(miss[1:6], ', '), '') AS missing, resume[1:160] AS preview FROM matched")(
    lambda spark, sf: data.matched(spark, sf).select(
        "application_id", join_sorted(F.col("matched_skills"), 6).alias("matched"), join_sorted(F.col("missing_skills"), 6).alias("missing"),
        F.col("resume_preview").alias("preview")))

RANK = """row_number() OVER (PARTITION BY job_id ORDER BY rule1 DESC, application_id)"""


def _rank(spark, sf):
    return screening.rank_candidates(view(spark, sf, "v_application"), view(spark, sf, "v_candidate"), view(spark, sf, "v_job"))


query("rank_candidates", q.FACTS + f"""SELECT application_id, job_id, candidate_id, rule1 AS final_score, rule1 AS match_score, CAST(NULL AS DOUBLE) AS ml_probability,
  decision, coalesce(array_to_string(hit[1:6], ', '), '') AS matched_skills, coalesce(array_to_string(miss[1:6], ', '), '') AS missing_skills,
  yrs AS experience_years, {q.education_name('edu')} AS education, resume[1:160] AS resume_preview, {RANK} AS rank FROM scored""")(_rank)
query("win_rank_candidates", q.FACTS + f"SELECT application_id, job_id, {RANK} AS rank FROM scored")(
    lambda spark, sf: screening.rank_by_job(screening.ranking_rows(scoring.add_decision(data.matched(spark, sf))).select("application_id", "job_id", "final_score")).select("application_id", "job_id", "rank"))


@query("join_one_to_many", q.FACTS.replace("pairs AS (SELECT DISTINCT candidate_id, job_id FROM v_application)",
       "pairs AS (SELECT candidate_id, 0::BIGINT AS job_id FROM v_candidate)") + """
SELECT c.candidate_id, round(s.sim, 9) AS similarity, CAST(len(list_filter(j.jd_skills, lambda x: list_contains(c.skills, x))) AS BIGINT) AS matched
FROM cand c JOIN sims s ON s.candidate_id = c.candidate_id JOIN job j ON j.job_id = 0""")
def join_one_to_many(spark, sf):
    """Every resume against one job: the job's profile is a single row, read as a scalar."""
    job = profiles.job_facts(view(spark, sf, "v_job").where("job_id = 0"), K.BASE_SKILLS)
    one = job.select(F.struct("*").alias("j")).scalar()
    pairs = profiles.candidate_facts(view(spark, sf, "v_candidate"), K.BASE_SKILLS).withColumn("j", one)
    pairs = pairs.select("*", "j.*")
    return scoring.add_match(pairs.withColumn("similarity", tfidf.two_text_similarity("resume_terms", "resume_counts", "jd_terms", "jd_counts"))) \
        .select("candidate_id", F.round("similarity", 9).alias("similarity"), F.size("matched_skills").alias("matched"))


@query("join_labels_back", q.FACTS + f"""SELECT application_id, job_id, {RANK} AS rank,
  CAST(CASE raw_label WHEN 'Hired' THEN 1 WHEN 'No' THEN 0 END AS BIGINT) AS dataset_label FROM scored""")
def join_labels_back(spark, sf):
    labels = data.standard(spark, sf).select(F.col("row_id").alias("application_id"), F.col("label").alias("dataset_label"))
    return _rank(spark, sf).select("application_id", "job_id", "rank").join(labels, "application_id", "left")


@query("precision_top20", q.FACTS + """,
l AS (SELECT *, CASE raw_label WHEN 'Hired' THEN 1 ELSE 0 END AS label FROM scored WHERE raw_label IN ('Hired', 'No')),
r AS (SELECT job_id, label, row_number() OVER (PARTITION BY job_id ORDER BY rule1 DESC, application_id) AS rn, count(*) OVER (PARTITION BY job_id) AS n FROM l)
SELECT job_id, round(avg(CASE WHEN rn <= greatest(1, n // 5) THEN label END), 9) AS precision_top20, round(avg(label), 9) AS base_rate FROM r GROUP BY job_id""")
def precision_top20(spark, sf):
    scored = scoring.add_decision(data.matched(spark, sf)).select("application_id", "job_id", "final_score")
    labels = data.standard(spark, sf).where("label IS NOT NULL").select(F.col("row_id").alias("application_id"), "label")
    out = metrics.precision_at_top_fifth(scored.join(labels, "application_id"), "job_id", "label", [F.desc("final_score"), F.col("application_id")])
    return out.select("job_id", F.round("precision_top20", 9).alias("precision_top20"), F.round("base_rate", 9).alias("base_rate"))


# --- fitted TF-IDF and the feature table ---------------------------------------------------------------------------

GRAMS = f"""
texts AS (SELECT 'c' || CAST(candidate_id AS VARCHAR) AS d, candidate_id AS id, resume AS t FROM v_candidate
  UNION ALL SELECT 'j' || CAST(job_id AS VARCHAR), job_id, job_description FROM v_job),
grams AS (SELECT d, unnest({q.grams('s')}) AS term FROM (SELECT d, {q.tokens(q.clean('t'))} AS s FROM texts)),
tf AS MATERIALIZED (SELECT d, term, count(*) AS tf FROM grams GROUP BY ALL),
mult AS (SELECT 'c' || CAST(candidate_id AS VARCHAR) AS d, count(*) AS m FROM loaded GROUP BY 1
  UNION ALL SELECT 'j' || CAST(job_id AS VARCHAR), count(*) FROM loaded GROUP BY 1),
n AS (SELECT sum(m) AS n FROM mult),
vocab AS MATERIALIZED (SELECT term, df, cf, ln((1 + n) / (1 + df)) + 1 AS idf FROM (
  SELECT term, CAST(sum(m) AS BIGINT) AS df, CAST(sum(m * tf) AS BIGINT) AS cf FROM tf JOIN mult USING (d) GROUP BY term HAVING sum(m) >= 2 ORDER BY cf DESC, term LIMIT 30000), n),
w AS MATERIALIZED (SELECT d, term, (1 + ln(tf)) * idf AS w FROM tf JOIN mult USING (d) JOIN vocab USING (term)),
unit AS MATERIALIZED (SELECT d, term, w / sqrt(sum(w * w) OVER (PARTITION BY d)) AS w FROM w)
"""
TFIDF = q.SCREENING + "," + GRAMS


@query("tfidf_fit", TFIDF + "SELECT term, df, cf, round(idf, 9) AS idf FROM vocab")
def tfidf_fit(spark, sf):
    v, _, _ = data.fitted(data.slim_loaded(spark, sf), spark, sf)
    return v.withColumn("idf", F.round("idf", 9))


@query("tfidf_transform", TFIDF + "SELECT d, term, round(w, 9) AS weight FROM unit")
def tfidf_transform(spark, sf):
    v, c, j = data.fitted(data.slim_loaded(spark, sf), spark, sf)
    both = c.select(F.concat(F.lit("c"), F.col("candidate_id").cast("string")).alias("d"), "terms", "counts").unionByName(
        j.select(F.concat(F.lit("j"), F.col("job_id").cast("string")).alias("d"), "terms", "counts"))
    u = tfidf.transform(both, v, "d")
    return u.select("d", F.explode(F.arrays_zip("terms", "weights")).alias("e")).select(
        "d", F.col("e.terms").alias("term"), F.round("e.weights", 9).alias("weight"))


SIMS = """,
psim AS (SELECT p.candidate_id, p.job_id, sum(a.w * b.w) AS s FROM (SELECT DISTINCT candidate_id, job_id FROM loaded) p
  JOIN unit a ON a.d = 'c' || CAST(p.candidate_id AS VARCHAR) JOIN unit b ON b.d = 'j' || CAST(p.job_id AS VARCHAR) AND b.term = a.term GROUP BY ALL),
rsim AS (SELECT l.*, coalesce(s, 0.0) AS sim FROM loaded l LEFT JOIN psim USING (candidate_id, job_id))
"""


@query("tfidf_similarity", TFIDF + SIMS + "SELECT row_id, round(sim, 9) AS tfidf_similarity FROM rsim")
def tfidf_similarity(spark, sf):
    rows = data.slim_loaded(spark, sf)
    v, c, j = data.fitted(rows, spark, sf)
    out = tfidf.similarity(rows.select("row_id", "candidate_id", "job_id"), tfidf.transform(c, v, "candidate_id"),
                           tfidf.transform(j, v, "job_id"), "candidate_id", "job_id")
    return out.select("row_id", F.round("tfidf_similarity", 9).alias("tfidf_similarity"))


FEATS = TFIDF + SIMS + f""",
cf AS MATERIALIZED (SELECT candidate_id, {q.skills('resume')} AS rs, {q.education('resume')} AS edu, {q.years('resume')} AS yrs, {q.certifications('resume')} AS certs,
  {q.words('resume')} AS words, {q.clean('resume')} AS rc FROM v_candidate),
jf AS MATERIALIZED (SELECT job_id, {q.skills('job_description')} AS js, {q.education('job_description')} AS redu, {q.years('job_description')} AS ryrs,
  list_filter(string_split({q.clean('job_role')}, ' '), lambda w: length(w) > 2) AS ws FROM v_job),
o AS (SELECT r.row_id, r.label, r.sim, cf.*, jf.*, len(list_filter(js, lambda x: list_contains(rs, x)))::DOUBLE AS ov,
  len(list_distinct(list_concat(rs, js)))::DOUBLE AS un FROM rsim r JOIN cf USING (candidate_id) JOIN jf USING (job_id)),
feats AS (SELECT row_id, label, sim AS tfidf_similarity, ov AS skill_overlap, CASE WHEN len(js) > 0 THEN ov / len(js)::DOUBLE ELSE 0.0 END AS skill_coverage,
  CASE WHEN un > 0 THEN ov / un ELSE 0.0 END AS skill_jaccard, len(rs)::DOUBLE AS resume_skill_count, len(js)::DOUBLE AS jd_skill_count,
  edu::DOUBLE AS education_level, redu::DOUBLE AS required_education, (CASE WHEN edu >= 0 AND redu >= 0 THEN edu - redu ELSE 0 END)::DOUBLE AS education_gap,
  yrs AS experience_years, ryrs AS required_experience, yrs - ryrs AS experience_gap, certs::DOUBLE AS certifications, words::DOUBLE AS resume_word_count,
  CASE WHEN len(ws) = 0 THEN 0.0 ELSE len(list_filter(ws, lambda w: contains(rc, w)))::DOUBLE / len(ws)::DOUBLE END AS role_title_in_resume FROM o)
"""
# The rules with the similarity over the fitted vocabulary instead of the two texts', and a given probability.
_RULES = q.FACTS[q.FACTS.index(",\ncand AS"):].replace(
    "FROM v_application a JOIN cand c", "FROM (SELECT row_id AS application_id, candidate_id, job_id, NULL AS raw_label FROM loaded) a JOIN cand c").replace(
    "sims AS (SELECT candidate_id, job_id, ab / sqrt(aa * bb) AS sim FROM norms)", "sims AS (SELECT DISTINCT candidate_id, job_id, sim FROM rsim)")


@query("rank_candidates_model", TFIDF + SIMS + _RULES + f""", f AS (SELECT application_id, job_id, round(rule, 1) AS match_score, round({FINAL}, 1) AS final_score,
  CASE WHEN {FINAL} >= 65 THEN 'Shortlist' WHEN {FINAL} >= 45 THEN 'Hold' ELSE 'Reject' END AS decision FROM rules)
SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY final_score DESC, application_id) AS rank FROM f""")
def rank_candidates_model(spark, sf):
    """The ranking of a trained model: fitted similarity, and a probability for two applications in three."""
    rows = data.slim_loaded(spark, sf)
    vocabulary, _, _ = data.fitted(rows, spark, sf)
    p = F.pmod(F.col("row_id") * 7919 + 42, F.lit(1009)) / F.lit(1008.0)
    a = rows.select(F.col("row_id").alias("application_id"), "candidate_id", "job_id", F.when(F.col("row_id") % 3 != 0, p).alias("probability"))
    ranked = screening.rank_candidates(a, view(spark, sf, "v_candidate"), view(spark, sf, "v_job"), probability="probability", fitted=vocabulary)
    return ranked.select("application_id", "job_id", "match_score", "final_score", "decision", "rank")


ROUNDED = ["tfidf_similarity", "skill_coverage", "skill_jaccard", "role_title_in_resume"]


def feature_rows(spark, sf, keep=("label",)):
    return data.feature_table(data.slim_loaded(spark, sf), spark, sf, list(keep))


@query("features_pair", FEATS + "SELECT row_id, " + ", ".join(f"round({f}, 9) AS {f}" if f in ROUNDED else f for f in K.FEATURE_NAMES) + " FROM feats")
def features_pair(spark, sf):
    t = feature_rows(spark, sf)
    return t.select("row_id", *[F.round(f, 9).alias(f) if f in ROUNDED else F.col(f) for f in K.FEATURE_NAMES])


QUART = "".join(f"""{' UNION ALL ' if i else ''}SELECT '{c}' AS feature, label, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM feats GROUP BY label"""
                for i, c in enumerate(["tfidf_similarity", "skill_coverage"]))


@query("eda_box_stats", FEATS + f""", qs AS ({QUART}), v AS (SELECT 'tfidf_similarity' AS feature, label, tfidf_similarity AS x FROM feats
  UNION ALL SELECT 'skill_coverage', label, skill_coverage FROM feats)
SELECT feature, CAST(label AS BIGINT) AS label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low, round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high
FROM v JOIN qs USING (feature, label) GROUP BY feature, label, q1, median, q3""")
def eda_box_stats(spark, sf):
    t = feature_rows(spark, sf).select("label", "tfidf_similarity", "skill_coverage")
    both = eda.box_stats(t, "tfidf_similarity").unionByName(eda.box_stats(t, "skill_coverage"))
    return both.select("feature", "label", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@query("eda_feature_corr", FEATS + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round((SELECT CASE WHEN max({f}) > min({f}) THEN corr({f}, label) END FROM feats), 3) AS correlation" for f in K.FEATURE_NAMES))
def eda_feature_corr(spark, sf):
    return eda.feature_correlation(feature_rows(spark, sf))


# --- panels ------------------------------------------------------------------------------------------------------------

TARGET = (q.FACTS + """,
req AS (SELECT application_id, lower(job_role) AS role, list_sort(list_distinct(list_concat(jd_skills, skills))) AS target,
  CASE WHEN yrs < 3 THEN 1 WHEN yrs < 6 THEN 2 ELSE 3 END AS need FROM matched),
iv AS (SELECT *, interviews_this_week::DOUBLE / greatest(max_per_week, 1)::DOUBLE AS load,
  list_sort(list_distinct(list_transform(string_split(skills, ';'), lambda s: trim(s)))) AS ivs FROM v_interviewer),
free AS (SELECT * FROM iv WHERE load < 1),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM (SELECT DISTINCT role, target, need FROM req)),
sc AS MATERIALIZED (SELECT rid, pool_ord, level, load, list_sort(list_filter(ivs, lambda s: list_contains(target, s))) AS ov, role <> '' AND role = lower(primary_role) AS same,
  0.45::DOUBLE * least(1.0::DOUBLE, 3.0::DOUBLE * len(list_filter(ivs, lambda s: list_contains(target, s)))::DOUBLE / greatest(len(target), 1)::DOUBLE)
  + 0.30::DOUBLE * CASE WHEN role <> '' AND role = lower(primary_role) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  + 0.15::DOUBLE * CASE WHEN CASE level WHEN 'Senior' THEN 2 WHEN 'Lead' THEN 3 WHEN 'Manager' THEN 4 WHEN 'Director' THEN 5 ELSE 1 END >= need THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END
  + 0.10::DOUBLE * (1 - load) AS score FROM d, free)
""").replace("cand AS (", f"v_interviewer AS ({recipes(False)['v_interviewer']}),\ncand AS (", 1)
REASON = """(SELECT upper(r[1]) || lower(r[2:]) FROM (SELECT array_to_string(list_filter([CASE WHEN same THEN 'works in the same role' END,
  CASE WHEN len(ov) > 0 THEN 'can assess ' || array_to_string(ov[1:3], ', ') END, lower(level) || ' level', CASE WHEN load < 0.5 THEN 'has availability' END],
  lambda s: s IS NOT NULL), '; ') AS r))"""
PICKS = TARGET + """,
pool AS (SELECT count(*) AS n FROM free),
p1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, pool_ord) AS rn FROM sc) WHERE rn = 1),
s2 AS (SELECT s.*, p.ov AS cov, [p.level] AS lv, p.pool_ord AS first FROM sc s JOIN p1 p USING (rid), pool WHERE s.pool_ord <> p.pool_ord
  AND NOT (len(list_filter(s.ov, lambda x: NOT list_contains(p.ov, x))) = 0 AND s.level = p.level AND pool.n > 6)),
p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, pool_ord) AS rn FROM s2) WHERE rn = 1),
s3 AS (SELECT s.* FROM sc s JOIN p2 p USING (rid), pool WHERE s.pool_ord <> p.pool_ord AND s.pool_ord <> p.first
  AND (s.score < p.score OR (s.score = p.score AND s.pool_ord > p.pool_ord))
  AND NOT (len(list_filter(s.ov, lambda x: NOT list_contains(list_concat(p.cov, p.ov), x))) = 0 AND list_contains(list_append(p.lv, p.level), s.level) AND pool.n > 6)),
p3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, pool_ord) AS rn FROM s3) WHERE rn = 1),
picks AS (SELECT rid, pool_ord, level, load, ov, same, score, 1 AS pick_no FROM p1 UNION ALL SELECT rid, pool_ord, level, load, ov, same, score, 2 FROM p2
  UNION ALL SELECT rid, pool_ord, level, load, ov, same, score, 3 FROM p3),
panels AS (SELECT r.application_id, k.*, i.name, i.primary_role, i.interviews_this_week, i.max_per_week, i.data_source FROM req r
  JOIN d ON d.role = r.role AND d.target = r.target AND d.need = r.need JOIN picks k ON k.rid = d.rid JOIN iv i ON i.pool_ord = k.pool_ord)
"""

query("set_target_skills", TARGET + f"SELECT application_id, {ARR('target')} AS target FROM req")(
    lambda spark, sf: data.matched(spark, sf).select("application_id", F.array_sort(F.array_union("jd_skills", "skills")).alias("target")))


@query("panel_score", TARGET + """SELECT role, array_to_string(target, '|') AS target, CAST(need AS BIGINT) AS need, slot, pool_ord, array_to_string(ov, '|') AS overlap, round(score, 9) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY rid, slot ORDER BY score DESC, pool_ord) AS rn FROM (SELECT *, unnest(list_append(list_transform(ov, lambda s: 'skill ' || s), 'level ' || level)) AS slot FROM sc))
  JOIN d USING (rid) WHERE rn = 1""")
def panel_score(spark, sf):
    """Every score a panel can turn on: per request the best person of each level and for each skill of its target."""
    lists = panel.short_lists(panel.requests_of(data.matched(spark, sf)), view(spark, sf, "v_interviewer"))
    people = lists.select("request", F.col("role_key").alias("role"), F.array_join("target", "|").alias("target"), F.col("need").cast("bigint").alias("need"), F.explode("people").alias("p"))
    slots = F.array_append(F.transform("p.overlap", lambda s: F.concat(F.lit("skill "), s)), F.concat(F.lit("level "), "p.level"))
    best = people.select("request", "role", "target", "need", F.explode(slots).alias("slot"), "p").groupBy("request", "role", "target", "need", "slot").agg(F.max("p").alias("p"))
    return best.select("role", "target", "need", "slot", (-F.col("p.turn")).alias("pool_ord"), F.array_join("p.overlap", "|").alias("overlap"), F.round("p.score", 9).alias("score"))


@query("join_panel", TARGET + """SELECT r.role, array_to_string(r.target, '|') AS target, s.pool_ord, array_to_string(s.ov, '|') AS overlap, CAST(r.need AS BIGINT) AS need, round(max(s.score), 9) AS score FROM sc s JOIN d r USING (rid)
  WHERE len(s.ov) > 0 GROUP BY ALL""")
def join_panel(spark, sf):
    """Every request with all available interviewers who share a skill with it, and their scores."""
    people = panel.available(view(spark, sf, "v_interviewer")).withColumn("iv_role", F.lower("primary_role"))
    req = panel.requests_of(data.matched(spark, sf)).withColumn("request", F.sha2(F.to_json(F.struct("role_key", "target", "need")), 256))
    asked = req.select("request", F.explode("target").alias("skill"))
    holders = people.select("pool_ord", F.explode("iv_skills").alias("skill")).join(asked.groupBy("skill").agg(F.count("*").alias("asked")), "skill")
    met = skew.spread_join(asked, holders, "skill", "request", "asked").groupBy("request", "pool_ord").agg(F.array_sort(F.collect_set("skill")).alias("overlap"))
    j = met.join(req, "request").join(people, "pool_ord")
    same = (F.col("role_key") != "") & (F.col("role_key") == F.col("iv_role"))
    return j.select(F.col("role_key").alias("role"), "target", "pool_ord", "overlap", "need", F.round(panel.panel_score(
        F.size("overlap"), F.size("target"), same, F.col("level"), F.col("need"), F.col("load")), 9).alias("score"))


def panels(spark, sf):
    return panel.select_panels(data.matched(spark, sf), view(spark, sf, "v_interviewer"))


query("panel_select", PICKS + f"""SELECT application_id, CAST(pick_no AS BIGINT) AS pick_no, pool_ord, name, level, primary_role, {q.round_exact('score', 3)} AS score,
  {ARR('ov')} AS covers_skills, CAST(interviews_this_week AS VARCHAR) || '/' || CAST(max_per_week AS VARCHAR) || ' this week' AS workload, data_source FROM panels""")(
    lambda spark, sf: panels(spark, sf).drop("reason"))
query("panel_reason", PICKS + f"SELECT application_id, pool_ord, {REASON} AS reason FROM panels")(
    lambda spark, sf: panels(spark, sf).select("application_id", "pool_ord", "reason"))

# --- generated texts -------------------------------------------------------------------------------------------------

NUM = q.short_number
SUMMARY = f"""array_to_string(list_filter(list_concat(list_concat(list_concat(
  ['**Profile**', 'Candidate with about ' || {NUM('yrs')} || ' years of experience (education: ' || {q.education_name('edu')} || ') and ' || CAST(len(skills) AS VARCHAR) || ' identifiable skills.', '', '**Strengths for this role**'],
  CASE WHEN len(hit) > 0 THEN list_transform(hit[1:5], lambda s: '- Demonstrates ' || s) ELSE ['- No direct skill overlap detected'] END),
  ['- Semantic similarity to the JD: ' || CAST(CAST(round_even(sim * 100, 0) AS BIGINT) AS VARCHAR) || '%', '', '**Gaps or risks to verify**']),
  list_concat(CASE WHEN len(miss) > 0 THEN list_transform(miss[1:4], lambda s: '- No evidence of ' || s) ELSE ['- No major skill gaps detected'] END,
  [CASE WHEN gap < 0 THEN '- Experience is about ' || {NUM('abs(gap)')} || ' years below the stated requirement' END, '', '**Recommendation:** ' || decision || ' - ' || reason])),
  lambda s: s IS NOT NULL), chr(10))"""


def _scored(spark, sf):
    return scoring.add_decision(data.matched(spark, sf))


query("gen_summary_template", q.FACTS + f"SELECT application_id, {SUMMARY} AS summary FROM scored")(
    lambda spark, sf: _scored(spark, sf).select("application_id", generation.summary_text().alias("summary")))


def _sq(cat, question, look):
    return f"{{'category': {q.lit(cat)}, 'question': {question}, 'look': {look}}}"


def _fmt(template, name, value):
    parts = template.split("{" + name + "}")
    return " || ".join(x for i, p in enumerate(parts) for x in ([value] if i else []) + [q.lit(p)])


QS = (f"list_concat(list_concat(list_transform(hit[1:3], lambda s: {_sq('Technical', _fmt(K.TECHNICAL_QUESTION, 's', 's'), _fmt(K.TECHNICAL_LOOK_FOR, 's', 's'))}), "
      f"list_transform(miss[1:2], lambda s: {_sq('Gap probing', _fmt(K.GAP_QUESTION, 's', 's'), q.lit(K.GAP_LOOK_FOR))})), ["
      + ", ".join(_sq(c, _fmt(t, "role", "job_role"), q.lit(w)) for c, t, w in K.STANDARD_QUESTIONS) + "])[1:8]")
query("gen_questions_template", q.FACTS + f"""SELECT application_id, unnest(range(1, len(l) + 1)) AS q_no, unnest(l).category AS category, unnest(l).question AS question,
  unnest(l).look AS what_to_look_for FROM (SELECT application_id, {QS} AS l FROM scored)""")(
    lambda spark, sf: generation.question_rows(_scored(spark, sf)))


def _sqlfill(template, **values):
    import re
    parts = []
    for piece in re.split(r"(?<!\{)(\{[a-z_]+\})(?!\})", template):
        if re.fullmatch(r"\{[a-z_]+\}", piece):
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append(q.lit(piece.replace("{{", "{").replace("}}", "}")))
    return " || ".join(parts)


LISTED = lambda c: f"CASE WHEN len({c}) > 0 THEN array_to_string({c}, ', ') ELSE 'none' END"
SUM_PROMPT = q.mask("(" + _sqlfill(K.SUMMARY_USER, role="job_role", jd="job_description", resume="resume", match_score="CAST(rule1 AS VARCHAR)", prob="'n/a'",
                                   matched=f"({LISTED('hit')})", missing=f"({LISTED('miss')})") + ")")
QUE_PROMPT = q.mask("(" + _sqlfill(K.QUESTIONS_USER, role="job_role", jd="job_description", matched=f"({LISTED('hit')})", missing=f"({LISTED('miss')})",
                                   exp="CAST(yrs AS VARCHAR)", n="'8'") + ")")


@query("llm_prompt_table", q.FACTS + f"""SELECT application_id, 'candidate_summary' AS purpose, {q.lit(K.SUMMARY_SYSTEM)} AS system, {SUM_PROMPT} AS "user" FROM scored
UNION ALL SELECT application_id, 'interview_questions', {q.lit(K.QUESTIONS_SYSTEM)}, {QUE_PROMPT} FROM scored""")
def llm_prompt_table(spark, sf):
    texts = _scored(spark, sf).join(view(spark, sf, "v_candidate").select("candidate_id", "resume"), "candidate_id") \
        .join(view(spark, sf, "v_job").select("job_id", "job_description"), "job_id")
    return generation.application_prompts(texts)


@query("llm_parse_json", """
WITH r AS (SELECT conv_id, turn, text, (conv_id + turn) % 5 AS kind FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, kind <> 4 AS parsed, CASE WHEN kind IN (0, 1) THEN 2::BIGINT END AS items, CASE WHEN kind IN (0, 1) THEN text END AS first_question FROM r""")
def llm_parse_json(spark, sf):
    """Assistant turns dressed as replies: fenced list, list inside talk, object, broken list, plain talk."""
    r = view(spark, sf, "conversations").where("role = 'assistant'").withColumn("kind", (F.col("conv_id") + F.col("turn")) % 5)
    item = F.to_json(F.struct(F.lit("Technical").alias("category"), F.col("text").alias("question"), F.lit("detail").alias("what_to_look_for")))
    two = F.concat(F.lit("["), item, F.lit(", "), item, F.lit("]"))
    reply = (F.when(F.col("kind") == 0, F.concat(F.lit("```json\n"), two, F.lit("\n```")))
             .when(F.col("kind") == 1, F.concat(F.lit("Here you are: "), two, F.lit(" Good luck.")))
             .when(F.col("kind") == 2, F.concat(F.lit("```"), item, F.lit("```")))
             .when(F.col("kind") == 3, F.concat(F.lit("["), item, F.lit(", {\"category\": ]")))
             .otherwise(F.translate("text", "[]{}", "")))
    parsed = r.select("conv_id", "turn", generation.reply_json(reply).alias("json"))
    qs = parsed.withColumn("qs", generation.reply_questions(F.col("json")))
    return qs.select("conv_id", "turn", F.col("json").isNotNull().alias("parsed"), F.array_size("qs").alias("items"),
                     F.get("qs.question", F.lit(0)).alias("first_question"))
