"""Pieces of SQL that the oracle texts are built from."""

from __future__ import annotations

import re

from rostra import constants as K
from rostra.functions.text import WS, WS_CHARS
from rostra.sources.fixtures import oracle_with

RARE = "1.4054651081081644"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in sorted(set(K.STOP_WORDS))) + "]"


def rep(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(x: str) -> str:
    return f"trim({x}, {lit(WS_CHARS)})"


def clean(x: str) -> str:
    x = rep(f"lower({x})", rf"https?://[^{WS}]+|www\.[^{WS}]+", " ")
    x = rep(x, rf"[^{WS}]+@[^{WS}]+", " ")
    return f"trim({rep(x, '[^a-z0-9+#./-]+', ' ')})"


def mask(x: str) -> str:
    w = r"\p{L}\p{N}_"
    x = rep(x, rf"[{w}.+-]+@[{w}-]+\.[{w}.]+", "[EMAIL]")
    x = rep(x, rf"(\+?\p{{Nd}}[\p{{Nd}}{WS}().-]{{8,}}\p{{Nd}})", "[PHONE]")
    return rep(x, rf"https?://[^{WS}]+|www\.[^{WS}]+", "[URL]")


def low(x: str) -> str:
    """Lower case with letters beyond ASCII as z and other such characters as blanks, so that \\b works on ASCII."""
    return rep(rep(f"lower({x})", r"[^\x00-\x7f\p{L}\p{N}]", " "), r"[^\x00-\x7f]", "z")


def education(x: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({low(x)}, {lit(p)}) THEN {v}" for v, p in K.EDUCATION_PATTERNS)
    return f"CAST(CASE {arms} ELSE -1 END AS BIGINT)"


def education_name(level: str) -> str:
    arms = " ".join(f"WHEN {v} THEN {lit(n)}" for v, n in K.EDUCATION_NAMES.items())
    return f"CASE {level} {arms} ELSE 'Not stated' END"


def years(x: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({low(x)}, {lit(p)}) THEN {y}" for p, y in reversed(K.SENIORITY_PATTERNS))
    stated = f"list_transform(regexp_extract_all({low(x)}, {lit(K.YEARS_PATTERN)}, 1), lambda n: CAST(n AS DOUBLE))"
    return f"CAST(coalesce(list_max(list_filter({stated}, lambda n: n <= 45)), CASE {arms} ELSE 0.0 END) AS DOUBLE)"


def certifications(x: str) -> str:
    lists = f"regexp_extract_all({low(x)}, {lit(K.CERTIFICATION_LIST_PATTERN)}, 1)"
    words = f"len(regexp_extract_all({low(x)}, {lit(K.CERTIFICATION_WORD_PATTERN)}))"
    listed = f"list_sum(list_transform({lists}, lambda e: len(string_split_regex(e, ',| and '))))"
    return f"CAST(CASE WHEN len({lists}) > 0 THEN {listed} ELSE {words} END AS BIGINT)"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(f'[^{WS}]+')}))"


def skills(x: str, vocabulary: list[str] | None = None) -> str:
    """Sorted list of vocabulary hits, one guarded pattern per term (no term holds another as a whole word)."""
    terms = sorted(vocabulary or K.BASE_SKILLS)
    hits = ", ".join(
        f"CASE WHEN regexp_matches(lower({x}), {lit('(^|[^a-z0-9])' + re.escape(t) + '($|[^a-z0-9+#])')}) THEN {lit(t)} END"
        for t in terms)
    return f"list_filter([{hits}], lambda s: s IS NOT NULL)"


def joined(items: str, by: str = "|") -> str:
    return f"coalesce(array_to_string({items}, {lit(by)}), '')"


def tokens(x: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({x}), {lit('[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]{2,}')}), "
            f"lambda t: NOT list_contains({stop_list()}, t))")


def grams(s: str) -> str:
    return f"list_concat({s}, list_transform(range(1, len({s})), lambda i: {s}[i] || ' ' || {s}[i + 1]))"


def round_exact(x: str, digits: int) -> str:
    """Same rule as the engine: the exact binary value, half to even."""
    s = f"{10 ** digits}.0::DOUBLE"
    return (f"(SELECT CASE WHEN p - floor(p) = 0.5 AND err > 0 THEN floor(p) + 1 WHEN p - floor(p) = 0.5 AND err < 0 THEN floor(p) "
            f"ELSE round_even(p, 0) END / ({s}) FROM (SELECT p, (hi * ({s}) - p) + (v - hi) * ({s}) AS err FROM "
            f"(SELECT v, v * ({s}) AS p, (v * 134217729.0::DOUBLE) - ((v * 134217729.0::DOUBLE) - v) AS hi FROM (SELECT ({x})::DOUBLE AS v))))")


def short_number(x: str) -> str:
    return f"regexp_replace(CAST(round({x}, 4) AS VARCHAR), '\\.0$', '')"


# Labelled applications, the first of each (resume, job description) pair.
SCREENING = oracle_with("v_screening") + """,
loaded AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT row_id, candidate_id, job_id, resume, job_description, job_role, sensitive_age, sensitive_segment,
      CASE raw_label WHEN 'Hired' THEN 1 ELSE 0 END AS label,
      row_number() OVER (PARTITION BY resume, job_description ORDER BY row_id) AS rn
    FROM v_screening WHERE raw_label IN ('Hired', 'No') AND length(resume) > 20 AND length(job_description) > 20)
  WHERE rn = 1)
"""

# Every text of the fixtures.
TEXTS = oracle_with("v_candidate", "v_job") + """,
v_texts AS (
  SELECT 'c' || CAST(candidate_id AS VARCHAR) AS text_id, resume AS text FROM v_candidate
  UNION ALL SELECT 'j' || CAST(job_id AS VARCHAR), job_description FROM v_job
  UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR), text FROM documents)
"""

# Profiles of candidates and jobs, similarity under TF-IDF of the two texts, rule score and decision per application.
FACTS = oracle_with("v_application", "v_candidate", "v_job") + f""",
cand AS (
  SELECT candidate_id, resume, {skills('resume')} AS skills, {education('resume')} AS edu, {years('resume')} AS yrs,
    {tokens(clean('resume'))} AS toks FROM v_candidate),
job AS (
  SELECT job_id, job_role, job_description, {skills('job_description')} AS jd_skills, {education('job_description')} AS req_edu,
    {years('job_description')} AS req_yrs, {tokens(clean('job_description'))} AS toks FROM v_job),
ct AS (SELECT candidate_id, t, count(*) AS n FROM (SELECT candidate_id, unnest(toks) AS t FROM cand) GROUP BY ALL),
jt AS (SELECT job_id, t, count(*) AS n FROM (SELECT job_id, unnest(toks) AS t FROM job) GROUP BY ALL),
pairs AS (SELECT DISTINCT candidate_id, job_id FROM v_application),
norms AS (
  SELECT candidate_id, job_id, sum(ab) AS ab, sum(aa) AS aa, sum(bb) AS bb FROM (
    SELECT p.candidate_id, p.job_id, c.n * coalesce(j.n, 0) AS ab,
      (c.n * CASE WHEN j.n IS NULL THEN {RARE} ELSE 1.0 END)^2 AS aa, 0.0 AS bb
    FROM pairs p JOIN ct c ON c.candidate_id = p.candidate_id LEFT JOIN jt j ON j.job_id = p.job_id AND j.t = c.t
    UNION ALL
    SELECT p.candidate_id, p.job_id, 0, 0.0, (j.n * CASE WHEN c.n IS NULL THEN {RARE} ELSE 1.0 END)^2
    FROM pairs p JOIN jt j ON j.job_id = p.job_id LEFT JOIN ct c ON c.candidate_id = p.candidate_id AND c.t = j.t)
  GROUP BY ALL),
sims AS (SELECT candidate_id, job_id, ab / sqrt(aa * bb) AS sim FROM norms),
matched AS (
  SELECT a.application_id, a.candidate_id, a.job_id, a.raw_label, c.resume, c.skills, c.edu, c.yrs, j.job_role, j.job_description,
    j.jd_skills, j.req_edu, j.req_yrs, s.sim,
    list_sort(list_filter(j.jd_skills, lambda x: list_contains(c.skills, x))) AS hit,
    list_sort(list_filter(j.jd_skills, lambda x: NOT list_contains(c.skills, x))) AS miss,
    c.yrs - j.req_yrs AS gap,
    CASE WHEN j.req_edu < 0 OR c.edu >= j.req_edu THEN 1.0 ELSE 0.4 END::DOUBLE AS edu_fit
  FROM v_application a JOIN cand c ON c.candidate_id = a.candidate_id JOIN job j ON j.job_id = a.job_id
  JOIN sims s ON s.candidate_id = a.candidate_id AND s.job_id = a.job_id),
parts AS (
  SELECT *, CASE WHEN len(jd_skills) > 0 THEN len(hit)::DOUBLE / len(jd_skills)::DOUBLE ELSE 0.0 END AS coverage,
    CASE WHEN req_yrs = 0 OR gap >= 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1 + gap / greatest(req_yrs, 1.0::DOUBLE)) END AS exp_fit,
    least(sim / 0.5::DOUBLE, 1.0::DOUBLE) AS sem
  FROM matched),
rules AS (
  SELECT *, 100 * (0.45::DOUBLE * coverage + 0.30::DOUBLE * sem + 0.10::DOUBLE * edu_fit + 0.15::DOUBLE * exp_fit) AS rule
  FROM parts),
scored AS (
  SELECT *, CASE WHEN rule >= 65 THEN 'Shortlist' WHEN rule >= 45 THEN 'Hold' ELSE 'Reject' END AS decision,
    CASE WHEN rule >= 65 THEN 'strong overall fit with the job requirements'
      WHEN rule >= 45 AND len(miss) > 0 THEN 'partial fit; verify ' || array_to_string(miss[1:2], ', ')
      WHEN rule >= 45 THEN 'partial fit; verify depth of experience'
      ELSE 'low alignment with the core requirements' END AS reason,
    round(rule, 1) AS rule1
  FROM rules)
"""
