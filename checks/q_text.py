"""Per-text functions over every text of the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data, sqlkit as q
from checks.registry import query
from rostra import constants as K
from rostra.functions import text as tx
from rostra.functions.skills import extract_skills
from rostra.operators import profiles, skills as sk, tfidf
from rostra.operators.chunks import chunk_documents
from rostra.session import materialize
from rostra.sources.fixtures import oracle_with, view


def _each(name, column, sql):
    query(name, q.TEXTS + f"SELECT text_id, {sql} FROM v_texts")(
        lambda spark, sf: data.texts(spark, sf).select("text_id", *column()))


_each("txt_clean", lambda: [F.md5(tx.clean(F.col("text"))).alias("cleaned"), F.length(tx.clean(F.col("text"))).alias("chars")],
      f"md5({q.clean('text')}) AS cleaned, length({q.clean('text')}) AS chars")
_each("txt_mask_pii", lambda: [F.md5(tx.mask_pii(F.col("text"))).alias("masked")], f"md5({q.mask('text')}) AS masked")
_each("txt_skills", lambda: [F.array_join(extract_skills(F.col("text"), K.BASE_SKILLS), "|").alias("skills")],
      f"{q.joined(q.skills('text'))} AS skills")
_each("txt_education", lambda: [tx.education_level(F.col("text")).alias("level"),
                                tx.education_name(tx.education_level(F.col("text"))).alias("name")],
      f"{q.education('text')} AS level, {q.education_name(q.education('text'))} AS name")
_each("txt_experience", lambda: [tx.experience_years(F.col("text")).alias("years")], f"{q.years('text')} AS years")
_each("txt_certifications", lambda: [tx.certification_count(F.col("text")).alias("n")], f"{q.certifications('text')} AS n")
_each("txt_word_count", lambda: [tx.word_count(F.col("text")).alias("words")], f"{q.words('text')} AS words")
SECTIONS = "list_filter([" + ", ".join(
    f"CASE WHEN regexp_matches({q.low('text')}, {q.lit(chr(92) + 'b' + h + chr(92) + 'b')}) THEN '{h}' END" for h in K.SECTION_HEADERS
) + "], lambda s: s IS NOT NULL)"
_each("txt_sections", lambda: [tx.sections_found(F.col("text")).alias("sections")], f"{q.joined(SECTIONS)} AS sections")
CONTACT = rf"[^{tx.WS}]+@[^{tx.WS}]+|\+?\p{{Nd}}[\p{{Nd}}{tx.WS}-]{{8,}}"
_each("txt_contact", lambda: [tx.has_contact_info(F.col("text")).alias("contact")],
      f"regexp_matches(text, {q.lit(CONTACT)}) AS contact")
FLAGS = (f"list_filter([CASE WHEN {q.words('text')} < 80 THEN {q.lit(K.FLAG_SHORT)} END, "
         f"CASE WHEN len({q.skills('text')}) = 0 THEN {q.lit(K.FLAG_NO_SKILLS)} END, "
         f"CASE WHEN {q.education('text')} < 0 THEN {q.lit(K.FLAG_NO_EDUCATION)} END], lambda s: s IS NOT NULL)")
_each("txt_quality_flags", lambda: [tx.quality_flags(
    tx.word_count(F.col("text")), extract_skills(F.col("text"), K.BASE_SKILLS), tx.education_level(F.col("text"))).alias("flags")],
    f"{q.joined(FLAGS)} AS flags")
_each("txt_trim", lambda: [F.md5(tx.cut(F.col("text"), 3500)).alias("long_cut"), F.md5(tx.cut(F.col("text"), 100)).alias("short_cut")],
      "md5(CASE WHEN length(text) > 3500 THEN text[1:3500] || ' ...' ELSE text END) AS long_cut, "
      "md5(CASE WHEN length(text) > 100 THEN text[1:100] || ' ...' ELSE text END) AS short_cut")


@query("txt_sentences", q.TEXTS + f"""
SELECT text_id, pos, sentence FROM (
  SELECT text_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM (
    SELECT text_id, list_filter(list_transform(string_split_regex(
      regexp_replace(text, {q.lit('([.!?])[' + tx.WS + ']+')}, {q.lit(chr(92) + '1' + chr(1))}, 'g'), {q.lit(chr(1) + '|' + chr(92) + 'n+')}),
      lambda s: trim(s, ' -*')), lambda s: len(regexp_extract_all(s, {q.lit(f'[^{tx.WS}]+')})) >= 5) AS s FROM v_texts))""")
def txt_sentences(spark, sf):
    return data.texts(spark, sf).select("text_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))


@query("txt_tokens", q.TEXTS + f"""
SELECT text_id, len(s) AS words, len(g) AS grams, md5(coalesce(array_to_string(g, '|'), '')) AS content
FROM (SELECT text_id, s, {q.grams('s')} AS g FROM (SELECT text_id, {q.tokens('text')} AS s FROM v_texts))""")
def txt_tokens(spark, sf):
    t = data.texts(spark, sf).withColumn("s", tx.word_tokens(F.col("text"), K.STOP_WORDS))
    t = t.withColumn("g", tx.with_bigrams(F.col("s")))
    return t.select("text_id", F.size("s").alias("words"), F.size("g").alias("grams"), F.md5(F.array_join("g", "|")).alias("content"))


@query("txt_role_hit", oracle_with("v_screening") + f""",
w AS (SELECT row_id, {q.clean('resume')} AS r, list_filter(string_split({q.clean('job_role')}, ' '), lambda w: length(w) > 2) AS ws FROM v_screening)
SELECT row_id, CASE WHEN len(ws) = 0 THEN 0.0 ELSE len(list_filter(ws, lambda w: contains(r, w)))::DOUBLE / len(ws) END AS role_hit FROM w""")
def txt_role_hit(spark, sf):
    """A resume is cleaned once per candidate, a role is cut once per job; applications meet what is left."""
    a = view(spark, sf, "v_application").select(F.col("application_id").alias("row_id"), "candidate_id", "job_id")
    c = materialize(view(spark, sf, "v_candidate").select("candidate_id", tx.clean(F.col("resume")).alias("cleaned")), "cleaned")
    j = view(spark, sf, "v_job").select("job_id", tx.role_words(F.col("job_role")).alias("words"))
    return a.join(c, "candidate_id").join(j, "job_id").select("row_id", tx.role_hit(F.col("words"), F.col("cleaned")).alias("role_hit"))


@query("profile_resume", oracle_with("v_candidate") + f"""
SELECT candidate_id, {q.joined(q.skills('resume'))} AS skills, {q.education('resume')} AS education_level,
  {q.education_name(q.education('resume'))} AS education, {q.years('resume')} AS experience_years,
  {q.certifications('resume')} AS certifications, {q.joined(SECTIONS.replace('lower(text)', 'lower(resume)'))} AS sections_found,
  {q.words('resume')} AS word_count, regexp_matches(resume, {q.lit(CONTACT)}) AS has_contact_info,
  {q.joined(FLAGS.replace('lower(text)', 'lower(resume)').replace('_all(text', '_all(resume'))} AS quality_flags FROM v_candidate""")
def profile_resume(spark, sf):
    c = view(spark, sf, "v_candidate").select("candidate_id", "resume")
    return profiles.profile_resumes(c, K.BASE_SKILLS).drop("resume")


FOLD = oracle_with("v_corpus").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
paras AS (SELECT doc, unnest(range(len(ps))) AS p_no, unnest(ps) AS p FROM (
  SELECT doc, list_filter(list_transform(string_split_regex(text, {q.lit(chr(92) + 'n[' + tx.WS + ']*' + chr(92) + 'n')}), lambda p: {q.strip('p')}), lambda p: p <> '') AS ps
  FROM v_corpus)),
bodies AS (
  SELECT doc, p_no, starts_with(p, '#') AS head, string_split(ltrim(p, '# '), chr(10))[1] AS title,
    CASE WHEN NOT starts_with(p, '#') THEN p WHEN instr(p, chr(10)) > 0 THEN {q.strip('substr(p, instr(p, chr(10)) + 1)')} ELSE '' END AS body
  FROM paras),
fulls AS (SELECT *, CASE WHEN length(body) > 700 THEN CAST(ceil((length(body) - 700) / 580.0) AS BIGINT) ELSE 0 END AS m FROM bodies),
raw_steps AS (
  SELECT doc, p_no, -1 AS k, 'head' AS kind, title AS body FROM fulls WHERE head
  UNION ALL SELECT doc, p_no, k, 'piece', substr(body, CAST(k * 580 + 1 AS BIGINT), 700) FROM (SELECT *, unnest(range(m)) AS k FROM fulls)
  UNION ALL SELECT doc, p_no, m, 'rest', substr(body, CAST(m * 580 + 1 AS BIGINT)) FROM fulls WHERE body <> ''
  UNION ALL SELECT doc, 1000000000, 0, 'end', '' FROM v_corpus),
steps AS MATERIALIZED (SELECT doc, kind, body, row_number() OVER (PARTITION BY doc ORDER BY p_no, k) AS i FROM raw_steps),
fold AS (
  SELECT doc, 0::BIGINT AS i, doc AS section, '' AS buf, NULL::VARCHAR AS out_section, NULL::VARCHAR AS out_text FROM v_corpus
  UNION ALL
  SELECT doc, i, CASE WHEN kind = 'head' THEN body ELSE section END,
    CASE WHEN kind = 'rest' THEN CASE WHEN lft <> '' THEN lft || chr(10) || body ELSE body END ELSE lft END,
    CASE WHEN closes AND {q.strip('closing')} <> '' THEN section END,
    CASE WHEN closes AND {q.strip('closing')} <> '' THEN {q.strip('closing')} END
  FROM (
    SELECT *, CASE WHEN kind = 'head' THEN '' WHEN closes THEN CASE WHEN length(closing) > 120 THEN right(closing, 120) ELSE closing END ELSE buf END AS lft FROM (
      SELECT f.doc, s.i, s.kind, s.body, f.section, f.buf, CASE WHEN s.kind = 'piece' THEN f.buf || ' ' || s.body ELSE f.buf END AS closing,
        s.kind <> 'rest' OR length(f.buf) + length(s.body) > 700 AS closes
      FROM fold f JOIN steps s ON s.doc = f.doc AND s.i = f.i + 1)))
"""


@query("doc_chunk", FOLD + """
SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY i) - 1 AS BIGINT) AS chunk_id, out_section AS section, out_text AS text
FROM fold WHERE out_text IS NOT NULL""")
def doc_chunk(spark, sf):
    return chunk_documents(view(spark, sf, "v_corpus")).select("doc", "chunk_id", "section", "text")


MINED = f"""
phrases AS (
  SELECT mult, unnest(list_concat(list_concat(
    regexp_extract_all(lower(text), {q.lit(K.SKILL_PHRASE_PATTERNS[0])}, 1), regexp_extract_all(lower(text), {q.lit(K.SKILL_PHRASE_PATTERNS[1])}, 1)),
    regexp_extract_all(lower(text), {q.lit(K.SKILL_PHRASE_PATTERNS[2])}, 1))) AS phrase FROM source),
pieces AS (SELECT mult, trim(regexp_replace(unnest(string_split_regex(phrase, ',| and |\\|')), '[^a-z0-9+#./\\s-]', '', 'g'), ' .-') AS skill FROM phrases),
mined AS (SELECT skill, CAST(sum(mult) AS BIGINT) AS freq FROM pieces
  WHERE length(skill) BETWEEN 2 AND 40 AND len(regexp_extract_all(skill, '\\S+')) BETWEEN 1 AND 4 GROUP BY skill HAVING sum(mult) >= 3)
"""
MINE_ALL = q.SCREENING + """,
source AS (SELECT 1 AS mult, resume AS text FROM loaded UNION ALL SELECT 1, job_description FROM loaded),""" + MINED


def mined(spark, sf):
    c, j = data.corpus(data.loaded(spark, sf), spark, sf)
    return sk.mine_skills(c.select("text", "mult").unionByName(j.select("text", "mult")), "text", weight="mult")


query("skill_mine", MINE_ALL + "SELECT skill, freq FROM mined")(mined)


def full_vocabulary(spark, sf):
    from rostra.sources.tables import base_vocabulary
    return sk.full_vocabulary(base_vocabulary(spark), mined(spark, sf))


BASE = "[" + ", ".join(q.lit(s) for s in K.BASE_SKILLS) + "]"
query("set_vocab_union", MINE_ALL + f"SELECT DISTINCT trim(lower(s)) AS skill FROM (SELECT unnest({BASE}) AS s UNION ALL SELECT skill FROM mined)")(full_vocabulary)

# The phrases of the fixtures only list skills of the fixture vocabulary, so base and mined terms are known here.
from rostra.sources.fixtures import SKILL  # noqa: E402


@query("join_vocab", q.TEXTS + f"SELECT text_id, {q.joined(q.skills('text', sorted(set(K.BASE_SKILLS) | set(SKILL))))} AS skills FROM v_texts")
def join_vocab(spark, sf):
    return sk.add_skills(data.texts(spark, sf), "text", full_vocabulary(spark, sf)).select("text_id", "skills")


@query("role_skill_profile", oracle_with("v_screening") + f""",
top AS (SELECT job_role, count(*) AS rows FROM v_screening GROUP BY job_role),
firsts AS (SELECT * FROM (SELECT job_role, row_id, resume FROM v_screening)),
counts AS (SELECT job_role, skill, count(*) AS n FROM (SELECT job_role, unnest({q.skills('resume')}) AS skill FROM firsts) GROUP BY ALL),
best AS (SELECT job_role, list(skill ORDER BY n DESC, skill) AS l FROM (SELECT *, row_number() OVER (PARTITION BY job_role ORDER BY n DESC, skill) AS rn FROM counts) WHERE rn <= 15 GROUP BY job_role)
SELECT t.job_role, t.rows, array_to_string(coalesce(b.l, ['communication', 'problem solving']), '|') AS skills FROM top t LEFT JOIN best b USING (job_role)""")
def role_skill_profile(spark, sf):
    a = view(spark, sf, "v_application").select(F.col("application_id").alias("row_id"), "candidate_id", "job_id")
    c = view(spark, sf, "v_candidate").select("candidate_id", extract_skills(F.col("resume"), K.BASE_SKILLS).alias("skills"))
    j = view(spark, sf, "v_job").select("job_id", "job_role")
    return sk.role_skill_profile(a.join(c, "candidate_id").join(j, "job_id"))


@query("win_first_n_per_group", oracle_with("v_screening") + """
SELECT job_role, row_id FROM (SELECT job_role, row_id, row_number() OVER (PARTITION BY job_role ORDER BY row_id) AS rn FROM v_screening) WHERE rn <= 300""")
def win_first_n(spark, sf):
    a = view(spark, sf, "v_application").select(F.col("application_id").alias("row_id"), "job_id")
    rows = a.join(view(spark, sf, "v_job").select("job_id", "job_role"), "job_id")
    return sk.first_n_per_group(rows, "job_role", [F.col("row_id")], 300).select("job_role", "row_id")
