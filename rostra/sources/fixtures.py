"""Recruitment tables derived from the driver's tables by arithmetic on keys.

Each recipe is one text rendered for Spark or for the oracle, so both read the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra.session import spread

ROLE = ["Data Scientist", "Web Developer", "HR Manager", "Accountant", "DevOps Engineer"]
SKILL = ["python", "sql", "pandas", "statistics", "nlp", "machine learning", "javascript", "react", "html", "css",
         "rest api", "git", "recruitment", "payroll", "leadership", "accounting", "taxation", "auditing", "excel",
         "budgeting", "docker", "kubernetes", "linux", "terraform"]
LEVELTXT = ["entry-level", "mid-level", "senior-level"]
DEGREE = ["Bachelors", "Masters", "PhD", "Diploma"]
LEVEL = ["Engineer", "Senior", "Lead", "Manager", "Director"]


def _pick(items: list[str], index: str, spark: bool) -> str:
    quoted = ", ".join(f"'{i}'" for i in items)
    if spark:
        return f"element_at(array({quoted}), cast({index} as int))"
    return f"([{quoted}])[{index}]"


def recipes(spark: bool) -> dict[str, str]:
    """View name to SELECT text. ``spark`` chooses the dialect."""
    a = lambda items, index: _pick(items, index, spark)
    s = lambda x: f"cast({x} as {'string' if spark else 'varchar'})"
    views = {}
    views["v_job"] = f"""
        SELECT cast(n_nationkey as bigint) AS job_id, {a(ROLE, 'n_nationkey%5+1')} AS job_role,
          'We are hiring a ' || {a(ROLE, 'n_nationkey%5+1')} || '. Required skills: '
          || {a(SKILL, 'n_nationkey%24+1')} || ', ' || {a(SKILL, '(n_nationkey*5+2)%24+1')} || ', '
          || {a(SKILL, '(n_nationkey*7+4)%24+1')} || '. ' || {a(DEGREE, 'n_nationkey%4+1')}
          || ' degree and ' || {s('1+n_nationkey%8')} || '+ years of experience preferred.' AS job_description
        FROM nation"""
    views["v_candidate"] = f"""
        SELECT c_custkey AS candidate_id,
          'Proficient in ' || {a(SKILL, 'c_custkey%24+1')} || ', ' || {a(SKILL, '(c_custkey*7+3)%24+1')} || ', '
          || {a(SKILL, '(c_custkey*11+5)%24+1')} || ', with ' || {a(LEVELTXT, 'c_custkey%3+1')}
          || ' experience in the field. Holds a ' || {a(DEGREE, 'c_custkey%4+1')} || ' degree. '
          || CASE WHEN c_custkey%3=0 THEN {s('c_custkey%30')} || ' years of experience. ' ELSE '' END
          || CASE WHEN c_custkey%4=1 THEN 'Certifications such as AWS, Scrum and SAP. ' ELSE '' END
          || 'Contact c' || {s('c_custkey')} || '@example.com' AS resume,
          cast(20+c_custkey%45 as int) AS sensitive_age, c_mktsegment AS sensitive_segment
        FROM customer"""
    views["v_application"] = """
        SELECT o_orderkey AS application_id, o_custkey AS candidate_id, cast(o_orderkey%25 as bigint) AS job_id,
          CASE o_orderstatus WHEN 'F' THEN 'Hired' WHEN 'O' THEN 'No' ELSE 'pending' END AS raw_label,
          o_orderdate AS applied_at
        FROM orders"""
    views["v_screening"] = """
        SELECT a.application_id AS row_id, a.candidate_id, a.job_id, c.resume, j.job_description, j.job_role,
          a.raw_label, c.sensitive_age, c.sensitive_segment
        FROM v_application a JOIN v_candidate c ON a.candidate_id = c.candidate_id JOIN v_job j ON a.job_id = j.job_id"""
    pair = lambda k, j: a(SKILL, f"(s_suppkey*{k}+{j})%24+1")
    views["v_interviewer"] = f"""
        SELECT s_suppkey AS pool_ord, s_name AS name, {a(ROLE, 's_suppkey%5+1')} AS primary_role,
          {a(LEVEL, 's_nationkey%5+1')} AS level,
          {pair(1, 0)} || '; ' || {pair(3, 1)} || '; ' || {pair(9, 2)} || '; ' || {pair(13, 3)} AS skills,
          cast(s_suppkey%7 as int) AS interviews_this_week, cast(4+s_suppkey%3 as int) AS max_per_week,
          'SYNTHETIC' AS data_source
        FROM supplier"""
    views["v_resume_category"] = "SELECT doc_id AS row_id, text AS resume, source AS category FROM documents"
    newline = "'\\n'" if spark else "chr(10)"
    views["v_corpus"] = f"""
        SELECT {s('doc_id')} AS doc, doc_id AS doc_ord, lang,
          CASE doc_id%3 WHEN 0 THEN text
            WHEN 1 THEN '# ' || source || {newline} || {newline} || replace(text, {newline}, {newline} || {newline})
            ELSE '## Part ' || {s('doc_id')} || {newline} || replace(text, {newline}, {newline} || ' ' || {newline}) END AS text
        FROM documents"""
    views["v_question"] = """
        SELECT b.item_id AS question_id, b.text AS question, min(d.doc_id) AS expected_doc
        FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id, b.text"""
    views["v_usage_log"] = f"""
        SELECT ts, event_type AS purpose, event_type <> 'error' AS ok, cast(floor(value*10) as bigint) AS prompt_chars,
          cast(floor(value) as bigint) AS output_chars, value AS seconds, 'm' || {s('user_id%3')} AS model, event_id
        FROM events"""
    return views


TABLES = ["nation", "customer", "orders", "supplier", "documents", "benchmark", "events", "embeddings", "labels",
          "conversations"]

TEXT_TABLES = {"documents": "doc_id", "customer": "c_custkey", "orders": "o_orderkey"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table (or raw table) as a DataFrame. Nested views and tables are substituted by name."""
    if name == "v_question":
        return questions(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), view(spark, sf_dir, "documents"))
    texts = recipes(spark=True)
    needed = {"v_screening": ["v_application", "v_candidate", "v_job"]}.get(name, [])
    raw = {"v_job": ["nation"], "v_candidate": ["customer"], "v_application": ["orders"], "v_interviewer": ["supplier"],
           "v_resume_category": ["documents"], "v_corpus": ["documents"],
           "v_usage_log": ["events"]}
    if name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return spread(table, TEXT_TABLES[name]) if name in TEXT_TABLES else table
    inputs = {n: view(spark, sf_dir, n) for n in needed + raw.get(name, [])}
    query = texts[name]
    for n in inputs:
        query = _substitute(query, n)
    return spark.sql(query, **inputs)


def questions(benchmark: DataFrame, documents: DataFrame) -> DataFrame:
    """Every benchmark item as a question, with the first document that contains its text, or none.

    Items meet documents on the item's longest inner word, which a document that contains the item has as a word too; items of
    fewer than three words have the empty word, which is compared with every document only if there are such items.
    """
    words = F.split("text", r"[\x20\x09-\x0D]+")
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    items = benchmark.select("item_id", F.col("text").alias("item"), F.coalesce(longest, F.lit("")).alias("word"))
    held = documents.select("doc_id", "text", F.explode(F.array_union(F.array_distinct(words), F.array(F.lit("")))).alias("word"))
    wanted = held.join(items.select("word").distinct(), "word", "left_semi")
    first = (wanted.join(items, "word").where(F.col("text").contains(F.col("item")))
             .groupBy("item_id").agg(F.min("doc_id").alias("expected_doc")))
    return benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"), "item_id") \
        .join(first, "item_id", "left").select("question_id", "question", "expected_doc")


def _substitute(query: str, table: str) -> str:
    return re.sub(rf"(?<=FROM |JOIN ){table}\b", "{" + table + "}", query)


def oracle_with(*names: str) -> str:
    """``WITH`` prefix that defines the named views for the oracle."""
    texts = recipes(spark=False)
    wanted: list[str] = []
    for n in names:
        if n == "v_screening":
            for m in ("v_application", "v_candidate", "v_job"):
                if m not in wanted:
                    wanted.append(m)
        if n not in wanted:
            wanted.append(n)
    return "WITH " + ",\n".join(f"{n} AS ({texts[n]})" for n in wanted)
