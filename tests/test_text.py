"""Golden rows of the text functions."""

import re

import pytest
from pyspark.sql import functions as F

from rostra import constants as K
from rostra.functions import text as tx
from rostra.functions.numbers import round_exact, short_number
from rostra.functions.skills import extract_skills


def one(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_education(spark):
    texts = ["contact me now", "must be able", "PhD in physics", "Diploma holder", "12th pass", "nothing here", "Masters degree"]
    assert one(spark, tx.education_level, *texts) == [3, 2, 4, 1, 0, -1, 3]


def test_experience(spark):
    cases = {"2015 years": 15.0, "100 years": 0.0, "50 years, senior": 7.0, "sr. engineer": 0.0, "sr.engineer": 7.0,
             "5+ yrs and 2.5 years": 5.0, "junior": 1.5, "entry-level": 0.5, "head of sales, junior": 9.0, "": 0.0}
    assert one(spark, tx.experience_years, *cases) == list(cases.values())


def test_certifications(spark):
    cases = {"certifications such as A, B, and C.": 4, "certifications": 0, "certified, a certificate": 2,
             "Certification such as X and Y. certified": 2}
    assert one(spark, tx.certification_count, *cases) == list(cases.values())


def test_masking(spark):
    cases = {"2019 - 2021 x": "[PHONE] x", "mail a@b.com": "mail [EMAIL]", "see www.x.org/a now": "see [URL] now",
             "+1 (555) 123-4567": "[PHONE]"}
    assert one(spark, tx.mask_pii, *cases) == list(cases.values())


def test_clean(spark):
    assert one(spark, tx.clean, "See https://x.y/z or A@B.com — C++ & C# é!") == ["see or c++ c#"]


def test_skills_guards_and_longest_reading(spark):
    found = one(spark, lambda c: extract_skills(c, K.BASE_SKILLS), "mysql … c++ java javascript … java+ c++x")
    assert found == [["c++", "java", "javascript"]]
    nested = ["data", "data science", "science fiction"]
    texts = ["data science fiction", "data science and data", "datax"]
    assert one(spark, lambda c: extract_skills(c, nested), *texts) == [["data science"], ["data", "data science"], []]


def test_sentences_and_words(spark):
    assert one(spark, tx.word_count, " a b \n c ", "") == [3, 0]
    got = one(spark, tx.sentences, "- One two three four five. Short one.\n* six seven eight nine ten")[0]
    assert got == ["One two three four five.", "six seven eight nine ten"]


def test_profile_flags_and_sections(spark):
    flags = one(spark, lambda c: tx.quality_flags(tx.word_count(c), extract_skills(c, K.BASE_SKILLS), tx.education_level(c)), "x y")[0]
    assert flags == [K.FLAG_SHORT, K.FLAG_NO_SKILLS, K.FLAG_NO_EDUCATION]
    assert one(spark, tx.sections_found, "Work History and Skills; skillsets") == [["work history", "skills"]]


@pytest.mark.parametrize("digits", [1, 3])
def test_rounding_equals_python(spark, digits):
    values = [0.15, 0.25, 0.35, 2.675, 62.25, 62.35, 1.0005, 99.95, 0.0, 33.333, 45.05, 64.95]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.r for r in df.select("i", round_exact(F.col("v"), digits).alias("r")).orderBy("i").collect()]
    assert got == [round(v, digits) for v in values]


def test_short_number(spark):
    df = spark.createDataFrame([(5.0,), (0.5,), (2.3000000000000003,)], "v double")
    assert [r.s for r in df.select(short_number(F.col("v")).alias("s")).collect()] == ["5", "0.5", "2.3"]


def test_clean_is_linear_in_the_length_of_a_word(spark):
    """a long word was walked once from each of its characters; mail addresses and links go as before."""
    import time
    cases = {"x@y.com z": "z", "@a b": "a b", "a@ b": "a b", "a@@ b": "b", "@@a b": "b", "@a@b c": "c", "Mail A@B@C\x1cd": "mail d", "see http://a@b/c www.x d": "see d", "http:/ www. @": "http / www.", "": ""}
    assert one(spark, tx.clean, *cases) == list(cases.values())
    began = time.time()
    assert one(spark, lambda t: F.length(tx.clean(F.repeat(t, 100_000))), "x") == [100_000]
    assert time.time() - began < 20


def test_masking_is_linear_in_the_length_of_a_word(spark):
    """a long word was walked once from each of its characters; what is masked is as before."""
    import time
    cases = {"a@b.c-d@e.f x": "[EMAIL][EMAIL] x", "a@b.c+d@e.f@g.h": "[EMAIL][EMAIL]@g.h", "é_1.+-@b-c.d": "[EMAIL]", "a@@b.c @b.c a@b": "a@@b.c @b.c a@b",
             "a@b.c 012-345 6789x": "[EMAIL] [PHONE]x", "1@2.345678901234 5": "[EMAIL] 5", "see http://x.y www.z": "see [URL] [URL]", "https:// www. http": "https:// www. http",
             "http://a@b.c": "[URL]", "": ""}
    assert one(spark, tx.mask_pii, *cases) == list(cases.values())
    began = time.time()
    assert one(spark, lambda t: F.length(tx.mask_pii(F.concat(F.repeat(t, 300_000), F.lit(" a@b.c")))), "x") == [300_008]
    assert time.time() - began < 20


def test_role_hit_query_keeps_every_application(spark, tmp_path):
    """resumes are cleaned before the join; repeated and missing keys meet as in a plain join."""
    from pyspark.sql import types as T
    from checks import q_text
    spark.createDataFrame([(1, "A"), (1, "B"), (None, "A"), (2, "A")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(2, "x"), (7, "y")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    day = T._parse_datatype_string("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string")
    spark.createDataFrame([(2, 1, "F", "d"), (2, 1, "F", "d"), (27, 2, "O", "d"), (7, None, "P", "d"), (None, 1, "F", "d"), (3, 1, "F", "d")], day).write.parquet(f"{tmp_path}/orders.parquet")
    plan = q_text.txt_role_hit(spark, str(tmp_path))
    assert sorted((r.row_id, r.role_hit) for r in plan.collect()) == [(2, 0.0)] * 4 + [(27, 0.0)]
    assert "regexp_replace" not in plan._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_clean_takes_what_is_allowed(spark):
    """Words of allowed characters joined by a space are the text with all else replaced; no text stays none."""
    texts = ["", "  ", "!?", "  a  b ", "É c++ ünï 日本 x/y", "a b c\n\td", "#.-/+", "😀a😀b", None]
    want = [None if t is None else re.sub(r"[^a-z0-9+#./-]+", " ", t.lower()).strip(" ") for t in texts]
    assert one(spark, tx.clean, *texts) == want
    plan = spark.createDataFrame([("x",)], "t string").select(tx.clean(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and "[^a-z0-9" not in plan
