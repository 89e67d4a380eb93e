"""Operators against brute force and hand-worked rows, and invariance under partitioning."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rostra import constants as K
from rostra.operators import answers, chunks, fairness, generation, loading, metrics, models, ordering, panel, profiles, retrieval, scoring, skew, skills, tfidf
from rostra.functions.skills import extract_skills
from rostra.session import shared_folder
from rostra.sources import tables as io
from rostra.sources.fixtures import questions


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_rank_equals_window_for_a_hot_group(spark):
    rng = random.Random(3)
    data = [(i, 0 if i % 3 else i % 7, float(rng.randint(0, 9))) for i in range(500)]
    df = spark.createDataFrame(data, "id int, g int, s double").repartition(5)
    got = {(r.g, r.id): (r.rank, r.n) for r in ordering.add_rank(df, ["g"], [F.desc("s"), F.col("id")], "rank", "n").collect()}
    for g in {d[1] for d in data}:
        members = sorted((d for d in data if d[1] == g), key=lambda d: (-d[2], d[0]))
        for place, d in enumerate(members, 1):
            assert got[(g, d[0])] == (place, len(members))


def test_running_sums(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(100)], "k int, v int").repartition(4)
    out = rows(ordering.add_running_sums(df, [], [F.col("k")], {"v": "c"}), "k")
    total = 0
    for k, v, c, t in out:
        total += v
        assert (c, t) == (total, sum(i % 4 for i in range(100)))


def test_spread_join_keeps_every_match(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 11}") for i in range(300)], "id int, key string")
    counts = facts.groupBy("key").agg(F.count("*").alias("n"))
    keyed = counts.select("key", "n", F.length("key").alias("v"))
    got = rows(skew.spread_join(facts, keyed, "key", "id", "n", unique=True), "id")
    assert got == rows(facts.join(keyed.drop("n"), "key"), "id")


def chunked(spark, docs):
    df = spark.createDataFrame([(n, n, t) for n, t in docs.items()], "doc string, doc_ord string, text string")
    got = {}
    for r in chunks.chunk_documents(df).orderBy("doc", "chunk_id").collect():
        assert r.chunk_id == len(got.setdefault(r.doc, []))
        got[r.doc].append((r.section, r.text))
    return got


def test_chunks_worked_by_hand(spark):
    run = "".join(chr(97 + i % 26) for i in range(1500))
    four = ["p" * 300, "q" * 300, "r" * 300, "s" * 10]
    got = chunked(spark, {
        "nothing": "", "headings": "# One\n\n## Two\n\n#", "short": "First paragraph.\n\n  \nSecond paragraph.",
        "sections": "Before.\n\n# Leave rules\nUp to ten days.\n# not a heading\n\nMore.\n\n## Pay\n\nMonthly.",
        "long": run, "filled": "\n\n".join(four)})
    assert "nothing" not in got and "headings" not in got
    assert got["short"] == [("short", "First paragraph.\nSecond paragraph.")]
    assert got["sections"] == [("sections", "Before."), ("Leave rules", "Up to ten days.\n# not a heading\nMore."), ("Pay", "Monthly.")]
    # Pieces of 700 start every 580 characters; each later chunk carries the last 120 of the one before.
    assert got["long"] == [("long", run[:700]), ("long", run[580:700] + " " + run[580:1280]), ("long", run[1160:1280] + "\n" + run[1160:])]
    assert got["filled"] == [("filled", "p" * 300 + "\n" + "q" * 300), ("filled", "q" * 120 + "\n" + "r" * 300 + "\n" + "s" * 10)]


def test_chunk_properties(spark):
    rng = random.Random(5)
    docs, words = {}, {}
    for i in range(25):
        paragraphs = [[f"w{i}x{p}x{k}" for k in range(rng.randint(1, 200))] for p in range(rng.randint(1, 9))]
        docs[f"d{i}"] = "\n\n".join(("## head\n" if rng.random() < .3 else "") + " ".join(p) for p in paragraphs)
        words[f"d{i}"] = [w for p in paragraphs for w in p]
    for name, found in chunked(spark, docs).items():
        texts = [t for _, t in found]
        assert max(map(len, texts)) <= 821 + 701 and all(t and t == t.strip() for t in texts)
        whole = " ".join(texts)
        assert all(w in whole for w in words[name] if len(" ".join(words[name])) < 700)
        firsts = [min(k for k, t in enumerate(texts) if w in t) for w in words[name] if any(w in t for t in texts)]
        assert firsts == sorted(firsts) and len(firsts) >= 0.9 * len(words[name])  # in order; a cut may split a word


POOL = "pool_ord long, name string, primary_role string, level string, skills string, interviews_this_week int, max_per_week int, data_source string"
ASKS = "application_id int, job_role string, jd_skills array<string>, skills array<string>, experience_years double"


def picks(spark, people, asks):
    got = {}
    for r in panel.select_panels(spark.createDataFrame(asks, ASKS), spark.createDataFrame(people, POOL)).orderBy("application_id", "pick_no").collect():
        got.setdefault(r.application_id, []).append((r.pool_ord, r.score))
    return got


def test_panels_worked_by_hand(spark):
    ask = [(1, "data", ["python"], ["sql"], 1.0)]
    same = [(i, f"n{i}", "Data", "Senior", "python", i, 10, "x") for i in range(6)]
    others = [(6, "n6", "Data", "Senior", "sql", 6, 10, "x"), (7, "n7", "Data", "Lead", "python", 7, 10, "x"), (8, "n8", "Data", "Lead", "sql", 10, 10, "x")]
    # Eight can come: after the first, those who add neither a skill nor a level are passed over. n8 is fully booked.
    assert picks(spark, same + others, ask) == {1: [(0, 1.0), (6, 0.94), (7, 0.93)]}
    # Six can come: nobody is passed over.
    assert picks(spark, same, ask) == {1: [(0, 1.0), (1, 0.99), (2, 0.98)]}
    assert picks(spark, same[:2], ask) == {1: [(0, 1.0), (1, 0.99)]}
    # Another role loses 0.3, no shared skill 0.45; equal scores keep the order of the pool.
    assert picks(spark, [(5, "a", "Law", "Senior", "", 0, 5, "x"), (2, "b", "Law", "Senior", "cobol", 0, 5, "x")], ask) == {1: [(2, 0.25), (5, 0.25)]}


def test_panel_properties(spark):
    rng = random.Random(11)
    known = ["python", "sql", "react", "excel", "payroll", "git"]
    people = [(i, f"n{i}", rng.choice("ABC"), rng.choice(list(K.PANEL_LEVELS)), "; ".join(rng.sample(known, rng.randint(0, 3))), rng.randint(0, 5),
               rng.choice([4, 5]), "x") for i in range(60)]
    asks = [(i, rng.choice(["A", "b", "", "Z"]), rng.sample(known, rng.randint(0, 3)), rng.sample(known, rng.randint(0, 3)), float(rng.randint(0, 8))) for i in range(30)]
    got = picks(spark, people, asks)
    for i, *_ in asks:
        chosen = got[i]
        assert 1 <= len(chosen) <= 3 and len({p for p, _ in chosen}) == len(chosen)
        assert all(people[p][5] < people[p][6] for p, _ in chosen)
        assert [s for _, s in chosen] == sorted((s for _, s in chosen), reverse=True)


def test_match_worked_by_hand(spark):
    resume, jd = "Writes terraform and sql daily. Bachelors degree, 4 years.", "We need sql, terraform and kubernetes. At least 2 years."
    c = profiles.candidate_facts(spark.createDataFrame([(1, resume)], "candidate_id long, resume string"), ["sql", "terraform", "kubernetes"])
    j = profiles.job_facts(spark.createDataFrame([(1, "Engineer", jd)], "job_id long, job_role string, job_description string"), ["sql", "terraform", "kubernetes"])
    pair = c.withColumn("job_id", F.lit(1)).join(j, "job_id").withColumn(
        "similarity", tfidf.two_text_similarity("resume_terms", "resume_counts", "jd_terms", "jd_counts"))
    r = scoring.add_decision(scoring.add_match(pair)).first()
    assert r.matched_skills == ["sql", "terraform"] and r.missing_skills == ["kubernetes"]
    assert abs(r.rule_score - (45 * 2 / 3 + 30 * min(r.similarity / 0.5, 1) + 10 + 15)) < 1e-9


def test_skill_join_equals_pattern(spark):
    texts = ["python and c++; node.js", "machine learning systems", ".net core", "nothing", "learning systems", "日本語 c# résumé", "語学", "résumé?"]
    terms = ["python", "c++", "node.js", "machine learning", "learning systems", ".net", "core", "日本", "語", "é", "c#"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    by_join = rows(skills.add_skills(docs, "t", spark.createDataFrame([(s,) for s in terms], "skill string")).select("id", "skills"), "id")
    assert by_join == rows(docs.select("id", extract_skills(F.col("t"), terms).alias("skills")), "id")
    assert by_join[1] == (1, ["machine learning"]) and by_join[5] == (5, ["c#", "日本", "語"])


def test_empty_vocabulary_means_the_base_skills(spark):
    docs = spark.createDataFrame([(1, "python and excel"), (2, "zebra")], "id int, t string")
    none = spark.createDataFrame([], "skill string")
    assert rows(skills.add_skills(docs, "t", none).select("id", "skills"), "id") == [(1, ["excel", "python"]), (2, [])]
    assert rows(docs.select("id", extract_skills(F.col("t"), []).alias("skills")), "id") == [(1, ["excel", "python"]), (2, [])]


def test_uncapped_vocabulary_loses_no_term(spark):
    docs = spark.createDataFrame([(i, f"common word{i} word{i + 1}") for i in range(50)], "id int, t string")
    counted = tfidf.count_terms(docs, F.col("t"), bigrams=False)
    vocabulary = tfidf.fit(counted, tfidf.document_count(counted), min_df=1, max_terms=None)
    free, capped = (rows(tfidf.transform(counted, vocabulary, "id", max_terms=m), "id") for m in (None, 100))
    assert free == capped and all(len(r[1]) == 3 for r in free)


def test_numbers_written_as_text(spark, tmp_path):
    long = "a text that is long enough to be kept"
    (tmp_path / "n.csv").write_text("row_id,resume,job_description,label,age\n" + "".join(
        f"{i},{long} {i},{long},{v},{20 + i}\n" for i, v in enumerate(["1.0", "0.0", "2", "", "-1"])))
    raw = io.read_csv(spark, str(tmp_path / "n.csv"))
    standard = loading.standardise_screening(raw)
    assert [r.label for r in standard.orderBy("row_id").collect()] == [1, 0, 1, 0, 0]
    assert loading.load_screening(standard).count() == 5
    words = spark.createDataFrame([("yes",), ("1",)], "label string")
    assert loading.is_numeric(raw, "age") and not loading.is_numeric(words, "label")
    people = spark.createDataFrame([(i % 2, str(20 + i % 40)) for i in range(200)], "p int, sensitive_age string")
    assert {r.grp for r in fairness.group_rates(people, "p").collect()} == {"<25", "25-34", "35-44", "45+"}


def test_lexical_hit_without_a_vector_stays(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.0])], "question_id long, embedding array<double>")
    lexical = spark.createDataFrame([(7, 2, 0.9), (7, 1, 0.2)], "question_id long, vec_id long, score double")
    got = rows(retrieval.hybrid_top_k(lexical, vectors, asked).select("vec_id", F.round("score", 6)), F.col("vec_id"))
    assert got == [(1, 0.6), (2, 0.45)]


def test_questions_find_their_document(spark):
    documents = spark.createDataFrame([(3, "x one two three y"), (1, "one two three"), (2, "onetwo"), (5, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three"), (2, "e two thr"), (3, "a b"), (4, "missing words here")], "item_id long, text string")
    assert rows(questions(items, documents), "question_id") == [(1, "one two three", 1), (2, "e two thr", 1), (3, "a b", 5), (4, "missing words here", None)]


def test_spread_join_salts_by_rows(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(1000)], "id int, key string")
    keyed = facts.groupBy("key").agg(F.count("*").alias("n")).withColumn("v", F.length("key"))
    for how in ("inner", "left"):
        assert skew.spread_join(facts, keyed, "key", "id", "n", unique=True, hot_share=0.01, how=how).count() == 1000


def test_shared_folder_is_needed_on_a_cluster():
    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "spark://host:7077"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Fake)


def test_entry_needs_no_jar_of_pyspark(tmp_path):
    code = "import pyspark; pyspark.__file__ = '/nowhere/__init__.py'; import __spark_entry__ as e; assert len(e.queries()) > 120 and len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True, timeout=120)


def test_fairness_corner_cases(spark):
    ages = [25, 26, 35, 45, 46, 120, 121, 0, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a int")
    assert [r.g for r in df.select("i", fairness.age_group(F.col("a")).alias("g")).orderBy("i").collect()] == \
        ["<25", "25-34", "25-34", "35-44", "45+", "45+", "nan", "nan", "nan"]
    none = spark.createDataFrame([(0, "a")] * 25 + [(0, "b")] * 25, "p int, sensitive_gender string")
    r = fairness.audit(fairness.group_rates(none, "p")).first()
    assert r.disparate_impact_ratio != r.disparate_impact_ratio and r.passes_four_fifths_rule is False


def test_auc_with_ties_and_one_class(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (1, 0.1)]
    df = spark.createDataFrame(data, "y int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(metrics.roc_auc(df, "y", "s").first()[0] - want) < 1e-12
    lonely = metrics.roc_auc(df.where("y = 1"), "y", "s").first()[0]
    assert lonely != lonely


def test_labels(spark):
    df = spark.createDataFrame([(" Best Match ",), ("REJECT",), ("maybe",), (None,)], "w string")
    assert [r[0] for r in df.select(loading.binary_label(F.col("w"), False)).collect()] == [1, 0, None, None]


def test_replies(spark):
    cases = {'```json\n[{"category": "T", "question": "q"}]\n```': True, "say [1, 2] now": False, '{"a": 1}': False, "[broken": None, "": None}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").withColumn("j", generation.reply_json(F.col("t")))
    got = df.select("i", "j", generation.reply_questions(F.col("j")).alias("q")).orderBy("i").collect()
    for r, want in zip(got, cases.values()):
        assert (r.j is None) == (want is None) and (r.q is not None) == bool(want)


def test_answers_without_hits(spark):
    docs = spark.createDataFrame([("a.md", "a.md", "# Offers\n\nAn offer letter stays valid for seven calendar days after issue.")], "doc string, doc_ord string, text string")
    asked = spark.createDataFrame([(1, "How long is an offer letter valid?"), (2, "zebra quantum")], "question_id int, question string")
    hits = retrieval.search(retrieval.build_index(docs), asked)
    got = {r.question_id: r for r in answers.answer_questions(hits, asked).collect()}
    assert got[1].mode == "extractive" and got[1].answer.endswith("[1]") and got[1].sources[0].section == "Offers"
    assert got[2].mode == "none" and got[2].answer == K.NOT_FOUND and got[2].sources is None


def test_files(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "a.csv").write_bytes("Résumé Text,Kind\nx,1\n".encode("latin-1"))
    (tmp_path / "b" / "z.csv").write_text('Resume,Category\n"a ""q"", b\nc",x\n', encoding="utf-8")
    found = io.discover(spark, str(tmp_path), ["resume", "category"], ["job_description"]).first().file
    assert found.endswith("b/z.csv")
    got = io.read_csv(spark, str(tmp_path / "b")).first()
    assert got.Resume == 'a "q", b\nc' and got.Category == "x"
    assert io.read_csv(spark, str(tmp_path / "a.csv")).columns == ["Résumé Text", "Kind"]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "README.md").write_text("no")
    (tmp_path / "docs" / "p.md").write_text("# yes\nline")
    assert [(r.doc, r.text) for r in io.read_documents(spark, str(tmp_path / "docs")).collect()] == [("p.md", "# yes\nline")]


def test_sensitive_columns_are_never_features():
    assert not any(c.startswith("sensitive_") for c in models.assembler().getInputCols())
    try:
        models.assembler(["sensitive_age"])
    except ValueError:
        return
    raise AssertionError("a sensitive feature was accepted")


def test_late_log_rows_are_dropped(spark, tmp_path):
    from rostra.streaming import jobs
    log, schema = str(tmp_path / "log"), "ts timestamp, purpose string, prompt_chars long, output_chars long"
    batches = [["2024-01-01 10:05:00", "2024-01-01 10:50:00", "2024-01-01 14:00:00"], ["2024-01-02 00:00:00"], ["2024-01-01 10:30:00"]]
    for stamps in batches:
        frame = spark.createDataFrame([(t, "ask", 5, 2) for t in stamps], "ts string, purpose string, prompt_chars long, output_chars long")
        frame.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(log)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(log)
    jobs.run_to_end(jobs.usage_per_hour(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = rows(spark.read.parquet(str(tmp_path / "out")).select(F.date_format("hour", "dd HH"), "calls", "prompt_chars"), "hour")
    assert got == [("01 10", 2, 10), ("01 14", 1, 5)]
