"""Fitted models: quality on separable data, comparison, and what is saved."""

import math
import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rostra import constants as K
from rostra.operators import models, tfidf


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        label = int(rng.random() < 0.35)
        values = [rng.gauss(1.2 * label if k < 3 else 0.0, 1.0) for k in range(len(K.FEATURE_NAMES))]
        rows.append((i, label, i % 5, *values))
    df = spark.createDataFrame(rows, "row_id long, label int, fold int, " + ", ".join(f"{n} double" for n in K.FEATURE_NAMES))
    return df.where("row_id < 300").cache(), df.where("row_id >= 300").cache()


def test_all_shortlist_models_are_compared(spark, features):
    train, test = features
    got = models.compare(train, test, tree_scale=0.05)
    rows = got.table.collect()
    assert {r.model for r in rows} == {models.LR, models.RF, models.GBT, models.DEEP} and got.best == rows[0].model
    assert [(-r.f1, -r.roc_auc) for r in rows] == sorted((-r.f1, -r.roc_auc) for r in rows)
    assert all(r.roc_auc > 0.85 and r.f1 > 0.6 and r.cv_f1_mean > 0.6 and 0 <= r.cv_f1_std < 0.3 for r in rows)
    for name, model in got.models.items():
        top = [r.feature for r in models.importance(spark, model).collect()]
        assert len(top) == len(K.FEATURE_NAMES) and len(set(top[:4]) & set(K.FEATURE_NAMES[:3])) >= 2


def test_the_forest_keeps_nodes_with_the_rows_and_grows_the_same_trees(spark, features):
    weighted = models.add_class_weights(features[0]).persist()
    grown = []
    for keep in (True, False):
        pipeline = models.shortlist_models(300, 0.05)[models.RF]
        forest = pipeline.getStages()[-1]
        assert forest.getCacheNodeIds()
        forest.setCacheNodeIds(keep)
        grown.append(pipeline.fit(weighted).stages[-1].toDebugString.split("\n", 1)[1])
    weighted.unpersist()
    assert grown[0] == grown[1] and "Tree 14" in grown[0]


def test_fits_run_beside_each_other(spark):
    both = threading.Barrier(2, timeout=30)

    def fit(name):
        both.wait()  # passed only while the other fit runs too
        return name, spark.range(3).count()
    assert list(models.fit_together(spark, {n: lambda n=n: fit(n) for n in "ab"}).items()) == [(n, (n, 3)) for n in "ab"]
    with pytest.raises(ZeroDivisionError):
        models.fit_together(spark, {"a": lambda: 1, "b": lambda: 1 / 0})


@pytest.mark.parametrize("name", [models.LR, models.GBT])
def test_folds_are_judged_by_models_of_the_others(spark, features, name):
    weighted = models.add_class_weights(features[0]).persist()
    pipeline, found = models.shortlist_models(300, 0.05)[name], []
    for k in range(5):
        scored = pipeline.fit(weighted.where(F.col("fold") != k)).transform(weighted.where(F.col("fold") == k))
        pairs = Counter((r.label, int(r.prediction)) for r in scored.select("label", "prediction").collect())
        found.append(2 * pairs[1, 1] / (2 * pairs[1, 1] + pairs[0, 1] + pairs[1, 0]))
    mean, std = models.cross_validated_f1(features[0], name, tree_scale=0.05)
    assert mean == pytest.approx(sum(found) / 5, abs=0.02) and std == pytest.approx((sum((f - sum(found) / 5) ** 2 for f in found) / 5) ** 0.5, abs=0.02)


def test_the_comparison_cross_validates_all_models(spark, features, monkeypatch):
    """the query leaves out no folds."""
    from checks import q_models
    small = models.shortlist_models
    monkeypatch.setattr(models, "shortlist_models", lambda rows, tree_scale=1.0: small(rows, 0.02))
    monkeypatch.setattr(q_models, "_train_test", lambda spark, sf: features)
    rows = q_models.ml_model_comparison(spark, "rows of this test").collect()
    assert len(rows) == 4 and all(0.4 < r.cv_f1_mean <= 1 and 0 <= r.cv_f1_std < 0.3 for r in rows)


def test_a_loaded_model_equals_the_saved_one(spark, features, tmp_path):
    train, test = features
    fitted = models.fit_shortlist(train, models.LR)
    models.save_model(spark, fitted, str(tmp_path), models.LR, 0.4, {"f1": 0.7}, {"x": 1.0}, spark.createDataFrame([("a", 1.5)], "term string, idf double"), 300, "there.csv")
    loaded, about = models.load_model(spark, str(tmp_path))
    row = about.first()
    assert (row["name"], row.threshold, row.trained_rows, row.source_file, row.feature_names) == (models.LR, 0.4, 300, "there.csv", K.FEATURE_NAMES)
    one, two = (models.predict(m, test, 0.4).orderBy("row_id").select("row_id", "probability", "predicted").collect() for m in (fitted, loaded))
    assert one == two and all((r.probability >= 0.4) == (r.predicted == 1) for r in one)
    assert models.load_vocabulary(spark, str(tmp_path)).collect() == [("a", 1.5)]


@pytest.fixture(scope="module")
def category_data(spark):
    rng = random.Random(8)
    topics = {"Cook": "salt pan oven bread soup knife".split(), "Pilot": "runway wing fuel tower cockpit radio".split(), "Nurse": "ward patient dose shift bandage clinic".split()}
    rows = []
    for i in range(150):
        name = sorted(topics)[i % 3]
        words = [rng.choice(topics[name]) if rng.random() < 0.6 else rng.choice("alpha beta gamma delta".split()) for _ in range(25)]
        rows.append((i, " ".join(words), name, "test" if i % 5 == 0 else "train"))
    return models.category_data(spark.createDataFrame(rows, "row_id long, resume string, category string, split string"))


def test_all_category_models_are_compared(category_data):
    rows = models.compare_categories(category_data).table.collect()
    assert {r.model for r in rows} == set(models.category_models(1)) and all(r.macro_f1 > 0.9 and r.accuracy > 0.9 for r in rows)
    assert [-r.macro_f1 for r in rows] == sorted(-r.macro_f1 for r in rows)


@pytest.mark.parametrize("name", ["Multinomial NB", "Linear SVM"])
def test_a_loaded_category_model_judges_new_texts(spark, category_data, tmp_path, name):
    fitted = models.category_models(category_data.rows)[name].fit(category_data.train)
    models.save_category_model(category_data, fitted, str(tmp_path), name, {"macro_f1": 1.0})
    loaded = models.load_category_model(spark, str(tmp_path))
    assert loaded.labels == ["Cook", "Nurse", "Pilot"] and loaded.about.first()["name"] == name
    texts = spark.createDataFrame([(1, "The oven and the pan: bread, soup"), (2, "RUNWAY tower, fuel"), (3, "")], "row_id long, resume string")
    got = {r.row_id: r.predicted_category for r in models.predict_categories(loaded, texts).collect()}
    assert got[1][0].category == "Cook" and got[2][0].category == "Pilot" and len(got[3]) == 3
    assert all(abs(sum(p.score for p in v) - 1) < 1e-9 and [p.score for p in v] == sorted((p.score for p in v), reverse=True) for v in got.values())


def test_summary_names_the_category(spark, category_data):
    from rostra.plans import screening
    fitted = models.category_models(category_data.rows)["Multinomial NB"].fit(category_data.train)
    m = models.CategoryModel(models.PipelineModel([fitted]), category_data.labels, category_data.vocabulary, None)
    resumes = spark.createDataFrame([(1, "Python and SQL for 5 years. The oven, the pan, bread and soup " * 3)], "candidate_id long, resume string")
    jobs = spark.createDataFrame([(1, "We want Python and Spark, 3 years", "Cook")], "job_id long, job_description string, job_role string")
    pool = spark.createDataFrame([(0, "Ann", "Cook", "Senior", "python; sql", 1, 4, "x")],
                                 "pool_ord long, name string, primary_role string, level string, skills string, interviews_this_week int, max_per_week int, data_source string")
    row = screening.screen_table(spark.createDataFrame([(7, 1, 1)], "application_id long, candidate_id long, job_id long"), resumes, jobs, pool, categories=m).first()
    assert row.predicted_category[0].category == "Cook" and "most aligned with Cook" in row.summary


def test_texts_are_split_without_moving_twice(spark):
    """the rows and splits of the plain way, also where ids repeat, and vectors are not kept in memory besides their file."""
    from rostra.operators import loading
    rows = [(i if i % 7 else i // 2 * 2, f"text number {i // 2} " * 6, f" {'abc'[i % 3]} ") for i in range(120)] + [(None, "without id " * 9, "a"), (500, "short", "a"), (501, "rare class " * 9, "z"), (502, None, "a")]
    raw = spark.createDataFrame(rows, "row_id long, resume string, category string").repartition(3)
    plain = loading.stratified_split(loading.keep_frequent_classes(loading.load_resume_category(raw)).where("category IS NOT NULL"), "category", "row_id")
    got = loading.split_categories(raw)

    def table(df, *columns):
        return Counter(tuple(r) for r in df.select(*columns).collect())
    assert table(got, "row_id", "resume", "category") == table(plain, "row_id", "resume", "category") and got.count() > 50
    assert table(got, "row_id", "category", "split") == table(plain, "row_id", "category", "split")
    assert "place" not in got.columns
    d = models.category_data(got, max_terms=50)
    assert d.train.storageLevel.useMemory is False and "InMemoryTableScan" not in d.train._jdf.queryExecution().executedPlan().toString()


def test_vectors_are_looked_up_where_the_rows_lie(spark):
    """No shuffle, and a row has the vector of its own text, however often its id occurs."""
    rows = [(1, "bread soup bread"), (1, "soup knife"), (None, "knife"), (2, ""), (3, None), (4, "unknown words")]
    counted = tfidf.count_terms(spark.createDataFrame(rows, "row_id long, t string").repartition(2), F.col("t"))
    vocabulary = spark.createDataFrame([("soup", 1.5), ("bread", 2.0), ("bread soup", 3.0), ("knife", 1.0)], "term string, idf double")
    vectors = models.text_vectors(counted, vocabulary)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    idf = {"bread": 2.0, "bread soup": 3.0, "knife": 1.0, "soup": 1.5}
    got = {(r.row_id, r.t): r.features for r in vectors.collect()}
    assert len(got) == len(rows)
    for (row_id, t) in rows:
        words = (t or "").split()
        counts = Counter(w for w in words + [" ".join(p) for p in zip(words, words[1:])] if w in idf)
        raw = [(1 + math.log(counts[w])) * idf[w] if counts[w] else 0.0 for w in idf]
        length = math.sqrt(sum(x * x for x in raw)) or 1.0
        assert got[row_id, t].size == 4 and got[row_id, t].toArray().tolist() == pytest.approx([x / length for x in raw])
