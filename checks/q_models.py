"""Spark ML models. Fits differ from other engines by design, so these are checked by row count and by tests of range."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from checks import data
from checks.registry import once, query
from rostra import constants as K
from rostra.operators import loading, models
from rostra.session import materialize, scratch_path
from rostra.sources.fixtures import view


@once
def training_table(spark, sf):
    """Features of the labelled applications with split and fold; written once, read by every fit."""
    split = materialize(loading.stratified_split(data.slim_loaded(spark, sf), "label", "row_id"), "split")
    train_rows = split.where("split = 'train'")
    folds = loading.stratified_folds(train_rows.select("row_id", "label"), "label", "row_id").select("row_id", "fold")
    feats = data.feature_table(split, spark, sf, ["label", "split", "sensitive_age", "sensitive_segment"], F.col("split") == "train")
    return materialize(feats.join(folds, "row_id", "left"), "features")


def _train_test(spark, sf):
    t = training_table(spark, sf)
    return t.where("split = 'train'"), t.where("split = 'test'")


#: Each model is fitted once per session and data set, with all its trees; the queries share the fits.
SHORTLIST = {name: once(lambda spark, sf, name=name: models.fit_shortlist(_train_test(spark, sf)[0], name))
             for name in (models.LR, models.RF, models.GBT, models.DEEP)}


def _fit_query(name, model):
    @query(name)
    def run(spark, sf):
        scored = models.predict(SHORTLIST[model](spark, sf), _train_test(spark, sf)[1].select("row_id", "label", *K.FEATURE_NAMES))
        return scored.select("row_id", "label", "probability", "predicted")
    return run


_fit_query("ml_shortlist_lr", models.LR)
_fit_query("ml_shortlist_rf", models.RF)
_fit_query("ml_shortlist_gbt", models.GBT)
_fit_query("ml_shortlist_xgb", models.DEEP)


@query("ml_cv_f1")
def ml_cv_f1(spark, sf):
    train, _ = _train_test(spark, sf)
    mean, std = models.cross_validated_f1(train, models.LR)
    return spark.createDataFrame([(models.LR, mean, std)], "model string, cv_f1_mean double, cv_f1_std double")


def _shortlist_fits(spark, sf):
    return models.fit_together(spark, {name: lambda fit=fit: fit(spark, sf) for name, fit in SHORTLIST.items()})


@once
def _comparison(spark, sf):
    """All four models: on the test rows, and cross-validated on the five folds of the training rows."""
    train, test = _train_test(spark, sf)
    return models.compare(train, test, fitted=_shortlist_fits(spark, sf))


@query("ml_model_comparison")
def ml_model_comparison(spark, sf):
    return _comparison(spark, sf).table.drop("train_seconds")


@query("sort_models")
def sort_models(spark, sf):
    """Both model tables, best first: all shortlist models by F1 and area, all category models by macro F1."""
    # What the fits share is built first; then they run beside each other, and the comparisons find them made.
    _train_test(spark, sf), _category_data(spark, sf)
    models.fit_together(spark, {name: lambda fit=fit: fit(spark, sf) for name, fit in {**SHORTLIST, **{f"category {name}": fit for name, fit in CATEGORY.items()}}.items()})
    # Places follow from the test rows alone; the folds are in ml_model_comparison.
    shortlist = models.compare(*_train_test(spark, sf), with_folds=False, fitted=_shortlist_fits(spark, sf)).table.select(
        F.lit("shortlist").alias("kind"), "model", F.row_number().over(Window.orderBy(F.desc("f1"), F.desc("roc_auc"))).alias("place"), "f1")
    fits = {name: fit(spark, sf) for name, fit in CATEGORY.items()}
    category = models.compare_categories(_category_data(spark, sf), given=fits).table.select(
        F.lit("category").alias("kind"), "model", F.row_number().over(Window.orderBy(F.desc("macro_f1"), "model")).alias("place"), F.col("macro_f1").alias("f1"))
    return shortlist.unionByName(category)


@query("sort_importance")
def sort_importance(spark, sf):
    return models.importance(spark, SHORTLIST[models.LR](spark, sf))


@query("ml_predict_batch")
def ml_predict_batch(spark, sf):
    return models.predict(SHORTLIST[models.LR](spark, sf), _train_test(spark, sf)[1].select("row_id", *K.FEATURE_NAMES))


@query("sink_models")
def sink_models(spark, sf):
    train, test = _train_test(spark, sf)
    fitted = SHORTLIST[models.LR](spark, sf)
    path = scratch_path(spark, "model")
    models.save_model(spark, fitted, path, models.LR, K.SHORTLIST_PROBABILITY, {"rows": train.count()},
                      {r.feature: r.importance for r in models.importance(spark, fitted).collect()},
                      data.fitted(data.slim_loaded(spark, sf), spark, sf)[0], train.count(), f"{sf}/orders.parquet")
    loaded, about = models.load_model(spark, path)
    if models.load_vocabulary(spark, path).count() == 0:
        raise ValueError("the saved model has no vocabulary")
    scored = models.predict(loaded, test.select("row_id", *K.FEATURE_NAMES))
    return scored.select("row_id", "probability", "predicted", about.select("name").scalar().alias("name"))


@query("sink_category_model")
def sink_category_model(spark, sf):
    """A saved and loaded category model judges the test texts."""
    d, path = _category_data(spark, sf), scratch_path(spark, "category")
    models.save_category_model(d, CATEGORY["Multinomial NB"](spark, sf), path, "Multinomial NB", {"rows": d.rows})
    loaded = models.load_category_model(spark, path)
    texts = _category_split(spark, sf).where("split = 'test'")
    return models.predict_categories(loaded, texts).select("row_id", F.posexplode("predicted_category").alias("pos", "t")) \
        .select("row_id", (F.col("pos") + 1).alias("place"), "t.category", "t.score")


@once
def _category_split(spark, sf):
    return loading.split_categories(view(spark, sf, "v_resume_category"))


@once
def _category_data(spark, sf):
    return models.category_data(_category_split(spark, sf))


def _fit_category(spark, sf, name):
    d = _category_data(spark, sf)
    return models.category_models(d.rows)[name].fit(d.train)


CATEGORY = {name: once(lambda spark, sf, name=name: _fit_category(spark, sf, name)) for name in ("Multinomial NB", "Logistic Regression", "Linear SVM")}


def _category_query(name, model):
    @query(name)
    def run(spark, sf):
        d = _category_data(spark, sf)
        scored = CATEGORY[model](spark, sf).transform(d.test)
        return scored.select("row_id", "category", models.predicted_category(d.labels).alias("predicted"))
    return run


_category_query("ml_category_nb", "Multinomial NB")
_category_query("ml_category_lr", "Logistic Regression")
_category_query("ml_category_svm", "Linear SVM")


def _topk(spark, sf, model):
    d = _category_data(spark, sf)
    scored = CATEGORY[model](spark, sf).transform(d.test)
    return scored.select("row_id", F.posexplode(models.top_categories(scored, d.labels)).alias("pos", "t")) \
        .select("row_id", (F.col("pos") + 1).alias("place"), "t.category", "t.score")


query("ml_category_topk")(lambda spark, sf: _topk(spark, sf, "Linear SVM"))
query("win_topk_category")(lambda spark, sf: _topk(spark, sf, "Multinomial NB"))
