"""Classifiers on Spark ML: training, cross-validation, comparison, persistence and prediction."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Hashable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from rostra import constants as K
from rostra.operators import metrics, tfidf
from rostra.session import materialize, scratch_path, spread
from rostra.functions import text as tx
from rostra.functions.binding import let
from rostra.functions.vectors import unit

PARALLEL_FITS = 4
ROWS_PER_TASK = 5000
TOLERANCE = 1e-4  # fixed value: stopping tolerance of the linear models
LR, RF, GBT, DEEP = "Logistic Regression", "Random Forest", "Gradient Boosting", "Boosted deep"


def add_class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Balanced weights ``n / (classes * rows of the class)``; they sum to ``n``."""
    weights = class_weights(df, label, name)
    return df.join(F.broadcast(weights), label)


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("__n"))
    total = counts.agg(F.struct(F.sum("__n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.select(label, (total["n"] / (total["k"] * F.col("__n"))).alias(name))


def assembler(features: list[str] | None = None) -> VectorAssembler:
    """Feature vector. Sensitive columns are refused."""
    names = features or K.FEATURE_NAMES
    if any(n.startswith("sensitive_") for n in names):
        raise ValueError("sensitive columns are never features")
    return VectorAssembler(inputCols=names, outputCol="raw_features")


def shortlist_models(rows: int, tree_scale: float = 1.0) -> dict[str, Pipeline]:
    """The four classifiers. ``tree_scale`` shrinks the ensembles for quick trials."""
    trees = lambda n: max(2, int(n * tree_scale))
    common = dict(labelCol="label", featuresCol="features", seed=K.SEED)
    weights = dict(weightCol="weight")
    copy = VectorAssembler(inputCols=["raw_features"], outputCol="features")
    boosted = dict(maxIter=trees(100), maxDepth=3, stepSize=0.1)
    deep = dict(maxIter=trees(300), maxDepth=5, stepSize=0.05, subsamplingRate=0.9, featureSubsetStrategy="0.9")
    return {
        LR: Pipeline(stages=[
            assembler(), StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(labelCol="label", featuresCol="features", maxIter=2000, regParam=1.0 / max(rows, 1),
                               tol=TOLERANCE, standardization=False, **weights)]),
        # Each row keeps the node it is in, in every tree, so a level does not walk 300 trees from their roots. Twelve levels need no checkpoint.
        RF: Pipeline(stages=[assembler(), copy, RandomForestClassifier(
            numTrees=trees(300), maxDepth=12, minInstancesPerNode=3, maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=-1, **common, **weights)]),
        GBT: Pipeline(stages=[assembler(), copy, GBTClassifier(**boosted, **common)]),
        DEEP: Pipeline(stages=[assembler(), copy, GBTClassifier(**deep, **common)]),
    }


def fit_shortlist(train: DataFrame, name: str, tree_scale: float = 1.0) -> PipelineModel:
    weighted = add_class_weights(spread(train, "row_id")).persist()
    try:
        return shortlist_models(weighted.count(), tree_scale)[name].fit(weighted)
    finally:
        weighted.unpersist()


def fit_together(spark: SparkSession, fits: dict[Hashable, Callable[[], object]], at_once: int = PARALLEL_FITS) -> dict[Hashable, object]:
    """The results of the ``fits``, run beside each other: boosting and linear fits are thousands of short jobs one after the other,
    which leave cores to the others. At most ``at_once``, those given last first, as the longest stand last."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(fits[name])) for name in reversed(fits)}
        return {name: running[name].result() for name in fits}


def predict(model: PipelineModel, features: DataFrame, threshold: float = K.SHORTLIST_PROBABILITY) -> DataFrame:
    """Add ``probability`` of a match and ``predicted``, the threshold counted as a match."""
    scored = model.transform(features)
    out = features.columns + ["probability"]
    scored = scored.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1))).select(*out)
    return scored.withColumn("predicted", metrics.thresholded(F.col("probability"), threshold))


def cross_validated_f1(train: DataFrame, name: str, fold: str = "fold", tree_scale: float = 1.0,
                       parallelism: int = PARALLEL_FITS) -> tuple[float, float]:
    """Mean and population deviation of F1 over the given folds: each is judged by a model of the others, ``parallelism`` at a time."""
    weighted = add_class_weights(spread(train, "row_id")).persist()
    try:
        pipeline = shortlist_models(weighted.count(), tree_scale)[name]
        folds = weighted.agg(F.max(fold)).first()[0] + 1
        judge = MulticlassClassificationEvaluator(labelCol="label", metricName="fMeasureByLabel", metricLabel=1.0)

        def judged(k: int) -> float:
            return judge.evaluate(pipeline.fit(weighted.where(F.col(fold) != k)).transform(weighted.where(F.col(fold) == k)))

        found = list(fit_together(train.sparkSession, {k: lambda k=k: judged(k) for k in range(folds)}, parallelism).values())
        return float(np.mean(found)), float(np.std(found))
    finally:
        weighted.unpersist()


def importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, importance)``: tree importances or absolute coefficients, largest first. Fifteen rows."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(K.FEATURE_NAMES, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass
class Comparison:
    table: DataFrame
    models: dict[str, PipelineModel]
    best: str


def compare(train: DataFrame, test: DataFrame, names: list[str] | None = None, tree_scale: float = 1.0,
            threshold: float = K.SHORTLIST_PROBABILITY, with_folds: bool = True, fitted: dict[str, PipelineModel] | None = None) -> Comparison:
    """Fit each model (unless it is among the ``fitted``), cross-validate it, score it on the test rows; the best has the
    highest F1, then AUC."""
    spark = train.sparkSession
    rows, models = [], {}
    for name in names or [LR, RF, GBT, DEEP]:
        began = time.time()
        cv_mean, cv_std = cross_validated_f1(train, name, tree_scale=tree_scale) if with_folds else (None, None)
        models[name] = fitted[name] if fitted and name in fitted else fit_shortlist(train, name, tree_scale)
        scored = predict(models[name], test.select("row_id", "label", *K.FEATURE_NAMES), threshold)
        m = metrics.binary_metrics(scored.select("label", "predicted", "probability"), "label", "predicted", "probability").first()
        rows.append((name, m.accuracy, m.precision, m.recall, m.f1, m.roc_auc, cv_mean, cv_std, time.time() - began))
    table = spark.createDataFrame(
        rows, "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, "
              "cv_f1_mean double, cv_f1_std double, train_seconds double")
    ordered = best_first(table)
    return Comparison(ordered, models, ordered.first().model)


def best_first(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.desc("f1"), F.desc("roc_auc"))


def save_model(spark: SparkSession, model: PipelineModel, path: str, name: str, threshold: float,
               metric_values: dict, importances: dict, vocabulary: DataFrame | None = None,
               trained_rows: int | None = None, source_file: str | None = None) -> None:
    """Model directory with a one-row table beside it (name, threshold, metrics, importances, feature names, trained rows,
    source file) and the fitted vocabulary, so that a loaded model can score new texts."""
    model.write().overwrite().save(f"{path}/model")
    row = [(name, threshold, json.dumps(metric_values), json.dumps(importances), list(K.FEATURE_NAMES), trained_rows, source_file)]
    spark.createDataFrame(row, "name string, threshold double, metrics string, importances string, feature_names array<string>, "
                          "trained_rows long, source_file string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    if vocabulary is not None:
        vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/about")


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/vocabulary")


# --- resume category -----------------------------------------------------------------------------------


def text_vectors(counted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Put ``features``, the TF-IDF vector over the numbered vocabulary, in place of the ``terms`` and ``counts`` of each row.

    The vocabulary must have been fitted with a cap of at most MAX_TERMS_CATEGORY terms, so collecting and broadcasting it
    are bounded; a larger one is an error. Terms are looked up where the rows lie, a batch at a time: nothing is shuffled.
    """
    size = vocabulary.count()
    if size > tfidf.MAX_TERMS_CATEGORY:
        raise ValueError(f"a vocabulary of {size} terms was fitted without a cap")
    numbered = vocabulary.select("term", "idf").orderBy("term").collect()
    shared = counted.sparkSession.sparkContext.broadcast((pa.array([r.term for r in numbered], pa.string()), np.array([r.idf for r in numbered], float)))
    kept = [f for f in counted.schema if f.name not in ("terms", "counts")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        for batch in batches:
            found, flat = batch.column("terms"), batch.column("terms").flatten()
            number = pc.index_in(flat, value_set=terms.cast(flat.type))
            known = number.is_valid()
            # Terms are sorted in a row and numbered in the same order.
            row = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(found), 0).to_numpy())[known.to_numpy(zero_copy_only=False)]
            edges = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32))
            number = number.drop_null()
            parts = (number, batch.column("counts").flatten().filter(known), pa.array(idf[number.to_numpy()]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.ListArray.from_arrays(edges, p) for p in parts)],
                                             names=[*(f.name for f in kept), "indices", "tf", "idf"])

    schema = StructType([*kept, *(StructField(n, ArrayType(t)) for n, t in (("indices", IntegerType()), ("tf", IntegerType()), ("idf", DoubleType())))])
    weights = F.zip_with("tf", "idf", lambda n, idf: (1 + F.log(n)) * idf)
    columns = [f.name for f in kept]
    return sparse_vectors(counted.mapInArrow(look_up, schema).select(*columns, "indices", unit(weights).alias("values")), size)


def sparse_vectors(df: DataFrame, size: int) -> DataFrame:
    """Put Spark ML sparse vectors, as ``features``, in place of ``indices`` and ``values``. They are written as the parts
    that a vector has in a file and read back as vectors."""
    kept = [f for f in df.schema if f.name not in ("indices", "values")]
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values")
    path = scratch_path(df.sparkSession, "vectors")
    df.select(*(f.name for f in kept), parts.alias("features")).write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(StructType([*kept, StructField("features", VectorUDT())])).parquet(path)


def category_models(rows: int) -> dict[str, object]:
    common = dict(labelCol="class_index", featuresCol="features")
    return {
        "Multinomial NB": NaiveBayes(smoothing=0.1, modelType="multinomial", **common),
        "Logistic Regression": LogisticRegression(family="multinomial", regParam=1.0 / (5 * max(rows, 1)), maxIter=3000,
                                                  tol=TOLERANCE, standardization=False, **common),
        "Linear SVM": OneVsRest(classifier=LinearSVC(regParam=1.0 / max(rows, 1), maxIter=1000, tol=TOLERANCE,
                                                     standardization=False, **common),
                                parallelism=PARALLEL_FITS, **common),
    }


@dataclass
class CategoryData:
    train: DataFrame
    test: DataFrame
    labels: list[str]
    rows: int
    vocabulary: DataFrame


def category_data(rows: DataFrame, row_id: str = "row_id", max_terms: int = tfidf.MAX_TERMS_CATEGORY) -> CategoryData:
    """Train and test vectors of ``(row_id, resume, category, split)``; vocabulary fitted on train only."""
    # Written, not cached: terms are several times as long as the texts, and a cached batch of 10,000 long rows is built whole in memory.
    counted = materialize(tfidf.count_terms(rows.select(row_id, "category", "split", tx.clean(F.col("resume")).alias("t")), F.col("t")).drop("t"), "counted", "zstd")
    train_counts = counted.where(F.col("split") == "train")
    vocabulary = tfidf.fit(train_counts, tfidf.document_count(train_counts), 2, max_terms).persist()
    indexer = StringIndexer(inputCol="category", outputCol="class_index", stringOrderType="alphabetAsc").fit(rows)
    # The vectors are in a file; every fit keeps what it reads again, so a copy in memory would push that to disk.
    data = indexer.transform(few_tasks(text_vectors(counted, vocabulary)))
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    return CategoryData(train, test, indexer.labels, train.count(), vocabulary)


def few_tasks(df: DataFrame) -> DataFrame:
    """Tasks of a few thousand rows: every fitting step sends the model to each task and back."""
    tasks = -(-df.count() // ROWS_PER_TASK)
    return df.coalesce(max(1, tasks))


def class_scores(scored: DataFrame, labels: list[str]) -> Column:
    """Class scores: probabilities, or for margins a softmax shifted by the largest one."""
    if "probability" in scored.columns:
        return vector_to_array("probability")
    raw = vector_to_array("rawPrediction")
    shifted = let(F.array_max(raw), lambda top: F.transform(raw, lambda x: F.exp(x - top)))
    return let(shifted, lambda exps: let(
        F.aggregate(exps, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(exps, lambda x: x / total)))


def top_categories(scored: DataFrame, labels: list[str], k: int = 3) -> Column:
    """The ``k`` best (score, category) pairs, best first."""
    names = F.array(*[F.lit(n) for n in labels])
    pairs = F.zip_with(class_scores(scored, labels), names, lambda s, n: F.struct(s.alias("score"), n.alias("category")))
    return F.slice(F.sort_array(pairs, asc=False), 1, k)


def predicted_category(labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in labels]), F.col("prediction").cast("int") + 1)


@dataclass
class CategoryModel:
    """A category model with all that is needed to judge new texts."""
    model: PipelineModel
    labels: list[str]
    vocabulary: DataFrame
    about: DataFrame


def save_category_model(d: CategoryData, model: Model, path: str, name: str, metric_values: dict) -> None:
    """The fitted model, its vocabulary, and a one-row table with name, labels in the order of their numbers, metrics and rows."""
    spark = d.train.sparkSession
    PipelineModel([model]).write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(name, list(d.labels), json.dumps(metric_values), d.rows)], "name string, labels array<string>, metrics string, trained_rows long") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    d.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")


def load_category_model(spark: SparkSession, path: str) -> CategoryModel:
    about = spark.read.parquet(f"{path}/about")
    return CategoryModel(PipelineModel.load(f"{path}/model"), list(about.first().labels), spark.read.parquet(f"{path}/vocabulary"), about)


def predict_categories(m: CategoryModel, texts: DataFrame, row_id: str = "row_id", text: str = "resume", k: int = 3) -> DataFrame:
    """``row_id`` and ``predicted_category``, the ``k`` best (score, category) pairs, for each row of ``texts (row_id, resume)``."""
    counted = tfidf.count_terms(texts.select(row_id, tx.clean(F.col(text)).alias("t")), F.col("t")).drop("t")
    scored = m.model.transform(text_vectors(counted, m.vocabulary))
    return scored.select(row_id, top_categories(scored, m.labels, k).alias("predicted_category"))


def compare_categories(d: CategoryData, names: list[str] | None = None, given: dict[str, Model] | None = None) -> Comparison:
    """Fit each category model (or those named, unless it is ``given``) and score it on the test rows; the best has the highest macro F1."""
    rows, fitted = [], {}
    for name, estimator in category_models(d.rows).items():
        if names is not None and name not in names:
            continue
        began = time.time()
        fitted[name] = given[name] if given and name in given else estimator.fit(d.train)
        scored = fitted[name].transform(d.test).select("category", predicted_category(d.labels).alias("predicted"))
        m = metrics.multiclass_metrics(scored, "category", "predicted").first()
        rows.append((name, m.accuracy, m.macro_f1, m.weighted_f1, time.time() - began))
    spark = d.train.sparkSession
    table = spark.createDataFrame(rows, "model string, accuracy double, macro_f1 double, weighted_f1 double, train_seconds double") \
        .orderBy(F.desc("macro_f1"), "model")
    return Comparison(table, fitted, table.first().model)
