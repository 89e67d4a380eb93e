"""Standardise raw tables: labels, filters, duplicates, load report, sampling and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rostra import constants as K
from rostra.operators.ordering import add_rank
from rostra.session import materialize
from rostra.sources.tables import find_column


def as_text(column: Column) -> Column:
    """Text form in which a missing value reads ``nan``."""
    return F.coalesce(column.cast("string"), F.lit("nan"))


def is_numeric(df: DataFrame, column: str) -> bool:
    """Whether a column holds numbers: by its type or, as text from a CSV file, because every value that is there parses."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return True
    if not isinstance(kind, T.StringType):
        return False
    value = F.trim(F.col(f"`{column}`"))
    there = df.where(value.isNotNull() & (value != "") & (F.lower(value) != "nan"))
    found = there.agg(F.count("*").alias("n"), F.count(value.try_cast("double")).alias("numbers")).first()
    return found.n > 0 and found.n == found.numbers


def binary_label(column: Column, numeric: bool) -> Column:
    """1 / 0 label. Numbers: above zero. Words: looked up in the two word lists, null when in neither."""
    if numeric:
        number = F.nanvl(F.coalesce(column.try_cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.when(number > 0, 1).otherwise(0)
    word = F.lower(F.trim(as_text(column)))
    return F.when(word.isin(K.POSITIVE_LABELS), 1).when(word.isin(K.NEGATIVE_LABELS), 0)


def standardise_screening(raw: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Project a table with normalised headers to the screening schema. Sensitive columns only get a prefix."""
    pick = {field: find_column(raw.columns, field) for field in ("resume", "job_description", "label", "job_role")}
    numeric = is_numeric(raw, pick["label"])
    role = as_text(F.col(pick["job_role"])) if pick["job_role"] else F.lit(K.UNKNOWN_ROLE)
    sensitive = [c for c in K.SENSITIVE_COLUMNS if c in raw.columns]
    return raw.select(
        F.col(row_id),
        as_text(F.col(pick["resume"])).alias("resume"),
        as_text(F.col(pick["job_description"])).alias("job_description"),
        binary_label(F.col(pick["label"]), numeric).alias("label"),
        role.alias("job_role"),
        *[F.col(c).alias(f"sensitive_{c}") for c in sensitive])


def usable_screening(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull()
                    & (F.length("resume") > K.MIN_SCREENING_CHARS)
                    & (F.length("job_description") > K.MIN_SCREENING_CHARS))


def dedup_pairs(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Keep the first row of each (resume, job description).

    Only two digests and an id are grouped, and the minimum is combined before the shuffle, so a pair that
    fills a third of the table costs no more than any other.
    """
    first = (
        df.select(F.sha2("resume", 256).alias("r"), F.sha2("job_description", 256).alias("j"), row_id)
        .groupBy("r", "j").agg(F.min(row_id).alias(row_id)).select(row_id))
    return df.join(first, row_id, "left_semi")


def load_screening(standard: DataFrame, row_id: str = "row_id") -> DataFrame:
    return dedup_pairs(usable_screening(standard), row_id)


def usable_categories(raw: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Resume and category, texts above 50 characters."""
    resume, category = find_column(raw.columns, "resume"), find_column(raw.columns, "category")
    df = raw.select(row_id, as_text(F.col(resume)).alias("resume"),
                    F.trim(as_text(F.col(category))).alias("category"))
    return df.where(F.length("resume") > K.MIN_CATEGORY_CHARS)


def first_of_equal(usable: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Ids of the first of each group of equal rows."""
    return (usable.select(F.sha2("resume", 256).alias("r"), "category", row_id)
            .groupBy("r", "category").agg(F.min(row_id).alias(row_id)).select(row_id))


def load_resume_category(raw: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Resume and category, texts above 50 characters, equal rows once (the first by id)."""
    df = usable_categories(raw, row_id)
    return df.join(first_of_equal(df, row_id), row_id, "left_semi")


def split_categories(raw: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The rows of ``load_resume_category`` in frequent classes, with their ``split``.

    Texts are written with a place, all is settled on rows without texts, and the texts move once, to meet the result by place.
    """
    texts = materialize(usable_categories(raw, row_id).withColumn("place", F.monotonically_increasing_id()), "texts", "zstd")
    rows = texts.select("place", row_id, "category").join(first_of_equal(texts, row_id), row_id, "left_semi")
    split = stratified_split(keep_frequent_classes(rows).where("category IS NOT NULL"), "category", row_id)
    return materialize(texts.select("place", "resume").join(split, "place").select(row_id, "resume", "category", "split"), "categories", "zstd")


def load_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows kept, rows dropped and the positive rate, as one row."""
    return (
        before.select(F.lit(1).alias("n_in"), F.lit(0).alias("n_out"), F.lit(None).cast("int").alias("label"))
        .unionByName(after.select(F.lit(0).alias("n_in"), F.lit(1).alias("n_out"), F.col("label").cast("int")))
        .agg(F.sum("n_in").alias("rows_before"), F.sum("n_out").alias("rows_after"),
             (F.sum("n_in") - F.sum("n_out")).alias("rows_dropped"), F.avg("label").alias("positive_rate")))


def frequent_classes(df: DataFrame, column: str = "category", at_least: int = K.MIN_CLASS_ROWS) -> DataFrame:
    """Classes with enough rows."""
    return df.groupBy(column).agg(F.count("*").alias("rows")).where(F.col("rows") >= at_least).select(column)


def keep_frequent_classes(df: DataFrame, column: str = "category", at_least: int = K.MIN_CLASS_ROWS) -> DataFrame:
    return df.join(frequent_classes(df, column, at_least), column, "left_semi")


def sample_rows(df: DataFrame, n: int, row_id: str, seed: int = K.SEED) -> DataFrame:
    """``n`` rows in an arithmetic order fixed by the seed; the same rows on every run."""
    return df.orderBy(shuffle_key(row_id, seed), row_id).limit(n)


def shuffle_key(row_id: str, seed: int = K.SEED) -> Column:
    """Arithmetic shuffle order that any SQL engine can repeat."""
    return F.pmod(F.col(row_id) * 7919 + seed, F.lit(100003))


def stratified_split(df: DataFrame, label: str, row_id: str, test_share: float = K.TEST_SHARE,
                     seed: int = K.SEED) -> DataFrame:
    """Add ``split``: the first share of each label in shuffle order is ``test``, the rest ``train``."""
    ranked = add_rank(df, [label], [shuffle_key(row_id, seed), F.col(row_id)], "__rank", "__size")
    test_rows = F.round(F.col("__size") * test_share)
    return (ranked.withColumn("split", F.when(F.col("__rank") <= test_rows, "test").otherwise("train"))
            .drop("__rank", "__size"))


def stratified_folds(df: DataFrame, label: str, row_id: str, folds: int = K.FOLDS, seed: int = K.SEED) -> DataFrame:
    """Add ``fold`` (0 to folds - 1) so that each fold has its share of every label."""
    ranked = add_rank(df, [label], [shuffle_key(row_id, seed), F.col(row_id)], "__rank")
    return (ranked.withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int")).drop("__rank"))
