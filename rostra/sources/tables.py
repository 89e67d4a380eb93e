"""Readers and writers for the tables the engine works on."""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rostra import constants as K
from rostra.sources.records import read_records

SPLITS_PER_CORE, SPLITS_PER_TASK = 8, 64  # of small files
USAGE_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()), T.StructField("purpose", T.StringType()),
    T.StructField("provider", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("ok", T.BooleanType()), T.StructField("prompt_chars", T.LongType()),
    T.StructField("output_chars", T.LongType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("pii_masked", T.BooleanType())])
QUESTION_SCHEMA = T.StructType([
    T.StructField("question", T.StringType()), T.StructField("expected_doc", T.StringType())])
INTERVIEWER_SCHEMA = T.StructType([
    T.StructField("interviewer_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("primary_role", T.StringType()), T.StructField("level", T.StringType()),
    T.StructField("skills", T.StringType()), T.StructField("interviews_this_week", T.IntegerType()),
    T.StructField("max_per_week", T.IntegerType()), T.StructField("data_source", T.StringType())])


def normalise_header(name: str) -> str:
    """Lower case, runs of other characters become one underscore, none at the ends."""
    return re.sub(r"[^a-z0-9]+", "_", str(name).strip().lower()).strip("_")


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def find_column(columns: list[str], field: str) -> str | None:
    """First accepted header of a standard field that is present."""
    return next((alias for alias in K.HEADER_ALIASES[field] if alias in columns), None)


def alias_columns(df: DataFrame, fields: list[str]) -> DataFrame:
    """Select the standard fields under their standard names; a missing one is an error."""
    found = {field: find_column(df.columns, field) for field in fields}
    missing = [field for field, column in found.items() if column is None]
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}")
    return df.select(*[F.col(column).alias(field) for field, column in found.items()])


def file_encodings(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file: utf-8 when every line is valid, else latin-1. Lines are checked in parallel."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"))
        .groupBy("file").agg(F.bool_and("valid").alias("valid"))
        .select("file", F.when(F.col("valid"), "UTF-8").otherwise("ISO-8859-1").alias("encoding")))


CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Quoted CSV files of one layout, each in its own encoding.

    Fields may hold line breaks; a large file is still read by many tasks (see ``records``). Without a schema all columns
    are text, named by the header of the first file.
    """
    rows = read_records(spark, path)
    if schema is None:
        first = rows.where("head").agg(F.min(F.struct("file", "record")).alias("first")).first().first
        if first is None:
            raise FileNotFoundError(f"no CSV files under {path}")
        names = next(csv.reader(io.StringIO(first.record, newline="")))
        names = [n or f"_c{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n if names.count(n) == 1 else f"{n}{i}", T.StringType()) for i, n in enumerate(names)])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = F.from_csv("record", _ddl(schema), CSV_OPTIONS)
    return rows.where("NOT head").select(fields.alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """Header line of every CSV file under a folder, as normalised names."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value",
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"))
        .where(F.col("block") == 0))
    first = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    tidy = lambda h: F.trim(F.regexp_replace(F.lower(F.trim(h)), "[^a-z0-9]+", "_"), F.lit("_"))
    # A quoted name may hold commas.
    names = F.regexp_extract_all("header", F.lit('(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return first.select("file", F.transform(names, tidy).alias("columns"))


def discover(spark: SparkSession, path: str, required: list[str], forbidden: list[str] | None = None,
             explicit: str | None = None) -> DataFrame:
    """The first file by sorted path whose header has every required and no forbidden field."""
    if explicit:
        return spark.range(1).select(F.lit(explicit).alias("file"))
    has = lambda field: F.arrays_overlap(
        "columns", F.array(*[F.lit(a) for a in K.HEADER_ALIASES[field]]))
    found = csv_headers(spark, path)
    for field in required:
        found = found.where(has(field))
    for field in forbidden or []:
        found = found.where(~has(field))
    return found.agg(F.min("file").alias("file")).where(F.col("file").isNotNull())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Markdown and text documents under a folder, read-me files left out, in path order.

    Spark counts every small file as one of several MB, which would give a task a handful of files: splits are put together.
    """
    docs = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    docs = docs.coalesce(max(SPLITS_PER_CORE * spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions() // SPLITS_PER_TASK))
    name = F.lower(F.col("_metadata.file_name"))
    return (
        docs.where(name.rlike(r"\.(md|txt)$") & ~name.startswith("readme"))
        .select(F.col("_metadata.file_name").alias("doc"), F.col("_metadata.file_path").alias("doc_ord"),
                F.col("value").alias("text")))


def read_usage_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(USAGE_LOG_SCHEMA).json(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of questions; the multi-line reader turns array items into rows."""
    return spark.read.schema(QUESTION_SCHEMA).option("multiLine", True).json(path)


def read_interviewers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').schema(INTERVIEWER_SCHEMA).csv(path)


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """An uploaded CSV: headers trimmed and lower-cased, a ``resume`` column is required."""
    raw = read_csv(spark, path)
    df = raw.toDF(*[c.lower().strip() for c in raw.columns])
    if "resume" not in df.columns:
        raise ValueError("the CSV needs a column named 'resume'")
    return df


def write_report_csv(df: DataFrame, path: str, digits: int = 4) -> None:
    """Write a report with every floating-point column rounded."""
    out = df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name) for f in df.schema])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.select("skill").write.mode("overwrite").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A saved vocabulary, or the base skills where none was saved."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.read.schema("skill string").parquet(path)
    return base_vocabulary(spark)


def base_vocabulary(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in K.BASE_SKILLS])).alias("skill"))
