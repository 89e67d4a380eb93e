"""Register queries next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(run(spark, sf_dir))
        QUERIES[name] = tidy
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def once(build: Callable) -> Callable:
    """Build a shared written table once per session and data set; later queries read it."""
    made: dict[tuple[str, str], object] = {}

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = build(spark, sf_dir)
        return made[key]
    return get


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: bigint, double, joined string arrays."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        columns.append(c.alias(f.name))
    return df.select(*columns)
