"""Selection rates per sensitive group and the four-fifths rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rostra import constants as K
from rostra.functions.numbers import round_scaled
from rostra.operators.loading import is_numeric


def age_group(age: Column) -> Column:
    """Right-closed bins (0,25], (25,35], (35,45], (45,120]; anything else is ``nan``."""
    return (F.when((age > 0) & (age <= 25), "<25").when((age > 25) & (age <= 35), "25-34")
            .when((age > 35) & (age <= 45), "35-44").when((age > 45) & (age <= 120), "45+").otherwise("nan"))


def audited_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("sensitive_")
            and c.removeprefix("sensitive_") not in K.UNAUDITED_COLUMNS]


def group_rates(df: DataFrame, predicted: str, min_rows: int = K.MIN_GROUP_ROWS) -> DataFrame:
    """``(attr, grp, selection_rate, group_size)`` of groups with enough rows, all attributes in one pass."""
    entries = []
    for column in audited_columns(df):
        attr = column.removeprefix("sensitive_")
        value = age_group(F.col(column).try_cast("double")) if attr == "age" and is_numeric(df, column) \
            else F.coalesce(F.col(column).cast("string"), F.lit("nan"))
        entries.append(F.struct(F.lit(attr).alias("attr"), value.alias("grp")))
    return (
        df.select(F.col(predicted).alias("p"), F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.attr", "e.grp").agg(F.avg("p").alias("selection_rate"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= min_rows))


def audit(rates: DataFrame) -> DataFrame:
    """Per attribute with two or more groups: lowest over highest rate, and whether it reaches 0.8."""
    ratio = F.when(F.col("high") > 0, F.col("low") / F.col("high")).otherwise(F.lit(float("nan")))
    bounds = rates.groupBy("attr").agg(
        F.min("selection_rate").alias("low"), F.max("selection_rate").alias("high"), F.count("*").alias("groups"))
    return bounds.where(F.col("groups") >= 2).select(
        "attr", round_scaled(ratio, 3).alias("disparate_impact_ratio"),
        # NaN sorts above every number in Spark, so it is ruled out before the comparison.
        (~F.isnan(ratio) & (ratio >= K.FOUR_FIFTHS)).alias("passes_four_fifths_rule"))
