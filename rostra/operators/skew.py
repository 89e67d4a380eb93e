"""Equi-join in which a few keys may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def spread_join(facts: DataFrame, keyed: DataFrame, key: str, spread_by: str, rows: str, unique: bool = False,
                hot_share: float = 1e-4, how: str = "inner") -> DataFrame:
    """Join ``facts`` to ``keyed`` on ``key``, spreading the rows of hot keys over as many tasks as they need.

    ``unique`` says that ``keyed`` has each key once. ``keyed[rows]`` states how many fact rows a key has (a document
    frequency, say). A key is hot when it holds at least ``hot_share`` of all of them, so there are at most
    ``1 / hot_share`` hot keys however large the input is; only that list is broadcast. A hot key gets one salt for each
    ``hot_share`` of the rows it holds: its rows take a salt from ``spread_by`` and the matching ``keyed`` row is repeated
    once per salt, at most ``2 / hot_share`` copies over all keys. Every match is kept. ``how`` is inner or left.
    """
    counts = keyed.select(key, rows) if unique else keyed.groupBy(key).agg(F.max(rows).alias(rows))
    unit = F.greatest(counts.agg(F.sum(rows)).scalar() * F.lit(hot_share), F.lit(1))
    hot = counts.where(F.col(rows) > unit).select(key, F.ceil(F.col(rows) / unit).cast("int").alias("__salts"))
    left = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("__salts")), F.lit(0)).cast("int"))
        .drop("__salts"))
    right = (
        keyed.drop(rows).join(F.broadcast(hot), key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
        .drop("__salts"))
    return left.join(right, [key, "__salt"], how).drop("__salt")
