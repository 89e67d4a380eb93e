"""Exact positions and running totals over groups of any size.

A window over one huge group runs in one task. Here rows are range-partitioned on the whole sort key, so a
group that holds most of the rows is spread over many partitions; positions inside a partition come from the
sorted order, and each group needs only one offset per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rostra.session import materialize

PART_SHIFT = 33  # monotonically_increasing_id keeps the partition number above 33 bits


def _sorted_parts(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    keys = [F.col(g) for g in group] + order
    # Range bounds come from a sample of the input, which would compute it twice: write it first.
    placed = (
        materialize(df, "unsorted").repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", PART_SHIFT))
        .withColumn("__pos", F.col("__id").bitwiseAND(F.lit((1 << PART_SHIFT) - 1)))
        .drop("__id"))
    return materialize(placed, "sorted")


def _earlier(group: list[str]):
    """Frame over the parts of one group that come before this one: at most one row per partition."""
    return Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)


def add_rank(df: DataFrame, group: list[str], order: list[Column], rank: str,
             size: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group, and the group size on request.

    ``order`` must be total (end it with an id).
    """
    grouped = group or ["__all"]
    base = df if group else df.withColumn("__all", F.lit(0))
    placed = _sorted_parts(base, grouped, order)
    parts = placed.groupBy(*grouped, "__part").agg(F.min("__pos").alias("__first"), F.count("*").alias("__rows"))
    offsets = parts.select(
        *grouped, "__part", "__first",
        F.coalesce(F.sum("__rows").over(_earlier(grouped)), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy(*grouped)).alias("__size"))
    joined = placed.join(offsets, [*grouped, "__part"])
    out = joined.withColumn(rank, F.col("__pos") - F.col("__first") + F.col("__before") + 1)
    if size:
        out = out.withColumn(size, F.col("__size"))
    keep = [c for c in df.columns] + [rank] + ([size] if size else [])
    return out.select(*keep)


def add_running_sums(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add running totals in the given order: ``{"pos": "cum_pos"}`` adds ``cum_pos`` and ``cum_pos_total``."""
    grouped = group or ["__all"]
    base = df if group else df.withColumn("__all", F.lit(0))
    placed = _sorted_parts(base, grouped, order)
    totals = placed.groupBy(*grouped, "__part").agg(*[F.sum(c).alias(f"__sum_{c}") for c in sums])
    offsets = totals.select(
        *grouped, "__part",
        *[F.coalesce(F.sum(f"__sum_{c}").over(_earlier(grouped)), F.lit(0)).alias(f"__before_{c}") for c in sums],
        *[F.sum(f"__sum_{c}").over(Window.partitionBy(*grouped)).alias(f"{out}_total") for c, out in sums.items()])
    inside = (Window.partitionBy(*grouped, "__part").orderBy("__pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.join(offsets, [*grouped, "__part"])
    for column, name in sums.items():
        out = out.withColumn(name, F.sum(column).over(inside) + F.col(f"__before_{column}"))
    return out.select(*df.columns, *[n for o in sums.values() for n in (o, f"{o}_total")])
