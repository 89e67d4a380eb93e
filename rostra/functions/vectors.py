"""Term vectors kept in the row as parallel arrays; no shuffle is needed to build or compare them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rostra.functions.binding import let


def add_term_counts(df: DataFrame, tokens: Column, terms: str = "terms", counts: str = "counts") -> DataFrame:
    """Add the distinct terms (sorted) of a row and how often each occurs.

    The tokens are sorted inside the row and runs of equal tokens are measured, so a long document
    costs n log n and no rows are exploded or shuffled. The steps are separate projections because
    a nested lambda would otherwise compute the sorted array again for each element.
    """
    start = F.filter(
        F.when(F.size("__sorted") > 0, F.sequence(F.lit(0), F.size("__sorted") - 1))
        .otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (F.get("__sorted", i) != F.get("__sorted", i - 1)))
    return (
        df.withColumn("__sorted", F.sort_array(tokens))
        .withColumn("__start", start)
        .withColumn(terms, F.transform("__start", lambda i: F.get("__sorted", i)))
        .withColumn(counts, F.transform(
            "__start", lambda i, k: F.coalesce(F.get("__start", k + 1), F.size("__sorted")) - i))
        .drop("__sorted", "__start"))


def common_weights(left_terms: str, left_weights: str, right_terms: str, right_weights: str) -> Column:
    """``array<struct<a, b>>``: both weights of each common term, in the order of the terms.

    Each side has a term once, so after one sort of both sides the two entries of a common term are neighbours. Cost is
    that of the sort, however many terms are common.
    """
    def side(terms: str, weights: str, number: int) -> Column:
        return F.transform(terms, lambda t, i: F.struct(t.alias("t"), F.lit(number).alias("side"), F.get(weights, i).cast("double").alias("w")))

    both = F.sort_array(F.concat(side(left_terms, left_weights, 0), side(right_terms, right_weights, 1)))
    return let(both, lambda entries: F.filter(F.transform(entries, lambda e, i: F.when(
        F.get(entries, i + 1)["t"] == e["t"], F.struct(e["w"].alias("a"), F.get(entries, i + 1)["w"].alias("b")))), lambda p: p.isNotNull()))


def dot(left_terms: str, left_weights: str, right_terms: str, right_weights: str) -> Column:
    """Sum of products over the common terms."""
    return F.aggregate(common_weights(left_terms, left_weights, right_terms, right_weights), F.lit(0.0), lambda acc, p: acc + p["a"] * p["b"])


def sum_of_squares(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w.cast("double") * w.cast("double"))


def unit(weights: Column) -> Column:
    """Weights divided by their Euclidean length."""
    return let(F.sqrt(sum_of_squares(weights)), lambda length: F.transform(weights, lambda w: w / length))
