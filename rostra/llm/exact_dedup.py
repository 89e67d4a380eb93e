"""Exact deduplication: local, salted and global combining of equal texts, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rostra.llm.common import BLANKS, fresh
from rostra.operators.skew import spread_join
from rostra.session import materialize

SALTS = 16


def normalised(text: Column) -> Column:
    """The text with each run of blanks as one space; a missing text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_rows``.

    Equal texts are found in three steps, and each groups by digest **and** whole text, so texts that only share a digest
    never meet: every task combines its own rows (Spark's partial aggregation), the digest groups are merged per salt (a
    salt is a set of input partitions, so a task sends a text once), and the winners of the salts are merged over
    the cluster. No step holds more of a group of copies than one row per input partition. Documents then take
    ``keep_id`` and ``group_size`` from the winner; digests with a large share of the rows are spread over many tasks.

    A missing text counts as empty. A missing id sorts after all others; a group with no id at all keeps the row with
    the missing id. Rows that repeat both id and text are one document: they come back as one row, whose ``n_rows`` says
    how many there were; ``group_size`` counts rows. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("norm"))
    rows = rows.withColumn("digest", F.sha2(F.encode("norm", "UTF-8"), 256))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    winners = salted.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    # One row per digest: two texts with one SHA-256 would stop the job rather than be taken for copies.
    alone = F.when(F.count("*") > 1, F.raise_error(F.lit("two texts with one SHA-256"))).otherwise(F.min("group_size"))
    winners = materialize(winners.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), alone.alias("group_size")), "winners")
    members = rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n_rows"))
    found = spread_join(members, winners.withColumn("__rows", F.col("group_size")), "digest", "doc_id", "__rows", unique=True)
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"), "n_rows")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; of repeated rows one stays."""
    stay = exact_dedup(docs).where("kept").select(F.struct("text_sha256", "doc_id").alias("kept_row"))
    digest = fresh(docs, "digest")
    rows = docs.withColumn(digest, F.sha2(F.encode(normalised(docs["text"]), "UTF-8"), 256))
    out = rows.join(stay, F.struct(rows[digest], rows["doc_id"]).eqNullSafe(stay["kept_row"]), "left_semi")
    return out.dropDuplicates([digest]).drop(digest)
