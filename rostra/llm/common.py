"""Pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = {ord(u): low for u, low in zip(UPPER, LOWER)}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(df: DataFrame) -> Column:
    """The text, a missing one as the empty string."""
    return F.coalesce(df["text"], F.lit(""))


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a missing id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % mod


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def in_partitions(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` under a shorter name."""
    return df.mapInArrow(work, schema)


def batches_of(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``most_bytes`` in each piece; a row is never cut."""
    sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset:][:len(batch) + 1]) \
        if pa.types.is_string(batch.column(column).type) or pa.types.is_binary(batch.column(column).type) \
        else np.array([len(x or b"") for x in batch.column(column).to_pylist()])
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(batch):
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
