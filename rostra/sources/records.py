"""Records of quoted CSV files whose fields may hold line breaks, read by many tasks a file.

Spark's line reader deals a file out in byte ranges of whole lines. Whether a range begins inside a quoted field depends on all
ranges before it, so each range first tells where it would end from either beginning; a running composition of
these answers gives every range its true beginning. Then all ranges cut their lines into records at once, and only a record that crosses
a border is put together from the pieces of its ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: The rest of a quoted field: up to a quote that no other quote follows, or the end of the line.
_QUOTED = re.compile(rb'(?:[^"]|"")*+("?)')
_TO_COMMA = re.compile(rb"[^,]*+(,?)")


def ends_open(line: bytes, is_open: bool) -> bool:
    """Whether a quoted field goes on after this line. A quote opens a field only as its first character."""
    if b'"' not in line:
        return is_open
    at = 0
    while True:
        if is_open:
            closed = _QUOTED.match(line, at)
            if not closed[1]:
                return True
            at, is_open = closed.end(), False
        elif line.startswith(b'"', at):
            at, is_open = at + 1, True
            continue
        comma = _TO_COMMA.match(line, at)
        if not comma[1]:
            return False
        at = comma.end()


def _lines(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def ranges(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``file, block, is_open, latin``: for each byte range whether it begins inside a quoted field, and whether the file is not UTF-8."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, closed, opened, valid = None, False, True, True

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in (*now, closed, opened, valid)],
                                              names=["file", "block", "closed", "opened", "valid"])
        for batch in batches:
            for file, block, value, good in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value", "good"))):
                if (file, block) != now:
                    if now is not None:
                        yield row()
                    now, closed, opened, valid = (file, block), False, True, True
                valid = valid and good
                if b'"' in value:
                    closed, opened = ends_open(value, closed), ends_open(value, opened)
        if now is not None:
            yield row()

    lines = _lines(spark, path, pattern).select("file", "block", F.is_valid_utf8("value").alias("good"), F.col("value").cast("binary").alias("value"))
    told = lines.mapInArrow(work, "file string, block long, closed boolean, opened boolean, valid boolean")
    # A range leaves a fixed state behind, or the one it found, or the other one. What counts is the last fixed one and the flips since.
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum((F.col("closed") & ~F.col("opened")).cast("int")).over(before), F.lit(0))
    fixed = F.last(F.when(F.col("closed") == F.col("opened"), F.struct(F.col("closed").cast("int").alias("state"), F.col("flips"))), ignorenulls=True).over(before)
    return (told.withColumn("flips", flips).withColumn("fixed", fixed)
            .withColumn("since", F.col("flips") - F.coalesce("fixed.flips", F.lit(0)) + F.coalesce("fixed.state", F.lit(0)))
            .select("file", "block", (F.col("since") % 2 == 1).alias("is_open"),
                    (~F.bool_and("valid").over(Window.partitionBy("file"))).alias("latin")))


def read_records(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``file, head, record``: every record of every file as text; ``head`` marks the first of a file. Empty lines are no records.

    The table of ranges, one short row for each byte range (128 MB by default), is broadcast, so that lines stay where they are read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, is_open, began, code, head = None, [], False, True, "utf-8", False
        rows: list[tuple] = []

        def cut(ended: bool) -> None:
            """Hand on what is held: a whole record, or the piece of one that this range has."""
            nonlocal head
            text = b"\n".join(parts)
            if began and ended:
                text = text.removesuffix(b"\r")
            if text or not (began and ended):
                rows.append((*now, began, ended, head and began, text.decode(code, "replace")))
                head = head and not began
            parts.clear()

        def table() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                             names=["file", "block", "began", "ended", "head", "record"])
            rows.clear()
            return out

        for batch in batches:
            for file, block, value, opens, latin in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value", "is_open", "latin"))):
                if (file, block) != now:
                    if parts:
                        cut(not is_open)
                    now, is_open, began, code, head = (file, block), opens, not opens, "latin-1" if latin else "utf-8", block == 0
                    value = value.removeprefix(b"\xef\xbb\xbf") if block == 0 else value
                parts.append(value)
                is_open = ends_open(value, is_open)
                if not is_open:
                    cut(True)
                    began = True
            yield table()
        if parts:
            cut(not is_open)
        yield table()

    lines = _lines(spark, path, pattern).withColumn("value", F.col("value").cast("binary"))
    placed = lines.join(F.broadcast(ranges(spark, path, pattern)), ["file", "block"]).select("file", "block", "value", "is_open", "latin")
    cut = placed.mapInArrow(work, "file string, block long, began boolean, ended boolean, head boolean, record string")
    whole = cut.where("began AND ended").select("file", "head", "record")
    # At most two pieces a range: the rest of a record that began before, and the beginning of one that goes on.
    running = Window.partitionBy("file").orderBy("block", "began").rowsBetween(Window.unboundedPreceding, 0)
    pieces = cut.where("NOT (began AND ended)").withColumn("number", F.sum(F.col("began").cast("int")).over(running))
    crossing = pieces.groupBy("file", "number").agg(
        F.max("head").alias("head"), F.array_sort(F.collect_list(F.struct("block", "began", "record"))).alias("p")) \
        .select("file", "head", F.regexp_replace(F.array_join("p.record", "\n"), "\r$", "").alias("record"))
    return whole.unionByName(crossing)
