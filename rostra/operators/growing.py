"""An index that grows: segments are appended, deletions are markers, and a table of commits says what counts.

A segment holds the chunks and lists of the documents added together and is never written again. How many chunks have a
term, and with it every weight, depends on all segments, so these figures are merged when the index is opened. One
writer at a time; readers see the commits that are complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra.operators import chunks as ch
from rostra.operators.retrieval import Index, _place, segment, statistics, with_chunk_key
from rostra.session import materialize

SEGMENT_BITS = 50  # places of a segment start at its number times 2 ** 50
COMMITS = "number int, kind string"


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """What has been committed, in order: one short row for each append or deletion."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return sorted((r.number, r.kind) for r in spark.read.schema(COMMITS).parquet(f"{path}/commits").collect())


def _commit(spark: SparkSession, path: str, number: int, kind: str) -> None:
    spark.createDataFrame([(number, kind)], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _next(spark: SparkSession, path: str) -> int:
    number = max((n for n, _ in _commits(spark, path)), default=-1) + 1
    if number >= 1 << (63 - SEGMENT_BITS):
        raise ValueError(f"{number} commits: build the index anew")
    return number


def append_documents(docs: DataFrame, path: str, stop_words: list[str] | None = None) -> int:
    """Add ``docs (doc, doc_ord, text)`` as a segment; gives the number of the commit. What an unfinished append left behind is written over."""
    spark = docs.sparkSession
    number = _next(spark, path)

    def written(df: DataFrame, part: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/segments/{number}/{part}", compression="zstd")
        return spark.read.schema(df.schema).parquet(f"{path}/segments/{number}/{part}")

    segment(with_chunk_key(ch.chunk_documents(docs)), stop_words, written, number << SEGMENT_BITS)
    _commit(spark, path, number, "segment")
    return number


def delete_documents(names: DataFrame, path: str) -> int:
    """Mark the documents of ``names (doc)`` as deleted from all segments so far; they may be added again later."""
    spark = names.sparkSession
    number = _next(spark, path)
    names.select("doc").distinct().write.mode("overwrite").parquet(f"{path}/deleted/{number}")
    _commit(spark, path, number, "deletion")
    return number


def open_index(spark: SparkSession, path: str) -> Index:
    """The index of all documents that have been added and not deleted since; an index that nothing was added to is an error."""
    commits = _commits(spark, path)
    numbers = [n for n, kind in commits if kind == "segment"]
    if not numbers:
        raise ValueError(f"nothing has been added to {path}")

    def written(df: DataFrame, part: str) -> DataFrame:
        return materialize(df, part, "zstd")

    def union(part: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [spark.read.parquet(f"{path}/segments/{n}/{part}") for n in numbers])

    chunks, lists = union("chunks"), union("lists")
    deletions = [spark.read.parquet(f"{path}/deleted/{n}").withColumn("until", F.lit(n)) for n, kind in commits if kind == "deletion"]
    if deletions:
        last = reduce(DataFrame.unionByName, deletions).groupBy("doc").agg(F.max("until").alias("until"))
        marked = chunks.join(last, "doc", "left").withColumn("gone", F.coalesce(F.shiftright("place", SEGMENT_BITS) < F.col("until"), F.lit(False)))
        gone = written(marked.where("gone").select("place"), "gone")
        chunks = written(marked.where("NOT gone").drop("gone", "until"), "chunks")
        postings = lists.select("part", "shard", "term", F.explode(F.arrays_zip("ords", "counts")).alias("e")).withColumn("place", _place("shard", "e.ords"))
        left = postings.join(gone, "place", "left_anti").groupBy("part", "shard", "term").agg(F.sort_array(F.collect_list("e")).alias("e"))
        lists = written(left.select("part", "shard", "term", "e.ords", "e.counts").repartition("part").sortWithinPartitions("part", "term"), "lists")
    return Index(chunks, *statistics(chunks, lists, written))
