"""Line deduplication by aligning pairs of documents that share rare lines."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostra.llm.common import BLANKS, in_partitions
from rostra.operators.skew import spread_join
from rostra.session import materialize

ALIGNED_AT_ONCE = 64


def _anchors(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of equal lines to align by, rising in ``a``: lines that occur once on either side, else the rarest shared lines,
    the first on one side with the first on the other, and so on."""
    in_a, in_b = Counter(a), Counter(b)
    shared = {x: n + in_b[x] for x, n in in_a.items() if x in in_b}
    least = min(shared.values(), default=0)
    chosen = {x for x, n in shared.items() if n == 2 or (least > 2 and n == least)}
    there: dict[int, list[int]] = {x: [] for x in chosen}
    for j, x in enumerate(b):
        if x in chosen:
            there[x].append(j)
    turn: Counter = Counter()
    pairs = []
    for i, x in enumerate(a):
        if x in chosen:
            if turn[x] < len(there[x]):
                pairs.append((i, there[x][turn[x]]))
            turn[x] += 1
    return pairs


def patience_blocks(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned equal blocks ``(start in a, start in b, length)`` of two line sequences, by patience diff.

    The common head and tail of a stretch are blocks. Of the pairs to align by (see ``_anchors``) the longest chain that rises on both
    sides is kept, found by laying patience piles; each pair grows over equal lines on both sides; the stretches
    between are aligned again, until no line is shared.
    """
    blocks, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        head = 0
        while a0 + head < a1 and b0 + head < b1 and a[a0 + head] == b[b0 + head]:
            head += 1
        tail = 0
        while a1 - tail > a0 + head and b1 - tail > b0 + head and a[a1 - tail - 1] == b[b1 - tail - 1]:
            tail += 1
        if head:
            blocks.append((a0, b0, head))
        if tail:
            blocks.append((a1 - tail, b1 - tail, tail))
        a0, a1, b0, b1 = a0 + head, a1 - tail, b0 + head, b1 - tail
        if a0 == a1 or b0 == b1:
            continue
        single = [(a0 + i, b0 + j) for i, j in _anchors(a[a0:a1], b[b0:b1])]
        piles: list[int] = []
        tops: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(single):
            k = bisect_left(piles, j)
            piles[k:k + 1], tops[k:k + 1] = [j], [n]
            back.append(tops[k - 1] if k else -1)
        chain, n = [], tops[-1] if tops else -1
        while n >= 0:
            chain.append(single[n])
            n = back[n]
        at_a, at_b, found = a0, b0, False
        for i, j in reversed(chain):
            if i < at_a or j < at_b:  # already inside a block
                continue
            left = right = 0
            while i - left > at_a and j - left > at_b and a[i - left - 1] == b[j - left - 1]:
                left += 1
            while i + right < a1 and j + right < b1 and a[i + right] == b[j + right]:
                right += 1
            if i - left > at_a and j - left > at_b:
                todo.append((at_a, i - left, at_b, j - left))
            blocks.append((i - left, j - left, left + right))
            at_a, at_b, found = i + right, j + right, True
        if found and at_a < a1 and at_b < b1:
            todo.append((at_a, a1, at_b, b1))
    return sorted(blocks, key=lambda x: x[1])


def covered_lines(a: list[int], b: list[int], rare: set[int]) -> list[int]:
    """Lines of ``b`` in aligned blocks that hold a rare shared line."""
    return [j for _, start, n in patience_blocks(a, b) if not rare.isdisjoint(b[start:start + n]) for j in range(start, start + n)]


def line_hashes(docs: DataFrame) -> DataFrame:
    """Adds ``lines array<long>``: a hash of every line, blanks collapsed; 0 for a line without anything else."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, BLANKS, " ")))
    return docs.withColumn("lines", F.transform(lines, lambda x: F.when(x == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(x))))


def line_dedup(docs: DataFrame, rare_docs: int | None = None, with_text: bool = True) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed array<int>`` of every document and, with ``with_text``, its remaining ``text``.

    Two documents are aligned if they share a line, or all lines, and the earlier is the first that has it; earlier means a smaller id.
    Aligned common blocks with such a line are deleted from the later document; the earlier one is looked at as it was given.
    Lines are compared with runs of blanks as one and without those at the ends. All lines of all documents are counted; a
    line's documents are never listed, each is only tied to the first, so pairs grow with the lines however many documents
    have one. With ``rare_docs``, only lines that at most so many documents have tie documents together.

    A missing text is empty: one line, never removed. Documents with one id are ordered by a hash of their text; rows that repeat
    id and text are one document, aligned once, and come back as often as given. A missing id comes after all others.
    Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    lined = materialize(line_hashes(rows).select("doc_id", "th", "lines").dropDuplicates(["doc_id", "th"]), "lines")
    # A missing id sorts last: (no id, id, text hash).
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    lined = lined.withColumn("doc", key)
    # A text as a whole is one more key, so that a copy meets the first copy even if other documents had all its lines before.
    whole = F.when(F.exists("lines", lambda h: h != 0), F.xxhash64("lines", F.lit("whole")))
    lined = lined.withColumn("whole", whole)
    places = lined.select("doc", F.explode(F.array_union("lines", F.array("whole"))).alias("h")).where("h <> 0")
    counts = materialize(places.groupBy("h").agg(F.count("*").alias("n"), F.min("doc").alias("first")), "line_counts")
    shared = counts.where("n > 1" if rare_docs is None else F.col("n").between(2, rare_docs)).select("h", "first", "n")
    # Lines that very many documents have, and first documents with very many later ones, are spread over many tasks.
    tied = spread_join(places, shared, "h", "doc", "n", unique=True).where("doc <> first")
    pairs = materialize(tied.groupBy("doc", "first").agg(F.collect_list("h").alias("rare")), "line_pairs")
    later = lined.select("doc", F.col("lines").alias("b"), "whole")
    earlier = lined.select(F.col("doc").alias("first"), F.col("lines").alias("a")).join(pairs.groupBy("first").agg(F.count("*").alias("n")), "first")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for at in range(0, len(batch), ALIGNED_AT_ONCE):
                part = batch.slice(at, ALIGNED_AT_ONCE)
                found += [list(range(len(b))) if whole in rare else covered_lines(a, b, set(rare))
                          for a, b, rare, whole in zip(*(part.column(c).to_pylist() for c in ("a", "b", "rare", "whole")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "th", "cut"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    both = spread_join(pairs.join(later, "doc"), earlier, "first", "doc", "n", unique=True).select("doc.doc_id", "doc.th", "a", "b", "rare", "whole")
    cut = in_partitions(both, align, f"doc_id {id_type}, th long, cut array<int>")
    removed = cut.groupBy("doc_id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("removed")).where(F.size("removed") > 0)
    given = removed.select(F.struct("doc_id", "th").alias("of"), "removed")
    out = rows.join(given, F.struct(rows["doc_id"], rows["th"]).eqNullSafe(given["of"]), "left").drop("of")
    out = out.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    split = F.split("text", "\n")
    kept = F.when(F.size("removed") == 0, F.col("text")).otherwise(
        F.array_join(F.filter(split, lambda x, i: ~F.array_contains("removed", i)), "\n"))
    return out.select("doc_id", F.size(split).cast("bigint").alias("n_lines"), F.size("removed").cast("bigint").alias("n_removed"), "removed",
                      *([kept.alias("text")] if with_text else []))
