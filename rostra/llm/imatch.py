"""I-Match document fingerprints, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rostra.functions.binding import let
from rostra.llm.common import BLANKS

LEAST_SHARE, MOST_SHARE = 0.005, 0.2  # band of document frequencies: idf from ln 5 to ln 200
MOST_LEXICON = 1 << 20  # an error above: the band of one corpus does not have so many terms
FEW_TERMS = 4  # a text with fewer lexicon terms is also known by all its terms
CELLS = 32  # random lexicon subsets of each of three sizes
GROUP_DOCS = 2048
MOST_GROUPS = 10_000


def term_hashes(text: Column) -> Column:
    """Distinct lower-cased words of a text as 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), BLANKS), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def fit_lexicon(hashes: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> list[int]:
    """Terms whose share of documents lies in the band. ``hashes`` has the distinct ``terms`` of each document.

    All documents count, and every term of the band belongs to the lexicon. A term of the band is in ``least`` of all documents
    or more, so there are at most (mean distinct terms of a document) / ``least`` of them, whatever the number of documents: a few ten thousand.
    """
    documents = hashes.count()
    counts = hashes.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    band = counts.where((F.col("n") >= max(2.0, least * documents)) & (F.col("n") <= most * documents)).select("term")
    found = [r.term for r in band.limit(MOST_LEXICON + 1).collect()]
    if len(found) > MOST_LEXICON:
        raise ValueError(f"the band from {least} to {most} of the documents has more than {MOST_LEXICON} terms")
    return sorted(found)


def _cells(h: Column) -> Column:
    """The subsets a term is in: one of 32 that share out the whole lexicon, perhaps one of 32 that share out an eighth of it,
    perhaps one of 32 that share out a sixty-fourth."""
    part = h.bitwiseAND(F.lit(CELLS - 1))
    other = F.shiftright(h, 11).bitwiseAND(F.lit(CELLS - 1))
    return F.array_compact(F.array(
        part, F.when(F.shiftright(h, 5).bitwiseAND(F.lit(7)) == 0, other + CELLS),
        F.when(F.shiftright(h, 5).bitwiseAND(F.lit(63)) == 0, other + 2 * CELLS)))


def signature(terms: Column, lexicon: list[int]) -> Column:
    """For each subset in which the text has terms, in order: its number and the hash of the sorted terms. A text with fewer than
    ``FEW_TERMS`` terms of the lexicon, but with terms, has one more subset: all its terms."""
    def hashed(pairs: Column) -> Column:
        cells = F.sort_array(F.array_distinct(F.transform(pairs, lambda p: p["c"])))
        return F.transform(cells, lambda c: F.concat(
            F.lpad(F.lower(F.hex(c)), 2, "0"),
            F.lpad(F.lower(F.hex(F.xxhash64(F.transform(F.filter(pairs, lambda p: p["c"] == c), lambda p: p["h"])))), 16, "0")))

    def signed(kept: Column) -> Column:
        every = F.lpad(F.lower(F.hex(F.xxhash64(F.sort_array(terms)))), 16, "0")
        own = let(F.flatten(F.transform(kept, lambda h: F.transform(_cells(h), lambda c: F.struct(c.alias("c"), h.alias("h"))))), hashed)
        few = (F.size(kept) < FEW_TERMS) & (F.size(terms) > 0)
        return F.concat(own, F.when(few, F.array(F.concat(F.lit(f"{3 * CELLS:02x}"), every))).otherwise(F.array().cast("array<string>")))

    # One lookup a term: a list of constants becomes a hash set that is built once, not once a row.
    return let(F.sort_array(F.filter(terms, lambda t: t.isin(lexicon) if lexicon else F.lit(False))), signed)


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets in which either text has terms, the share with the same hash; 1 if neither has any, as both are without terms."""
    cells = F.size(F.array_union(F.transform(a, lambda x: F.substring(x, 1, 2)), F.transform(b, lambda x: F.substring(x, 1, 2))))
    return F.when(cells == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / cells)


def _followed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add to each row the ``columns`` of the next one in the order of ``doc_id``, as ``next_*``; after the last comes the first.

    Rows are dealt into ranges of ids of about ``GROUP_DOCS`` rows, found from approximate quantiles, and the first row of each range
    also goes to the range before. So a text moves once, and no range grows with the input up to ``MOST_GROUPS`` of them.
    """
    ids = rows.select("doc_id")
    total = ids.count()
    groups = max(1, min(MOST_GROUPS, math.ceil(total / GROUP_DOCS)))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / groups for k in range(1, groups)], 10 * groups)).first()[0] if groups > 1 else []
    cuts, wide = sorted(set(cuts or [])), max(1, math.isqrt(groups))
    chunks = [cuts[k:k + wide] for k in range(0, len(cuts), wide)]

    def below(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))

    def literal(values: list) -> Column:
        return F.array(*map(F.lit, values)) if values else F.array().cast("array<bigint>")
    # Two steps: the chunk of cuts, then the cut within it.
    chunk = below(literal([c[0] for c in chunks]))
    inside = below(F.coalesce(F.try_element_at(F.array(*map(literal, chunks)), chunk), literal([]))) if chunks else F.lit(0)
    group = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * wide + inside))
    firsts = {r.g: r.least for r in ids.withColumn("g", group).groupBy("g").agg(F.min("doc_id").alias("least")).collect()}
    order = sorted(firsts)
    before = {g: order[k - 1] for k, g in enumerate(order)}
    table = F.array(*[F.struct(F.lit(firsts.get(g)).cast("bigint").alias("least"), F.lit(before.get(g, 0)).alias("before"))
                      for g in range(len(cuts) + 2)])
    placed = rows.withColumn("g", group).withColumn("own", F.element_at(table, F.col("g") + 1))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("own.least")), F.array(
        F.struct(F.col("g").alias("g"), F.lit(0).alias("copy")), F.struct(F.col("own.before").alias("g"), F.lit(1).alias("copy")))
    ).otherwise(F.array(F.struct(F.col("g").alias("g"), F.lit(0).alias("copy"))))
    spread = placed.select("*", F.explode(copies).alias("to")).drop("g", "own")
    w = Window.partitionBy("to.g").orderBy("to.copy", F.col("doc_id").asc_nulls_last(), "text")
    return spread.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).where("to.copy = 0").drop("to")


def document_fingerprints(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """``doc_id, fingerprint`` of every document: the hashes of its terms in random subsets of the lexicon.

    A missing text counts as empty; a text without any term has the empty fingerprint. Equal texts have equal ones.
    Rows are worked on one by one, so repeated rows and missing ids need no care; other columns are not read.
    """
    rows = docs.select("doc_id", term_hashes(F.coalesce(docs["text"], F.lit(""))).alias("terms"))
    return rows.select("doc_id", F.array_join(signature(F.col("terms"), fit_lexicon(rows, least, most)), "").alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Fingerprints of every text and of the text with its later half replaced by the start of the next document.

    Gives ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next document is the
    one with the next larger id, after the last the first; a table of one row is followed by itself. A missing text counts as
    empty. Rows with one id are ordered by their text; rows without an id come last. Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    lexicon = fit_lexicon(rows.select(term_hashes(F.col("text")).alias("terms")), least, most)
    signed = rows.withColumn("sig", signature(term_hashes(F.col("text")), lexicon))
    pairs = _followed(signed, ["text", "sig"]).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    out = pairs.withColumn("edited", edited).withColumn("edited_sig", signature(term_hashes(F.col("edited")), lexicon))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), F.array_join("sig", "").alias("fingerprint"),
        F.array_join("edited_sig", "").alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
