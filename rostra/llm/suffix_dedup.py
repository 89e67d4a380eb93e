"""Removal of long repeated byte strings over a whole corpus, by suffix arrays over the places that may repeat."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostra.llm.common import in_partitions
from rostra.llm.suffix_array import suffix_array
from rostra.operators.ordering import add_rank
from rostra.session import materialize

LENGTH = 100  # bytes of a string that counts as repeated
SEED = 28  # bytes of an anchor
CHUNK_BYTES = 1 << 20  # text worked on at once
PIECE_BYTES = 4 << 20  # windows of a longer text are worked on in pieces of so many
PLACE_BITS = 23  # places within a chunk and a piece
LEAST_BUCKETS, BUCKET_UNITS = 256, 200_000
SORTED_BYTES = 1 << 17  # bytes in one suffix array
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LETTER = np.frombuffer(hashlib.shake_256(b"letters").digest(2048), np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number, modulo 2^64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 16), np.uint64(base))
        steps[0] = 1
        held = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return held[:n]


class Rolling:
    """Hashes of any stretch of a byte array, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[data] * _powers(_BASE, len(data)), dtype=np.uint64)])
        self.undo = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.undo[start]
        h = (h ^ h >> np.uint64(31)) * _MIX
        return h ^ h >> np.uint64(29)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width``."""
    held, m = 1, x
    while held * 2 <= width:
        m, held = np.minimum(m[:-held], m[held:]), held * 2
    return np.minimum(m[:len(x) - width + 1], m[width - held:][:len(x) - width + 1])


def units(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Cut all windows of ``length`` bytes into runs that share an anchor: ``(first, last, anchor hash, content hash)``.

    ``data`` holds texts one after the other and ``ends`` where each ends. The anchor of a window is the stretch of ``seed``
    bytes in it with the least hash, so equal windows have equal anchors, at equal distances. The content hash covers the
    bytes of all windows of the run and the anchor's place in it.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(data) < length:
        return none
    starts, sizes = np.append(0, ends[:-1]), np.diff(np.append(0, ends))
    # Windows inside one text: all starts up to length before its end.
    marks = np.zeros(len(data) + 1, np.int64)
    long = sizes >= length
    np.add.at(marks, starts[long], 1)
    np.add.at(marks, ends[long] - length + 1, -1)
    inside = np.flatnonzero(np.cumsum(marks)[:len(data) - length + 1] > 0)
    if not len(inside):
        return none
    rolling, at = Rolling(data), np.arange(len(data) - seed + 1)
    if len(data) >> PLACE_BITS:
        raise ValueError("too much text at once")
    bits = np.uint64(PLACE_BITS)  # the same for all texts, so that ties between hashes are settled in one way
    hashes = rolling(at, at + seed)
    anchor = (_sliding_least(hashes >> bits << bits | at.astype(np.uint64), length - seed + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    anchor = anchor[inside]
    heads = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)))
    first, last, own = inside[heads], inside[np.append(heads[1:], len(inside)) - 1], anchor[heads]
    content = rolling(first, last + length) + (own - first).astype(np.uint64) * np.uint64(_BASE) + (last - first).astype(np.uint64) * _MIX
    return first, last, hashes[own], (content ^ content >> np.uint64(32)) * _MIX


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _chunks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Texts of a batch in the order of their keys: key, first byte and bytes of each, a bounded amount at once.

    Texts beyond PIECE_BYTES come in pieces that share no window and miss none.
    """
    order = np.argsort(batch.column("key").to_numpy(), kind="stable")
    keys, texts = batch.column("key").to_numpy()[order], batch.column("text").take(pa.array(order))
    held, size = [], 0
    for k, text in zip(keys.tolist(), texts):
        data = text.as_buffer()
        for at in range(0, max(len(data), 1), PIECE_BYTES):
            part = data.slice(at, min(PIECE_BYTES + length - 1, len(data) - at)).to_pybytes()
            if held and size + len(part) > CHUNK_BYTES:
                yield np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64), [h[2] for h in held]
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64), [h[2] for h in held]


def _gather(docs: DataFrame, buckets: int, length: int, seed: int) -> DataFrame:
    """Runs of windows of all documents, packed by bucket of their anchor; runs with equal content in one chunk of text leave
    only their first, and the others as removed stretches."""
    names = ["bucket", "h", "c", "key", "first", "more", "cut_key", "cut_lo", "cut_hi"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty, turn = b"", 0
        for whole in batches:
            for keys, bases, texts in _chunks(whole, length):
                sizes = np.array([len(t) for t in texts])
                ends = np.cumsum(sizes)
                first, last, h, c = units(np.frombuffer(b"".join(texts), np.uint8), ends, length, seed)
                doc = np.searchsorted(ends, first, side="right")
                key, lo = keys[doc], first - (ends - sizes)[doc] + bases[doc]
                _, kept = np.unique(h * _MIX + c, return_index=True)
                again = np.ones(len(h), bool)
                again[kept] = False
                kept = kept[np.lexsort((kept, (h[kept] % np.uint64(buckets))))]
                bucket = (h[kept] % np.uint64(buckets)).astype(np.int64)
                cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(kept) else np.zeros(0, np.int64)
                rows = []
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(kept)]):
                    on = kept[a:b]
                    # Differences of keys and places are small numbers, which Spark's compression takes down.
                    rows.append((int(bucket[a]), _blob(h[on]), _blob(c[on]), _blob(np.diff(key[on], prepend=0)), _blob(np.diff(lo[on], prepend=0)),
                                 _blob((last - first)[on].astype(np.uint8)), empty, empty, empty))
                if again.any():
                    merged = _merge(key[again], lo[again], (lo + last - first + length)[again])
                    rows.append((turn % buckets, *[empty] * 5, *map(_blob, merged)))
                    turn += 1
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=names)

    return in_partitions(docs, work, "bucket long, " + ", ".join(f"{n} binary" for n in names[1:]))


def _merge(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of stretches, by key: overlapping and touching ones become one."""
    if not len(key):
        return key, lo, hi
    order = np.lexsort((lo, key))
    key, lo, hi = key[order], lo[order], hi[order]
    fresh_key = np.append(True, key[1:] != key[:-1])
    # A running maximum within each key: shift the keys apart.
    shift = np.cumsum(fresh_key) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + shift) - shift
    heads = np.flatnonzero(np.append(True, fresh_key[1:] | (lo[1:] > reach[:-1])))
    return key[heads], lo[heads], reach[np.append(heads[1:], len(key)) - 1]


_FOUND = "key long, lo long, hi long, h long"


def _match(table: pa.Table, length: int) -> pa.Table:
    """Of one bucket: removed stretches (no ``h``), and the runs whose anchor stands in runs with different content."""
    cut = [np.concatenate([np.frombuffer(b or b"", np.int64) for b in table.column(c).to_pylist()] or [np.zeros(0, np.int64)])
           for c in ("cut_key", "cut_lo", "cut_hi")]
    blobs = {c: table.column(c).to_pylist() for c in ("h", "c", "key", "first", "more")}
    h, c = (np.concatenate([np.frombuffer(b, np.uint64) for b in blobs[x]]) for x in ("h", "c"))
    key, lo = (np.concatenate([np.cumsum(np.frombuffer(b, np.int64)) for b in blobs[x]]) for x in ("key", "first"))
    more = np.concatenate([np.frombuffer(b, np.uint8) for b in blobs["more"]]).astype(np.int64)
    order = np.lexsort((lo, key, c, h))
    h, c, key, lo, more = h[order], c[order], key[order], lo[order], more[order]
    new_h = np.append(True, h[1:] != h[:-1])[:len(h)]
    new = (new_h | np.append(True, c[1:] != c[:-1])[:len(h)])
    group = np.cumsum(new_h) - 1
    kinds = np.bincount(group[new], minlength=int(new_h.sum())) if len(h) else np.zeros(0, np.int64)
    twice, edge = ~new, new & (kinds[group] > 1) if len(h) else new
    removed = _merge(np.concatenate([cut[0], key[twice]]), np.concatenate([cut[1], lo[twice]]),
                     np.concatenate([cut[2], (lo + more + length)[twice]]))
    out = [np.concatenate([removed[k], x[edge]]) for k, x in enumerate((key, lo, lo + more + length))]
    return pa.table({"key": out[0], "lo": out[1], "hi": out[2],
                     "h": pa.array(np.concatenate([np.zeros(len(removed[0]), np.int64), h[edge].view(np.int64)]),
                                   mask=np.append(np.ones(len(removed[0]), bool), np.zeros(int(edge.sum()), bool)))})


def window_classes(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``length`` bytes over different segments: number of the class of equal ones, segment, place in it.

    The suffix array of the segments, each closed by a symbol below all bytes, brings equal windows together; neighbours
    are compared byte by byte.
    """
    text = b"".join(s + b"\0" for s in segments)
    closing = np.cumsum([len(s) + 1 for s in segments]) - 1
    data = np.frombuffer(text, np.uint8)
    symbols = np.append(data.astype(np.int64) + 2, 0)
    symbols[closing] = 1
    order = np.frombuffer(suffix_array(symbols.tolist()), np.int32)[1:].astype(np.int64)
    room = np.repeat(closing, np.diff(np.append(-1, closing))) - np.arange(len(text))
    order = order[room[order] >= length]
    windows, step = np.lib.stride_tricks.sliding_window_view(data, length), 1 << 14
    same = np.concatenate([np.zeros(min(1, len(order)), bool), *((windows[a] == windows[b]).all(axis=1) for a, b in (
        (order[k:min(k + step, len(order) - 1)], order[k + 1:k + 1 + step]) for k in range(0, len(order) - 1, step)))])
    segment = np.searchsorted(closing, order)
    return np.cumsum(~same), segment, order - np.append(0, closing[:-1] + 1)[segment]


def _sort_out(table: pa.Table, length: int) -> pa.Table:
    """Of one bucket of runs with their text: the stretches whose windows also start earlier.

    Windows that occur once under their anchor are dropped first; what is left is cut into segments, equal ones become one, and the
    different segments of whole anchors go into suffix arrays.
    """
    h = table.column("h").to_numpy()
    order = np.lexsort((table.column("lo").to_numpy(), table.column("key").to_numpy(), h))
    table = table.take(pa.array(order))
    h, key, lo = h[order], table.column("key").to_numpy(), table.column("lo").to_numpy()
    texts = table.column("text").to_pylist()
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begin[owner] + start
    prints = Rolling(data)(at, at + length) + h[owner].view(np.uint64) * _MIX
    _, which, times = np.unique(prints, return_inverse=True, return_counts=True)
    often = times[which] > 1
    owner, start = owner[often], start[often]
    heads = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1))[:len(owner)])
    tails = np.append(heads[1:], len(owner))[:len(heads)] - 1
    # Segments, by anchor; holders of each in the order of the corpus.
    batch: dict[tuple[int, bytes], list[int]] = {}
    size, out, anchor = 0, [], None

    def flush() -> None:
        cls, segment, place = window_classes([s for _, s in batch], length)
        # Each window at all holders of its segment; the first of a class in the order of the corpus stays.
        held = [np.array(x) for x in batch.values()]
        many = np.array([len(x) for x in held])
        run = np.concatenate(held)
        times = many[segment]
        which = np.arange(int(times.sum())) + np.repeat((np.cumsum(many) - many)[segment] - np.cumsum(times) + times, times)
        o = owner[heads[run[which]]]
        cls, k, p = np.repeat(cls, times), key[o], lo[o] + start[heads[run[which]]] + np.repeat(place, times)
        order = np.lexsort((p, k, cls))
        again = order[1:][cls[order[1:]] == cls[order[:-1]]]
        out.append(_merge(k[again], p[again], p[again] + length))

    for r, (a, b) in enumerate(zip(heads.tolist(), tails.tolist())):
        o = int(owner[a])
        segment = texts[o][int(start[a]):int(start[b]) + length]
        if size >= SORTED_BYTES and h[o] != anchor:
            flush()
            batch, size = {}, 0
        anchor = h[o]
        runs = batch.setdefault((int(h[o]), segment), [])
        if not runs:
            size += len(segment)
        runs.append(r)
    if batch:
        flush()
    found = _merge(*(np.concatenate([np.zeros(0, np.int64), *(x[k] for x in out)]) for k in range(3)))
    return pa.table({"key": found[0], "lo": found[1], "hi": found[2]})


def repeated_stretches(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``key, stretches``: of each document with any, the stretches ``(lo, hi)`` of bytes in windows that also start earlier.

    ``docs`` has ``key long``, unique and not missing, which orders the documents, and ``text binary``.
    """
    if length - seed > 250:
        raise ValueError("windows of one anchor are counted in a byte: choose a longer seed")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, math.ceil(total * 2 / (length - seed + 2) / BUCKET_UNITS))
    found = materialize(_gather(docs, buckets, length, seed).groupBy("bucket").applyInArrow(lambda t: _match(t, length), _FOUND), "matches")
    wanted = found.where(F.col("h").isNotNull()).groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "h")).alias("runs"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, r["lo"], r["h"], t[r["lo"]:r["hi"]]) for k, t, runs in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "runs"))) for r in runs]
            for at in range(0, len(rows), 10_000):
                columns = list(zip(*rows[at:at + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["key", "lo", "h", "text"])

    cut = in_partitions(docs.join(wanted, "key").select("key", "text", "runs"), cut_out, "key long, lo long, h long, text binary")
    settled = cut.groupBy(F.pmod("h", F.lit(buckets)).alias("bucket")).applyInArrow(lambda t: _sort_out(t, length), "key long, lo long, hi long")
    stretches = found.where(F.col("h").isNull()).select("key", "lo", "hi").unionByName(settled)
    return stretches.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("stretches"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Documents with a unique number ``key`` in the order of their ids, and whether that is the id itself.

    It is where all ids are there and differ; else the key is the rank by (id, missing ids last; hash of the text).
    """
    rows = docs.withColumn("text", F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    integral = docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    clean = integral and docs.where(F.col("doc_id").isNull()).limit(1).count() == 0 and docs.groupBy("doc_id").count().where("count > 1").limit(1).count() == 0
    if clean:
        # Both joins with the texts have the same condition, so that one shuffle of the texts serves both.
        return rows.withColumn("key", F.col("doc_id").cast("long")).where(F.col("key").isNotNull()), True
    ranked = (add_rank(rows.withColumn("th", F.xxhash64("text")), [], [F.col("doc_id").asc_nulls_last(), F.col("th"), F.monotonically_increasing_id()], "key")
              .withColumn("key", F.col("key").cast("long")).drop("th"))
    return materialize(ranked, "keyed"), False


def _keep(text: bytes, stretches: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many runs."""
    if not stretches:
        return text, 0, 0
    lo, hi = (np.array([s[k] for s in stretches], np.int64) for k in ("lo", "hi"))
    _, lo, hi = _merge(np.zeros(len(lo), np.int64), lo, hi)
    return b"".join(text[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)])), int((hi - lo).sum()), len(lo)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with ``with_text``, the remaining bytes ``kept``.

    Removed is each UTF-8 byte that a string of ``length`` bytes covers which also starts earlier: in a document with a smaller id, or
    further left in the same one. Strings never cross documents, may overlap, and are judged on the texts as given.

    Every window of ``length`` bytes is filed under an anchor in it, so equal windows meet. Runs of windows with the same
    content collapse in the tasks first and then per bucket: all but the first are removed. Where one anchor has runs with
    different content, their texts go into suffix arrays built from Lyndon groups, which bring equal windows together.

    A missing text is empty; a missing id comes after all others; rows with one id are ordered by a hash of their text, equal
    rows in any order, and each comes back. Other columns are not read.
    """
    rows, own = _keyed(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    left = rows.select("key", "text") if own else rows
    joined = left.join(repeated_stretches(rows.select("key", "text"), length, seed), "key", "left").select(
        F.col("key").cast(id_type).alias("doc_id") if own else "doc_id", "text", "stretches")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist()):
                kept, n_removed, n_spans = _keep(text, stretches)
                out.append((len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(columns, kinds))][:5 + with_text], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_text]
    return in_partitions(joined, work, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """The documents with their repeated bytes taken out of ``text``; ``n_chars`` follows where there is one, other columns stay.

    Where a removed stretch begins or ends inside a character, what is left of that character goes too. A document of which nothing
    is left keeps its row with an empty text; a missing text stays missing.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "text", F.struct(*others, F.col("text").isNull().alias("no text")).alias("given"))
    rows, _ = _keyed(packed)
    joined = rows.join(repeated_stretches(rows.select("key", "text"), length, seed), "key", "left")
    schema = packed.select("given").schema.add("left", "string").add("cut", "boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stretches = batch.column("stretches").to_pylist()
            left = [_keep(t, s)[0].decode("utf-8", "ignore") for t, s in zip(batch.column("text").to_pylist(), stretches)]
            yield pa.RecordBatch.from_arrays([batch.column("given"), pa.array(left, pa.string()), pa.array([bool(s) for s in stretches])],
                                             names=["given", "left", "cut"])

    done = joined.select("text", "stretches", "given").mapInArrow(work, schema)
    changed = {"text": F.when(~F.col("given").getField("no text"), F.col("left"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cut"), F.length("left")).otherwise(F.col("given.n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*[(changed[c] if c in changed else F.col("given").getField(c)).alias(c) for c in docs.columns])
