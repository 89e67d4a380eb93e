"""Byte-level BPE with word ends: encoding by speculation and verification, and decoding."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rostra.llm.common import batches_of, in_partitions

CACHED_WORDS = 300_000  # words, and chunks between blanks, that a Python worker remembers; beyond that it starts afresh
BATCH_BYTES = 2 << 20
SEPARATORS = regex.compile("[\x1c-\x1f]")
NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class WordBpe:
    """Tables of a ``tokenizers`` JSON file whose model is BPE with a word-end suffix."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in (vocab | self.special).items()}
        rules = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        self.words = regex.compile(rules[0])
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max(self.text) + 1
        # When a token comes to be: 0 for single letters, else the number of its merge. And the two parts it comes from.
        self.born = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        made = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in merges], np.int64).reshape(-1, 3)
        if len(np.unique(made[:, 2])) < len(made):
            raise ValueError("a token has two merges: pairs can't be checked one by one")
        self.born[made[:, 2]] = np.arange(1, len(made) + 1)
        self.left[made[:, 2]], self.right[made[:, 2]] = made[:, 0], made[:, 1]
        keys = made[:, 0] << 32 | made[:, 1]
        order = np.argsort(keys)
        self.pair_keys, self.pair_born = keys[order], order + 1
        self.made = made[:, 2]
        cut = len(self.suffix)
        self.last = {t[:-cut]: i for t, i in vocab.items() if t.endswith(self.suffix) and t != self.suffix}
        self.inner = {t: i for t, i in vocab.items() if not t.endswith(self.suffix)}
        self.longest, self.longest_last = max(map(len, self.inner)), max(map(len, self.last))
        self.letters = byte_letters()
        self.known: dict[str | int, tuple[bytes, str]] = {}  # of words
        self.seen: dict[str | int, tuple[bytes, str]] = {}  # of chunks between blanks

    def chunks(self, text: str) -> list[str | int]:
        """A text, lower-cased and in composed form, cut at blanks, which no word spans; special tokens as their ids."""
        out: list[str | int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                # Letter by letter, so that a sigma at a word's end is no special case.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            # str.split also cuts at four control characters that the file's rule takes for symbols.
            out += regex.split(r"\s+", part.lower()) if SEPARATORS.search(part) else part.lower().split()
        return out

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over a word in byte letters; the last token ends the word."""
        out, at, n, inner, last = [], 0, len(word), self.inner, self.last
        while True:
            if n - at <= self.longest_last and word[at:] in last:
                out.append(last[word[at:]])
                return out
            end = min(n - 1, at + self.longest)
            while word[at:end] not in inner:
                end -= 1
            out.append(inner[word[at:end]])
            at = end

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of neighbours: would merging their letters together give the same two tokens?

        Both tokens are taken apart at the boundary, latest merge first. At each moment two parts meet there; if a merge
        of those two comes before the merge that takes either of them away, it would have been made. At equal times the
        merge further left comes first.
        """
        fine = np.ones(len(left), bool)
        open_, a, b = np.arange(len(left)), left.copy(), right.copy()
        gone_a, gone_b = np.full(len(left), NONE), np.full(len(left), NONE)
        while len(open_):
            keys = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            born = np.where(self.pair_keys[at] == keys, self.pair_born[at], NONE)
            crossed = (born < gone_a) & (born <= gone_b) & (born != NONE)
            fine[open_[crossed]] = False
            on = ~crossed & ((self.born[a] > 0) | (self.born[b] > 0))
            open_, a, b, gone_a, gone_b = open_[on], a[on], b[on], gone_a[on], gone_b[on]
            undo_a = self.born[a] > self.born[b]
            both = self.born[a] == self.born[b]  # the same token: its right occurrence was merged last
            undo_a &= ~both
            gone_a, gone_b = np.where(undo_a, self.born[a], gone_a), np.where(undo_a, gone_b, self.born[b])
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return fine

    def exact(self, words: list[str]) -> list[list[int]]:
        """Plain merging of words in byte letters, all words side by side.

        Each round makes, in every word, the earliest merge that is possible there, at all its places from the left;
        a merge can only allow later ones, so this is the order of merging one place at a time.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter((self.inner[c] for w in words for c in w), np.int64, int(sizes.sum()))
        flat[np.cumsum(sizes) - 1] = [self.last[w[-1]] for w in words]
        owner, done = np.repeat(np.arange(len(words)), sizes), [[]] * len(words)
        while len(flat):
            keys = np.where(owner[1:] == owner[:-1], flat[:-1] << 32 | flat[1:], -1)
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            born = np.append(np.where(self.pair_keys[at] == keys, self.pair_born[at], NONE), NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            first = np.minimum.reduceat(born, starts)
            counts = np.diff(np.append(starts, len(flat)))
            for k in np.flatnonzero(first == NONE).tolist():
                done[owner[starts[k]]] = flat[starts[k]:starts[k] + counts[k]].tolist()
            earliest = np.repeat(first, counts)
            hit = (born == earliest) & (earliest != NONE)
            # In a run of overlapping places every second one counts, from the left.
            place = np.flatnonzero(hit)
            fresh_run = np.append(True, place[1:] != place[:-1] + 1) if len(place) else np.zeros(0, bool)
            since = np.arange(len(place)) - np.maximum.accumulate(np.where(fresh_run, np.arange(len(place)), 0))
            place = place[since % 2 == 0]
            flat[place] = self.made[born[place] - 1]
            stay = earliest != NONE
            stay[place + 1] = False
            flat, owner = flat[stay], owner[stay]
        return done

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Ids of each distinct word, and how many needed exact merging."""
        spelled = ["".join(map(self.letters.__getitem__, w.encode("utf-8"))) if not (w.isascii() and w.isprintable()) else w for w in words]
        guesses = [self.propose(w) for w in spelled]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((i for g in guesses for i in g), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(guesses)), sizes)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        wrong = np.unique(owner[inside[~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]]])
        for i, ids in zip(wrong.tolist(), self.exact([spelled[i] for i in wrong.tolist()])):
            guesses[i] = ids
        return guesses, len(wrong)

    def decode(self, ids: list[int]) -> str:
        """Token texts with a space between them, as the file names no decoder; unknown ids give nothing."""
        return " ".join(self.text[i] for i in ids if i in self.text)

    def _learn(self, chunks: list[str | int]) -> None:
        """Remember the ids and the decoded text of new chunks, encoding the words that are new in them."""
        cut = [[c] if isinstance(c, int) else self.words.findall(c) for c in chunks]
        new = list({w for words in cut for w in words if w not in self.known})
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known, new = {}, list({w for words in cut for w in words})
        plain = [w for w in new if not isinstance(w, int)]
        for word, ids in [*zip(plain, self.encode_words(plain)[0]), *((w, [w]) for w in new if isinstance(w, int))]:
            self.known[word] = (np.array(ids, "<u4").tobytes(), self.decode(ids))
        for chunk, words in zip(chunks, cut):
            found = [self.known[w] for w in words]
            self.seen[chunk] = found[0] if len(found) == 1 else (b"".join([f[0] for f in found]), " ".join([f[1] for f in found]))

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Of each text the ids as little-endian unsigned 32-bit integers, and the decoded text."""
        cut = [self.chunks(t) for t in texts]
        every = {c for chunks in cut for c in chunks}
        new = [c for c in every if c not in self.seen]
        if len(self.seen) + len(new) > CACHED_WORDS:
            self.seen, new = {}, list(every)
        self._learn(new)
        out = []
        for chunks in cut:
            found = [self.seen[c] for c in chunks]
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[0]])))
        return out


@lru_cache(maxsize=2)
def _tables(definition: str) -> WordBpe:
    return WordBpe(definition)


def encode(docs: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """Encode whole texts with the BPE file at the path ``tokenizer`` (read by the driver), and decode the ids again.

    Gives ``doc_id, n_tokens`` and ``ids array<long>, decoded string``, or ``ids_sha256, decoded_sha256`` with ``digests``.
    A missing text counts as empty and has no tokens. Special tokens written out in a text become their ids. Each row
    is worked on alone, so repeated rows and a missing id need no care; other columns are not read.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tables(definition.value)
        for whole in batches:
            for batch in batches_of(whole, "text", BATCH_BYTES):
                found = bpe.encode_batch([t or "" for t in batch.column("text").to_pylist()])
                counts = pa.array([len(f[0]) // 4 for f in found], pa.int64())
                if digests:
                    two = [pa.array([hashlib.sha256(f[0]).hexdigest() for f in found], pa.string()),
                           pa.array([hashlib.sha256(f[1].encode()).hexdigest() for f in found], pa.string())]
                else:
                    two = [pa.array([np.frombuffer(f[0], "<u4").astype(np.int64) for f in found], pa.list_(pa.int64())),
                           pa.array([f[1] for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, *two], names=names)

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<long>, decoded string"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return in_partitions(docs.select("doc_id", "text"), work, f"doc_id {id_type}, n_tokens long, {kinds}")
