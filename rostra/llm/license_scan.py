"""Licence scans with a positional index of rare licence words."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostra.llm.common import in_partitions

# Bytes of words stay (A-Z lower-cased), all others become blanks: words are runs of 0-9, a-z and non-ASCII characters.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Template(NamedTuple):
    label: str
    text: str
    mandatory: tuple[str, ...]


# Phrases that count as licence marks by themselves, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices of well-known public licences, and the phrases without which one is not present.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license "
                           "you may obtain a copy of the license at", ("apache license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                    "documentation files the software to deal in the software without restriction including without limitation the rights to use "
                    "copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                    "the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions "
                    "and the following disclaimer", ("redistribution and use in source and binary forms",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                        "published by the free software foundation either version 3 of the license or at your option any later version",
             ("general public license", "free software foundation", "version 3")),
    Template("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                        "published by the free software foundation either version 2 of the license or at your option any later version",
             ("general public license", "free software foundation", "version 2")),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with "
                        "this file you can obtain one at", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                    "granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("cc0", "to the extent possible under law the author has waived all copyright dedicated under cc0", ("cc0",)),
    Template("cc-by-4.0", "licensed under cc by 4.0", ("cc by 4.0",)),
    Template("cc-by-sa", "licensed under cc by sa 4.0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4.0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4.0", ("cc by nd",)),
    Template("eclipse", "made available under the terms of the eclipse public license", ("eclipse public license",)),
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def places(words: list[bytes], phrase: list[bytes], where: dict[bytes, list[int]]) -> list[int]:
    """Starts of all places where the words of the phrase stand one after the other."""
    n = len(phrase)
    rare = min(range(n), key=lambda i: len(where.get(phrase[i], ())))
    return [p - rare for p in where.get(phrase[rare], ()) if p >= rare and words[p - rare:p - rare + n] == phrase]


class Index:
    """Postings of all words of all templates: word to (template, position)."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[bytes, int], documents: int, lookups: int, votes: int):
        self.templates = [(t.label, words_of(t.text), [words_of(m) for m in t.mandatory]) for t in templates]
        self.base = [(words_of(p), label) for p, label in BASE]
        self.lookups = lookups
        phrases = [key for _, _, keys in self.templates for key in keys]
        every = {w for _, words, _ in self.templates for w in words} | {w for phrase in phrases for w in phrase}
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) for w in every}
        self.votes = [min(votes, len(set(words))) for _, words, _ in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, words, _) in enumerate(self.templates):
            for q, w in enumerate(words):
                self.postings[w].append((t, q))

        def rarest(phrase: list[bytes]) -> bytes:
            return max(phrase, key=lambda w: (self.idf.get(w, 0.0), w))
        #: The rarest word of each mandatory phrase: without all those of a template it cannot be present.
        self.needed = [{rarest(key) for key in keys} for _, _, keys in self.templates]
        self.always = {rarest(key) for key in phrases}
        self.triggers = self.always | {rarest(phrase) for phrase, _ in self.base}
        self.wanted = every | {w for phrase, _ in self.base for w in phrase}

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        if self.triggers.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        where: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.wanted:
                where[w].append(p)
        starts, base = [], set()
        for phrase, label in self.base:
            if found := places(words, phrase, where):
                starts += found
                base.add(label)
        labels, score = set(base), float(bool(base))
        keys = {t: at for t, (_, _, mandatory) in enumerate(self.templates)
                if self.needed[t] <= where.keys() and all(at := [places(words, m, where) for m in mandatory])}
        # The words of the highest idf that this text has, and those of the mandatory phrases, say where a template may lie.
        has = sorted(self.postings.keys() & where.keys(), key=lambda w: (-self.idf[w], w)) if keys else []
        offsets = {(t, p - q) for w in [*has[:self.lookups], *(w for w in has[self.lookups:] if w in self.always)]
                   for t, q in self.postings[w] if t in keys for p in where[w]}
        for t, offset in offsets:
            label, body, mandatory = self.templates[t]
            # Every mandatory phrase stands inside the stretch that the template covers, give or take a word each side.
            if all(_any_between(at, offset - 1, offset + len(body) + 1 - len(m)) for m, at in zip(mandatory, keys[t])):
                same = [w for i, w in enumerate(words[max(offset, 0):max(offset + len(body), 0)], max(-offset, 0)) if w == body[i]]
                if len(set(same)) >= self.votes[t]:
                    labels.add(label)
                    score = max(score, len(same) / len(body))
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(labels)), score)


def _any_between(places_: list[int], low: int, high: int) -> bool:
    at = bisect_left(places_, low)
    return at < len(places_) and places_[at] <= high


def word_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each licence word stands, over all documents; one row per word goes to the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for w in vocabulary.intersection(words_of(text or "")):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts = in_partitions(docs.select("text"), work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counts.collect()}


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, lookups: int = 16, votes: int = 2) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every document.

    A first pass counts in how many documents each word of the templates stands. All words of the templates are indexed with their
    positions. In each document, the ``lookups`` licence words of highest inverse document frequency that it has, and the rarest word of each mandatory
    phrase, however common, are looked up: together with their own places they say at which offset a template may lie. Where
    ``votes`` different words of the template stand at their places and its mandatory phrases too,
    the template's label is given. Phrases of ``BASE`` count wherever their words stand one after the other.
    ``score`` is 1 with a base phrase, else the largest share of a template's words found in place, 0 without a label.
    A missing text is empty: no words, no labels (""), no positions (null). Rows are scanned one by one, so repeated
    rows and missing ids need no care; other columns are not read.
    """
    vocabulary = {w for t in templates for phrase in (t.text, *t.mandatory) for w in words_of(phrase)}
    index = Index(templates, word_frequencies(docs, vocabulary), docs.count(), lookups, votes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = [index.scan(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))] if rows
                else [batch.column("doc_id"), *(pa.array([], k) for k in kinds)], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return in_partitions(docs.select("doc_id", "text"), work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                         "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
