"""Finding the terms of a large vocabulary in texts: a trie in sorted arrays, walked from all word starts at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd

BEYOND = 0x110000  # one more than the last code point: stands between texts, and no term has it
STARTS_AT_ONCE = 1 << 20
CHARS_AT_ONCE = 1 << 21


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: may it stand before a term, and after one?"""
    before = np.ones(BEYOND + 1, bool)
    before[ord("a"):ord("z") + 1] = before[ord("0"):ord("9") + 1] = False
    after = before.copy()
    after[[ord("+"), ord("#")]] = False
    return before, after


class Terms:
    """A trie of terms. Nodes are numbered level by level, so the edges, sorted by (parent, character), lie in the order of
    their children and child i + 1 hangs on edge i.

    A term can only begin where no letter or digit stands before it, so the few starts of a text are walked together, a
    character per step, and most end after two or three; failure links would lead to starts that do not count.
    """

    def __init__(self, terms: Iterable[str]):
        words = [_points(t) for t in sorted(set(terms)) if t]
        size = np.array([len(w) for w in words], np.int64)
        flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
        first = np.cumsum(size) - size
        node, edges, nodes = np.zeros(len(words), np.int64), [], 1
        for depth in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > depth)
            keys, place = np.unique(node[on] * (BEYOND + 1) + flat[first[on] + depth], return_inverse=True)
            node[on] = nodes + place
            nodes += len(keys)
            edges.append(keys)
        self.edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.ends = np.zeros(nodes, bool)
        self.ends[node] = size > 0
        self.opens = np.zeros(BEYOND + 1, bool)
        self.opens[flat[first]] = True
        self.before, self.after = _kinds()

    def longest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the longest term at each place that has one. ``points`` ends with BEYOND."""
        free = np.concatenate([[True], self.before[points[:-1]]])
        starts = np.flatnonzero(free & self.opens[points])
        length = np.zeros(len(starts), np.int64)
        for part in range(0, len(starts), STARTS_AT_ONCE):
            on = np.arange(part, min(part + STARTS_AT_ONCE, len(starts)))
            at, node = starts[on], np.zeros(len(on), np.int64)
            while len(on):
                key = node * (BEYOND + 1) + points[at]
                edge = np.searchsorted(self.edges, key)
                known = self.edges[np.minimum(edge, len(self.edges) - 1)] == key
                on, at, node = on[known], at[known] + 1, edge[known] + 1
                whole = self.ends[node] & self.after[points[np.minimum(at, len(points) - 1)]]
                length[on[whole]] = at[whole] - starts[on[whole]]
        return starts[length > 0], length[length > 0]

    def find(self, texts: pd.Series, known: pd.Series | None = None) -> pd.Series:
        """Per text ``[start, length, start, length, ...]`` in text order, with the longer of what is ``known``; missing texts have none."""
        out: list[list[int]] = [[] if known is None or known.iloc[i] is None else list(known.iloc[i]) for i in range(len(texts))]
        batch: list[int] = []
        chars = 0
        for i, text in enumerate(texts):
            if text:
                batch.append(i)
                chars += len(text)
            if chars >= CHARS_AT_ONCE:
                self._into(texts, batch, out)
                batch, chars = [], 0
        self._into(texts, batch, out)
        return pd.Series(out, dtype=object)

    def _into(self, texts: pd.Series, batch: list[int], out: list[list[int]]) -> None:
        if not batch or not len(self.edges):
            return
        parts = [p for i in batch for p in (_points(texts.iloc[i]), np.array([BEYOND], np.uint32))]
        first = np.cumsum([0] + [len(p) for p in parts])[::2]
        starts, lengths = self.longest(np.concatenate(parts))
        bounds = np.searchsorted(starts, first)
        for k, i in enumerate(batch):
            mine = slice(bounds[k], bounds[k + 1])
            found = dict(zip((starts[mine] - first[k]).tolist(), lengths[mine].tolist()))
            for at, n in zip(out[i][::2], out[i][1::2]):
                found[at] = max(n, found.get(at, 0))
            out[i] = [x for pair in sorted(found.items()) for x in pair]


def leftmost_longest(texts: pd.Series, found: pd.Series) -> pd.Series:
    """Distinct sorted terms of each text when it is read from the left and a term takes its characters with it."""
    out = []
    for text, places in zip(texts, found):
        terms, free = set(), 0
        for at, n in zip(places[::2], places[1::2]):
            if at >= free:
                terms.add(text[at:at + n])
                free = at + n
        out.append(sorted(terms))
    return pd.Series(out, dtype=object)
