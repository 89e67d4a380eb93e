"""Forward and backward sums over all segmentations of words into pieces of a unigram vocabulary."""

from __future__ import annotations

from copy import copy

import numpy as np

SIDE_BY_SIDE = 48  # longer words are worked on one by one
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    mixed = hashes * _MIX
    return ((mixed ^ mixed >> np.uint64(32)) & np.uint64(slots - 1)).astype(np.int64)


class Pieces:
    """Vocabulary of byte strings with natural-log scores, a column for each model; all single bytes must be in it.

    Pieces with a leading blank can only stand first in a word.
    """

    def __init__(self, pieces: list[bytes], scores: np.ndarray):
        self.scores = scores
        self.place = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.longest_inside = max(len(p) for p in pieces if p[0] != 32)
        hashes = np.zeros(len(pieces), np.uint64)
        on = np.arange(len(pieces))
        for n in range(self.longest):
            on = on[[len(pieces[i]) > n for i in on.tolist()]]
            hashes[on] = hashes[on] * _BASE + np.array([pieces[i][n] + 1 for i in on.tolist()], np.uint64)
        if len(np.unique(hashes)) < len(pieces):
            raise ValueError("two pieces with one hash")
        self.slots = 1 << (4 * len(pieces)).bit_length()
        self.keys, self.found = np.zeros(self.slots, np.uint64), np.full(self.slots, -1, np.int32)
        for i, (h, s) in enumerate(zip(hashes, _slot(hashes, self.slots).tolist())):
            while self.found[s] >= 0:
                s = (s + 1) % self.slots
            self.keys[s], self.found[s] = h, i

    @property
    def models(self) -> int:
        return self.scores.shape[1]

    def with_scores(self, scores: np.ndarray) -> Pieces:
        """The same vocabulary with other scores."""
        other = copy(self)
        other.scores = scores
        return other

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, -1 for none."""
        slot = _slot(hashes, self.slots)
        out = np.where(self.keys[slot] == hashes, self.found[slot], -1)
        on = np.flatnonzero((out < 0) & (self.found[slot] >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) % self.slots
            hit = self.keys[slot[on]] == hashes[on]
            out[on[hit]] = self.found[slot[on[hit]]]
            on = on[~hit & (self.found[slot[on]] >= 0)]
        return out

    def _reach(self, i: int, n: int) -> range:
        """Ends of the pieces that may start at ``i`` of a word of ``n`` bytes."""
        return range(i + 1, min(n, i + (self.longest_inside if i else self.longest)) + 1)

    def _score(self, which: np.ndarray, model: np.ndarray | None) -> np.ndarray:
        return self.scores[which] if model is None else self.scores[which, model][:, None]

    def _same_length(self, letters: np.ndarray, model: np.ndarray | None, weights: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        count, n = letters.shape
        ahead = np.full((n + 1, count, self.models if model is None else 1), -np.inf)
        ahead[0] = 0.0
        arcs = []
        for i in range(n):
            hashes = np.zeros(count, np.uint64)
            for j in self._reach(i, n):
                hashes = hashes * _BASE + (letters[:, j - 1].astype(np.uint64) + np.uint64(1))
                which = self._lookup(hashes)
                on = np.flatnonzero(which >= 0)
                if len(on):
                    which = which[on]
                    score = self._score(which, None if model is None else model[on])
                    ahead[j, on] = np.logaddexp(ahead[j, on], ahead[i, on] + score)
                    if expected is not None:
                        arcs.append((i, j, on, which, score))
        if expected is not None:
            behind = np.full((n + 1, count, 1), -np.inf)
            behind[n] = 0.0
            for i, j, on, which, score in reversed(arcs):
                through = score + behind[j, on]
                behind[i, on] = np.logaddexp(behind[i, on], through)
                share = np.exp(ahead[i, on] + through - ahead[n, on])[:, 0] * weights[on]
                np.add.at(expected, (which, model[on]), share)
        return ahead[n]

    def _alone(self, word: bytes, model: int | None = None, weight: float = 0.0, expected: np.ndarray | None = None) -> np.ndarray:
        n = len(word)
        arcs = [[(j, self.place[word[i:j]]) for j in self._reach(i, n) if word[i:j] in self.place] for i in range(n)]
        scores = self.scores if model is None else self.scores[:, model:model + 1]
        ahead, behind = np.full((n + 1, scores.shape[1]), -np.inf), np.full((n + 1, scores.shape[1]), -np.inf)
        ahead[0] = behind[n] = 0.0
        for i in range(n):
            for j, which in arcs[i]:
                ahead[j] = np.logaddexp(ahead[j], ahead[i] + scores[which])
        if expected is not None:
            for i in range(n - 1, -1, -1):
                for j, which in arcs[i]:
                    through = scores[which] + behind[j]
                    behind[i] = np.logaddexp(behind[i], through)
                    expected[which, model] += weight * float(np.exp(ahead[i] + through - ahead[n])[0])
        return ahead[n]

    def _by_length(self, words: list[bytes]):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(sizes[order]) != 0)) if len(order) else []
        for start, end in zip(cuts, [*cuts[1:], len(order)]):
            on, n = order[start:end], int(sizes[order[start]])
            letters = np.frombuffer(b"".join([words[k] for k in on.tolist()]), np.uint8).reshape(len(on), n) if n <= SIDE_BY_SIDE else None
            yield on, letters

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability in each model, summed over all its segmentations."""
        out = np.zeros((len(words), self.models))
        for on, letters in self._by_length(words):
            if letters is None:
                for k in on.tolist():
                    out[k] = self._alone(words[k])
            else:
                out[on] = self._same_length(letters, None, None, None)
        return out

    def expect(self, words: list[bytes], model: np.ndarray, weights: np.ndarray, expected: np.ndarray) -> None:
        """Add to ``expected`` how often each piece is used in each word's own model, over all segmentations, ``weights`` times."""
        for on, letters in self._by_length(words):
            if letters is None:
                for k in on.tolist():
                    self._alone(words[k], int(model[k]), float(weights[k]), expected)
            else:
                self._same_length(letters, model[on], weights[on], expected)
