"""Packing and language ID against brute force, and all operators that change texts on a table without rows."""

import random
from collections import Counter

import pandas as pd
import pytest

from rostra.llm import exact_dedup, language_id, packing, simhash, suffix_dedup


def plain_best_fit(items, capacity):
    """Every bin is tried for every item: the tightest one with room and no conflict, the oldest of equal ones."""
    bins, placed = [], {}
    for row, piece, size, source, cluster in sorted(items, key=lambda x: (-x[2], x[0], x[1])):
        best = None
        for k, (room, sources, clusters) in enumerate(bins):
            if room >= size and (source is None or source not in sources) and (cluster is None or cluster not in clusters):
                if best is None or room < bins[best][0]:
                    best = k
        if best is None:
            bins.append((capacity, set(), set()))
            best = len(bins) - 1
        room, sources, clusters = bins[best]
        bins[best] = (room - size, sources | {source} - {None}, clusters | {cluster} - {None})
        placed[row, piece] = best
    return placed, [b[0] for b in bins]


@pytest.mark.parametrize("seed", range(8))
def test_packing_equals_brute_force(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 200])
    items = [(row, 0, rng.randint(0, capacity), rng.choice([None, *"abcdefgh"]), rng.choice([None, None, *"123"])) for row in range(rng.randint(1, 250))]
    table = pd.DataFrame(items, columns=["row", "piece", "n_tokens", "source", "cluster"])
    got = packing.pack_block(table.sample(frac=1, random_state=seed), capacity)
    placed, room = plain_best_fit(items, capacity)
    assert {(r.row, r.piece): r.bin for r in got.itertuples()} == placed
    assert all(room[r.bin] == r.bin_free for r in got.itertuples())


def plain_grams(text):
    words, out = "".join(c if c.isalpha() else " " for c in f" {text.lower()} "), Counter()
    words = f" {' '.join(words.split())} " if words.strip() else " "
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            g = words[i:i + n]
            if g != " " and " " not in g[1:-1]:
                out[g] += 1
    return out


def plain_ranking(counts, most):
    def packed(g):
        key = 0
        for c in g:
            key = key << 21 | ord(c)
        return key
    return sorted(counts, key=lambda g: (-counts[g], packed(g)))[:most]


def test_language_id_equals_brute_force(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdéfg ", "bb": "defghßü ", "cc": "xyzabc' "}
    rows = []
    for i in range(90):
        lang = sorted(letters)[i % 3]
        rows.append((i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 900))), lang if i % 7 else None))
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 !", "cc"), (103, "ÀÉ", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = 60
    profiles = language_id.fit_profiles(docs.where("doc_id % 2 = 0"), size)
    counts = {}
    for i, text, lang in rows:
        if i % 2 == 0 and lang and text is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    want = {lang: plain_ranking(c, size) for lang, c in counts.items()}
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.predict_language(docs, profiles, size).collect()}
    for i, text, _ in rows:
        mine = plain_ranking(plain_grams(text or ""), size)
        if not mine:
            assert got[i] == ("und", 0.0)
            continue
        away = {lang: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(mine)) for lang, p in want.items()}
        best = min(sorted(away), key=away.get)
        assert got[i] == (best, round(1 - away[best] / (size * len(mine)), 9))


def test_stages_on_a_table_without_rows(no_docs):
    for stage in (language_id.known_language, exact_dedup.kept_documents, simhash.one_of_each, suffix_dedup.without_repeats):
        out = stage(no_docs)
        assert out.columns == no_docs.columns and out.count() == 0
    assert packing.best_fit_packing(no_docs).count() == 0
