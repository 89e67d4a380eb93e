"""Spelling variants, ranked search and toxicity, against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rostra.llm import queries, ranked_search, spelling, toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def variant_rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randint(4, 9))) for _ in range(40)] + ["y" * 300, "étéété", "aaaaa", "aaaaaa", "×÷×÷×"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(base[:rng.randint(1, len(base))])
            if rng.random() < 0.5:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "B", "é", "ab", w[at] * 2]) + w[at + 1:]
            words.append(w)
        rows.append((i, rng.choice([" ", "-", "\n", "1", "ł", "東"]).join(words)))
    rows += [(700 + i, "alphabet " * 8 + "alphabets " * 3 + "alphabetzs " * (i % 2)) for i in range(8)]  # forms of forms
    rows += [(500, None), (501, ""), (502, " \n 12 ? "), (503, "zebra " * 30000 + "zebras " * 3), (None, "without idea " * 5), (None, "without idea " * 5), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("crowded", [spelling.CROWDED, 3])
def test_spelling_variants(spark, monkeypatch, crowded):
    rows = variant_rows()
    monkeypatch.setattr(spelling.near_words, "__defaults__", (crowded,))
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, n long, word string, form string").repartition(3)
    got = spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = plain_variants(rows)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sum(f is not None for _, f, *_ in want) > 50 and any(r != f and f for _, f, r, *_ in want)


def test_spelling_on_an_empty_table(no_docs):
    assert spelling.spelling_variants(no_docs).count() == 0


def test_position_index_equals_brute_force():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(7, 8))) for _ in range(700)})
    coded = [w.encode("latin-1") for w in words]
    for low, high in ((0, 3), (3, 7), (0, 7)):  # one block: pairs whose shorter word has 7 letters and whose first difference is in the window
        q, found = spelling.PositionIndex(coded, np.zeros(len(words), np.int64), np.full(len(words), 7), np.full(len(words), low), np.full(len(words), high)).near()
        want = set()
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                if min(len(a), len(b)) == 7 and one_edit(a, b):
                    first = next((k for k in range(7) if a[k] != b[k]), 7)
                    if low <= first < high or first == high == 7:
                        want.add((i, j))
        assert set(zip(q.tolist(), found.tolist())) == want and len(want) == len(q)


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_ranking(docs, items, best):
    terms = [plain_terms(t) for _, t in docs]
    sizes = [len(t) for t in terms]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for ts in terms for t in set(ts))
    counts = [Counter(t) for t in terms]
    out = []
    joined = defaultdict(list)
    for item, text in items:
        joined[item] += plain_terms(text)
    for item, asked in joined.items():
        scored = []
        for (doc_id, _), c, n in zip(docs, counts, sizes):
            score = 0
            for t in asked:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, doc_id, -s) for k, (s, _, _, doc_id) in enumerate(sorted(scored)[:best])]
    return out


@pytest.mark.parametrize("block, at_once", [(1 << 13, 1000), (16, 2)])
def test_ranked_search(spark, edge_docs, edge_rows, no_docs, monkeypatch, block, at_once):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_search, "FIRST_READS", 2)
    items = [(1, "the words of this and THAT that"), (2, "der die das"), (3, None), (4, ""), (5, "zzz unknown"), (6, edge_rows[4][1]), (7, "no id at all"),
             (None, "café ist"), (7, "id"), (8, "more " + "the " * 50)]
    table = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, rank int, score int")
    want = plain_ranking([r[:2] for r in edge_rows], items, 20)
    got = ranked_search.ranked_search(edge_docs, table, 20, at_once).select("item_id", "rank", "doc_id", "score").collect()
    assert Counter(map(tuple, got)) == Counter(want) and len(want) > 80
    assert ranked_search.ranked_search(no_docs, table).count() == 0
    assert ranked_search.ranked_search(edge_docs, table.where("item_id > 99")).count() == 0


def test_reading_stops_early_with_whole_results():
    rng = np.random.default_rng(4)
    docs, terms = 20_000, 12
    hits = rng.random((terms, docs)) < np.linspace(0.02, 0.9, terms)[:, None]
    impact = rng.zipf(1.6, (terms, docs)).clip(1, 40_000)
    impact[:, 500:520] = impact[:, 500:501]  # ties
    t, d = np.nonzero(hits)
    lists = ranked_search.ImpactLists(t, d, impact[t, d], docs)
    weights = {k: int(w) for k, w in enumerate(np.linspace(3000, 10, terms))} | {99: 5}
    scores = (hits * impact * np.array([weights[k] for k in range(terms)])[:, None]).sum(axis=0)
    found, got, reads = lists.search(weights, 20, 1)
    last = np.sort(scores)[-20]
    assert set(found.tolist()) == set(np.flatnonzero(scores >= last).tolist()) and (scores[found] == got).all()
    assert reads <= len(t)  # a list is read to its end where a document of the result is not in it
    none = lists.search(weights, 20, int(scores.max()) + 1)
    assert len(none[0]) == 0 and none[2] < 0.7 * len(t)
    above = lists.search(weights, 20, int(last) + 1)
    assert set(above[0].tolist()) == set(np.flatnonzero(scores > last).tolist()) and above[2] <= reads


def test_block_max_search_equals_full_product():
    rng = np.random.default_rng(8)
    idf = rng.random(40) + 1
    vectors = sorted({tuple(zip(*sorted({int(t): int(f) for t, f in zip(rng.integers(0, 40, rng.integers(1, 9)), rng.integers(1, 4, 9))}.items()))) for _ in range(900)})
    index = toxicity.BlockMaxIndex(vectors, idf)
    dense = np.zeros((len(vectors), 40))
    for k, (t, f) in enumerate(vectors):
        dense[k, list(t)] = index.weights(t, f)
    assert len(vectors) > 600
    for k in range(0, len(vectors), 7):
        rows, sims = index.nearest(*vectors[k], 16)
        full = dense @ dense[k]
        last = np.sort(full)[-16]
        assert set(np.flatnonzero(full > last + 1e-9)) <= set(rows.tolist()) <= set(np.flatnonzero(full >= last - 1e-9)) and len(rows) >= 16
        assert np.allclose(sims, full[rows]) and (np.diff(sims) <= 0).all() and k in rows[:5]
    assert len(toxicity.BlockMaxIndex([], idf).nearest((1, 2), (1, 1), 5)[0]) == 0


def test_short_lists_are_read_without_bounds_of_blocks(monkeypatch):
    """F op13: the bounds of all blocks cost more than the lists; long lists still go by blocks, with the same rows and cosines."""
    rng = random.Random(4)
    vectors = sorted({(t, tuple(rng.randint(1, 3) for _ in t)) for t in (tuple(sorted(rng.sample(range(40), rng.randint(1, 9)))) for _ in range(900))})
    idf = np.array([1 + rng.random() for _ in range(40)])
    whole, blocks = toxicity.BlockMaxIndex(vectors, idf), toxicity.BlockMaxIndex(vectors, idf)
    whole.most = None
    got = [whole.nearest(*v, 16) for v in vectors[::9]]
    monkeypatch.setattr(toxicity, "READ_WHOLE", -1, raising=False)
    want = [blocks.nearest(*v, 16) for v in vectors[::9]]
    assert all((a == c).all() and (b == d).all() and len(a) >= 16 for (a, b), (c, d) in zip(got, want))


def test_texts_with_frequent_terms_are_looked_up_together(monkeypatch):
    """F op13: where labels depend on frequent words most examples share terms with a text; a lookup of its own for each text read all their postings."""
    rng = np.random.default_rng(11)
    vectors = sorted({(tuple(t), tuple(rng.integers(1, 6, len(t)).tolist())) for t in (np.flatnonzero(rng.random(60) < 0.6).tolist() for _ in range(1500)) if t})
    index, summed = toxicity.BlockMaxIndex(vectors, rng.random(60) + 1), []
    dense = np.zeros((len(vectors), 60))
    for k, (t, f) in enumerate(vectors):
        dense[k, list(t)] = index.weights(t, f)
    cosines = index._cosines
    monkeypatch.setattr(index, "_cosines", lambda asked, text, row: summed.append(len(row)) or cosines(asked, text, row))
    texts = vectors[::10]
    got = index.nearest_of(texts, 16)
    assert sum(summed) < len(texts) * len(vectors) / 20
    for k, (rows, sims) in enumerate(got):
        full = dense @ dense[10 * k]
        last = np.sort(full)[-16]
        assert set(np.flatnonzero(full > last + 1e-9)) <= set(rows.tolist()) <= set(np.flatnonzero(full >= last - 1e-9)) and np.allclose(sims, full[rows])
    assert index.nearest_of([], 16) == [] and toxicity.BlockMaxIndex([], np.ones(0)).nearest_of([], 16) == []
    alone = [index.nearest(*v, 16) for v in texts]
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(got, alone))


def toxic_rows():
    rng = random.Random(5)
    plain = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            words += rng.choices(["Horrid", "vile,", "NASTY"], k=rng.randint(1, 4))
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs += [(1000, None), (1001, ""), (1002, "!!"), (1003, docs[0][1]), (None, "vile horrid"), (None, docs[0][1]), docs[2], docs[2], (1004, "nasty " * 50000)]
    labels += [(None, 1), (3, None), (2, labels[2][1]), (4, 1 - labels[4][1]), (77777, 1)]
    return docs, labels


def plain_toxicity(docs, labels):
    """The same by dense cosine, without index."""
    means = defaultdict(list)
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5:
            means[i].append(y)
    texts = {}
    for i, t in docs:
        if i in means:
            texts[i] = min(texts.get(i, t or ""), t or "")
    y = {i: int(sum(means[i]) / len(means[i]) >= 0.5) for i in texts}
    seen, bad = Counter(), Counter()
    for i, t in texts.items():
        for w in set(plain_terms(t)):
            seen[w] += 1
            bad[w] += y[i]
    n, m = len(y), sum(y.values())

    def g2(w):
        cells = [(bad[w], seen[w] * m / n), (seen[w] - bad[w], seen[w] * (n - m) / n), (m - bad[w], (n - seen[w]) * m / n), (n - m - seen[w] + bad[w], (n - seen[w]) * (n - m) / n)]
        return 2 * sum(a * math.log(a / b) for a, b in cells if a)
    vocabulary = sorted(w for w in seen if seen[w] >= 3 and g2(w) >= toxicity.LEAST_G2)
    df = Counter(w for _, t in docs for w in set(plain_terms(t)) & set(vocabulary))
    idf = np.array([math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in vocabulary])

    def vector(t):
        c = Counter(plain_terms(t))
        raw = np.array([(1 + math.log(c[w])) if c[w] else 0.0 for w in vocabulary]) * idf
        return raw / (np.linalg.norm(raw) or 1)
    def counts(t):
        c = Counter(plain_terms(t))
        return tuple(c[w] for w in vocabulary)
    groups, of = defaultdict(list), {}
    for i, t in texts.items():
        groups[counts(t)].append(y[i])
        of[counts(t)] = vector(t)
    base = m / n

    def vote(t, without=None):
        q = vector(t)
        own = counts(t)
        if not q.any():
            k, bad_ = len(groups[own]) - (without is not None), sum(groups[own]) - (without or 0)
            return (bad_ + base) / (k + 1)
        sims = sorted(((float(np.dot(q, of[v])), v) for v in groups if any(v) and np.dot(q, of[v]) > 0), reverse=True)
        last = sims[min(16, len(sims)) - 1][0]
        top = bottom = 0.0
        for s, v in sims:
            if s >= last - 1e-12:
                k, bad_ = len(groups[v]), sum(groups[v])
                if without is not None and v == own:
                    k, bad_ = k - 1, bad_ - without
                top, bottom = top + s ** 4 * bad_, bottom + s ** 4 * k
        return (top + base) / (bottom + 1)
    slope, shift = toxicity.calibration(np.array([vote(texts[i], y[i]) for i in sorted(texts)]), np.array([y[i] for i in sorted(texts)], float))
    out = []
    for i, t in docs:
        v = vote(t)
        out.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0, 1 / (1 + math.exp(-(slope * math.log(v / (1 - v)) + shift)))))
    return out, vocabulary


def test_toxicity(spark, no_docs):
    docs, labels = toxic_rows()
    table = spark.createDataFrame([(*d, "en", 9, 0.5) for d in docs], "doc_id long, text string, lang string, toxic int, score double").repartition(3)
    marks = spark.createDataFrame([(*x, "t", 1) for x in labels], "doc_id long, toxic int, text string, term int")
    want, vocabulary = plain_toxicity(docs, labels)
    assert {"horrid", "vile", "nasty"} <= set(vocabulary)
    got = toxicity.toxicity(table, marks).collect()
    rounded = [(r.doc_id, r.held_out, round(r.score, 6)) for r in got]
    assert Counter(rounded) == Counter((i, h, round(s, 6)) for i, h, s in want)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    truth = dict(labels[:400])
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400 and r.doc_id not in (2, 3, 4)]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    shown = next(r.evidence for r in got if r.doc_id == 1004)
    assert shown and shown[0].n_toxic > 0 and shown[0].similarity == pytest.approx(1.0) and truth[shown[0].doc_id] == 1
    assert toxicity.toxicity(no_docs, marks).count() == 0
    assert {r.score for r in toxicity.toxicity(table, marks.where("doc_id < 0")).collect()} == {0.0}


def test_sql_covers_what_sql_can_express():
    assert {"op7_exact_dedup", "op12_ranked_search"} == set(queries.ORACLES)
