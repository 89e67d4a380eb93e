"""Operators over the whole corpus, and the pipeline, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rostra.llm import lattice, line_dedup, lm_score, packing, simhash, suffix_array, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_repeats(rows, length):
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(data[p:p + length])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[i] = len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()
    return out


def test_suffix_array():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 3, 200):
        for n in range(0, 60):
            text = [*rng.integers(1, letters + 1, n).tolist(), 0]
            assert suffix_array.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:])


def test_window_classes():
    found = {}
    for c, segment, place in zip(*(x.tolist() for x in suffix_dedup.window_classes([b"abcdefgh", b"xbcdefy", b"\0\0\0\0\0\0"], 5))):
        found.setdefault(c, []).append((segment, place))
    classes = [sorted(c) for c in found.values()]
    assert [(0, 1), (1, 1)] in classes and [(2, 0), (2, 1)] in classes and sum(map(len, classes)) == 4 + 3 + 2 and len(classes) == 7


def test_suffix_dedup(unique_docs, unique_rows, no_docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(unique_docs).collect()}
    assert got == plain_repeats([(r[0], r[1]) for r in unique_rows], 100)
    assert sum(v[1] for v in got.values()) > 1000
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


@pytest.mark.parametrize("piece", [4 << 20, 700])
def test_suffix_dedup_of_overlapping_repeats(spark, monkeypatch, piece):
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("ab "), 60)) for _ in range(6)]

    def text():
        parts = [pool[rng.integers(6)][:rng.integers(1, 61)] if rng.random() < .7 else "".join(rng.choice(list("abcé "), rng.integers(0, 40))) for _ in range(rng.integers(0, 12))]
        return "".join(parts)
    rows = [(i, text()) for i in range(120)] + [(400, None), (401, "a" * 900), (402, "ab" * 300), (403, "a" * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if piece == 4 << 20:
        got = suffix_dedup.suffix_dedup(docs, 20, 6).collect()
    else:  # long texts are cut into pieces on the workers: look at the function that does it
        import pyarrow as pa
        monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 900)
        batch = pa.RecordBatch.from_arrays([pa.array([2, 1]), pa.array([b"x" * 2000, b"yz" * 100])], names=["key", "text"])
        cut = [(k, a, len(t)) for keys, at, texts in suffix_dedup._chunks(batch, 20) for k, a, t in zip(keys.tolist(), at.tolist(), texts)]
        assert cut == [(1, 0, 200), (2, 0, 719), (2, 700, 719), (2, 1400, 600)]
        return
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == plain_repeats(sorted(rows), 20)


def test_suffix_dedup_of_rows_without_own_ids(edge_docs, edge_rows):
    got = suffix_dedup.suffix_dedup(edge_docs).collect()
    assert len(got) == len(edge_rows)
    same = [r.n_removed for r in got if r.doc_id == 4]
    size = len(edge_rows[4][1].encode())
    assert sorted(same) == [0, size, size] or size < 100
    left = suffix_dedup.without_repeats(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == len(edge_rows)
    assert sum(r.n_chars for r in left.collect() if r.text) == sum(len(r.text) for r in left.collect() if r.text)


def plain_packing_is_valid(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        assert sum(r.n_tokens for r in held) + held[0].bin_free == capacity
        sources = [r.source for r in held if r.source is not None]
        assert len(sources) == len(set(sources)) and sorted(r.position for r in held) == list(range(len(held)))


def test_packing(edge_docs, edge_rows, no_docs):
    got = packing.best_fit_packing(edge_docs, capacity=300, block_docs=50).collect()
    plain_packing_is_valid(got, 300)
    tokens, want = Counter(), Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    for r in edge_rows:
        want[r[0]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    assert tokens == +want | {i: 0 for i, n in want.items() if not n}
    copies = [r.bin_id for r in got if r.doc_id == 4]
    assert len(copies) == len(set(copies)) == 3
    assert packing.best_fit_packing(no_docs).count() == 0


def test_best_fit_passes_over_conflicts():
    bins = packing.Bins(10)
    assert [bins.place(7, 1, 0), bins.place(5, 2, 0)] == [0, 1]
    assert bins.place(3, 1, 0) == 1  # the tightest bin holds source 1
    assert bins.place(2, 2, 0) == 0 and bins.place(1, 2, 0) == 2
    assert bins.place(1, 0, 4) == 0 and bins.place(1, 0, 4) == 1


def log_of_all_segmentations(word, scores):
    total = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        total[j] = sum(total[i] * math.exp(scores[word[i:j]]) for i in range(j) if word[i:j] in scores)
    return math.log(total[-1])


def test_lattice():
    pieces = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"abc", b" ab", b"bc"]
    scores = np.linspace(-3, -6, len(pieces))
    both = lattice.Pieces(pieces, np.stack([scores, scores[::-1]], axis=1))
    words = [b" abc", b" ab", b" c", b" abcabcab", b" " + b"abc" * 40]
    for m, own in enumerate((scores, scores[::-1])):
        table = dict(zip(pieces, own))
        assert np.allclose(both.log_probability(words)[:, m], [log_of_all_segmentations(w, table) for w in words])
    expected = np.zeros((len(pieces), 2))
    both.expect(words, np.array([0, 1, 0, 1, 1]), np.ones(len(words)), expected)
    covered = (expected * np.array([len(p) for p in pieces])[:, None]).sum()
    assert math.isclose(covered, sum(map(len, words)), rel_tol=1e-9)  # every byte is in one piece of each segmentation


def test_lm_score(edge_docs, edge_rows, no_docs):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER)) for r in edge_rows]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2 for r in edge_rows]
    counts, texts = Counter(w for k, ws in enumerate(words) if not held[k] for w in ws), len(held) - sum(held)
    n, v = sum(counts.values()) + texts, len(counts) + 1
    want = Counter()
    for r, ws, h in zip(edge_rows, words, held):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws) + math.log10((texts + 1) / (n + v + 1))
        want[r[0], h, len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n, round(base, 6)] += 1
    got = lm_score.lm_score(edge_docs, PIECES).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    long = [r for r in got if r.n_tokens > 1000]
    assert all(r.score > r.base_score - 0.3 * r.n_tokens for r in long)
    assert lm_score.lm_score(no_docs, PIECES).count() == 0


def test_every_repeated_training_word_is_a_piece(spark, monkeypatch):
    """Whether a word is kept in memory or met by the join: its own piece counts."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(80)), "xx") for i in range(60)], "doc_id long, text string, lang string")
    scores = {}
    for share, whole in ((5e-7, True), (1.0, True), (1.0, False)):
        monkeypatch.setattr(lm_score, "HOT_SHARE", share)
        got = lm_score.lm_score(docs, PIECES, whole_words=whole).collect()
        scores[share, whole] = sum(r.score for r in got if r.held_out) / sum(r.n_tokens for r in got if r.held_out)
    near, far, none = scores.values()
    assert none < far - 0.5 and abs(near - far) < 0.05 and -2.5 < far < -1.6  # 60 words: about log10(1 / 60) each


def test_patience_blocks():
    a, b = [1, 2, 3, 4, 5, 6, 7], [9, 1, 2, 3, 8, 5, 6, 2, 7]
    assert line_dedup.patience_blocks(a, b) == [(0, 1, 3), (4, 5, 2), (6, 8, 1)]
    assert line_dedup.patience_blocks([], [1]) == [] and line_dedup.patience_blocks([1, 1], [1, 1]) == [(0, 0, 2)]
    assert line_dedup.patience_blocks([8, 1, 2, 1, 2, 9], [7, 1, 2, 1, 2, 5]) == [(1, 1, 4)]
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (rng.integers(0, 8, rng.integers(0, 14)).tolist() for _ in range(2))
        ends = (0, 0)
        for i, j, n in line_dedup.patience_blocks(a, b):
            assert n > 0 and a[i:i + n] == b[j:j + n] and i >= ends[0] and j >= ends[1]
            ends = (i + n, j + n)
        assert sum(n for *_, n in line_dedup.patience_blocks(a, a)) == len(a)
        assert bool(line_dedup.patience_blocks(a, b)) == bool(set(a) & set(b))


def test_copies_with_repeated_lines_are_cleaned(spark):
    rng = random.Random(3)
    texts = ["a\nb\na\nb", "a\nb\na\nb", "x\nx", "x\nx"]
    for _ in range(15):
        text = "\n".join(rng.choice("pqr") + str(rng.randint(0, 2)) for _ in range(rng.randint(1, 30)))
        texts += [text] * rng.randint(1, 3)
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    first = {}
    for i, t in enumerate(texts):
        if first.setdefault(t, i) != i:
            assert got[i] == ""


def test_line_dedup(spark, edge_docs, edge_rows, no_docs):
    rows = [(1, "alpha one\nbeta two\ngamma three\nown line"), (2, "intro\nbeta  two \ngamma three\n\nouter"), (3, "gamma three\nbeta two"), (4, None), (5, "")]
    got = {r.doc_id: (r.n_lines, r.removed, r.text) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (4, [], rows[0][1]) and got[2] == (5, [1, 2], "intro\n\nouter")
    assert got[3][1] in ([0], [1])  # crossed lines: one of the two is aligned
    assert got[4] == (1, [], "") and got[5] == (1, [], "")
    common = [(i, f"common line\nown {i}") for i in range(30)]
    assert line_dedup.line_dedup(spark.createDataFrame(common, "doc_id long, text string"), rare_docs=10).where("n_removed > 0").count() == 0
    edge = line_dedup.line_dedup(edge_docs).collect()
    assert len(edge) == len(edge_rows) and all(len(r.text.split("\n")) == r.n_lines - r.n_removed or r.n_removed == r.n_lines for r in edge)
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_line_dedup_of_lines_in_very_many_documents(spark):
    passage = "\n".join(f"shared line {k}" for k in range(4))
    rows = [(i, passage) for i in range(150)] + [(i, f"own {i}\n{passage}\nend {i}") for i in range(150, 300)] + [(300, "own line")]
    got = {r.doc_id: (r.removed, r.text) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == ([], passage) and got[300] == ([], "own line")
    assert all(got[i] == ([0, 1, 2, 3], "") for i in range(1, 150))
    assert all(got[i] == ([1, 2, 3, 4], f"own {i}\nend {i}") for i in range(150, 300))


def test_pipeline(spark, unique_rows, tmp_path):
    import corpus_pipeline
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([r[:5] for r in unique_rows], columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = spark.createDataFrame([tuple(r) for r in stage(spark, table, str(tmp_path)).collect()], columns)
        seen.append({r.doc_id: r.text for r in table.collect()})
        assert table.columns == docs.columns
    texts = {r[0]: r[1] for r in unique_rows}
    lettered = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert seen[0] == lettered
    first = {}
    for i, t in sorted(lettered.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert seen[1] == {i: lettered[i] for i in first.values()}
    prints = {i: simhash.fingerprint(t)[0] for i, t in seen[1].items()}
    root = {i: i for i in prints}
    for _ in prints:
        least = {i: min(root[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
        if least == root:
            break
        root = least
    assert seen[2] == {i: seen[1][i] for i in prints if root[i] == i}
    kept = plain_repeats(sorted(seen[2].items()), 100)
    assert {i for i in kept if kept[i][1]} == {i for i, t in seen[3].items() if t != seen[2][i]}
    assert all(kept[i][0] - kept[i][1] - 8 <= len(t.encode()) <= kept[i][0] - kept[i][1] for i, t in seen[3].items())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(seen[3])
    plain_packing_is_valid(packed, packing.CAPACITY)
    assert sum(r.n_tokens for r in packed) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in seen[3].values())
