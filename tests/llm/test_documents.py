"""Operators that work document by document or by groups of equal texts, against plain versions."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostra.llm import bpe, exact_dedup, imatch, language_id, license_scan, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE_FILE = public_tokenizers.path("word_bpe_49k.json")


def test_exact_dedup(edge_docs, edge_rows, no_docs):
    groups = defaultdict(list)
    for r in edge_rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    want = set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i, n in Counter(ids).items():
            want.add((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest(), n))
    got = exact_dedup.exact_dedup(edge_docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_rows").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    kept = exact_dedup.kept_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({min((i for i in ids if i is not None), default=None): 1 for ids in groups.values()})
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_exact_dedup_spreads_a_hot_group(spark):
    rows = [(i, "same" if i % 3 else f"text {i}") for i in range(3000)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(40)).where("group_size > 1")
    assert got.count() == 2000 and {(r.keep_id, r.group_size) for r in got.collect()} == {(1, 2000)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(edge_docs, edge_rows, no_docs):
    prints = [plain_fingerprint(r[1]) for r in edge_rows]
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            root[find(b)] = find(a)
    least = defaultdict(list)
    for k, r in enumerate(edge_rows):
        least[find(k)].append(r[0])
    want = Counter((r[0], f"{prints[k]:016x}", min((i for i in least[find(k)] if i is not None), default=None)) for k, r in enumerate(edge_rows))
    got = simhash.simhash_components(edge_docs).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == want
    first = Counter(r for k, r in enumerate(edge_rows) if r[0] == min((i for i in least[find(k)] if i is not None), default=None))
    one = simhash.one_of_each(edge_docs)
    assert one.columns == edge_docs.columns and Counter(map(tuple, one.collect())) == first
    assert simhash.simhash_components(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    rows = [(None, "zz yy xx ww vv uu"), (None, None), (5, ""), (7, "aa bb cc dd ee"), (7, "ff gg hh ii jj kk"), (6, "ff gg hh ii jj kk")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == Counter([rows[0], rows[2], rows[3], rows[5]])


@pytest.mark.parametrize("hot", [False, True])
def test_gray_index_finds_all_links(hot):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 64, 150, dtype=np.uint64)
    near = [base]
    for _ in range(4):
        copy = base.copy()
        for _ in range(3):
            copy ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        near.append(copy)
    fps = np.unique(np.concatenate([*near, rng.integers(0, 2 ** 8, 200).astype(np.uint64)]))
    keys, places = simhash._block_keys(fps, np.zeros(0, np.int64))
    if hot:
        keys, places = simhash._block_keys(fps, np.unique(keys))
    root = {int(f): int(f) for f in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in zip(*(x.tolist() for x in simhash.GrayIndex(keys, fps[places]).links())):
        root[find(a)] = find(b)
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert all(find(int(fps[a])) == find(int(fps[b])) for a, b in zip(*np.nonzero(linked)))
    groups = len({find(f) for f in root})
    reach = linked.copy()
    while ((wider := (reach.astype(int) @ reach.astype(int)) > 0) != reach).any():
        reach = wider
    assert groups == len({tuple(row.tolist()) for row in reach})


def test_gray_rank_neighbours_differ_in_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(ordered[1:] ^ ordered[:-1]) == 1).all()


def test_language_id(edge_docs, edge_rows, no_docs):
    got = language_id.language_id(edge_docs).collect()
    assert len(got) == len(edge_rows)
    texts = defaultdict(set)
    for r in edge_rows:
        texts[r[0]].add((r[1], r[2]))
    for r in got:
        (text, lang), *_ = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 4 == 2) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif len(text) > 60 and lang in ("en", "de"):
            assert r.lang_pred == lang or set(text) <= set("ax")
    kept = language_id.known_language(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in edge_docs.collect()} - {r.doc_id for r in kept.collect()} == {r[0] for r in edge_rows if not any(c.isalpha() for c in r[1] or "")}
    assert language_id.language_id(no_docs).count() == 0
    assert {r.lang_pred for r in language_id.predict_language(edge_docs, {}).collect()} == {"und"}


def test_gram_counts_in_pieces(monkeypatch):
    text = "The quick brown fox, jumps over 12 lazy dogs. " * 50
    keys, counts = language_id.count_grams(text)
    words = re.findall(r"[a-z]+", text.lower())
    padded = " " + " ".join(words) + " "
    want = Counter(padded.replace(" ", ""))
    want += Counter(padded[i:i + 2] for i in range(len(padded) - 1)) + Counter(padded[i:i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " ")
    assert sum(counts) == sum(want.values()) and sorted(counts) == sorted(want.values())
    monkeypatch.setattr(language_id, "PIECE", 200)
    again = language_id.count_grams(text)
    assert set(again[0]) == set(keys) and abs(again[1].sum() - counts.sum()) < 40  # a cut can double a blank


def test_bpe_equals_the_library(edge_docs, edge_rows, no_docs):
    library = Tokenizer.from_file(BPE_FILE)
    got = bpe.encode(edge_docs, BPE_FILE).collect()
    want = Counter()
    for r in edge_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in got) == want
    hashed = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in bpe.encode(edge_docs, BPE_FILE, digests=True).collect()}
    for r in got:
        assert hashed[r.doc_id] == (hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) or r.doc_id is None
    assert bpe.encode(no_docs, BPE_FILE).count() == 0


def test_bpe_odd_texts_and_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    library, own = Tokenizer.from_file(BPE_FILE), bpe.WordBpe(open(BPE_FILE, encoding="utf-8").read())
    letters = [chr(c) for c in range(0x2500)]
    import unicodedata
    texts = [f"a{c}b {c}{c}" for c in letters if unicodedata.category(c) != "Cn" and c != "՘"]
    texts += ["x" * 3000, "ab" * 900, "aaaaaaaa aaa", "a\x1cb \x1d", "<|startoftext|><|ENDOFTEXT|>", "thing's we'll I'D", "  ", ""]
    for at in range(0, len(texts), 97):
        for text, (ids, decoded) in zip(texts[at:at + 97], own.encode_batch(texts[at:at + 97])):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)


def test_fingerprints(edge_docs, unique_docs, unique_rows, no_docs):
    got = {r.doc_id: r for r in imatch.edited_fingerprints(unique_docs, least=0.01, most=0.9).collect()}
    ids = sorted(got)
    assert ids == [r[0] for r in unique_rows]
    texts = {r[0]: r[1] or "" for r in unique_rows}
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    prints = {r.doc_id: r.fingerprint for r in imatch.document_fingerprints(unique_docs, 0.01, 0.9).collect()}
    assert prints == {i: r.fingerprint for i, r in got.items()}
    assert prints[4] == prints[60] and len(set(prints.values())) > 50
    long = [r for i, r in got.items() if len(texts[i]) > 200 and got[i].fingerprint]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long])
    assert imatch.edited_fingerprints(edge_docs).count() == edge_docs.count() and imatch.edited_fingerprints(no_docs).count() == 0


def plain_signature(text, lexicon):
    """The hashes of a text's lexicon terms in the subsets, worked out with the xxhash library."""
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chained(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
        return f"{h:016x}"
    terms = sorted({signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())})
    cells = defaultdict(list)
    for t in (t for t in terms if t in lexicon):
        u = t & (1 << 64) - 1
        cells[u % 32].append(t)
        if u >> 5 & 7 == 0:
            cells[32 + (u >> 11) % 32].append(t)
        if u >> 5 & 63 == 0:
            cells[64 + (u >> 11) % 32].append(t)
    out = [f"{c:02x}{chained(v)}" for c, v in sorted(cells.items())]
    return out + ([f"60{chained(terms)}"] if terms and sum(t in lexicon for t in terms) < imatch.FEW_TERMS else [])


def test_fingerprints_equal_a_plain_version(spark):
    import random
    rng = random.Random(12)
    words = [f"w{k}" for k in range(3000)]
    rows = [(i, " ".join(rng.choice(words[:rng.choice([20, 300, 3000])]) for _ in range(rng.randint(1, 200)))) for i in range(120)]
    rows += [(500, "SHORT one!"), (501, "another Text"), (502, "short ONE!"), (503, None), (504, ""), (505, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = Counter(w for _, t in rows for w in set((t or "").lower().split()))
    lexicon = {xxhash.xxh64_intdigest(w.encode(), 42) for w, n in seen.items() if max(2, 0.005 * len(rows)) <= n <= 0.2 * len(rows)}
    lexicon = {x - (1 << 64) if x >> 63 else x for x in lexicon}
    assert len(lexicon) > 500
    want = {i: plain_signature(t or "", lexicon) for i, t in rows}
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: "".join(s) for i, s in want.items()}
    for (i, t), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        t, following = t or "", following or ""
        edited = plain_signature(t[:len(t) - len(t) // 2] + following[:len(t) // 2], lexicon)

        def likeness(a, b):
            cells = {x[:2] for x in a} | {x[:2] for x in b}
            return len(set(a) & set(b)) / len(cells) if cells else 1.0
        assert got[i].near_edited == pytest.approx(likeness(want[i], edited))
        assert got[i].near_next == pytest.approx(likeness(want[i], plain_signature(following, lexicon)))
    assert got[500].near_next == 0.0 and got[501].near_next == 0.0 and got[503].near_next == 1.0 and want[500] == want[502]


def test_no_term_of_the_band_is_left_out(spark):
    rows = [(i, " ".join(f"t{k}" for k in range(20_000) if k % 10 == i % 10)) for i in range(20)]
    hashes = spark.createDataFrame(rows, "doc_id long, text string").select(imatch.term_hashes(F.col("text")).alias("terms"))
    assert len(imatch.fit_lexicon(hashes)) == 20_000


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(imatch, "GROUP_DOCS", 7)
    rows = [(i * 3, f"text {i} " * (i % 5 + 1)) for i in range(200)]
    got = {r.doc_id: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 0.0001, 1.0).collect()}
    for k, (i, text) in enumerate(rows):
        half, following = len(text) // 2, rows[(k + 1) % len(rows)][1]
        assert got[i].edited_sha256 == hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()
    one = imatch.edited_fingerprints(spark.createDataFrame([(1, "alone here")], "doc_id long, text string"), 0.0001, 1.0).first()
    assert one.near_next == 1.0


def test_license_scan(edge_docs, edge_rows, no_docs):
    got = license_scan.license_scan(edge_docs).collect()
    texts = {r[0]: r[1] or "" for r in edge_rows}
    assert len(got) == len(edge_rows)
    for r in got:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(LOWER))
        found = [(k, label) for phrase, label in license_scan.BASE for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    licensed = next(r for r in got if "cc-by" in r.base_labels)
    assert licensed.labels == "cc-by,cc-by-nc,reserved" and licensed.score == 1.0
    assert license_scan.license_scan(no_docs).count() == 0


def test_license_needs_its_mandatory_phrase(spark):
    rows = [(1, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
            (2, "permission to copy this software and the associated documentation files to any person"), (3, "Licensed under the Apache License, Version 2.0."),
            (4, "an apache helicopter under version control"), (5, "nothing here")]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "", "apache-2.0", "", ""] and 0 < got[1].score < 1 and got[5].score == 0.0


def plain_labels(text, templates, votes=2):
    """Labels and score by trying every template at every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    labels, score = set(), 0.0
    for phrase, label in license_scan.BASE:
        if any(words[k:k + len(cut(phrase))] == cut(phrase) for k in range(len(words))):
            labels.add(label)
            score = 1.0
    for t in templates:
        body = cut(t.text)
        for offset in range(-len(body), len(words)):
            same = [w for i, w in enumerate(body) if 0 <= offset + i < len(words) and words[offset + i] == w]
            inside = all(any(words[p:p + len(cut(m))] == cut(m) for p in range(max(offset - 1, 0), offset + len(body) + 2 - len(cut(m)))) for m in t.mandatory)
            if inside and len(set(same)) >= min(votes, len(set(body))):
                labels.add(t.label)
                score = max(score, len(same) / len(body))
    return ",".join(sorted(labels)), score


@pytest.mark.parametrize("lookups", [16, 1])
def test_license_labels_equal_brute_force(spark, lookups):
    import random
    rng = random.Random(6)
    words = sorted({w for t in license_scan.TEMPLATES for w in t.text.split()}) + ["other"]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 3)):
            body = rng.choice(license_scan.TEMPLATES).text.split()
            a, b = sorted((rng.randint(0, len(body)), rng.randint(0, len(body))))
            part = body[a:b]
            if part and rng.random() < 0.4:
                part[rng.randrange(len(part))] = rng.choice(words)
            parts += part + [rng.choice(words) for _ in range(rng.randint(0, 3))]
        texts.append(" ".join(parts).upper() if rng.random() < 0.2 else ", ".join(parts))
    texts += ["", "MIT License", "cc0", "the " * 50 + "mit license " * 20]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), lookups=lookups).collect()}
    want = [plain_labels(t, license_scan.TEMPLATES) for t in texts]
    if lookups > 1:
        assert [(got[i].labels, round(got[i].score, 9)) for i in range(len(texts))] == [(a, round(b, 9)) for a, b in want]
    else:  # fewer offsets are tried; the mandatory phrases still nominate theirs
        assert [got[i].labels for i in range(len(texts)) if i >= 150] == [a for a, _ in want[150:]]


def test_common_words_still_find_a_license(spark):
    rows = [(i, "wir gehen mit dem license und nach haus") for i in range(900)] + [(900 + i, "MIT License granted to all") for i in range(100)]
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.labels for r in got if r.doc_id >= 900} == {"mit"} and {r.labels for r in got if r.doc_id < 900} == {""}
