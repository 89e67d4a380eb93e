"""Matching of large vocabularies against one pattern of all terms."""

import random
import re

from pyspark.sql import functions as F

from rostra.functions.automaton import BEYOND, Terms
from rostra.functions.skills import extract_skills
from rostra.operators import skills


def by_pattern(texts, terms):
    """All terms in one pattern, longer ones first."""
    one = "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True))
    pattern = re.compile(f"(?<![a-z0-9])(?:{one})(?![a-z0-9+#])")
    return [sorted({m.group() for m in pattern.finditer(t.lower())}) for t in texts]


def matched(spark, texts, terms, **options):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, t string, skills_note string")
    vocabulary = spark.createDataFrame([(t,) for t in terms], "skill string")
    return [r.skills for r in skills.add_skills(docs, "t", vocabulary, **options).orderBy("id").collect()]


def test_small_alphabet_equals_pattern(spark):
    rng = random.Random(3)
    draw = lambda letters, most: "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))
    terms = sorted({t for t in (draw("ab c+#.é語", 5).strip() for _ in range(60)) if t})
    texts = [draw("ab c+#.é語A1", 40) for _ in range(400)]
    want = by_pattern(texts, terms)
    assert matched(spark, texts, terms) == want
    assert matched(spark, texts, terms, at_once=40) == want  # the vocabulary in several parts
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    assert [r.s for r in docs.select("id", extract_skills(F.col("t"), terms).alias("s")).orderBy("id").collect()] == want


def test_hundred_thousand_terms(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    terms = set()
    while len(terms) < 100_000:
        terms.add(" ".join(word() for _ in range(rng.choice([1, 2, 2, 3]))))
    texts = [" ".join(word() for _ in range(40)) for _ in range(300)]
    # Equal to the pattern, without compiling one: the longest run of up to three words from each place on.
    want = []
    for t in texts:
        w, at, found = t.split(), 0, set()
        while at < len(w):
            n = next((n for n in (3, 2, 1) if at + n <= len(w) and " ".join(w[at:at + n]) in terms), 0)
            found |= {" ".join(w[at:at + n])} if n else set()
            at += max(n, 1)
        want.append(sorted(found))
    assert matched(spark, texts, sorted(terms)) == want and sum(map(len, want)) > 3000


def test_edges(spark):
    assert matched(spark, [None, "", " ", "x"], ["x", " X ", "", None]) == [[], [], [], ["x"]]
    assert matched(spark, ["python and zebra"], []) == [["python"]]  # no vocabulary: the base skills
    long = "java " * 300_000 + "c++"
    assert matched(spark, [long, "java", "c++"], ["java", "c", "c++", "java c"]) == [["c++", "java"], ["java"], ["c++"]]
    assert matched(spark, ["a", "b"], ["a b", "ab"]) == [[], []]  # no term runs over the end of a text


def test_trie_numbers_its_nodes_by_level():
    trie = Terms(["ab", "a", "ba", "abc"])
    assert trie.ends.tolist() == [False, True, False, True, True, True]
    assert (trie.edges[:-1] < trie.edges[1:]).all() and trie.edges.max() < len(trie.ends) * (BEYOND + 1)
