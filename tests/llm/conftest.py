import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, key long, row string, score double"
ENGLISH = "the of and to in that it was for on are with they this have from one had words but what some we can out other were all there when use your how said each she".split()
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie über".split()


def sentence(words, n, rng):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Random texts with copies, near copies and shared passages; missing and empty texts, ties, repeated rows, a long text."""
    rng = random.Random(7)
    texts = []
    for i in range(60):
        texts.append((sentence(ENGLISH if i % 3 else GERMAN, rng.randint(1, 120), rng), "en" if i % 3 else "de"))
    shared = sentence(ENGLISH, 40, rng)
    texts += [(texts[4][0], "en"), (texts[4][0].replace(" ", " \n"), "en"), (texts[7][0] + " more", "en")]
    texts += [(f"{sentence(ENGLISH, 9, rng)}\n{shared}\n{sentence(ENGLISH, 9, rng)}", "en") for _ in range(4)]
    texts += [(None, "en"), (None, None), ("", "de"), (" \n\t", None), ("!!! 123 ???", "en"), ("é" * 130 + "x" * 150, None), ("a" * 400, "en")]
    texts += [(sentence(ENGLISH, 6000, rng), "en"), ("It's CAFÉ İ ΣΑΣ <|endoftext|>x Licensed under CC BY-NC 4.0. All rights reserved.", "en")]
    rows = [(i, t, lang, f"s{i % 3}" if i % 5 else None, None if t is None else len(t), "d", 5, "r", 0.5) for i, (t, lang) in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, "no id at all", "en", "s1", 12, "d", 5, "r", 0.5), (None, "no id at all", "en", "s1", 12, "d", 5, "r", 0.5)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def unique_rows(edge_rows):
    return sorted({r[0]: r for r in edge_rows if r[0] is not None}.values())


@pytest.fixture(scope="session")
def unique_docs(spark, unique_rows):
    return spark.createDataFrame(unique_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
