import random
import re

import pytest

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
UPPER, LOWER = (bytes(range(a, a + 26)) for a in (65, 97))

# Columns whose names operators use themselves.
CLASHING = "size long, target double, score string, component_id long, shard int, row string, bucket int, key string"


def words(text):
    return WORD.findall((text or "").encode().translate(bytes.maketrans(UPPER, LOWER)))


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """Null, empty, blank, one-word, repeated, tied and very long texts; null ids, languages and sources."""
    rng = random.Random(3)
    base, long = sentence(rng, 90), sentence(rng, 30_000, 5_000)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", "fr", None),
        (4, "Hello", "en", "b"),
        (5, "hello", None, "b"),
        (6, base, "en", "b"),
        (7, base.upper(), "en", "c"),
        (8, base + " one more", "en", "c"),
        (9, long, "en", "d"),
        (10, long + " and the end", "en", "d"),
        (11, "123 456 !!", "en", "d"),
        (12, "déjà vu\x85über straße 日本語", "fr", "é"),
        (13, "x", "en", ""),
        (13, "x", "en", ""),
        (None, "no id here", "en", "a"),
        (None, None, None, None),
        *((20 + i, sentence(rng, 12), "en", "hot") for i in range(12)),
    ]
    return rows


@pytest.fixture
def edge_docs(spark):
    rows = [(*r, len(r[1] or ""), 1, 2.0, "s", 5, 6, "r", 7, "k") for r in edge_rows()]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return "/root/testdata/sf0.01"
