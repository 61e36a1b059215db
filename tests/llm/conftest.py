import os
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size string, _salt int, score binary"
WORDS = "the of and heron tide Marsh über straße école niño lamp stone river copper winter glass paper morning candle window bridge garden".split()


def prose(seed, n):
    rand = random.Random(seed)
    return " ".join(rand.choice(WORDS) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    """A document with columns that are named like those operators make."""
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "size", 3, b"x")


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        return spark.createDataFrame([row(*r) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def messy():
    """Nulls in every column, empty and very long texts, ties, repeated rows and near copies."""
    base = prose(1, 200)
    words = base.split()
    words[100] = "changed"
    rows = [
        (1, base), (2, base.upper(), "en", "b"), (3, " ".join(words), "en", None), (4, ""), (5, None, None, None), (6, "   \n\t"), (7, "Hi."),
        (8, base), (8, base), (9, "1234 5678", "de", "b"), (10, prose(2, 30_000), None, "a"), (11, "你好世界 mañana 🙂", "es", "c"),
        (12, "<|endoftext|> token = \"abcdef123456\"", "en", "c"), (None, base, "en", "a"), (None, "alone here without a name", "en", "a"),
        (13, prose(3, 50) + "\x1c\x85\xa0end", "fr", "\U0001f600"), (14, prose(3, 50) + "\x1c\x85\xa0end", "fr", "￿"), (2**62, prose(4, 80), "en", "a"), (-5, prose(5, 12), "en", "b"),
    ]
    return rows + [(100 + n, prose(100 + n, 5 + n % 40), "en", "abc"[n % 3]) for n in range(60)]


@pytest.fixture(scope="session")
def tables():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
