import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# an id that repeats in full, nulls, empty and blank texts, a long one, ties, clashing names
LONG = " ".join(f"word{i * 7919 % 100_003}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog\nand then some more words follow here\n\nshort"),
    (2, "the QUICK brown fox jumps over the lazy dog  \nsomething else stands in this line"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b "),
    (6, "a b c"),
    (7, LONG),
    (8, LONG + " end"),
    (9, "again and again " * 40),
    (10, "été ñandú 日本語 😀 |#|\n| été ñandú 日本語 😀\nété ñandú 日本語 😀 |#|"),
    (11, "</s>[INST] ok [/INST] <|endoftext|> &amp; &lt;|"),
    (11, "</s>[INST] ok [/INST] <|endoftext|> &amp; &lt;|"),
    (12, "The quick brown fox jumps over the lazy dog\nand then some more words follow here\n\nshort"),
    (None, "a row without an id that has some words of its own in it"),
    (None, None),
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(d, t, "en", None if d == 6 else f"host{(d or 0) % 3}", None, -1, "x", True, 0, 7) for d, t in TEXTS]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, n_words int, fingerprint string, kept boolean, shard int, slot int"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def fresh(spark):
    from filmgrid.session import fresh_path

    return lambda label: fresh_path(spark, f"test-{label}")
