import pytest

from tests.conftest import SMALL

CLASHING = ("size", "ids", "shard", "bucket", "cell", "words", "mix_key", "score")


@pytest.fixture(scope="session")
def documents(spark):
    """``(doc_id, text, source)`` of the smallest data set as Python rows."""
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    return [tuple(r) for r in d.select("doc_id", "text", "source").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and very long texts, ties, repeated rows and odd characters."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog", "a"),
        (1, "the quick brown fox jumps over the lazy dog", "a"),
        (2, "the quick brown fox jumps over the lazy dog", None),
        (3, None, "b"), (4, "", "b"), (5, " \t\n ", None), (6, long, "c"),
        (None, "a row without an id", "a"), (7, "it's <|endoftext|> 'll  don't\n\nx \u0085y", "b"),
        (8, "naïve 日本語 \U0001F600 \x0b\x0c vertical", "é"), (9, "one", None),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    cols = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([r + ("z",) * len(CLASHING) for r in odd_rows], cols)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
