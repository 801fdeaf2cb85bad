import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from loyalflow.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = "long text with many words again and again " * 4000
    rows = [(1, None, "en", "a", 0, 7), (2, "", "en", None, 0, 7), (3, long, None, "a", len(long), 7),
            (4, "one two three four five six", "en", "b", 27, 7), (4, "one two three four five six", "en", "b", 27, 7),
            (None, "no id", "en", "b", 5, 7), (5, "a" * 100_000, "en", "b", 100_000, None),
            (6, " \n\t  \n", "en", "c", 6, 7), (7, "é<|endoftext|> 日本 \x00😀", "xx", "c", 20, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
