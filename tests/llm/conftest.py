import random

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus():
    """The smallest documents: (doc_id, text) rows."""
    return duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and very long texts, repeated rows, clashing columns."""
    choose = random.Random(1)
    long = " ".join(choose.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(choose.randrange(900)) for _ in range(60_000))
    texts = [
        (1, "One plain text with some words in it, and a few more of them."),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (None, "A text without any number has words just the same."),
        (None, None),
        (5, long),
        (6, "repeated row"),
        (6, "repeated row"),
        (6, "another text of the same number"),
        (7, "<|endoftext|> é\u0000 \U0001f600 \u2581 \u001c!\u001c!  日本語 's"),
    ]
    return [(i, t, "en" if k % 2 else None, "x", k, "clash") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    df = spark.createDataFrame(odd_rows, schema)
    for name in ("shard", "_row", "_text", "ids", "h1", "node", "template", "toxic", "_rank"):
        df = df.withColumn(name, df["score"])
    return df
