import random

import duckdb
import pytest
from pyspark.sql import types as T

from tests.conftest import SF_SMALL

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def make_docs(spark, pairs):
    """(doc_id, text) pairs as a documents table."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS)


def edge_pairs():
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    words = "alpha beta gamma delta the of and license apache mit cc by gnu general public".split()
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    return [
        (1, "The MIT License and the Apache  license, by CC BY."), (1, "The MIT License and the Apache  license, by CC BY."), (2, None), (3, ""),
        (None, "a null id with some words to read"), (None, None), (4, long_text), (5, long_text), (6, "x" * 50_000), (7, "   \n\t  "), (8, "é̂ 日本語 😀 Ünïcode"),
        (9, "one"), (9, "another text under the same id"), (10, "1" * 3_000 + "." * 50), (11, "a@" * 4_000), (12, "\u0000\u0001 control"),
    ]
