import random

import pytest
from pyspark.sql import Row

LONG = "word " * 30_000
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, fp string, key string, score double, sequence_id int, shard int"


def make_docs(spark, rows):
    """documents with more columns, whose names clash with those that operators use."""
    return spark.createDataFrame([(*r, 0, 9, 9, "x", "y", 0.5, 9, 9) for r in rows], COLUMNS)


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


EDGE_ROWS = [
    (1, None, "en", "s1"),
    (2, "", "en", None),
    (3, " \n\t ", None, "s1"),
    (4, "one", "en", "s2"),
    (5, LONG, "en", "s2"),
    (6, "Same text here, twice.", "en", "s1"),
    (7, "Same text here, twice.", "de", "s3"),
    (7, "Same text here, twice.", "de", "s3"),
    (None, "no id", "en", "s1"),
    (None, None, None, None),
    (8, "ünï ço dé \U0001f600 中文", "zh", "s3"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return make_docs(spark, EDGE_ROWS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])


def collect(df):
    return [Row(**r.asDict(True)) for r in df.collect()]
