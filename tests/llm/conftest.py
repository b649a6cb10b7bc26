import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for p in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if p not in sys.path:
        sys.path.insert(0, p)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Null and empty texts, a null id, repeated rows, ties, long words and texts.
LONG = "The quick brown fox jumps over the lazy dog near the old river bank today. " * 700
PASSAGE = "a passage of words that stands in several documents of this small table and is far longer than one hundred bytes in all"
ROWS = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 48),
    (2, "one two three four five six seven eight nine ten", "en", "a", 48),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (4, "", "en", "a", 0),
    (5, "   \n\t \n", "en", "b", 8),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " tail", None, "b", None),
    (8, "word", "fr", None, 4),
    (9, "x" * 5000, "de", "a", 5000),
    (10, "日本語のテキスト 🙂 ünï cödé ﬁn", "fr", "c", 25),
    (11, "start " + PASSAGE + " end", "en", "c", 0),
    (12, "other " + PASSAGE + " stop", "en", "c", 0),
    (12, "other " + PASSAGE + " stop", "en", "c", 0),
    (None, "no id here but some text to read anyway", "en", "a", 1),
    (-5, "ONE TWO three four five six seven eight nine ten", "en", "a", 1),
]


@pytest.fixture(scope="session")
def spark():
    from tokenledger.session import get_session

    s = get_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """The same rows with columns that carry the operators' own names."""
    from pyspark.sql import functions as F

    names = ["n_tokens", "score", "held_out", "predicted", "sketch", "piece", "length", "rank", "node", "comp", "kept", "host",
             "lines", "salt", "spans", "kind", "bucket", "key", "n", "line", "start", "ids"]
    return df.select(*df.columns, *[F.lit("x").alias(c) for c in names])


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)
