"""Corpora and vocabularies from files.

``read_corpus`` gives ``(source, source_ord, doc_ord, weight, text)`` as
training expects it, ``read_vocab`` gives ``(group_ord, item_ord, term,
label)`` as ``build_vocab`` and ``extend_vocab`` expect it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.sources.fixtures import VOCAB_IN_SCHEMA


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", text: str = "text",
                doc_ord: str | None = None, source: str | None = None, source_ord: int = 0,
                weight: int = 1, whole_files: bool = False) -> DataFrame:
    """A corpus from ``parquet``, ``json`` (one object a line) or ``text``.

    Text files hold one document a line, or one a file with ``whole_files``.
    ``doc_ord`` names the ordinal column; without one, documents are numbered
    in reading order, which settles ties between equally frequent pairs only.
    """
    if fmt == "text":
        df, text = spark.read.text(path, wholetext=whole_files), "value"
    elif fmt in ("parquet", "json"):
        df = getattr(spark.read, fmt)(path)
    else:
        raise ValueError(f"unknown corpus format {fmt!r}")
    order = F.col(doc_ord) if doc_ord else F.monotonically_increasing_id()
    return df.select(F.lit(source or path).alias("source"), F.lit(int(source_ord)).alias("source_ord"),
                     order.cast("bigint").alias("doc_ord"), F.lit(int(weight)).cast("bigint").alias("weight"),
                     F.col(text).cast("string").alias("text"))


def read_vocab(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A vocabulary list from ``parquet``, ``csv`` (with a header) or ``json``
    with columns ``group_ord, item_ord, term, label``."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown vocabulary format {fmt!r}")
    reader = spark.read.schema(VOCAB_IN_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False)
    return getattr(reader, fmt)(path).select("group_ord", "item_ord", "term", "label")
