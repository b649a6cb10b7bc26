"""Readers for the driver tables and corpus mixes built from them.

Every reader selects only the columns it needs, so the Parquet scan prunes
columns and receives pushed-down filters (e.g. ``lang IN (...)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.session import num_partitions

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Scans with at least this many splits per core are never looked into.
_WIDE = 16


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over the cluster's cores, but only when the scan
    itself would leave cores idle: its largest split holds more than twice a
    core's share of the rows.

    A Parquet file is cut into byte ranges, but a row group is read by one of
    them, so the number of splits says little about a narrow scan.  The rows of
    each split are counted from the file footers (no column is read), one number
    per split and at most ``_WIDE`` splits per core.  A wider scan, which is any
    large input, is returned untouched.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        return df
    n = num_partitions(df)
    if n is None or n >= _WIDE * target:
        return df
    rows = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    return df.repartition(target) if max(rows, default=0) * target > 2 * sum(rows) else df


def documents(spark: SparkSession, sf_dir: str, cols: Sequence[str] = ("doc_id", "lang", "text"),
              langs: Sequence[str] | None = None) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    if langs is not None:
        df = df.where(F.col("lang").isin(list(langs)))
    return spread(df.select(*cols))


def conversations(spark: SparkSession, sf_dir: str,
                  cols: Sequence[str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations").select(*cols))


def _case(col: str, mapping: Sequence[tuple[str, int]], default=None) -> Column:
    expr = None
    for k, v in mapping:
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def documents_corpus(spark: SparkSession, sf_dir: str,
                     mix: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """Documents as a training corpus ``(source, source_ord, doc_ord, weight, text)``.

    ``mix`` is ``[(lang, weight), ...]`` in corpus order (English first in an
    English-heavy mix); ``None`` takes every document once, in ``doc_id``
    order.  Weights stand for repetition: rows are never copied.
    """
    if mix is None:
        d = documents(spark, sf_dir, ("doc_id", "text"))
        return d.select(F.lit("documents").alias("source"), F.lit(0).alias("source_ord"),
                        F.col("doc_id").alias("doc_ord"), F.lit(1).cast("bigint").alias("weight"),
                        "text")
    langs = [lang for lang, _ in mix]
    d = documents(spark, sf_dir, ("doc_id", "lang", "text"), langs=langs)
    return d.select(F.col("lang").alias("source"),
                    _case("lang", [(lang, i) for i, lang in enumerate(langs)]).cast("int").alias("source_ord"),
                    F.col("doc_id").alias("doc_ord"),
                    _case("lang", list(mix)).cast("bigint").alias("weight"),
                    "text")


def union_corpora(parts: Sequence[tuple[str, DataFrame, int]], text: str = "text",
                  doc_ord: str | None = None) -> DataFrame:
    """Concatenate corpora in order: ``[(source, frame, weight), ...]``.

    Each part gets its position as ``source_ord`` (so the first occurrence of
    a word is looked up in corpus order), its weight, and ``doc_ord`` from the
    given column (0 when the part is a single text).
    """
    out = None
    for i, (source, frame, weight) in enumerate(parts):
        part = frame.select(F.lit(source).alias("source"), F.lit(i).alias("source_ord"),
                            (F.col(doc_ord).cast("bigint") if doc_ord else F.lit(0).cast("bigint"))
                            .alias("doc_ord"),
                            F.lit(int(weight)).cast("bigint").alias("weight"), F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


# Mixes over the driver's documents, shaped like the reference experiments:
# an English-heavy mix (3 x English + 1 x French) and balanced mixes
# (1 x English + 10 x the other language).
DOCUMENT_MIXES = {
    "en_heavy": [("en", 3), ("fr", 1)],
    "balanced_fr": [("en", 1), ("fr", 10)],
    "balanced_de": [("en", 1), ("de", 10)],
}
