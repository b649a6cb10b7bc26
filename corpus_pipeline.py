"""A training-data pipeline over ``documents``: raw texts to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.llm import decontaminate, linededup, neardup, packing, quality
from tokenledger.llm.common import written
from tokenledger.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is low go.  Every row is judged by its own
    text (null: empty), repeated rows alike; with no labels to learn from all stay."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; ``n_chars`` follows a changed text.  A null
    text stays null, a document without a source is left as it is."""
    out = linededup.drop_boilerplate(docs)
    cols = [F.when(F.col("__dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col(c)).alias(c)
            if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays.  Texts without words and
    rows with a null doc_id stay; rows that repeat a kept doc_id stay."""
    return neardup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go, each row by its own text;
    null and empty texts stay, and an empty benchmark drops nothing."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their place in a sequence; a
    null or empty text is its end token alone, equal rows take a place each."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier, the tokenizer and the components are beyond plain SQL;
#: stages 2 to 4 are tested against plain Python row by row, the classifier on
#: held-out rows and the packing plan against piecewise best fit.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
