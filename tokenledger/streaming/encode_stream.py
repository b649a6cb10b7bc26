"""The encoders on Structured Streaming.

Encoding is a stateless column expression, so a stream of documents is
encoded exactly like a batch.  ``stream_tokens`` adds per-document counts;
``stream_tokens_by_key`` keeps running totals per key (stateful aggregation,
``update``/``complete`` output).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tokenledger.functions.text import byte_length
from tokenledger.functions.tokens import token_count

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read_documents_stream(spark: SparkSession, path: str, schema: T.StructType = DOCUMENTS_SCHEMA,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream of documents (``path`` is a folder or glob)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def stream_tokens(stream: DataFrame, rules, text: str = "text",
                  keep: Sequence[str] = ("doc_id", "lang"), bolt=None) -> DataFrame:
    """Per-document ``(*keep, n_bytes, tokens[, bolt_tokens])`` on a stream."""
    cols = [*keep, byte_length(text).alias("n_bytes"), token_count(text, rules).alias("tokens")]
    if bolt is not None:
        cols.append(bolt.token_count(text).alias("bolt_tokens"))
    return stream.select(*cols)


def stream_bolt_tokens(stream: DataFrame, scan, text: str = "text", keep: Sequence[str] = ("doc_id", "lang")) -> DataFrame:
    """Per-document ``(*keep, base, *variants)`` with vocabularies of any size
    that an automaton holds (``operators.scan.VariantScan``).  The pass is
    stateless: a file sink and its checkpoint make a restart write each
    document once."""
    return scan.counts(stream.select(*keep, text), text).drop(text)


def stream_tokens_by_key(stream: DataFrame, rules, keys: Sequence[str] = ("lang",),
                         text: str = "text") -> DataFrame:
    """Running token totals per key (stateful aggregation)."""
    per = stream.select(*keys, byte_length(text).alias("b"), token_count(text, rules).alias("t"))
    return per.groupBy(*keys).agg(F.count(F.lit(1)).alias("docs"), F.sum("b").alias("bytes"),
                                  F.sum("t").alias("tokens"))


def write_available(df: DataFrame, out_path: str, checkpoint: str | None = None,
                    fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now into files and stop (append mode).

    The checkpoint defaults to a folder inside ``out_path`` (readers skip
    names that start with ``_``): a later run to the same output goes on where
    the last one stopped, in any session.
    """
    ckpt = checkpoint or f"{out_path.rstrip('/')}/_checkpoint"
    return (df.writeStream.format(fmt).option("path", out_path)
            .option("checkpointLocation", ckpt).outputMode("append")
            .trigger(availableNow=True).start())
