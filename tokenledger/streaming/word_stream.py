"""A running word table on a file stream.

Every micro-batch is aggregated to its distinct words (frequency and first
occurrence) and written to a folder named by its batch id, so a batch that is
repeated after a failure replaces its own folder and never counts twice.  The
table is the sum of the folders: frequencies add up and the least first
occurrence wins, whatever the order in which documents arrive.  ``compact``
merges all folders up to a batch into one; readers use the latest complete
merged folder and the batches after it.

Defined cases: null texts have no words; a batch without words leaves an empty
folder; order columns are integers, nulls come first; no batch yet reads as an
empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenledger.functions.text import utf8_byte_string
from tokenledger.operators.words import word_freq

_BATCH, _MERGED = "batch-", "upto-"


def _schema(order: Sequence[str]) -> str:
    fields = ", ".join(f"`{c}`: bigint" for c in order)
    return f"word string, freq bigint, first struct<{fields}, pos: int>"


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> tuple[list[str], int]:
    """Complete folders that make up the table, and the last batch in them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {_BATCH: [], _MERGED: []}
    for f in fs.listStatus(root) if fs.exists(root) else []:
        name = f.getPath().getName()
        for kind, ids in found.items():
            if name.startswith(kind) and fs.exists(hadoop(f.getPath(), "_SUCCESS")):
                ids.append(int(name[len(kind):]))
    last = lambda ids: max((i for i in ids if upto is None or i <= upto), default=-1)
    base = last(found[_MERGED])
    later = sorted(i for i in found[_BATCH] if i > base and (upto is None or i <= upto))
    names = ([f"{_MERGED}{base}"] if base >= 0 else []) + [f"{_BATCH}{i}" for i in later]
    return [f"{path.rstrip('/')}/{n}" for n in names], max([base, *later])


def _total(spark: SparkSession, paths: list[str], order: Sequence[str]) -> DataFrame:
    schema = _schema(order)
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.groupBy("word").agg(F.sum("freq").alias("freq"), F.min("first").alias("first"))


def stream_words(stream: DataFrame, path: str, order: Sequence[str] = ("doc_id",), text: str = "text",
                 checkpoint: str | None = None) -> StreamingQuery:
    """Count the words of everything available now into the table at ``path``."""
    types = _schema(order).split("first ")[1]

    def add(batch: DataFrame, batch_id: int) -> None:
        own = batch.select(*[F.col(c).cast("bigint").alias(c) for c in order], text)
        words = word_freq(own, order, text, weight=None)
        words.select("word", "freq", F.col("first").cast(types).alias("first")).write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/{_BATCH}{batch_id}")

    ckpt = checkpoint or f"{path.rstrip('/')}/_checkpoint"
    return (stream.writeStream.foreachBatch(add).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def running_words(spark: SparkSession, path: str, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The word table of all batches so far: ``(word, tok, freq, first)``, the
    input of training."""
    paths, _ = _parts(spark, path)
    return _total(spark, paths, order).select("word", utf8_byte_string("word").alias("tok"), "freq", "first")


def compact(spark: SparkSession, path: str, upto: int | None = None, order: Sequence[str] = ("doc_id",)) -> int:
    """Merge the folders up to batch ``upto`` (default: all) into one, and
    return the last batch merged (-1: none).  Older folders stay readable."""
    paths, last = _parts(spark, path, upto)
    if len(paths) > 1:
        _total(spark, paths, order).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_MERGED}{last}")
    return last
