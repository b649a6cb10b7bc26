"""A running word table equals the batch table, whatever the batches."""

import pytest
from pyspark.sql import functions as F

from tokenledger.operators.train import train_bpe
from tokenledger.operators.words import word_table
from tokenledger.session import scratch_path
from tokenledger.streaming.encode_stream import read_documents_stream
from tokenledger.streaming.word_stream import compact, running_words, stream_words

from conftest import SF0001


def _rows(df):
    return sorted((r["word"], r["tok"], r["freq"], tuple(r["first"])) for r in df.collect())


@pytest.fixture()
def documents(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)))


def _deliver(documents, folder, part):
    documents.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)


def test_batches_late_documents_and_restarts(spark, documents):
    folder, out = scratch_path(spark, "words-in"), scratch_path(spark, "words-out")
    for n, part in enumerate((2, 0, 1)):  # first occurrences arrive late
        _deliver(documents, folder, part)
        assert stream_words(read_documents_stream(spark, folder), out).awaitTermination(300)  # each is a restart
        so_far = documents.where(F.col("part").isin([2, 0, 1][:n + 1]))
        assert _rows(running_words(spark, out)) == _rows(word_table(so_far, ["doc_id"], weight=None))
        if n == 1:
            assert compact(spark, out) == 1
    table = running_words(spark, out)
    assert compact(spark, out) == 2 and _rows(running_words(spark, out)) == _rows(table)
    assert train_bpe(table, 12).rules == train_bpe(word_table(documents, ["doc_id"], weight=None), 12).rules


def test_repeated_batch_counts_once(spark, documents):
    folder, out = scratch_path(spark, "words-in"), scratch_path(spark, "words-out")
    _deliver(documents, folder, 0)
    for run in range(2):  # a fresh checkpoint repeats batch 0
        q = stream_words(read_documents_stream(spark, folder), out, checkpoint=scratch_path(spark, f"words-ckpt{run}"))
        assert q.awaitTermination(300)
    want = word_table(documents.where("part = 0"), ["doc_id"], weight=None)
    assert _rows(running_words(spark, out)) == _rows(want)


def test_no_batches_and_texts_without_words(spark):
    folder, out = scratch_path(spark, "words-in"), scratch_path(spark, "words-out")
    assert running_words(spark, out).count() == 0 and compact(spark, out) == -1
    odd = spark.createDataFrame([(None, "b a"), (3, None), (3, ""), (-5, "a a")], "doc_id bigint, text string")
    odd.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars").write.parquet(folder)
    assert stream_words(read_documents_stream(spark, folder), out).awaitTermination(300)
    got = {r["word"]: (r["freq"], tuple(r["first"])) for r in running_words(spark, out).collect()}
    assert got == {"b": (1, (None, 0)), "a": (3, (None, 1))}
