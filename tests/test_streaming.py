"""Encoding a file stream gives the batch result."""

import os


from tokenledger.operators import encode as enc
from tokenledger.session import scratch_path
from tokenledger.sources.rules import reference_rules
from tokenledger.streaming.encode_stream import (read_documents_stream, stream_tokens,
                                                 write_available)

from conftest import SF0001


def test_stream_equals_batch(spark):
    rules = reference_rules("heavy")
    stream = read_documents_stream(spark, os.path.join(SF0001, "documents*.parquet"))
    out = scratch_path(spark, "stream-out")
    q = write_available(stream_tokens(stream, rules), out)
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("doc_id", "tokens").collect())
    batch = enc.encode_counts(spark.read.parquet(os.path.join(SF0001, "documents.parquet")),
                              rules, keep=["doc_id"])
    want = sorted(tuple(r) for r in batch.select("doc_id", "tokens").collect())
    assert got == want and len(got) == 200


def test_stream_running_totals_equal_batch(spark):
    from tokenledger.streaming.encode_stream import stream_tokens_by_key
    rules = reference_rules("heavy")
    stream = read_documents_stream(spark, os.path.join(SF0001, "documents*.parquet"))
    name = "tokens_by_lang_stream"
    q = (stream_tokens_by_key(stream, rules).writeStream.format("memory").queryName(name)
         .outputMode("complete").option("checkpointLocation", scratch_path(spark, "agg-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r["lang"]: (r["docs"], r["tokens"]) for r in spark.sql(f"SELECT * FROM {name}").collect()}
    batch = enc.tokens_by_key(spark.read.parquet(os.path.join(SF0001, "documents.parquet")),
                              rules, ["lang"])
    want = {r["lang"]: (r["docs"], r["tokens"]) for r in batch.collect()}
    assert got == want


def _files(spark, folder, lo, hi):
    spark.read.parquet(os.path.join(SF0001, "documents.parquet")).where(
        f"doc_id >= {lo} and doc_id < {hi}").coalesce(1).write.mode("append").parquet(folder)


def test_second_run_goes_on_where_the_first_stopped(spark):
    rules = reference_rules("heavy")
    folder, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    for lo, hi in ((0, 100), (100, 200)):
        _files(spark, folder, lo, hi)
        q = write_available(stream_tokens(read_documents_stream(spark, folder), rules), out)
        q.awaitTermination(300)
    got = sorted(r["doc_id"] for r in spark.read.parquet(out).collect())
    assert got == list(range(200))


def test_bolt_on_stream_equals_batch(spark):
    from tokenledger.operators.vocab import BoltOn, build_vocab
    from tokenledger.sources import fixtures as fx
    rules = reference_rules("heavy")
    bolt = BoltOn.from_vocab(build_vocab(fx.vocab_input(spark), 336), rules)
    folder, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    docs = spark.createDataFrame([(1, "créer un compte 我们 するデータ", "fr", "a", 1), (2, None, "en", "a", 0), (3, "the", "en", "a", 3)],
                                 read_documents_stream(spark, SF0001).schema)
    docs.write.parquet(folder)
    write_available(stream_tokens(read_documents_stream(spark, folder), rules, bolt=bolt), out).awaitTermination(300)
    got = {r["doc_id"]: (r["tokens"], r["bolt_tokens"]) for r in spark.read.parquet(out).collect()}
    from tokenledger.functions.tokens import token_count
    want = {r["doc_id"]: (r["a"], r["b"]) for r in docs.select(
        "doc_id", token_count("text", rules).alias("a"), bolt.token_count("text").alias("b")).collect()}
    assert got == want and got[1][1] < got[1][0]
