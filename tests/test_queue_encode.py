"""Encoding by the priority queue against the chain of passes and the checker."""

import random

import pytest
from pyspark.sql import functions as F

from tokenledger.functions import tokens as tk
from tokenledger.operators import encode as enc
from tokenledger.operators import queue_encode as qe
from tokenledger.operators.train import Rule, frequent_word_rules
from tokenledger.operators.words import word_table
from tokenledger.plans import queries as Q
from tokenledger.sources import tables as tb
from tokenledger.sources.rules import reference_rules

import checker
from conftest import SF0001
from test_properties import rand_text


def random_rules(rng, n, letters=6):
    """Any pairs: repeated, with themselves, of tokens that only later rules make."""
    out = []
    for i in range(n):
        left, right = (rng.choice([97 + rng.randrange(letters), 256 + rng.randrange(n)]) for _ in range(2))
        if 256 + i in (left, right):
            left = right = 97
        out.append(Rule(i, left, right, 256 + i, 2))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_queue_equals_passes(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rules = random_rules(rng, rng.randint(1, 25), rng.randint(1, 4))
        queue = qe.MergeQueue(rules)
        for _ in range(20):
            text = "".join(rng.choice("abcd a") for _ in range(rng.randint(0, 40)))
            want = checker.encode(text, [(r.left, r.right, r.new_id) for r in rules])
            assert tk.token_string_to_ids(queue(text)) == want, (rules, text)


def test_columns_equal_the_native_chain(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "y", None]), rand_text(rng, 25)) for i in range(300)] + [(1, "x", None), (1, "x", ""), (None, None, "aaaaa")]
    df = spark.createDataFrame(rows, "id int, lang string, text string").withColumn("ids", F.lit("own")).withColumn("tokens", F.lit(9))
    rules = reference_rules("heavy")
    native = enc.encode_with_ids(df, rules, keep=["id", "lang"])
    assert sorted(map(repr, qe.encode_ids_queued(df, rules, keep=["id", "lang"]).collect())) == sorted(map(repr, native.collect()))
    assert sorted(map(repr, qe.encode_counts_queued(df, rules, keep=["id"]).collect())) == sorted(
        map(repr, enc.encode_counts(df, rules, keep=["id"]).collect()))
    assert qe.encode_counts_queued(df.limit(0), rules).collect() == []
    assert [r["tokens"] for r in qe.encode_counts_queued(df.where("text = 'aaaaa'"), [], keep=["id"]).collect()] == [5]


def test_long_lists_take_the_queue_and_totals_agree(spark):
    words = word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"])
    rules = frequent_word_rules(words, 150)
    assert len(rules) > tk.NESTED_REPLACE_LIMIT and [r.rank for r in rules] == list(range(len(rules)))
    docs = tb.documents(spark, SF0001)
    assert "MapInArrow" in enc.encode_counts(docs, rules, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r["tokens"] for r in enc.encode_counts(docs, rules, keep=["doc_id"]).collect()}
    chain = {r["doc_id"]: r["n"] for r in docs.select("doc_id", tk.token_count("text", rules).alias("n")).collect()}
    assert got == chain
    ids = {r["doc_id"]: len(r["ids"]) for r in enc.encode_with_ids(docs, rules, keep=["doc_id"]).collect()}
    assert ids == chain
    a = {r["lang"]: r["tokens"] for r in enc.tokens_by_key(docs, rules, ["lang"]).collect()}
    assert a == {r["lang"]: r["tokens"] for r in enc.tokens_by_key_dedup(docs, rules, ["lang"]).collect()}
    assert sum(a.values()) == sum(chain.values())


def test_work_follows_the_merges_not_the_rules():
    rng = random.Random(2)
    used = random_rules(rng, 12, 3)
    idle = [Rule(0, 1000 + 2 * i, 1001 + 2 * i, 200_000 + i, 2) for i in range(30_000)]
    few, many = qe.MergeQueue(used), qe.MergeQueue([*idle[:15_000], *used, *idle[15_000:]])
    texts = ["".join(rng.choice("abc ") for _ in range(200)) for _ in range(50)]
    assert [few(t) for t in texts] == [many(t) for t in texts]
    assert few.merges == many.merges > 0


def test_runs_are_merged_once_and_forgotten_without_effect(monkeypatch):
    queue = qe.MergeQueue([Rule(0, 97, 98, 256, 2)])
    text = "abab abab c abab"
    once = queue(text)
    assert queue.merges == 2 and once.count(chr(256)) == 6
    monkeypatch.setattr(qe, "REMEMBERED", 0)
    assert queue(text) == once and queue.merges == 4


def test_stream_of_documents_with_many_rules(spark, tmp_path):
    from tokenledger.streaming import encode_stream as es

    docs = tb.table(spark, SF0001, "documents")
    docs.limit(60).repartition(3).write.parquet(str(tmp_path / "in"))
    rules = frequent_word_rules(word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"]), 120)
    stream = qe.encode_counts_queued(es.read_documents_stream(spark, str(tmp_path / "in")), rules, keep=["doc_id"])
    es.write_available(stream, str(tmp_path / "out")).awaitTermination()
    got = sorted((r["doc_id"], r["tokens"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = enc.encode_counts(spark.read.parquet(str(tmp_path / "in")), rules, keep=["doc_id"])
    assert got == sorted((r["doc_id"], r["tokens"]) for r in want.collect()) and len(got) == 60
