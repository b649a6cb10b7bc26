"""Round 3: training on fragments, words counted once for all mixes, matches by
blocks instead of rows, bounded Python memory."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenledger.operators import match, queue_encode as qe
from tokenledger.operators import train as tr
from tokenledger.operators.vocab import build_vocab
from tokenledger.operators.words import word_table, word_tables
from tokenledger.plans import queries as Q
from tokenledger.sources import fixtures as fx
from tokenledger.sources import tables as tb

from conftest import SF0001


def corpus(spark, texts):
    return word_table(spark.createDataFrame([(i, 1 + i % 3, t) for i, t in enumerate(texts)], "doc_ord bigint, weight bigint, text string"),
                      ["doc_ord"])


@pytest.mark.parametrize("more", [0, 3])
def test_fragments_give_the_same_rules(spark, monkeypatch, more):
    """Few pairs are kept, so floors are missed and words are cut again."""
    rng = random.Random(more)
    texts = [" ".join("".join(rng.choice("abcé]^-") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 6))) for _ in range(40)]
    words = corpus(spark, [*texts, "aaaaa aaa aaaa"])
    want = tr.train_bpe(words, 9, batched=False).rules
    monkeypatch.setattr(tr, "KEPT_PAIRS", 0.2)
    monkeypatch.setattr(tr, "MORE_KEPT", more)
    cuts = []
    real = tr.cut_words
    monkeypatch.setattr(tr, "cut_words", lambda *a: cuts.append(a[1]) or real(*a))
    assert tr.train_bpe(words, 9, checkpoint_every=2, index_from=10**6).rules == want and len(cuts) > 1


def test_steps_count_fragments_not_words(spark, monkeypatch):
    words = Q.materialize(word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"]), "words")[0]
    made = []
    real = tr.cut_words
    monkeypatch.setattr(tr, "cut_words", lambda *a: made.append(real(*a)) or made[-1])
    rules = tr.train_bpe(words, 30, written=True).rules
    assert len(rules) == 30 and made[0].count() < 0.4 * words.count()


def test_mixes_share_one_count(spark):
    rows = [(3, "en", "the cat the"), (1, "en", "a cat"), (None, "fr", "chat the"), (2, "fr", "cat"), (4, "de", "katze"), (1, "fr", None)]
    docs = spark.createDataFrame(rows, "doc_ord bigint, source string, text string")
    mixes = {"x": [("en", 3), ("fr", 1)], "y": [("fr", 10), ("en", 2)]}
    got = word_tables(docs, mixes)
    for name, mix in mixes.items():
        c = docs.where(F.col("source").isin([s for s, _ in mix])).withColumn("source_ord", F.when(F.col("source") == mix[0][0], 0).otherwise(1)).withColumn(
            "weight", F.when(F.col("source") == mix[0][0], mix[0][1]).otherwise(mix[1][1]))
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, word_table(c, ["source_ord", "doc_ord"]).collect()))


def test_matches_make_no_row_per_character(spark):
    plan = Q.QUERIES["bolt_ids_cjk"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan and "HashJoin" in plan and "collect_list" not in plan, plan


def test_blocks_meet_their_own_entries(spark):
    vocab = build_vocab(fx.vocab_input(spark), 336)
    texts = spark.createDataFrame([(i << 7, t) for i, t in enumerate(["我们 comme", None, "", "xyz", "する"])], "_row bigint, _t string")
    blocks = texts.withColumn("_block", F.shiftright("_row", 7))
    known = {r["term"] for r in vocab.collect()}
    found = {(r["_block"], r["term"]) for r in match.block_candidates(blocks, vocab, len(known)).collect()}
    want = {(i, t[a:b]) for i, t in enumerate(["我们 comme", "", "", "xyz", "する"]) for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    assert {(i, t) for i, t in found if t in known} == {(i, t) for i, t in want if t in known}


def test_python_memory_is_bounded(monkeypatch):
    batch = pa.record_batch([pa.array(["x" * 1000, None, "é" * 300, "", "y" * 5000, "z"])], names=["t"])
    parts = list(qe.slices(batch, 0, 1200))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and [p.num_rows for p in parts] == [2, 2, 1, 1]
    queue = qe.MergeQueue([tr.Rule(0, 97, 98, 256, 2)])
    monkeypatch.setattr(qe, "REMEMBERED_TOKENS", 20)
    assert queue("ab" * 500) == chr(256) * 500 and not queue._done  # a long run is not kept
    for i in range(1, 30):
        queue("ab" * (i % 9 + 1) + " " + "ba" * (i % 7 + 1))
        assert sum(map(len, queue._done)) <= 20 + 32
