"""Training from the inverted index: the same rules, fewer words counted."""

import random

import pytest
from pyspark.sql import functions as F

from tokenledger.operators import train_index as ti
from tokenledger.operators.train import train_bpe
from tokenledger.operators.words import word_table
from tokenledger.plans import queries as Q
from tokenledger.sources import tables as tb

from conftest import SF0001


@pytest.fixture(scope="module")
def doc_words(spark):
    return Q.materialize(word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"]), "words")[0]


def corpus(spark, texts):
    return word_table(spark.createDataFrame([(i, 1 + i % 3, t) for i, t in enumerate(texts)], "doc_ord bigint, weight bigint, text string"),
                      ["doc_ord"])


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (3, "abcé")])
def test_random_corpora_with_ties(spark, monkeypatch, seed, alphabet):
    """Few letters make ties, runs (aaaa) and pairs whose first word loses them."""
    monkeypatch.setattr(ti, "COMMIT", 2)
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 6))) for _ in range(40)]
    words = corpus(spark, texts)
    want = train_bpe(words, 14, index_from=10**6).rules
    assert train_bpe(words, 14, index_from=1).rules == want and len(want) > 10


def test_long_words_and_new_bases(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(ti, "PENDING", 6)
    texts = ["".join(rng.choice("abcd") for _ in range(900)) + " " + "".join(rng.choice("abcd") for _ in range(5)) for _ in range(12)]
    words = corpus(spark, texts + ["abab abc " * 30])
    want = train_bpe(words, 12, index_from=10**6).rules
    assert train_bpe(words, 12, index_from=2).rules == want


def test_documents_and_words_counted(spark, doc_words, monkeypatch):
    plain = train_bpe(doc_words, 72, written=True, index_from=10**6).rules
    got = train_bpe(doc_words, 72, written=True, index_from=48)
    assert got.rules == plain and got.indexed
    n = doc_words.count()
    counted = [s.words_counted for s in got.indexed]
    assert sum(counted) / len(counted) < 0.2 * n  # a recount reads all of them in every step
    assert [r.rank for r in got.rules] == list(range(72))


def test_index_rows_name_every_word_of_a_pair_once(spark, doc_words):
    words = doc_words.select("tok", "freq", F.monotonically_increasing_id().alias("first"))
    base = ti.build_base(words, 10, 200, 256)
    per = base.index.groupBy("pair").agg(F.count("*").alias("words"), F.count_distinct("first").alias("distinct"))
    assert per.where("words <> distinct").count() == 0
    holds = words.where(F.instr("tok", "th") > 0).count()
    assert per.where("pair = 'th'").first()["words"] == holds
    plan = base.index.where(ti._is_one_of("pair", ["th", "é'"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(pair,th)" in plan, plan
    base.drop()


def test_stops_when_no_pair_repeats(spark):
    words = corpus(spark, ["ab ab cd", "xyz"])
    for start in (1, 10**6):
        assert [(r.left, r.right) for r in train_bpe(words, 50, index_from=start).rules] == [
            (r.left, r.right) for r in train_bpe(words, 50, batched=False).rules]
