"""Training with any ordinals and word lengths; costs and baselines at scale."""

import random

import pytest

from tokenledger.operators import words as W
from tokenledger.operators.pairs import counted_pairs
from tokenledger.operators.train import train_bpe
from tokenledger.operators.words import first_key, word_freq, word_table
from tokenledger.plans import reports

import checker

SCHEMA = "source_ord bigint, doc_ord bigint, weight bigint, text string"
BIG = 2 ** 63 - 1
ORDINALS = {
    "small": [(0, 1), (0, 2), (1, 0), (1, 5)],
    "negative": [(-5, -2 ** 40), (-5, 3), (0, -7), (2, 2 ** 20)],
    "null": [(None, None), (None, 4), (3, None), (3, 9)],
    "decimal": [(0, -BIG), (0, BIG), (1, -BIG), (1, 0)],
    "struct": [(-BIG, -BIG), (-BIG, BIG), (BIG, -BIG), (BIG, BIG)],
}


def corpus(spark, ords, seed=3):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice("aabbc") for _ in range(rng.randint(1, 6))) for _ in range(9)) for _ in ords]
    rows = [(s, d, rng.randint(1, 3), t) for (s, d), t in zip(ords, texts)]
    return rows, spark.createDataFrame(rng.sample(rows, len(rows)), SCHEMA)


@pytest.mark.parametrize("kind", ORDINALS)
def test_any_ordinals(spark, kind):
    rows, df = corpus(spark, ORDINALS[kind])
    got = {r["word"]: (r["freq"], tuple(r["first"])) for r in word_freq(df, ["source_ord", "doc_ord"]).collect()}
    want = {}
    for s, d, w, t in rows:
        for i, word in enumerate(t.split()):
            f, first = want.get(word, (0, (s, d, i)))
            want[word] = (f + w, first)
    assert got == want
    rules = train_bpe(word_table(df, ["source_ord", "doc_ord"]), 12).rules
    assert [(r.left, r.right, r.new_id, r.n) for r in rules] == checker.train([(t, w) for _, _, w, t in rows], 12)


def test_pair_firsts_by_packed_key_rank_and_struct(spark):
    rows, df = corpus(spark, ORDINALS["small"])
    wt = word_table(df, ["source_ord", "doc_ord"])
    packed = first_key(wt)
    assert packed.fields and packed.shift
    want = sorted((r["pair"], r["n"], tuple(r["first"])) for r in counted_pairs(packed).collect())
    _, huge = corpus(spark, ORDINALS["struct"])
    ranked = first_key(word_table(huge, ["source_ord", "doc_ord"]))
    assert ranked.fields is None and ranked.shift
    by_rank = sorted((r["pair"], r["n"], tuple(r["first"])[2:]) for r in counted_pairs(ranked).collect())
    assert by_rank == [(p, n, f[2:]) for p, n, f in want]

    keys = W.WordKeys(packed.frame.drop("wkey"), None, packed.max_len, packed.n_words, [], None)
    assert sorted((r["pair"], r["n"], tuple(r["first"])) for r in counted_pairs(keys).collect()) == want


def test_long_words(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab") for _ in range(n)) + " ab" for n in (700, 257, 256, 3)]
    df = spark.createDataFrame([(0, i, 1, t) for i, t in enumerate(texts)], SCHEMA)
    rules = train_bpe(word_table(df, ["source_ord", "doc_ord"]), 10).rules
    assert [(r.left, r.right, r.new_id, r.n) for r in rules] == checker.train([(t, 1) for t in texts], 10)


def test_costs_of_a_hundred_terabytes(spark):
    df = spark.createDataFrame([("en", 30_000_000_000_000, 20_000_000_000_000)], "lang string, before bigint, after bigint")
    r = reports.token_cost(df, 2.5e-6, 1_000_000).first()
    assert r["cost_before"] == pytest.approx(3e13 * 2.5) and r["saved"] == pytest.approx(1e13 * 2.5)


def test_baseline_per_group(spark):
    rows = [(g, lang, float(10 * g + k)) for g in range(1, 4) for k, lang in enumerate(("en", "fr", "de"))] + [(9, "fr", 5.0)]
    df = reports.vs_baseline(spark.createDataFrame(rows, "group_id int, lang string, v double"), "v", by=["group_id"], out="x")
    got = {(r["group_id"], r["lang"]): r["x"] for r in df.collect()}
    assert got[2, "fr"] == pytest.approx(21 / 20) and got[3, "de"] == pytest.approx(32 / 30) and got[9, "fr"] is None
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_pairs_seen_once_are_not_ranked(spark):
    from tokenledger.operators.pairs import top_pairs
    df = spark.createDataFrame([(0, 0, 1, "abc abd")], SCHEMA)
    top = top_pairs(counted_pairs(first_key(word_table(df, ["source_ord", "doc_ord"]))), 10).collect()
    assert [(r["pair"], r["n"]) for r in top] == [("ab", 2)]
