"""Published results of the four reference experiments."""

import pytest
from pyspark.sql import functions as F

from tokenledger.functions.tokens import token_count
from tokenledger.operators.train import train_bpe
from tokenledger.operators.vocab import BoltOn, build_vocab, vocab_added
from tokenledger.operators.words import word_table
from tokenledger.plans import reports
from tokenledger.sources import fixtures as fx
from tokenledger.sources.rules import reference_rules

from checker import train as py_train

# Published token counts (English, Japanese, Korean, French, Chinese).
EXP1 = {"English": 34, "Japanese": 77, "Korean": 65, "French": 48, "Chinese": 39}
BOLT_ALL = {"English": 34, "Japanese": 11, "Korean": 43, "French": 22, "Chinese": 9}


def _counts(spark, rules, bolt=None):
    s = fx.parallel_sentences(spark)
    c = bolt.token_count("text") if bolt else token_count("text", rules)
    return {r["lang"]: r["c"] for r in s.select("lang", c.alias("c")).collect()}


def test_baked_rules_equal_python_training():
    for mix, spec in fx.CORPUS_MIXES.items():
        corpus = [(fx.CORPORA[src], w) for src, w in spec]
        expected = py_train(corpus, fx.NUM_MERGES)
        got = [(r.left, r.right, r.new_id, r.n) for r in reference_rules(mix)]
        assert got == expected, mix


@pytest.mark.parametrize("mix", ["heavy"])
def test_spark_training_reproduces_baked_rules(spark, mix):
    wt = word_table(fx.reference_corpus_mix(spark, mix), ["source_ord", "doc_ord"])
    res = train_bpe(wt, fx.NUM_MERGES)
    assert res.rules == reference_rules(mix)
    assert res.rules[0].n == 93 and res.rules[-1].new_id == 335


def test_experiment1_counts(spark):
    assert _counts(spark, reference_rules("heavy")) == EXP1


def test_experiment2_and_3(spark):
    ja = _counts(spark, reference_rules("balanced_ja"))
    assert (ja["English"], ja["Japanese"]) == (43, 64)
    zh = _counts(spark, reference_rules("balanced_zh"))
    assert zh["Chinese"] == 39  # "didn't improve at all"


def test_vocab_added_counts(spark):
    vin = fx.vocab_input(spark)
    v = build_vocab(vin, 336)
    got = {r["label"]: r["added"] for r in vocab_added(v, vin).collect()}
    assert got == {"ZH-char": 92, "ZH-bigram": 40, "JA-hiragana": 71, "JA-katakana": 71,
                   "JA-word": 37, "KO-char": 43, "FR-accent": 34, "FR-word": 49, None: 437}
    ids = v.agg(F.min("token_id"), F.max("token_id")).first()
    assert tuple(ids) == (336, 772)


def test_bolt_on_variants(spark):
    rules = reference_rules("heavy")
    expect = {"zh": {"Chinese": 9, "Japanese": 73}, "ja": {"Japanese": 11},
              "fr": {"French": 22}, "all": BOLT_ALL}
    for variant, labels in fx.VOCAB_VARIANTS.items():
        bolt = BoltOn.from_vocab(build_vocab(fx.vocab_input(spark, labels), 336), rules)
        got = _counts(spark, rules, bolt)
        for lang, n in expect[variant].items():
            assert got[lang] == n, (variant, lang)


def test_reduction_and_cost_report(spark):
    rules = reference_rules("heavy")
    bolt = BoltOn.from_vocab(build_vocab(fx.vocab_input(spark), 336), rules)
    s = fx.parallel_sentences(spark)
    before = s.select(F.col("lang"), token_count("text", rules).alias("tokens"))
    after = s.select(F.col("lang"), bolt.token_count("text").alias("tokens"))
    red = {r["lang"]: r for r in reports.bolt_reduction(before, after, "tokens",
                                                        baseline="English").collect()}
    assert round(red["Japanese"]["reduction_pct"]) == 86
    assert round(red["Chinese"]["reduction_pct"]) == 77
    assert round(red["French"]["reduction_pct"]) == 54
    assert round(red["Korean"]["reduction_pct"]) == 34
    assert red["English"]["reduction_pct"] is None
    assert round(red["Japanese"]["mult_before"], 1) == 2.3 and round(red["Japanese"]["mult_after"], 1) == 0.3
    assert round(red["Korean"]["mult_after"], 1) == 1.3
    ba = before.withColumnRenamed("tokens", "before").join(
        after.withColumnRenamed("tokens", "after"), "lang")
    cost = {r["lang"]: r for r in reports.token_cost(ba, fx.PRICE_PER_TOKEN, fx.SEND_VOLUME).collect()}
    assert round(cost["English"]["cost_before"], 2) == 85.00 and cost["English"]["saved"] is None
    assert round(cost["Japanese"]["cost_before"], 2) == 192.50
    assert round(cost["Japanese"]["saved"], 2) == 165.00
    assert round(cost["Chinese"]["saved"], 2) == 75.00
    assert round(cost["Korean"]["saved"], 2) == 55.00
    assert round(cost["French"]["saved"], 2) == 65.00


def test_gap_reduction_report(spark):
    s = fx.parallel_sentences(spark)
    heavy = s.select("lang", token_count("text", reference_rules("heavy")).alias("t"))
    bal = s.select("lang", token_count("text", reference_rules("balanced_ja")).alias("t"))
    g = {r["lang"]: r for r in reports.gap_reduction(heavy, bal, "t", baseline="English").collect()}
    assert round(g["Japanese"]["gap_before"], 1) == 2.3
    assert round(g["Japanese"]["gap_after"], 2) == round(64 / 43, 2)
    assert round(g["Japanese"]["reduction_pct"]) == round((1 - (64 / 43) / (77 / 34)) * 100)
