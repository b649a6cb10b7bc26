"""The reference's four experiments as report DataFrames.

These run on the fixed reference inputs (corpora, equal-meaning sentences,
vocabulary lists) and return the numbers the reference prints, one table per
report.  They are library entry points, not registered queries: the
registered queries run the same operators over the driver's tables.

``retrain=True`` learns the rules with ``train_bpe`` instead of using the
stored rules (both give the same 80 rules; the stored ones save ~70 jobs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.functions.text import byte_length
from tokenledger.functions.tokens import token_count
from tokenledger.operators.train import Rule, train_bpe
from tokenledger.operators.vocab import BoltOn, build_vocab
from tokenledger.operators.words import word_table
from tokenledger.plans import reports
from tokenledger.sources import fixtures as fx
from tokenledger.sources.rules import reference_rules

EN = fx.BASELINE_LANGUAGE


def mix_rules(spark: SparkSession, mix: str, retrain: bool = False) -> list[Rule]:
    if not retrain:
        return reference_rules(mix)
    wt = word_table(fx.reference_corpus_mix(spark, mix), ["source_ord", "doc_ord"])
    return train_bpe(wt, fx.NUM_MERGES).rules


def _counts(spark: SparkSession, rules, bolt: BoltOn | None = None) -> DataFrame:
    s = fx.parallel_sentences(spark)
    t = bolt.token_count("text") if bolt else token_count("text", rules)
    return s.select("lang_ord", "lang", "text", byte_length("text").cast("bigint").alias("bytes"),
                    t.cast("bigint").alias("tokens"))


def tokenization(spark: SparkSession, mix: str = "heavy", retrain: bool = False) -> DataFrame:
    """Experiment 1: tokens, bytes, tokens per byte and multiple of English."""
    c = _counts(spark, mix_rules(spark, mix, retrain))
    c = c.withColumn("tokens_per_byte", F.try_divide(F.col("tokens").cast("double"),
                                                     F.col("bytes").cast("double")))
    return reports.vs_baseline(c, "tokens", key="lang", baseline=EN, out="vs_english")


def balancing(spark: SparkSession, balanced_mix: str, langs: list[str],
              retrain: bool = False) -> DataFrame:
    """Experiments 2 and 3: gap to English, English-heavy vs balanced tokenizer."""
    heavy = _counts(spark, mix_rules(spark, "heavy", retrain)).select("lang", "tokens")
    bal = _counts(spark, mix_rules(spark, balanced_mix, retrain)).select("lang", "tokens")
    g = reports.gap_reduction(heavy, bal, "tokens", baseline=EN)
    return (g.where(F.col("lang").isin(langs))
            .select("lang", F.col("value_before").alias("heavy_tokens"),
                    F.col("value_after").alias("balanced_tokens"), "gap_before", "gap_after",
                    "reduction_pct"))


def bolt_on(spark: SparkSession, variant: str = "all", retrain: bool = False) -> DataFrame:
    """Experiment 4: before/after a bolt-on vocabulary, multiples of English before."""
    rules = mix_rules(spark, "heavy", retrain)
    vocab = build_vocab(fx.vocab_input(spark, fx.VOCAB_VARIANTS[variant]), 256 + len(rules))
    before = _counts(spark, rules).select("lang", "tokens")
    after = _counts(spark, rules, BoltOn.from_vocab(vocab, rules)).select("lang", "tokens")
    return reports.bolt_reduction(before, after, "tokens", baseline=EN)


def cost(spark: SparkSession, retrain: bool = False) -> DataFrame:
    """Experiment 4, cost report: each sentence sent SEND_VOLUME times."""
    r = bolt_on(spark, "all", retrain).select("lang", "before", "after")
    return reports.token_cost(r, fx.PRICE_PER_TOKEN, fx.SEND_VOLUME)
