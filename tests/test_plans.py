"""Plan-level behaviour: one pass per report, one word aggregation, input spreading."""

import re

import pytest

from tokenledger.operators.words import word_table
from tokenledger.plans import queries as Q
from tokenledger.sources import tables as tb

from conftest import SF0001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["vs_baseline", "gap_reduction", "gap_compare", "before_after", "bolt_reduction",
                                  "token_cost", "tokens_by_lang"])
def test_one_scan_and_no_join_per_report(spark, name):
    text = plan(Q.QUERIES[name](spark, SF0001))
    assert len(re.findall("FileScan parquet", text)) == 1, text
    assert "Join" not in text and "Subquery" not in text, text


@pytest.mark.parametrize("name", ["pair_counts", "pair_top"])
def test_pairs_read_the_written_words_once(spark, name):
    text = plan(Q.QUERIES[name](spark, SF0001))
    assert "SortAggregate" not in text and "documents" not in text, text
    assert len(re.findall("FileScan parquet", text)) == 1, text


def test_word_aggregation_is_a_hash_aggregate(spark):
    text = plan(word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"]))
    assert "SortAggregate" not in text and text.count("FileScan parquet") == 1, text


def test_training_partitions_follow_the_words(spark, monkeypatch):
    from tokenledger.operators import train as tr
    wt, _ = Q.materialize(word_table(tb.documents_corpus(spark, SF0001), ["source_ord", "doc_ord"]), "words")
    seen = []
    real = tr.num_partitions
    monkeypatch.setattr(tr, "num_partitions", lambda df: seen.append(real(df)) or seen[-1])
    monkeypatch.setattr(tr, "WORDS_PER_PARTITION", 1000)
    rules = tr.train_bpe(wt, 3, written=True).rules
    assert len(rules) == 3 and seen[0] < 27  # 27,782 words ask for 28 partitions whatever the cores
    monkeypatch.setattr(tr, "WORDS_PER_PARTITION", 20_000)
    assert tr.train_bpe(wt, 3, written=True).rules == rules


def test_concurrent_training_equals_sequential(spark):
    together = Q.trained_many(spark, SF0001, ["en_heavy", "balanced_fr"])
    assert together["balanced_fr"] == Q.train_documents(spark, SF0001, "balanced_fr")[0]
    assert together["en_heavy"] != together["balanced_fr"]


def test_spread_only_when_the_scan_is_narrow(spark):
    narrow = spark.range(100).coalesce(1)
    assert tb.spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert tb.spread(wide) is wide


def test_spread_deals_out_a_file_of_one_row_group(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from pyspark.sql import functions as F

    path = str(tmp_path / "one.parquet")
    pq.write_table(pa.table({"x": list(range(20_000)), "t": ["row " * 20 + str(i) for i in range(20_000)]}), path, row_group_size=20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        one = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert cores <= one.rdd.getNumPartitions() < tb._WIDE * cores  # many splits, one of them with all rows
        dealt = tb.spread(one)
        per = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(per) == cores and max(per) <= 2 * 20_000 / cores
        monkeypatch.setattr(tb, "_WIDE", 1)  # a wide scan is not looked into
        assert tb.spread(one) is one
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
